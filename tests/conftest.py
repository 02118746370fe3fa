import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]",
        shuffle_partitions=8,
        app_name="tessera-tests",
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tessera-test-ckpt-")},
    )
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (optionally of selected columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((v is not None, v) for v in t))
