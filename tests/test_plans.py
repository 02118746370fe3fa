"""Physical-plan properties the scale design relies on."""

import contextlib
import io

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def plan(spark, key):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[key](spark, SF_SMALL).explain("formatted")
    return buf.getvalue()


def test_top_k_is_limited_before_the_shuffle(spark):
    p = plan(spark, "category_top_words")
    # a partial WindowGroupLimit below the exchange, a final one above it
    assert p.count("WindowGroupLimit") >= 2


def test_year_filter_reaches_the_parquet_scan(spark):
    p = plan(spark, "revenue_by_category")
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_tokenizer_has_no_lambda(spark):
    p = plan(spark, "word_frequency")
    assert "lambdafunction" not in p


def test_global_top1_needs_no_window_or_sort(spark):
    p = plan(spark, "best_movie")
    assert "Window" not in p and "TakeOrderedAndProject" not in p


def test_scans_read_only_needed_columns(spark):
    p = plan(spark, "rating_count")
    assert "ReadSchema: struct<l_partkey:bigint>" in p


def test_ranks_and_percentiles_read_no_checkpoint(spark):
    for key in ("flush_batches", "latency_stats"):
        assert "ExistingRDD" not in plan(spark, key)


def test_a_cluster_without_a_shared_folder_is_an_error():
    import types

    import pytest

    from tessera.session import ensure_checkpoint_dir

    context = types.SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = types.SimpleNamespace(sparkContext=context, conf={})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)
