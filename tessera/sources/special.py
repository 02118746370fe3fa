"""Binary payloads: base64 transport of frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def b64encode(c: str | Column) -> Column:
    """Base64 without line breaks (Python's ``b64encode``), whatever the
    session's MIME-chunking setting is."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.base64(col), "[\\r\\n]", "")


def b64decode(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.unbase64(col)


def base64_roundtrip(frames: DataFrame, image_col: str = "image") -> DataFrame:
    """``frame_id, n_bytes, b64, roundtrip_ok``: encode each frame's bytes
    as base64 text (as the camera sends it) and check that decoding gives
    the same bytes back."""
    img = F.col(image_col)
    enc = b64encode(img)
    return frames.select(
        "frame_id",
        F.octet_length(img).cast("int").alias("n_bytes"),
        enc.alias("b64"),
        (b64decode(enc) == img).alias("roundtrip_ok"),
    )
