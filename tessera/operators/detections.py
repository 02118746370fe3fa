"""Person detections per frame: filters, counts, formats, batching, stats.

A detection record is one row per frame::

    frame_id long, ts timestamp, source long, process_ms double,
    raw_boxes array<struct<x1,y1,x2,y2 int, confidence double, cls int>>

``raw_boxes`` is what a model returned for the frame before the person /
confidence rule; :func:`person_boxes` applies it. Everything here is a
built-in expression, an aggregate or the distributed ranking of
:mod:`tessera.operators.sequence`; model scoring (the only Python in the
path) is in :func:`score_frames`.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalars import (
    BOX_FIELDS,
    BOXES_TYPE,
    boxes_json,
    epoch_seconds,
    local_datetime,
    round_half_even,
    truncate_int,
)
from tessera.operators.model_cache import model
from tessera.operators.sequence import rank_in_groups, same
from tessera.session import ship_package

# ---- fixed values of the reference pipeline ---------------------------------
MIN_CONFIDENCE = 0.40     # detections below this confidence are dropped
PERSON_CLASS = 0          # class index of "person"
FLUSH_ROWS = 5            # a batch is written when it holds 5 rows ...
FLUSH_SECONDS = 10        # ... or when the 10 s timer fires
CONFIDENCE_DIGITS = 4     # confidences are written with 4 digits ...
MS_DIGITS = 2             # ... and times with 2
RESULT_COLUMNS = ["frame_id", "timestamp", "datetime_str", "person_count", "process_ms", "boxes_json"]
# -----------------------------------------------------------------------------


def _is_person(b: Column, min_confidence: float, person_class: int) -> Column:
    return (b["cls"] == F.lit(person_class)) & (b["confidence"] >= F.lit(min_confidence))


def persons(raw_boxes: str | Column, min_confidence: float = MIN_CONFIDENCE,
            person_class: int = PERSON_CLASS) -> Column:
    """The person boxes of a frame (class and confidence rule), without the
    class field."""
    c = F.col(raw_boxes) if isinstance(raw_boxes, str) else raw_boxes
    kept = F.filter(c, lambda b: _is_person(b, min_confidence, person_class))
    return F.transform(kept, lambda b: F.struct(*[b[f].alias(f) for f in BOX_FIELDS]))


def person_boxes(det: DataFrame, min_confidence: float = MIN_CONFIDENCE,
                 person_class: int = PERSON_CLASS) -> DataFrame:
    """One row per kept box: ``frame_id, box_index`` (position in the model
    output) ``, x1, y1, x2, y2, confidence``."""
    # The outer form keeps Spark from inferring a "non-empty array" filter
    # that it would push into the producer of raw_boxes and evaluate twice;
    # the null row of an empty frame fails the person rule anyway.
    return (
        det.select("frame_id", F.posexplode_outer("raw_boxes").alias("box_index", "b"))
        .filter(F.col("b").isNotNull() & _is_person(F.col("b"), min_confidence, person_class))
        .select("frame_id", "box_index", *[F.col(f"b.{f}").alias(f) for f in BOX_FIELDS])
    )


def _written(b: Column) -> Column:
    """A box as it is written: whole coordinates, a rounded confidence."""
    corners = [truncate_int(b[f]).alias(f) for f in BOX_FIELDS[:4]]
    return F.struct(*corners, round_half_even(b["confidence"], CONFIDENCE_DIGITS).alias("confidence"))


def detection_records(det: DataFrame, min_confidence: float = MIN_CONFIDENCE,
                      person_class: int = PERSON_CLASS) -> DataFrame:
    """The record sent downstream per frame: ``frame_id, timestamp`` (epoch
    seconds) ``, person_count, boxes, process_ms`` -- the count is the number
    of kept boxes; confidences and times are rounded as the producer does."""
    kept = persons("raw_boxes", min_confidence, person_class)
    return det.select(
        "frame_id",
        epoch_seconds("ts").alias("timestamp"),
        F.size(kept).alias("person_count"),
        F.transform(kept, _written).alias("boxes"),
        round_half_even("process_ms", MS_DIGITS).alias("process_ms"),
        "source",
        "ts",
    )


def person_count(det: DataFrame) -> DataFrame:
    """``frame_id, person_count`` for every frame (0 when nobody is seen)."""
    return detection_records(det).select("frame_id", "person_count")


def frame_datetime(records: DataFrame, zone: str) -> DataFrame:
    """``frame_id, timestamp, datetime_str``: the epoch time as local wall
    time in ``zone`` (``yyyy-MM-dd HH:mm:ss``)."""
    return records.select("frame_id", "timestamp", local_datetime("timestamp", zone).alias("datetime_str"))


def results_table(records: DataFrame, zone: str) -> DataFrame:
    """Rows of the results file: the record plus ``datetime_str`` and the
    boxes as JSON text."""
    return records.select(
        "frame_id",
        "timestamp",
        local_datetime("timestamp", zone).alias("datetime_str"),
        "person_count",
        F.coalesce(F.col("process_ms"), F.lit(0.0)).alias("process_ms"),
        boxes_json(F.coalesce(F.col("boxes"), F.array().cast(BOXES_TYPE))).alias("boxes_json"),
    )


def frame_stats(records: DataFrame) -> DataFrame:
    """Frames, mean and maximum person count: one row."""
    return records.agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.avg("person_count").alias("avg_person_count"),
        F.max("person_count").alias("max_person_count"),
    )


TICK_SLICES = 1024  # parts of a tick that are ranked side by side


def flush_batches(
    records: DataFrame,
    t0: Column,
    interval_seconds: int = FLUSH_SECONDS,
    max_rows: int = FLUSH_ROWS,
    source_cols: Sequence[str] = (),
) -> DataFrame:
    """Which write batch each record lands in under "flush at ``max_rows``
    rows or on every ``interval_seconds`` tick".

    The timer empties the buffer at each tick, so counting restarts per
    tick: ``tick = floor((t - t0) / interval)``, ``rn`` = arrival rank inside
    the tick (ties by frame id), ``batch = floor((rn - 1) / max_rows)``. A row
    exactly on a tick belongs to the new tick. ``t0`` is the timer start
    (a timestamp column, e.g. a scalar subquery). The rank is computed
    without sending a tick to one task: a tick is cut into ``TICK_SLICES``
    slices of time (:func:`tessera.operators.sequence.rank_in_groups`).

    Output: ``frame_id, tick, batch, row_in_batch`` (+ ``source_cols``).
    """
    micros = F.unix_micros(F.to_timestamp("ts")) - F.unix_micros(F.to_timestamp(t0))
    step = interval_seconds * 1_000_000
    tick, within = F.floor(micros / F.lit(step)).cast("long"), F.pmod(micros, F.lit(step))
    ticked = records.select(
        *source_cols, "frame_id", "ts", tick.alias("tick"), F.floor(within * TICK_SLICES / F.lit(step)).cast("int").alias("slice")
    )
    ranked = rank_in_groups(ticked, [*source_cols, "tick"], "slice", ["ts", "frame_id"], "rank")
    return ranked.select(
        *source_cols,
        "frame_id",
        "tick",
        F.floor(F.col("rank") / max_rows).cast("long").alias("batch"),
        (F.col("rank") % max_rows).cast("int").alias("row_in_batch"),
    )


def latency_stats(
    records: DataFrame,
    group_cols: Sequence[str] = ("source",),
    percentiles: Sequence[float] = (0.5, 0.95),
    ms_scale: int = 2,
) -> DataFrame:
    """Per group: frames, mean / min / max ``process_ms`` and exact
    discrete percentiles (the smallest value with at least ``p`` of the
    group at or below it: rank ``ceil(p * n)``).

    Times are recorded at ``10**-ms_scale`` ms (the producer rounds them),
    so the mean is summed exactly as a decimal at that scale; it does not
    depend on the order in which partitions are added up.

    Exact percentiles come from counts per distinct value, added up in value
    order: rows are reduced by partial aggregation before anything moves, and
    a group brings as many rows to a task as it has distinct values.
    """
    group_cols = list(group_cols)
    valued = records.filter(F.col("process_ms").isNotNull()).select(*group_cols, "frame_id", "process_ms")
    exact = F.col("process_ms").cast(f"decimal(18,{ms_scale})")
    basic = valued.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_frames"),
        (F.sum(exact).cast("double") / F.count(F.lit(1))).alias("avg_ms"),
        F.min("process_ms").alias("min_ms"),
        F.max("process_ms").alias("max_ms"),
    )
    values = valued.groupBy(*group_cols, "process_ms").agg(F.count(F.lit(1)).alias("k"))
    up_to = Window.partitionBy(*group_cols).orderBy("process_ms").rowsBetween(Window.unboundedPreceding, 0)
    ranked = values.withColumn("last", F.sum("k").over(up_to))
    totals = basic.select(*[F.col(c).alias(f"_g_{c}") for c in group_cols], "n_frames")
    both = ranked.join(totals, same((ranked[c], totals[f"_g_{c}"]) for c in group_cols))
    # The smallest value whose running count reaches the rank.
    reached = lambda p: F.col("last") >= F.greatest(F.lit(1), F.ceil(F.col("n_frames") * F.lit(p)))
    names = [f"p{int(round(p * 100)):02d}_ms" for p in percentiles]
    picked = both.groupBy(*group_cols).agg(
        *[F.min(F.when(reached(p), F.col("process_ms"))).alias(n) for p, n in zip(percentiles, names)]
    )
    picked = picked.select(*[F.col(c).alias(f"_g_{c}") for c in group_cols], *names)
    joined = basic.join(picked, same((basic[c], picked[f"_g_{c}"]) for c in group_cols))
    return joined.select(*basic.columns, *names)


# ------------------------------------------------------------ model scoring --

Scorer = Callable[[list[bytes]], list[list[dict]]]

SCORED_SCHEMA = T.StructType(
    [
        T.StructField("frame_id", T.LongType()),
        T.StructField("person_count", T.IntegerType()),
        T.StructField("boxes", BOXES_TYPE),
        T.StructField("process_ms", T.DoubleType()),
    ]
)


def score_frames(
    frames: DataFrame,
    model_factory: Callable[[], Scorer],
    image_col: str = "image",
    keep: Sequence[str] = (),
    batch_size: int = 32,
    model_key: str | None = None,
) -> DataFrame:
    """Run a detection model over ``frame_id, image`` rows.

    ``model_factory()`` builds the model once per Python worker; the model
    maps a list of at most ``batch_size`` images (bytes) to a list of person
    boxes ``{x1, y1, x2, y2, confidence}`` for each. ``process_ms`` is a
    frame's share of its call. Coordinates lose their fractions, confidences
    are rounded to 4 digits and times to 2. Columns named in ``keep`` pass
    through. Calls that share a ``model_key`` share the workers' models.
    """
    ship_package(frames.sparkSession)
    key = model_key or uuid.uuid4().hex
    keep = list(keep)
    raw = "array<struct<x1:double,y1:double,x2:double,y2:double,confidence:double>>"
    kept = [frames.schema[c] for c in keep]
    schema = T.StructType(
        [SCORED_SCHEMA["frame_id"], *kept, T.StructField("boxes", T._parse_datatype_string(raw)), SCORED_SCHEMA["process_ms"]]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = model(key, model_factory)
        for pdf in batches:
            for at in range(0, len(pdf), batch_size):
                part = pdf.iloc[at : at + batch_size]
                images = [bytes(i) if i is not None else b"" for i in part[image_col]]
                t0 = time.perf_counter()
                found = score(images)
                ms = (time.perf_counter() - t0) * 1000 / len(images)
                out = {"frame_id": part["frame_id"].array, **{c: part[c].array for c in keep}}
                out["boxes"] = [[{f: float(b[f]) for f in BOX_FIELDS} for b in boxes] for boxes in found]
                yield pd.DataFrame(out | {"process_ms": ms})

    scored = frames.select("frame_id", *keep, image_col).mapInPandas(run, schema)
    return scored.select(
        "frame_id",
        *keep,
        F.size("boxes").alias("person_count"),
        F.transform("boxes", _written).alias("boxes"),
        round_half_even("process_ms", MS_DIGITS).alias("process_ms"),
    )


def byte_length_scorer() -> Scorer:
    """A deterministic stand-in model for tests: ``len(image) % 5`` boxes."""

    def score(images: list[bytes]) -> list[list[dict]]:
        return [[{"x1": j, "y1": j, "x2": j + 10, "y2": j + 10, "confidence": 0.5} for j in range(len(i) % 5)] for i in images]

    return score
