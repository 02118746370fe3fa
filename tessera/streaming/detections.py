"""The camera -> detection -> storage pipeline as Structured Streaming.

The reference moves JSON lines over TCP between three processes, buffers
rows under a lock and appends them to a CSV from timer threads. Here the
same steps are one streaming query:

* source: a directory of frame/detection records (parquet or JSON lines;
  a Kafka ``value`` + ``from_json`` gives the same plan), throttled with
  ``maxFilesPerTrigger``;
* per-record enrichment (:func:`tessera.operators.detections.detection_records`);
* sinks through ``foreachBatch``: each micro-batch is written to its own
  ``microbatch=<id>`` folder with ``overwrite``, so a batch replayed after a
  failure replaces its own output -- exactly once with the checkpoint,
  where the reference was at most once;
* "flush at 5 rows or every 10 s" is ``trigger(processingTime='10
  seconds')``, with ``maxRecordsPerFile`` on request; tests use
  ``availableNow``.

Checkpoints and outputs live under the cluster's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.detections import (
    FLUSH_ROWS,
    FLUSH_SECONDS,
    TICK_SLICES,
    Scorer,
    detection_records,
    results_table,
    score_frames,
)
from tessera.operators.sequence import rank_in_groups
from tessera.sources.special import b64decode
from tessera.session import path_exists, scratch_path
from tessera.streaming.totals import TotalsTable, stream_totals


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 1) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .format(fmt)
        .load(path)
    )


def _run(writer, trigger: str | None) -> StreamingQuery:
    if trigger is None:
        q = writer.trigger(availableNow=True).start()
    else:
        q = writer.trigger(processingTime=trigger).start()
    return q


def _batch_writer(out: str, write: Callable[[DataFrame, str], None]):
    def each(batch: DataFrame, batch_id: int) -> None:
        write(batch, f"{out}/microbatch={batch_id}")

    return each


def stream_person_counts(
    stream: DataFrame, out: str, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Stateless per-frame enrichment: ``frame_id, person_count, boxes,
    process_ms`` appended as parquet."""
    records = detection_records(stream).select("frame_id", "person_count", "boxes", "process_ms")
    writer = (
        records.writeStream.foreachBatch(
            _batch_writer(out, lambda b, p: b.write.mode("overwrite").parquet(p))
        ).option("checkpointLocation", checkpoint)
    )
    return _run(writer, trigger)


FRAME_SCHEMA = "frame_id long, timestamp double, image_b64 string"


def read_frame_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Camera frames as JSON lines ``{frame_id, timestamp, image_b64}``
    (the reference's wire format), decoded to ``frame_id, timestamp,
    image`` bytes."""
    raw = read_stream(spark, path, FRAME_SCHEMA, fmt="json", files_per_trigger=files_per_trigger)
    return raw.select("frame_id", "timestamp", b64decode("image_b64").alias("image"))


def stream_score_frames(
    frames: DataFrame,
    model_factory: Callable[[], Scorer],
    out: str,
    checkpoint: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Score each frame of a stream with the caller's model (one model per
    Python worker, Arrow batches) and append the detection records
    ``frame_id, timestamp, person_count, boxes, process_ms``."""
    scored = score_frames(frames, model_factory, keep=["timestamp"])
    writer = (
        scored.writeStream.foreachBatch(
            _batch_writer(out, lambda b, p: b.write.mode("overwrite").parquet(p))
        ).option("checkpointLocation", checkpoint)
    )
    return _run(writer, trigger)


def stream_flush_batches(
    stream: DataFrame,
    t0_micros: int,
    out: str,
    checkpoint: str,
    interval_seconds: int = FLUSH_SECONDS,
    max_rows: int = FLUSH_ROWS,
    source_cols: Sequence[str] = (),
    ticks_per_key: int = 64,
    trigger: str | None = None,
) -> StreamingQuery:
    """The "5 rows or 10 s" flush of every source as a stream.

    A row's position in its tick is the number of rows the source's tick has
    already seen plus its rank inside the micro-batch, and its write batch is
    ``(rn - 1) // max_rows`` -- the same numbers as the batch closed form
    :func:`tessera.operators.detections.flush_batches` when rows arrive in
    time order. Every row is numbered: a late one goes on counting where its
    tick stopped. Ranks are computed like the closed form's, so no source and
    no tick is put in one task.

    Each micro-batch files its rows per source and tick under the checkpoint
    folder, by spans of ``ticks_per_key`` ticks; a later one adds up those of
    the spans it touches. They are kept, as a late row may need them. A batch
    that is replayed replaces its own counts and sees only earlier ones.
    ``t0_micros`` is the timer start (epoch microseconds).
    """
    step = interval_seconds * 1_000_000
    micros = F.unix_micros(F.to_timestamp("ts")) - F.lit(t0_micros)
    tick, within = F.floor(micros / F.lit(step)).cast("long"), F.pmod(micros, F.lit(step))
    ticked = stream.select(
        *source_cols, "frame_id", F.to_timestamp("ts").alias("ts"), tick.alias("tick"),
        F.floor(within * TICK_SLICES / F.lit(step)).cast("int").alias("__t_slice"),
    )
    names = [*source_cols, "tick"]
    counts = f"{checkpoint}/flush-counts"
    span = F.coalesce(F.floor(F.col("tick") / F.lit(ticks_per_key)).cast("long"), F.lit(-1))

    def earlier(spark: SparkSession, spans: list[int], batch_id: int) -> DataFrame | None:
        if batch_id and not path_exists(spark, counts):
            raise ValueError(f"the counts of the batches before {batch_id} are not in {counts}")
        paths = [p for p in (f"{counts}/span={s}" for s in spans) if path_exists(spark, p)]
        if not paths:
            return None
        seen = spark.read.option("basePath", counts).parquet(*paths).filter(F.col("microbatch") < batch_id)
        return seen.groupBy(*names).agg(F.sum("__t_n").alias("__t_start"))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            spans = [r[0] for r in batch.select(span).distinct().collect()]
            start = earlier(batch.sparkSession, spans, batch_id)
            ranked = rank_in_groups(batch, names, "__t_slice", ["ts", "frame_id"], "__t_rank", start)
            ranked.select(
                *names[:-1], "frame_id", "tick",
                F.floor(F.col("__t_rank") / max_rows).cast("long").alias("batch"),
                (F.col("__t_rank") % max_rows).cast("int").alias("row_in_batch"),
            ).write.mode("overwrite").parquet(f"{out}/microbatch={batch_id}")
            own = batch.groupBy(*names).agg(F.count(F.lit(1)).alias("__t_n"))
            own = own.withColumns({"span": span, "microbatch": F.lit(batch_id)})
            own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("span", "microbatch").parquet(counts)
        finally:
            batch.unpersist()

    writer = ticked.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _run(writer, trigger)


def stream_running_total(
    stream: DataFrame, out: str, checkpoint: str, key: str = "source", trigger: str | None = None, buckets: int = 8
) -> StreamingQuery:
    """Running number of records per source: each micro-batch writes the new
    totals of the sources that it holds, and no others
    (:class:`tessera.streaming.totals.TotalsTable`)."""
    return stream_totals(stream, TotalsTable(stream.sparkSession, out, [key], buckets), checkpoint, trigger)


def read_running_total(spark: SparkSession, out: str, key: str = "source") -> DataFrame:
    """Current totals, one row a source."""
    return TotalsTable(spark, out, [key]).read()


def stream_results_sink(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    zone: str,
    replies: str | None = None,
    trigger: str | None = f"{FLUSH_SECONDS} seconds",
    max_rows_per_file: int | None = None,
) -> StreamingQuery:
    """Append the results CSV (``datetime_str`` and ``boxes_json`` added);
    optionally also write the per-frame reply records (two outputs from one
    stream, the batch is persisted once for both).

    The reference flushes after 5 rows or 10 s to bound the delay of one
    camera's rows. Here the trigger interval bounds the delay; a row cap per
    file (``max_rows_per_file``, e.g. ``FLUSH_ROWS``) is available but off by
    default, because at cluster rates it would write millions of tiny files.
    Which rows the reference would have written together is computed
    exactly by :func:`tessera.operators.detections.flush_batches`."""
    records = detection_records(stream)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            rows = results_table(batch, zone)
            w = rows.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
            if max_rows_per_file:
                w = w.option("maxRecordsPerFile", max_rows_per_file)
            w.csv(f"{out}/microbatch={batch_id}")
            if replies:
                batch.select("frame_id", "person_count", "boxes", "process_ms").write.mode("overwrite").json(
                    f"{replies}/microbatch={batch_id}"
                )
        finally:
            batch.unpersist()

    writer = records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _run(writer, trigger)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query, however long it takes, and surface
    its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def new_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    """Fresh (output, checkpoint) folders under the shared checkpoint dir."""
    base = scratch_path(spark, name)
    return f"{base}/out", f"{base}/checkpoint"


__all__ = [
    "new_paths",
    "read_frame_stream",
    "read_running_total",
    "read_stream",
    "run_to_end",
    "stream_flush_batches",
    "stream_person_counts",
    "stream_results_sink",
    "stream_running_total",
    "stream_score_frames",
]
