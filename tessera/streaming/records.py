"""JSON lines as records, with a quarantine for those that are none.

The storage process of the reference reads one JSON object a line and drops
the connection at the first line that it cannot read. Here every line ends in
one of two tables: records in one, broken or incomplete lines in the other,
with the reason, the file and the line itself. Both go through commit logs with
the same batch numbers, so a batch that is replayed (after a failure before,
between or after the two commits) leaves each line in exactly one place, and the
two counts add up to the lines read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.scalars import BOXES_TYPE
from tessera.streaming.append_table import AppendTable

#: What a camera sends, and what the detection process sends on.
FRAME_RECORD = "frame_id long, timestamp double, image_b64 string"
DETECTION_RECORD = T.StructType(
    [
        T.StructField("frame_id", T.LongType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("person_count", T.IntegerType()),
        T.StructField("process_ms", T.DoubleType()),
        T.StructField("boxes", BOXES_TYPE),
    ]
)
# Fields without a default in the storage process.
DETECTION_REQUIRED = ("frame_id", "timestamp", "person_count")

EMPTY, NOT_JSON, NOT_OBJECT, BAD_VALUE, MISSING = "empty line", "not JSON", "not an object", "bad value", "missing "
_BAD = "__t_bad"


def read_line_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Lines as they are (``value``) with the ``file`` they come from."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def _whole(value: Column) -> Column:
    """Whether the text is one JSON value and nothing else. The parser stops
    behind the first value; inside a list and inside an object it does not, and
    no other text fits both."""
    inside = [F.concat(F.lit(a), value, F.lit(b)) for a, b in (("[", "]"), ('{"v":', "}"))]
    return F.try_parse_json(inside[0]).isNotNull() & F.try_parse_json(inside[1]).isNotNull()


def parse_records(lines: DataFrame, schema: T.StructType | str, required: Sequence[str] = (), col: str = "value") -> DataFrame:
    """``lines`` with ``record`` (a struct, null for a broken line) and
    ``reason`` (null for a good one). A required field must be there and not
    null; a field of another type than the schema's breaks its line; fields
    that the schema does not name are ignored. NaN, a name that an object has
    twice and text behind the object are no JSON."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    value = F.col(col)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = F.from_json(value, T.StructType([*wanted.fields, T.StructField(_BAD, T.StringType())]), options)
    bare = F.trim(F.regexp_replace(value, "[\\t\\r\\n]", " "))
    out = lines.withColumn("__t_record", parsed)
    found = F.col("__t_record")
    reason = (
        F.when(value.isNull() | (F.length(bare) == 0), EMPTY)
        .when(~_whole(value), NOT_JSON)
        .when(~bare.startswith("{"), NOT_OBJECT)
        .when(found.isNull() | found[_BAD].isNotNull(), BAD_VALUE)
    )
    for name in required:
        reason = reason.when(found[name].isNull(), MISSING + name)
    out = out.withColumn("reason", reason)
    fields = F.struct(*[found[f.name].alias(f.name) for f in wanted])
    return out.withColumn("record", F.when(F.col("reason").isNull(), fields)).drop("__t_record")


def stream_records(
    lines: DataFrame,
    schema: T.StructType | str,
    good: AppendTable,
    bad: AppendTable,
    checkpoint: str,
    required: Sequence[str] = (),
    check: Column | None = None,
    trigger: str | None = None,
) -> StreamingQuery:
    """Records of ``lines`` (value, file) into ``good`` (the schema's columns),
    other lines into ``bad`` (value, file, reason).

    ``check`` may name further reasons: a text column over the record's fields
    that is null for a good one."""

    def each(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_records(batch, schema, required)
        if check is not None:
            flat = parsed.select("*", "record.*").withColumn("reason", F.coalesce("reason", check))
            parsed = flat.select(*parsed.columns)
        parsed = parsed.persist()
        try:
            good.append(parsed.filter("reason is null").select("record.*"), batch_id)
            bad.append(parsed.filter("reason is not null").select("value", "file", "reason"), batch_id)
        finally:
            parsed.unpersist()

    writer = lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)).start()


def undecodable(col: str = "image_b64") -> Column:
    """A reason for texts that are no base64."""
    return F.when(F.try_to_binary(F.col(col), F.lit("base64")).isNull(), F.lit("bad " + col))
