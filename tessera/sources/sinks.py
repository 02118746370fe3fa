"""Sinks: tab-separated key/value output, console report lines, the results
CSV (write and read back)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalars import ellipsis, fixed2, pad_right, parse_boxes_json

RESULTS_SCHEMA = T.StructType(
    [
        T.StructField("frame_id", T.LongType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("datetime_str", T.StringType()),
        T.StructField("person_count", T.IntegerType()),
        T.StructField("process_ms", T.DoubleType()),
        T.StructField("boxes_json", T.StringType()),
    ]
)


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", sort_by: Sequence[str] | None = None) -> None:
    """Key TAB value text lines from the first two columns, just as they are
    (one part file per task); a null is an empty field.

    ``sort_by`` gives the MapReduce output order: a range-partitioned sort,
    so part files are in key order (binary UTF-8 order, as Hadoop's Text
    keys) and each file is sorted.
    """
    if sort_by:
        df = df.orderBy(*sort_by)
    key, value = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns[:2])
    df.select(F.concat(key, F.lit("\t"), value)).write.mode(mode).text(path)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """``key, value`` of such lines; the key ends at the first tab."""
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).select(parts[0].alias("key"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("value"))


def write_results_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append rows to the results CSV directory with a header per part file.

    Quotes inside fields are doubled (``escape='"'``), as Python's csv
    writer does, so the JSON column survives a round trip.
    """
    (
        df.select(*RESULTS_SCHEMA.fieldNames())
        .write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_results_csv(spark: SparkSession, path: str, parse_boxes: bool = True) -> DataFrame:
    """Read a results CSV (ours or the reference's single file) with the
    fixed schema; ``boxes`` holds the decoded JSON column."""
    df = spark.read.csv(path, header=True, schema=RESULTS_SCHEMA, quote='"', escape='"', mode="FAILFAST")
    if parse_boxes:
        df = df.withColumn("boxes", parse_boxes_json("boxes_json"))
    return df


def report_cells(
    df: DataFrame,
    cells: Sequence[tuple[str, str, int | None]],
    order: Sequence[Column],
    limit: int | None = None,
    title_col: str | None = None,
) -> DataFrame:
    """Console-table rows as one ``line`` column, cells joined by `` | ``.

    Each cell is ``(column, kind, width)``: kind ``"s"`` is ``%-Ns`` (pad
    right, never truncate), ``"f2"`` is ``%.2f`` (``%-N.2f`` with a width),
    ``"d"`` is ``%d`` (``%-Nd``). A null number prints ``N/A``. ``title_col``
    is first cut to 35 chars + '...' when longer than 38. Rows are ordered
    by ``order`` (make it total) and cut to ``limit`` -- the report's row
    count is the feature.
    """
    out_cells = []
    for name, kind, width in cells:
        c = F.col(name)
        if kind == "s":
            text = c.cast("string")
            if title_col == name:
                text = ellipsis(text)
            text = F.coalesce(text, F.lit(""))
        elif kind == "f2":
            text = fixed2(c)
        elif kind == "d":
            text = F.when(c.isNull(), F.lit("N/A")).otherwise(c.cast("long").cast("string"))
        else:
            raise ValueError(f"unknown cell kind {kind!r}")
        out_cells.append(pad_right(text, width) if width else text)
    line = F.concat_ws(" | ", *out_cells)
    out = df.orderBy(*order)
    if limit is not None:
        out = out.limit(limit)
    return out.select(line.alias("line"))


def report_lines(
    df: DataFrame,
    text_cols: Sequence[tuple[str, int]],
    value_col: str,
    order: Sequence[Column],
    limit: int | None = None,
    title_col: str | None = None,
) -> DataFrame:
    """``%-Ns | %-Ms | %.2f`` rows (the gender and age reports): padded text
    columns followed by one ``%.2f`` value. See :func:`report_cells`."""
    cells = [(name, "s", width) for name, width in text_cols] + [(value_col, "f2", None)]
    return report_cells(df, cells, order, limit=limit, title_col=title_col)
