"""Column types of delimited text, inferred from all rows.

The types form a lattice: ``int`` < ``bigint`` < ``decimal`` (whole numbers of up
to 38 digits) < ``double``; ``timestamp`` and ``boolean`` stand beside them, and
every value is a ``string``. One distributed aggregate counts, for every column
and type, the values that break the type; the narrowest type that none breaks
is the column's. Every row counts, so a surprise in the last line of the last
file widens the type, and the counts tell how many values stand in the way of a
narrower one.

Empty fields are null and break nothing; a column of nulls only is a string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import java_trim

# From the narrowest to the widest; the order in which they are tried.
TYPES = ("int", "bigint", "decimal", "double", "timestamp", "boolean")
TEXT = "string"
DDL = {"decimal": "decimal(38,0)"}


def _parses(value: Column, kind: str) -> Column:
    if kind in ("int", "bigint"):
        # A cast would round "1.5" in some modes; only digits are whole numbers.
        return value.rlike("^[+-]?[0-9]+$") & value.try_cast(kind).isNotNull()
    if kind == "decimal":
        return value.rlike("^[+-]?0*[0-9]{1,38}$")
    if kind == "timestamp":
        return value.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}") & F.try_to_timestamp(value).isNotNull()
    if kind == "boolean":
        return F.lower(value).isin("true", "false")
    return value.try_cast(kind).isNotNull()


def type_report(raw: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A row for each column of ``raw`` (texts): position, column, type, values,
    nulls, and ``breaks``, the number of values that are not of each type."""
    columns = list(columns or raw.columns)
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    parts = []
    for i, c in enumerate(columns):
        value = java_trim(quoted(c))
        there = value.isNotNull() & (F.length(value) > 0)
        parts.append(F.count_if(there).alias(f"v{i}"))
        parts += [F.count_if(there & ~F.coalesce(_parses(value, t), F.lit(False))).alias(f"b{i}_{t}") for t in TYPES]
    counts = raw.agg(F.count(F.lit(1)).alias("n"), *parts)  # one row

    def row(i: int, c: str) -> Column:
        values = F.col(f"v{i}")
        kind = F.when(values == 0, F.lit(TEXT))
        for t in TYPES:
            kind = kind.when(F.col(f"b{i}_{t}") == 0, F.lit(DDL.get(t, t)))
        breaks = F.struct(*[F.col(f"b{i}_{t}").alias(t) for t in TYPES])
        return F.struct(
            F.lit(i).alias("position"), F.lit(c).alias("column"), kind.otherwise(F.lit(TEXT)).alias("type"),
            values.alias("values"), (F.col("n") - values).alias("nulls"), breaks.alias("breaks"),
        )

    return counts.select(F.inline(F.array(*[row(i, c) for i, c in enumerate(columns)])))


def read_raw_csv(spark: SparkSession, path: str | Sequence[str], sep: str = ";") -> DataFrame:
    """A delimited file with a header line as texts."""
    paths = path if isinstance(path, str) else list(path)
    return spark.read.csv(paths, sep=sep, header=True, escape='"')


def inferred_schema(raw: DataFrame) -> T.StructType:
    kinds = {r["column"]: r["type"] for r in type_report(raw).select("column", "type").collect()}  # a row a column
    return T.StructType([T.StructField(c, T._parse_datatype_string(kinds[c])) for c in raw.columns])


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """``raw`` cast to a schema with the same names. A value that does not fit
    ends the job: after :func:`inferred_schema` there is none."""
    out = []
    for f in schema.fields:
        text = F.col("`" + f.name.replace("`", "``") + "`")
        value = java_trim(text)
        value = F.when(F.length(value) > 0, value)
        out.append((text if isinstance(f.dataType, T.StringType) else value.cast(f.dataType)).alias(f.name))
    return raw.select(*out)


def read_inferred_csv(spark: SparkSession, path: str | Sequence[str], sep: str = ";") -> DataFrame:
    """A delimited file with a header line, its columns typed by their values."""
    raw = read_raw_csv(spark, path, sep)
    return typed(raw, inferred_schema(raw))
