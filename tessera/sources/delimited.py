"""Delimited text sources with the reference's line rules.

Lines are read with ``spark.read.text`` (one row per line, split across
tasks by file blocks) and parsed with column expressions; nothing is
collected to the driver. The Java rules that change results are kept:
trailing empty fields do not count towards the arity guard, fields are
trimmed of control characters, and a ``limit`` split keeps the rest of the
line in its last field.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import java_split, java_trim


LINE = "__line"


def read_lines(spark: SparkSession, paths: str | Sequence[str], numbered: bool = False) -> DataFrame:
    """All lines of one or several files/directories as one ``value``
    column (several paths are one table, as ``textFile("a,b")``). With
    ``numbered``, column ``LINE`` puts them in file order."""
    lines = spark.read.text(list(paths) if not isinstance(paths, str) else paths)
    if not numbered:
        return lines
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    return lines.select("value", place.alias(LINE))


def drop_header_lines(lines: DataFrame, header: str, col: str = "value") -> DataFrame:
    """Drop every line equal to ``header`` (all copies, as the reference's
    first-line filter does). The header is a parameter: it is never taken
    from "the first line", which has no meaning for a split file."""
    return lines.filter(F.col(col) != F.lit(header))


#: One row a file is broadcast up to so many files; more meet by shuffle.
BROADCAST_FILES = 100_000


def drop_file_headers(lines: DataFrame, is_header: Column | None = None, col: str = "value") -> DataFrame:
    """Drop the first line of every file, and no other line, however equal to
    it. ``lines`` are numbered (:func:`read_lines`); the first line of a file is
    the one with the smallest block and number, whichever task reads it.

    With ``is_header`` (a condition on the line) the first line goes only
    where the condition holds, for files of which some have a header.
    """
    files = F.col(LINE + ".file_path").alias("__file")
    first = lines.groupBy(files).agg(F.min(LINE).alias("__first"), F.min_by(col, LINE).alias(col))
    if is_header is not None:
        first = first.filter(is_header)
    first = first.select("__first")
    if len(lines.inputFiles()) <= BROADCAST_FILES:
        first = F.broadcast(first)
    return lines.join(first, F.col(LINE) == F.col("__first"), "left_anti")


def unlike_types(columns: Sequence[str], types: dict[str, T.DataType | str], sep: str = ",", col: str = "value") -> Column:
    """A condition for :func:`drop_file_headers`: a field of a typed column is
    there and is not of its type, as a column's name is not a number."""
    parts = java_split(col, sep)
    fields = {c: java_trim(F.get(parts, F.lit(i))) for i, c in enumerate(columns)}
    wrong = [(F.length(fields[c]) > 0) & fields[c].try_cast(t).isNull() for c, t in types.items()]
    return F.coalesce(reduce(lambda a, b: a | b, wrong), F.lit(False))


def number_lines(lines: DataFrame, out: str = "position") -> DataFrame:
    """Numbered lines (:func:`read_lines`) with their place in the whole input
    from 0: files in the order of their names, lines in the order of each file.

    Lines of a file block are read by one task in order, so a block's count and
    first number give every line its place; only a row a block is added up.
    """
    named = lines.withColumns({"__file": F.col(LINE + ".file_path"), "__block": F.col(LINE + ".file_block_start"), "__no": F.col(LINE + ".line")})
    blocks = named.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("n"), F.min("__no").alias("first"))
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        F.col("__file").alias("__f"), F.col("__block").alias("__b"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("__off")
    )
    joined = named.join(offsets, (F.col("__file") == F.col("__f")) & (F.col("__block") == F.col("__b")))
    return joined.select(*lines.columns, (F.col("__no") + F.col("__off")).alias(out))


def parse_delimited(
    lines: DataFrame,
    columns: Sequence[str],
    sep: str = ",",
    min_fields: int | None = None,
    limit: int = -1,
    types: dict[str, T.DataType | str] | None = None,
    strict: bool = True,
    col: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Split each line on ``sep`` and name the first ``len(columns)`` fields.

    * lines with fewer than ``min_fields`` fields (default: ``len(columns)``)
      are skipped, counting fields the Java way (trailing empties dropped;
      kept when ``limit`` > 0);
    * every field is trimmed like ``String.trim()``;
    * ``types`` casts named columns; ``strict=True`` fails the job on a bad
      number (ANSI cast), ``strict=False`` turns it into null;
    * columns of ``lines`` named in ``keep`` pass through.
    """
    need = len(columns) if min_fields is None else min_fields
    parts = java_split(col, sep, limit)
    arr = lines.select(*keep, parts.alias("_f")).filter(F.size("_f") >= need)
    out = [F.col(c) for c in keep]
    for i, name in enumerate(columns):
        field = java_trim(F.get(F.col("_f"), i))
        if types and name in types:
            dtype = types[name]
            field = field.cast(dtype) if strict else field.try_cast(dtype)
        out.append(field.alias(name))
    return arr.select(*out)


def rejected_lines(
    lines: DataFrame,
    columns: Sequence[str],
    sep: str = ",",
    min_fields: int | None = None,
    limit: int = -1,
    types: dict[str, T.DataType | str] | None = None,
    col: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The lines that :func:`parse_delimited` skips, or ends at when strict:
    ``value, n_fields, reason`` (``few fields`` or ``bad <column>``, the first of
    them). With its rows they make up all lines."""
    need = len(columns) if min_fields is None else min_fields
    parts = lines.select(*keep, F.col(col).alias("value"), java_split(col, sep, limit).alias("_f"))
    reason = F.when(F.size("_f") < need, F.lit("few fields"))
    for i, name in enumerate(columns):
        if types and name in types:
            field = java_trim(F.get(F.col("_f"), i))
            reason = reason.when(field.isNotNull() & field.try_cast(types[name]).isNull(), F.lit(f"bad {name}"))
    return parts.select(*keep, "value", F.size("_f").alias("n_fields"), reason.alias("reason")).filter(F.col("reason").isNotNull())


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """A stop-word file (one entry per line, UTF-8) as a one-column
    DataFrame ``word``: trimmed, lower-cased, blanks and repeats dropped.
    The text operators take it as it is."""
    lines = spark.read.option("encoding", "UTF-8").text(path)
    return (
        lines.select(F.lower(java_trim("value")).alias("word"))
        .filter(F.length("word") > 0)
        .distinct()
    )


def read_semicolon_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The columns of ``schema`` from a ``;``-separated CSV with a header
    line. Columns are found by their header names (in any case and order,
    others are ignored) and cast as the schema says; a missing one is an
    error. No inference pass over the data."""
    raw = spark.read.csv(path, sep=";", header=True, escape='"')
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    at = {c.strip().lower(): c for c in raw.columns}
    missing = [f.name for f in wanted if f.name.lower() not in at]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {raw.columns}")
    return raw.select(*[raw["`" + at[f.name.lower()] + "`"].cast(f.dataType).alias(f.name) for f in wanted])
