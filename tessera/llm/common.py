"""Helpers shared by the operators: frozen tables, and lookups that spread
hot keys.

Internal columns start with ``__t_``; operators select the input columns they
need before adding them, so other columns of the input never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.sequence import columns, same
from tessera.session import scratch_path

#: Bounds of :func:`hot_share`.
HOT_SHARE, MOST_HOT = 1000, 20_000
ROW = "__t_row"
_PLACE = 33  # bits of monotonically_increasing_id below the partition


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_share(spark: SparkSession) -> int:
    """A key is hot when it holds more than 1 / ``hot_share`` of all rows, so
    there are fewer hot keys than that: the bound of every broadcast of them.
    It follows the number of tasks, so that a key below it is no more than half
    of a task's rows, up to ``MOST_HOT`` keys."""
    return min(MOST_HOT, max(HOT_SHARE, 2 * shuffle_width(spark)))


def materialize(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it
    back: the lineage ends here, and a lost executor costs no recomputation
    of what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def freeze(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """:func:`materialize` with a unique number per row (column ``ROW``), so
    that repeated rows stay apart from here on."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), name, codec)


def partition_and_place(row: Column) -> tuple[Column, Column]:
    """The partition of a row's number, and its place there (gapless from 0)."""
    return F.shiftright(row, _PLACE), row.bitwiseAND((1 << _PLACE) - 1)


def place_in_order(rows: DataFrame, groups: list[str], order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``__t_pos`` (place in the group, from 0) and ``__t_total``
    (rows of the group). Groups and rows are dealt by ranges of their order,
    repeated rows too, so neither a hot group nor a hot value is in one task;
    a row's number says its partition and place, and partitions are added up."""
    spark = rows.sparkSession
    rows = freeze(rows, name)
    keys = [*[F.col(g).asc_nulls_first() for g in groups], *order, F.col(ROW)]
    dealt = rows.repartitionByRange(2 * shuffle_width(spark), *keys).sortWithinPartitions(*keys).drop(ROW)
    dealt = freeze(dealt, f"ordered-{name}")
    part, place = partition_and_place(F.col(ROW))
    dealt = dealt.withColumns({"__t_part": part, "__t_in": place}).drop(ROW)
    # A row for each partition and group in it.
    named = [F.col(g).alias(f"__t_g{i}") for i, g in enumerate(groups)]
    counts = dealt.groupBy(*named, F.col("__t_part").alias("__t_p")).agg(F.count(F.lit(1)).alias("n"), F.min("__t_in").alias("first"))
    own = [f"__t_g{i}" for i in range(len(groups))]
    of_group = Window.partitionBy(*own)
    before = F.coalesce(F.sum("n").over(of_group.orderBy("__t_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*own, "__t_p", (before - F.col("first")).alias("__t_off"), F.sum("n").over(of_group).alias("__t_total"))
    on = same([(dealt[g], counts[o]) for g, o in zip(groups, own, strict=True)]) & (dealt["__t_part"] == counts["__t_p"])
    joined = dealt.join(counts, on)
    return joined.withColumn("__t_pos", F.col("__t_in") + F.col("__t_off")).drop(*own, "__t_p", "__t_part", "__t_in", "__t_off")


def unit(seed, *cols: Column) -> Column:
    """A uniform number in [0, 1) that depends on the seed and columns only."""
    h = F.xxhash64(*[c if isinstance(c, Column) else F.lit(c) for c in (seed, *cols)])
    return F.shiftrightunsigned(h, 11) * F.lit(2.0**-53)


def skew_lookup(rows: DataFrame, table: DataFrame, keys: list[str], n: str, values: list[str], how: str = "left") -> DataFrame:
    """Join ``rows`` with the frozen ``table`` (unique ``keys``; ``n`` is the
    number of rows with that key), adding ``values``.

    Keys with more than 1 / :func:`hot_share` of all rows are broadcast; their
    rows are then spread over all tasks. The rest meet in an ordinary shuffle
    join in which no key is hot.
    """
    share = hot_share(rows.sparkSession)
    total = table.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    hot_rows = F.col(n) * share > F.lit(total)
    named = lambda side, p: side.select(
        *[F.col(k).alias(f"__t_{p}k{i}") for i, k in enumerate(keys)], F.struct(*values).alias(f"__t_{p}v")
    )
    hot, cold = named(table.filter(hot_rows), "h"), named(table.filter(~hot_rows), "c")
    a = rows.join(F.broadcast(hot), same((rows[k], hot[f"__t_hk{i}"]) for i, k in enumerate(keys)), "left")
    salt = F.when(F.col("__t_hv").isNotNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.lit(0))
    a = a.withColumn("__t_salt", salt)
    # Zero, but not a constant: the optimizer would take it out of the join's keys.
    cold = cold.withColumn("__t_csalt", F.pmod(F.xxhash64("__t_ck0"), F.lit(1)))
    on = same([(a[k], cold[f"__t_ck{i}"]) for i, k in enumerate(keys)]) & (a["__t_salt"] == cold["__t_csalt"])
    found = F.coalesce(F.col("__t_hv"), F.col("__t_cv"))
    out = a.join(cold, on, "left")
    if how == "inner":
        out = out.filter(found.isNotNull())
    return out.select(*columns(a, ("__t_hv", "__t_salt", *(f"__t_hk{i}" for i in range(len(keys))))), *[found[v].alias(v) for v in values])


def keep_rows(docs: DataFrame, chosen: DataFrame, identity: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` whose identity expressions equal a row of ``chosen``
    (columns named like ``identity``), one row for each of them."""
    temp = {k: f"__t_id_{k}" for k in identity}
    tagged = docs.withColumns({temp[k]: e for k, e in identity.items()})
    keys = chosen.select(*[F.col(k).alias(f"__t_ch_{k}") for k in identity]).distinct()
    on = same((tagged[temp[k]], keys[f"__t_ch_{k}"]) for k in identity)
    return tagged.join(keys, on, "left_semi").dropDuplicates(list(temp.values())).drop(*temp.values())
