"""Joins that stay even when one key holds a large part of the rows.

Adaptive execution splits a skewed partition of a join at run time. Where it is
off, or its thresholds are too coarse, :func:`join_spread` does the same with
exact counts: the keys that hold more than a task's share of all rows are found
first, their side of the lookup is broadcast, and their rows are spread over all
tasks of the shuffle join in which the rest meets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.sequence import columns
from tessera.session import scratch_path


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(rows: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """(key, n) of every key with more than 1 / ``tasks`` of all rows that have
    one: fewer than ``tasks`` keys, whatever the data. Counts are exact, with
    partial aggregation; they are written once, to be read for the total too."""
    spark = rows.sparkSession
    tasks = tasks or shuffle_tasks(spark)
    path = scratch_path(spark, "key-counts")
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts.filter(F.col("n") * tasks > F.lit(total))


def join_spread(rows: DataFrame, dim: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``dim`` (unique on ``key``; other columns
    are added), hot keys by broadcast. Rows without a key are dropped, as in
    any inner join."""
    values = [c for c in dim.columns if c != key]
    hot = hot_keys(rows, key, tasks).select(F.col(key).alias("__t_hot"))
    side = lambda d, p: d.select(F.col(key).alias(f"__t_{p}k"), F.struct(*[F.col(c) for c in values]).alias(f"__t_{p}v"))
    # At most one row of the lookup for each hot key, so fewer than `tasks`.
    known = F.broadcast(side(dim.join(F.broadcast(hot), F.col(key) == F.col("__t_hot"), "left_semi"), "h"))
    a = rows.join(known, rows[key] == F.col("__t_hk"), "left")
    found = F.col("__t_hv").isNotNull()
    a = a.withColumn("__t_salt", F.when(found, F.xxhash64(F.monotonically_increasing_id())).otherwise(F.lit(0).cast("long")))
    # Zero, but not a constant: the optimizer would take it out of the join's keys.
    cold = side(dim, "c").withColumn("__t_zero", F.pmod(F.xxhash64("__t_ck"), F.lit(1)))
    out = a.join(cold, (a[key] == F.col("__t_ck")) & (F.col("__t_salt") == F.col("__t_zero")), "left")
    value = F.coalesce("__t_hv", "__t_cv")
    out = out.filter(value.isNotNull())
    return out.select(*columns(a, ("__t_hk", "__t_hv", "__t_salt")), *[value[c].alias(c) for c in values])
