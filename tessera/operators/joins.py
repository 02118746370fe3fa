"""Join helpers: lookups with defaults, unique dimensions.

No side is broadcast by hint: Catalyst broadcasts a side whose files are below
``spark.sql.autoBroadcastJoinThreshold``, AQE one whose measured shuffle output
is, and a larger one is joined by shuffle with skewed partitions split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def unique_by_key(dim: DataFrame, key: str, order_col: str | Column) -> DataFrame:
    """One row per ``key``: the one with the greatest ``order_col``.

    This is the table form of "last duplicate wins" of a driver-side map;
    it keeps a join against the dimension from multiplying fact rows.
    The aggregate leaves the result hash-partitioned by ``key``, so the join
    that follows reuses that partitioning.
    """
    others = [c for c in dim.columns if c != key]
    order = F.col(order_col) if isinstance(order_col, str) else order_col
    best = F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_best")
    return dim.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in others])


def lookup_with_default(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    value: str,
    default: Column,
    output: str | None = None,
) -> DataFrame:
    """Left-join ``dim.value`` onto ``fact`` by ``key``; misses get ``default``.

    ``default`` is a column expression so it may depend on the key, e.g.
    ``concat('Unknown (', key, ')')``.
    """
    out = output or value
    side = dim.select(F.col(key), F.col(value).alias("_lookup_value"))
    joined = fact.join(side, on=key, how="left")
    return joined.withColumn(out, F.coalesce(F.col("_lookup_value"), default)).drop("_lookup_value")
