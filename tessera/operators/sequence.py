"""Exact positions inside groups, without putting a group in one task.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group
to one task; a group that holds a third of the data would stall the job. Here
the caller names a bucket that cuts each group into parts in order (a slice of
time, a hash if any order will do): rows are numbered inside (group, bucket)
and shifted by the counts of the buckets before. The counts are one row per
(group, bucket), so the window over them is small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def columns(df: DataFrame, without: Sequence[str] = ()) -> list[Column]:
    """All columns of ``df`` but some, whatever characters their names have."""
    return [df["`" + c.replace("`", "``") + "`"] for c in df.columns if c.lower() not in without]


def same(pairs) -> Column:
    """Null-safe equality of all pairs of columns."""
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in pairs])


def rank_in_groups(df: DataFrame, groups: Sequence[str], bucket: str, order: Sequence[str | Column], out: str, start: DataFrame | None = None) -> DataFrame:
    """Add ``out``, the position from 0 of each row in its group, the group
    being ordered by (``bucket``, ``order``).

    ``df`` is read twice, so an input that is expensive or not repeatable
    should be written first. Pick ``bucket`` so that its parts of a group fit
    a task. ``start`` (``groups`` and a number ``__t_start``) has the groups
    that do not begin at 0.
    """
    names = [*groups, bucket]
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("__t_n"))
        .withColumn("__t_off", F.coalesce(F.sum("__t_n").over(before), F.lit(0)))
        .select(*[F.col(c).alias(f"__t_k{i}") for i, c in enumerate(names)], "__t_off")
    )
    if start is not None:
        first = start.select(*[F.col(c).alias(f"__t_g{i}") for i, c in enumerate(groups)], "__t_start")
        offsets = offsets.join(first, same((offsets[f"__t_k{i}"], first[f"__t_g{i}"]) for i in range(len(groups))), "left")
        offsets = offsets.withColumn("__t_off", F.col("__t_off") + F.coalesce("__t_start", F.lit(0))).select(*[f"__t_k{i}" for i in range(len(names))], "__t_off")
    ranked = df.withColumn("__t_rn", F.row_number().over(Window.partitionBy(*names).orderBy(*order)))
    on = same((ranked[c], offsets[f"__t_k{i}"]) for i, c in enumerate(names))
    return ranked.join(offsets, on).select(
        *columns(ranked, ("__t_rn",)), (F.col("__t_off") + F.col("__t_rn") - 1).alias(out)
    )
