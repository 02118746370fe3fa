"""Top-k rows per group, and a ranked text form of them.

``row_number() <= k`` over a window is planned by Spark as a
``WindowGroupLimit``: each task keeps only its own top k per group *before*
the shuffle, so a hot group sends at most k rows per map task instead of all
of its rows. The final window then sees at most ``k * tasks`` rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(
    df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column], k: int, rank_col: str = "rank"
) -> DataFrame:
    """Rows ranked 1..k within each group by ``order_cols`` (which must be a
    total order inside the group, so the answer is deterministic)."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def ranked_text(
    ranked: DataFrame, group_cols: Sequence[str], item: Column, rank_col: str = "rank", sep: str = " ",
    output: str = "top",
) -> DataFrame:
    """One row per group: the items joined in rank order.

    Only used after :func:`top_k_per_group`, so each collected list holds at
    most k elements. The list is sorted by rank explicitly; the order of
    ``collect_list`` itself is never relied on.
    """
    pairs = F.collect_list(F.struct(F.col(rank_col).alias("r"), item.alias("t")))
    text = F.array_join(F.transform(F.array_sort(pairs), lambda x: x["t"]), sep)
    return ranked.groupBy(*group_cols).agg(text.alias(output))
