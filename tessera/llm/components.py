"""Connected components by contraction, in DataFrame rounds.

Each round points every node at the smallest node of its closed
neighbourhood (by id in the first rounds, by a fresh hash after them, so that
long paths shrink by a constant share), then merges the nodes that point to
one another's targets; the edges that remain join merged nodes. No list of
neighbours is ever collected; a hub's edges are spread by salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize

_SALT = 8
_BY_ID = 2  # rounds in natural order: stars around their smallest node end at once


def _follow(rows: DataFrame, key: str, other: str, table: DataFrame) -> DataFrame:
    """``rows.key`` replaced by its target in ``table`` (node, target), if it
    has one. ``other`` spreads the rows of a hot key over the salts."""
    salted = rows.withColumn("__t_s", F.pmod(F.xxhash64(other), F.lit(_SALT)))
    spread = table.select(
        F.col("node").alias("__t_n"), F.col("target").alias("__t_t"), F.explode(F.array(*[F.lit(i).cast("long") for i in range(_SALT)])).alias("__t_s2")
    )
    on = (salted[key] == spread["__t_n"]) & (salted["__t_s"] == spread["__t_s2"])
    joined = salted.join(spread, on, "left")
    return joined.select(*[F.coalesce("__t_t", key).alias(key) if c == key else salted[c] for c in rows.columns])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v); the component is
    one of its nodes. Node ids are longs; loops and repeats do no harm."""
    edges = materialize(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    targets: list[DataFrame] = []
    while not edges.isEmpty():
        k = len(targets)
        rank = lambda c: F.struct((F.lit(0) if k < _BY_ID else F.xxhash64(F.lit(k), c)).alias("h"), F.col(c).alias("id"))
        ends = edges.select(F.col("u").alias("node"), F.col("v").alias("w")).unionByName(edges.select(F.col("v").alias("node"), F.col("u").alias("w")))
        best = ends.groupBy("node").agg(F.min(rank("w")).alias("m"))
        table = materialize(best.select("node", F.least(F.col("m"), rank("node"))["id"].alias("target")), "targets")
        targets.append(table)
        moved = _follow(_follow(edges, "u", "v", table), "v", "u", table)
        edges = materialize(moved.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    if not targets:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    labels = targets[0].select("node", F.col("target").alias("component"))
    for table in targets[1:]:
        labels = _follow(labels, "component", "node", table)
    return materialize(labels, "components")
