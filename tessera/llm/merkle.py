"""A Merkle manifest of a dataset, with a proof for every row.

Every row is a leaf, the hash of its fields. The leaves of a group (a language)
stand in the order of their key; every ``fan`` consecutive nodes become the
hash of their concatenated hex digests, until one is left, the group's subroot.
The subroots, in the order of their groups, become the root in the same way.

Levels are built in aligned blocks of ``fan ** height`` nodes. A block keeps
each of its levels as one string of hex digests, all of the same width: parents
are hashes of fixed-width substrings, and the siblings of a node are the
substrings on both sides of it in its run (segments). The blocks' own roots are
the nodes of the next round, so the number of rounds is the logarithm of the
largest group to the base of a block's size (two for a quarter of a million
rows, four for 10^10). Proofs go down the same blocks: a block hands each of
its nodes their segments, followed by those of the block itself.

A block is the largest thing in one row (a few hundred kB with all its
proofs). Leaves are put in order by a range partitioning whose last key tells
repeated rows apart, and numbered by partition and place, so neither a hot
group nor a hot key is in one task. Nothing is broadcast by hint.

Defined cases: a null field is ``-``; a null group is a group and comes first; a
null key comes first in its group; rows with equal keys are leaves of their
own, in the order of their hashes; a group of one row has its leaf as subroot,
and a lone subroot is the root; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, place_in_order
from tessera.operators.sequence import same

FAN = 8
HEIGHT = 3
DIGEST = 64  # hex digits of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The letters that the tampering of the query lower-cases.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(value: Column | str) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column | str) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def _levels(first: Column, steps: Column, fan: int) -> Column:
    """Level strings from the lowest up, as an array of binary values."""
    width = fan * DIGEST

    def parents(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.length(level) / F.lit(width)).cast("int") - 1)
        return F.array_join(F.transform(runs, lambda j: F.sha2(F.substring(level, j * width + 1, F.lit(width)), 256)), "").cast("binary")

    return F.aggregate(F.array_repeat(F.lit(0), steps), F.array(first), lambda all_, _: F.concat(all_, F.array(parents(F.element_at(all_, -1)))))


def _segments(levels: Column, i: Column, fan: int) -> Column:
    """(left, right) of the i-th node of a block on each of its levels but the last."""

    def at(level: Column, depth: Column) -> Column:
        node = F.floor(i / F.pow(F.lit(fan), depth)).cast("int")
        run, end = node - F.pmod(node, F.lit(fan)), (node + 1) * DIGEST
        left = F.substring(level, run * DIGEST + 1, (node - run) * DIGEST)
        right = F.substring(level, end + 1, (run + fan) * DIGEST - end)  # a last run is shorter
        return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), at)


@dataclass
class Tree:
    """The rounds of blocks over the nodes of some groups, and their roots."""

    rounds: list[DataFrame]
    roots: DataFrame  # g, root


def build(nodes: DataFrame, fan: int = FAN, height: int = HEIGHT) -> Tree:
    """``nodes``: g (group), pos, total (nodes of the group), digest, item."""
    size = fan**height
    rounds, roots = [], []
    while True:
        members = F.array_sort(F.collect_list(F.struct("pos", "digest", "item")))
        blocks = nodes.groupBy("g", F.expr(f"pos div {size}").alias("block")).agg(F.max("total").alias("total"), members.alias("members"))
        whole = F.col("total") <= size  # the group's only block ends with its root
        steps = F.when(~whole, F.lit(height)).otherwise(sum((F.when(F.col("total") > fan**k, 1).otherwise(0) for k in range(height)), F.lit(0)))
        first = F.array_join(F.col("members.digest"), "").cast("binary")
        blocks = blocks.withColumn("levels", _levels(first, steps, fan))
        blocks = materialize(blocks.select("g", "block", "total", F.col("members.item").alias("items"), "levels"), "blocks")
        rounds.append(blocks)
        top = F.element_at("levels", -1).cast("string")
        roots.append(blocks.filter(F.col("total") <= size).select("g", top.alias("root")))
        if (blocks.agg(F.max("total")).first()[0] or 0) <= size:
            break
        up = F.expr(f"(total + {size - 1}) div {size}").alias("total")
        nodes = blocks.filter(F.col("total") > size).select("g", F.col("block").alias("pos"), up, top.alias("digest"), F.col("block").alias("item"))
    every = roots[0]
    for r in roots[1:]:
        every = every.unionByName(r)
    return Tree(rounds, materialize(every, "roots"))


def paths(tree: Tree, above: DataFrame, fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """Every node of the lowest round: its item and path (segments up to the
    end), subroot and root. ``above`` has g, path, subroot and root of each
    group's own root."""
    size = fan**height
    ends = ["path", "subroot", "root"]
    of_groups = above.select(F.col("g").alias("__t_g"), F.lit(0).cast("long").alias("__t_b"), *ends)
    found = None
    for blocks in reversed(tree.rounds):
        whole = F.col("total") <= size
        parts = [(blocks.filter(whole), of_groups)]
        if found is not None:  # the nodes of the round above are this round's blocks
            parts.append((blocks.filter(~whole), found.select(F.col("g").alias("__t_g"), F.col("item").alias("__t_b"), *ends)))
        joined = [b.join(over, same([(b["g"], over["__t_g"]), (b["block"], over["__t_b"])])) for b, over in parts]
        rows = joined[0] if len(joined) == 1 else joined[0].unionByName(joined[1])
        own = F.transform("items", lambda x, i: F.struct(x.alias("item"), F.concat(_segments(F.col("levels"), i, fan), F.col("path")).alias("path")))
        found = rows.select("g", "subroot", "root", F.inline(own))
    return found


def prove(leaves: DataFrame, group: str = "lang", key: str = "doc_id", leaf: str = "leaf", fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """``leaves`` with subroot, root and path, the siblings (left, right) of
    the leaf and of every node above it, up to the root. Columns of
    ``leaves`` should be narrow; they travel through the blocks."""
    placed = place_in_order(leaves, [group], [F.col(key).asc_nulls_first(), F.col(leaf)], "leaves")
    item = F.struct(*[F.col(f"`{c}`") for c in leaves.columns])
    node = [F.col("__t_pos").alias("pos"), F.col("__t_total").alias("total")]
    tree = build(placed.select(F.col(group).alias("g"), *node, F.col(leaf).alias("digest"), item.alias("item")), fan, height)

    groups = place_in_order(tree.roots.withColumn("all", F.lit(0)), ["all"], [F.col("g").asc_nulls_first()], "subroots")
    groups = groups.select(F.col("all"), *node, F.col("root").alias("digest"), F.struct("g", "root").alias("item"))
    top = build(groups.withColumnRenamed("all", "g"), fan, height)
    no_path = F.expr("cast(array() as array<struct<left:string,right:string>>)")
    above = top.roots.select("g", no_path.alias("path"), F.lit(None).cast("string").alias("subroot"), "root")
    over = paths(top, above, fan, height)
    over = over.select(F.col("item.g").alias("g"), "path", F.col("item.root").alias("subroot"), "root")
    return paths(tree, over, fan, height).select("item.*", "subroot", "root", "path")


def fold(leaf: Column | str, path: Column | str = "path") -> Column:
    """The root that a leaf and its siblings give."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def path_hash(path: Column | str = "path") -> Column:
    """Hash of all siblings, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def oracle(fan: int = FAN) -> str:
    """The query's rows in DuckDB's SQL: levels by recursion, then folds."""
    crc = (
        "xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda a, b: "
        "list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda r, i: xor(r >> 1, 3988292384 * (r & 1)), xor(a, b)), 4294967295), 4294967295)"
    )
    size = "strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR"
    part = lambda c: f"coalesce({size.format(c)}, '-')"
    low = "translate(text, '" + UPPER + "', '" + UPPER.lower() + "')"
    head = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    return f"""
    WITH RECURSIVE d AS (SELECT doc_id, lang, sha256({head} || {part('text')}) AS leaf, sha256({head} || {part(low)}) AS low,
        coalesce({crc} % 3 = 0, false) AS hit FROM documents),
    l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM d),
    up AS (SELECT g, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM l
      UNION ALL
      SELECT g, level + 1, pos, h, count(*) OVER (PARTITION BY g) FROM (
        SELECT g, level, pos // {fan} AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM up WHERE n > 1 GROUP BY g, level, pos // {fan})),
    top AS (SELECT 0 AS level, g AS pos, h, count(*) OVER () AS n FROM up WHERE n = 1
      UNION ALL
      SELECT level + 1, pos, h, count(*) OVER () FROM (
        SELECT level, pos // {fan} AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM top WHERE n > 1 GROUP BY level, pos // {fan})),
    heights AS (SELECT g, max(level) AS high FROM up GROUP BY g),
    nodes AS (SELECT up.g, level, pos, h FROM up JOIN heights USING (g) WHERE level < high
      UNION ALL
      SELECT heights.g, high + level, pos, h FROM heights, top WHERE n > 1),
    sides AS (SELECT g, level, pos,
        coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
      FROM nodes WINDOW w AS (PARTITION BY g, level, pos // {fan} ORDER BY pos)),
    f AS (SELECT g AS own, l.pos AS place, 0 AS level, g, CASE WHEN high = 0 THEN g ELSE l.pos END AS pos, CASE WHEN hit THEN low ELSE leaf END AS h, '' AS proof
      FROM l JOIN heights USING (g)
      UNION ALL
      SELECT own, place, f.level + 1, f.g, CASE WHEN f.level + 1 = high THEN own ELSE f.pos // {fan} END, sha256(s.l || f.h || s.r), proof || s.l || s.r
      FROM f JOIN heights USING (g) JOIN sides s ON s.g = f.g AND s.level = f.level AND s.pos = f.pos),
    ends AS (SELECT own, place, arg_max(h, level) AS folded, arg_max(proof, level) AS proof FROM f GROUP BY own, place)
    SELECT l.doc_id, l.leaf, up.h AS subroot, top.h AS root, sha256(ends.proof) AS proof_sha256, ends.folded AS folded_root, ends.folded = top.h AS verified
    FROM l JOIN up ON up.g = l.g AND up.n = 1 JOIN top ON top.n = 1 JOIN ends ON ends.own = l.g AND ends.place = l.pos
    """
