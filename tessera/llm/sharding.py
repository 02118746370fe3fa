"""Uniform shuffle into shards of exact sizes, by a communication matrix.

Rows lie in logical partitions. How many rows of each partition go to each
shard is drawn first, as one matrix with the partitions' counts as row sums and
the shards' exact sizes as column sums: the distribution that a uniform random
assignment of rows to places has, which is multivariate hypergeometric. The
matrix is drawn in two steps, each one hypergeometric draw after the other:
first for groups of partitions, as many as a group has members, then inside all
groups side by side. Then each partition is permuted and cut by its row of the
matrix, the pieces go to their shards, and each shard is permuted again.

A row knows its place in its partition, and permutations are computed, not
sorted: a swap-or-not shuffle (Hoang, Morris and Rogaway, 2012) maps the numbers
below n one to one onto themselves, for any n. So shard and slot of a row follow
from its number and small tables, and whole rows move once, to the output
partition of their shard and range of slots. Every output partition holds one
shard.

A draw inverts the distribution function outwards from the mode, with ratios
of neighbouring probabilities; values more than ten standard deviations away
are below the resolution of a double. The tables that are broadcast have a row
for each partition read and at most ``TABLE`` numbers of the matrix.

Defined cases: the law is ``rows`` (sizes differ by one at most, the first
shards are the larger); null texts, repeated rows, equal and null ids are rows
like any other; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ROW, freeze, materialize, partition_and_place, shuffle_width, unit
from tessera.operators.sequence import columns

SHARDS = 16
SEED = 5
ROUNDS = 32  # of a swap-or-not shuffle: a row is left alone by all with 2 ** -32
TABLE = 1 << 20  # numbers of the matrix, at most, or one partition's row


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(u: Column, total: Column, good: Column, n: Column) -> Column:
    """Good ones among ``n`` drawn of ``total``, for a uniform ``u``."""
    given = F.struct(*[c.cast("double").alias(k) for k, c in (("u", u), ("total", total), ("good", good), ("n", n))])

    def bounds(g: Column) -> Column:
        share = g["good"] / F.greatest(g["total"], F.lit(1.0))
        spread = g["n"] * share * (1 - share) * (g["total"] - g["n"]) / F.greatest(g["total"] - 1, F.lit(1.0))
        least, most = F.greatest(F.lit(0.0), g["n"] + g["good"] - g["total"]), F.least(g["n"], g["good"])
        middle = F.floor((g["n"] + 1) * (g["good"] + 1) / (g["total"] + 2)).cast("double")
        far = F.ceil(10 * F.sqrt(spread) + 20).cast("double")
        names = [g[k].alias(k) for k in ("u", "total", "good", "n")]
        return F.struct(*names, least.alias("least"), most.alias("most"), F.greatest(F.least(middle, most), least).alias("mode"), far.alias("far"))

    def steps(b: Column) -> Column:
        up, down = F.least(b["most"] - b["mode"], b["far"]), F.least(b["mode"] - b["least"], b["far"])
        return F.struct(*[b[k].alias(k) for k in ("u", "total", "good", "n", "mode")], up.alias("up"), down.alias("down"))

    def value(d: Column, i: Column) -> Column:  # the mode, upwards, then downwards from it
        return F.when(i <= d["up"], d["mode"] + i).otherwise(d["mode"] + d["up"] - i)

    def weight(d: Column, w: Column, i: Column, x: Column) -> Column:
        """Probability of the i-th value, as a multiple of the mode's."""
        bad = d["total"] - d["good"] - d["n"]
        rise = (d["good"] - x + 1) * (d["n"] - x + 1) / (x * (bad + x))
        fall = (x + 1) * (bad + x + 1) / ((d["good"] - x) * (d["n"] - x))
        before = F.when(i == d["up"] + 1, F.lit(1.0)).otherwise(w)
        return F.when(i == 0, F.lit(1.0)).when(i <= d["up"], before * rise).otherwise(before * fall)

    def walk(d: Column, goal: Column) -> Column:
        """Weights added up, and how many of the sums are within the goal."""
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("k"))

        def step(s: Column, k: Column) -> Column:
            def add(w: Column) -> Column:
                more = s["sum"] + w
                return F.struct(w.alias("w"), more.alias("sum"), (s["k"] + F.when(more <= goal, 1.0).otherwise(0.0)).alias("k"))

            i = k.cast("double")
            return _let(_let(value(d, i), lambda x: weight(d, s["w"], i, x)), add)

        return F.aggregate(F.sequence(F.lit(0).cast("long"), (d["up"] + d["down"]).cast("long")), start, step)

    def draw(d: Column) -> Column:
        place = _let(d["u"] * walk(d, F.lit(0.0))["sum"], lambda goal: walk(d, goal)["k"])
        return _let(F.least(place, d["up"] + d["down"]), lambda i: value(d, i)).cast("long")

    return _let(_let(_let(given, bounds), steps), draw)


def _deal(quotas: Column, sizes: Column, shards: int, seed: int, *salt) -> Column:
    """Array of rows of the matrix: for each size in turn, how much of each
    quota it gets of what is left."""

    def draw(left: Column, n: Column, at: Column) -> Column:
        def one(s: Column, j: Column) -> Column:
            def take(got: Column) -> Column:
                return F.struct(F.concat(s["taken"], F.array(got)).alias("taken"), (s["n"] - got).alias("n"), (s["total"] - left[j]).alias("total"))

            return _let(hypergeometric(unit(seed, *salt, at, j), s["total"], left[j], s["n"]), take)

        total = F.aggregate(left, F.lit(0).cast("long"), lambda a, q: a + q)
        start = F.struct(F.expr("cast(array() as array<bigint>)").alias("taken"), n.alias("n"), total.alias("total"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, one, lambda s: s["taken"])

    def give(s: Column, n: Column) -> Column:
        def add(taken: Column) -> Column:
            rest = F.zip_with(s["left"], taken, lambda q, t: q - t)
            return F.struct(rest.alias("left"), F.concat(s["rows"], F.array(taken)).alias("rows"))

        return _let(draw(s["left"], n, F.size(s["rows"])), add)

    start = F.struct(quotas.alias("left"), F.expr("cast(array() as array<array<bigint>>)").alias("rows"))
    return F.aggregate(sizes, start, give, lambda s: s["rows"])


def communication_matrix(sizes: DataFrame, quotas: list[int], parts: int, seed: int = SEED) -> DataFrame:
    """(part, counts): rows of each part for each shard. ``sizes`` has (part,
    n) with parts from 0 to ``parts`` - 1; the quotas add up to all rows."""
    spark = sizes.sparkSession
    wide = math.isqrt(parts - 1) + 1  # parts of a group, and about as many groups
    slots = spark.range(parts).select(F.col("id").cast("int").alias("part"))
    filled = slots.join(sizes.select(F.col("part").alias("p"), "n"), F.col("part") == F.col("p"), "left")
    filled = filled.select(F.expr(f"int(part div {wide})").alias("group"), "part", F.coalesce("n", F.lit(0)).alias("n"))
    groups = filled.groupBy("group").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("part", "n"))).alias("own"))
    groups = materialize(groups.select("group", "n", F.col("own.n").alias("sizes")), "part-groups")
    top = groups.agg(F.array_sort(F.collect_list(F.struct("group", "n"))).alias("all"))  # `wide` numbers
    dealt = _deal(F.lit(quotas).cast("array<long>"), F.col("all.n"), len(quotas), seed, F.lit(0))
    top = materialize(top.select(F.posexplode(dealt).alias("g", "quotas")), "group-rows")
    each = groups.join(top, F.col("group") == F.col("g")).repartition(min(wide, shuffle_width(spark)), "group")
    rows = F.posexplode(_deal(F.col("quotas"), F.col("sizes"), len(quotas), seed, F.lit(1), F.col("group"))).alias("i", "counts")
    return each.select("group", rows).select((F.col("group") * wide + F.col("i")).alias("part"), "counts")


def permuted(i: Column, n: Column, *seed) -> Column:
    """Where a random permutation of the numbers below ``n``, chosen by the
    seed, puts ``i``: in every round a number and its partner, which add up to
    a key of the round, change places or do not."""
    hashed = lambda *x: F.xxhash64(*[c if isinstance(c, Column) else F.lit(c) for c in (*seed, *x)])

    def swap(at: Column, round_: Column) -> Column:
        def decide(partner: Column) -> Column:
            coin = hashed("coin", round_, F.greatest(at, partner))
            return F.when(coin.bitwiseAND(1) == 1, partner).otherwise(at)

        return _let(F.pmod(F.pmod(hashed("key", round_), n) - at, n), decide)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), i, swap)


def shard_rows(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, parts: int | None = None) -> DataFrame:
    """``rows`` with shard (int, from 0) and slot (long, gapless from 0 in the
    shard), in the place of columns with these names. A partition of the result
    holds a range of the slots of one shard, in their order."""
    spark = rows.sparkSession
    width = shuffle_width(spark)
    parts = parts or max(1, min(width, TABLE // shards))
    frozen = freeze(rows.drop("shard", "slot"), "rows-to-shard")
    home, place = partition_and_place(F.col(ROW))
    read = frozen.groupBy(home.alias("home")).agg(F.count(F.lit(1)).alias("n"))
    read = read.withColumn("part", F.pmod(F.xxhash64(F.lit(seed), "home"), F.lit(parts)).cast("int"))
    # Partitions read follow one another in their logical partition: a row each.
    own = Window.partitionBy("part")
    before = F.coalesce(F.sum("n").over(own.orderBy("home").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    read = materialize(read.select("home", "part", "n", before.alias("base"), F.sum("n").over(own).alias("size")), "partitions-read")
    sizes = read.groupBy("part").agg(F.sum("n").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    quotas = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = materialize(communication_matrix(sizes, quotas, parts, seed), "matrix")
    cells = matrix.select("part", F.posexplode("counts").alias("to", "n"))
    upto = lambda c, by: F.sum("n").over(Window.partitionBy(c).orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
    cells = cells.select("part", "to", upto("part", "to").alias("end"), (upto("to", "part") - F.col("n")).alias("at"), (upto("part", "to") - F.col("n")).alias("start"))
    cuts = cells.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("to", "start", "end", "at"))).alias("__t_cuts"))  # a row of the matrix
    cuts = materialize(cuts.withColumnRenamed("part", "__t_p"), "cuts")

    known = F.broadcast(read.select(F.col("home").alias("__t_home"), F.col("part").alias("__t_part"), "base", "size"))
    row = frozen.join(known, home == F.col("__t_home")).join(F.broadcast(cuts), F.col("__t_part") == F.col("__t_p"))
    row = row.withColumn("__t_local", permuted(place + F.col("base"), F.col("size"), seed + 1, F.col("__t_part")))
    piece = F.filter("__t_cuts", lambda c: (c["start"] <= F.col("__t_local")) & (F.col("__t_local") < c["end"]))[0]
    row = row.withColumn("__t_piece", piece)
    shard = F.col("__t_piece.to").cast("int")
    quota = F.element_at(F.lit(quotas).cast("array<long>"), shard + 1)
    again = permuted(F.col("__t_piece.at") + F.col("__t_local") - F.col("__t_piece.start"), quota, seed + 2, shard)
    placed = row.select(*columns(frozen, (ROW,)), shard.alias("shard"), again.alias("slot"))
    each = max(1, -(-width // shards))
    target = F.col("shard") * each + F.floor(F.col("slot") * each / F.element_at(F.lit(quotas).cast("array<long>"), F.col("shard") + 1))
    return placed.repartitionById(shards * each, target.cast("int")).sortWithinPartitions("slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows in slot order within every file."""
    sharded.write.partitionBy("shard").parquet(path)
