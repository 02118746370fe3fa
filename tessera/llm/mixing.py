"""Mixing sources to target weights by Poisson replication.

A source with ``n`` rows and weight ``w`` (of all weights ``W``) should hold
``w / W`` of ``size`` rows, so each of its rows is repeated with mean
``rate = size * w / W / n``. The number of copies of a row is a Poisson draw
with that mean: a number hashed from the seed and the row is put through the
inverse distribution function. Rows are then exploded by their copies and
shuffled globally, by a hash of row and copy.

A mean above ``PART`` is split into equal parts with a draw each, whose sum
has the same distribution; so the table of a distribution stays short.

The only state is a row per source. Sources are counted with partial
aggregation; up to ``BROADCAST_SOURCES`` of them are broadcast, more are
joined by ``skew_lookup``, which spreads hot sources.

Defined cases: rows with a null source are a source of their own; without
given weights a source weighs the power ``alpha`` of its rows, with them a
source that is not named weighs 0 and its rows go; repeated rows draw one
by one; a null text draws like an empty one; an empty table
gives an empty result; other columns stay. Rows repeat when doc_id and text are
equal: they are numbered, and the number is part of what is hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ROW, freeze, materialize, shuffle_width, skew_lookup
from tessera.operators.sequence import columns, rank_in_groups

PART = 16.0
LONGEST = 80  # P(X > 80) with mean 16 is below 1e-27
ALPHA = 0.5
SEED = 20
BROADCAST_SOURCES = 10_000


def hashed(seed: int, *cols: Column) -> Column:
    """52 bits of the MD5 of the seed and the columns, as a long; the same in
    any SQL engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *cols)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, size: int | None = None, alpha: float = ALPHA) -> DataFrame:
    """source, n, rate: how often each row of a source is to be repeated on average."""
    counts = materialize(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "sources")
    if weights is None:
        weighed = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(alpha)))
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("weights must not be negative")
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "s string, w double")
        weighed = counts.join(given, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "n", F.coalesce("w", F.lit(0.0)).alias("w"))
    total = weighed.agg(F.sum("n"), F.sum("w")).first()
    rows, all_weights = size if size is not None else (total[0] or 0), total[1] or 1.0
    return weighed.select("source", "n", (F.lit(float(rows)) * F.col("w") / F.lit(all_weights) / F.col("n")).alias("rate"))


def _distribution(mean: Column) -> Column:
    """P(X <= k) for k = 0 .. LONGEST, as an array."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all"))

    def add(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["all"], F.array(s["c"] + p)).alias("all"))

    steps = F.transform(F.sequence(F.lit(1), F.lit(LONGEST)), lambda k: k.cast("double"))
    return F.aggregate(steps, start, add, lambda s: s["all"])


def _told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__t_me``, a text that tells a row from all others: a
    digest of id and text (ids may repeat or be null), and among equal rows
    their number, for all but one of them."""
    me = F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).cast("binary"))
    docs = docs.withColumn("__t_me", me)
    again = docs.groupBy("__t_me").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = materialize(again, "repeated-rows")
    if again.isEmpty():
        return docs
    rows = freeze(docs, "rows-to-mix")
    twins = skew_lookup(rows.select(ROW, "__t_me"), again, ["__t_me"], "n", ["n"], "inner")
    part = F.pmod(F.xxhash64(ROW), F.lit(4 * shuffle_width(docs.sparkSession)))
    twins = materialize(twins.select(ROW, "__t_me", part.alias("__t_part")), "twins")
    nth = rank_in_groups(twins, ["__t_me"], "__t_part", [ROW], "__t_nth").filter("__t_nth > 0")
    nth = nth.select(F.col(ROW).alias("__t_r"), "__t_nth")
    told = rows.join(nth, F.col(ROW) == F.col("__t_r"), "left")
    return told.withColumn("__t_me", F.concat_ws("#", "__t_me", F.col("__t_nth").cast("string"))).drop(ROW, "__t_r", "__t_nth")


def draw(docs: DataFrame, rate: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with ``__t_mix``: rate and copies of each row."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    known = rate.select(
        F.col("source").alias("__t_source"), "n", F.struct("rate", parts.alias("parts"), _distribution(F.col("rate") / parts).alias("below")).alias("__t_mix")
    )
    known = materialize(known, "rates")
    docs = _told_apart(docs)  # below the join, so that it is computed once a row
    if known.count() <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(known.drop("n")), docs["source"].eqNullSafe(known["__t_source"])).drop("__t_source")
    else:
        tagged = docs.withColumn("__t_source", F.col("source"))
        joined = skew_lookup(tagged, known, ["__t_source"], "n", ["__t_mix"]).drop("__t_source")

    def once(part: Column) -> Column:
        u = hashed(seed, F.col("__t_me"), part.cast("string")) / F.lit(2.0**52)
        return F.size(F.filter(F.col("__t_mix.below"), lambda c: c <= u)).cast("long")

    copies = F.aggregate(F.sequence(F.lit(1), F.col("__t_mix.parts")), F.lit(0).cast("long"), lambda a, i: a + once(i))
    return joined.withColumn("__t_mix", F.struct(F.col("__t_mix.rate").alias("rate"), copies.alias("copies")))


def poisson_mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    size: int | None = None,
    alpha: float = ALPHA,
    seed: int = SEED,
    details: bool = True,
) -> DataFrame:
    """The mixed and shuffled rows: the columns of ``docs`` and, with
    ``details``, copy (from 1), copies and rate, in the place of columns with
    these names."""
    drawn = draw(docs, rates(docs, weights, size, alpha), seed)
    drawn = drawn.filter(F.col("__t_mix.copies") > 0)
    copies = drawn.withColumn("__t_copy", F.explode(F.expr("sequence(1, int(__t_mix.copies))")))
    copies = copies.withColumn("__t_key", hashed(seed + 1, F.col("__t_me"), F.col("__t_copy").cast("string")))
    mixed = copies.repartition("__t_key").sortWithinPartitions("__t_key")
    extra = [F.col("__t_copy").alias("copy"), F.col("__t_mix.copies").alias("copies"), F.col("__t_mix.rate").alias("rate")]
    own = columns(mixed, ("__t_me", "__t_mix", "__t_copy", "__t_key", *(("copy", "copies", "rate") if details else ())))
    return mixed.select(*own, *(extra if details else []))


def oracle(alpha: float = ALPHA, seed: int = SEED) -> str:
    """The same rows in DuckDB's SQL."""
    return f"""
    WITH s AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {alpha}) AS w FROM documents GROUP BY source),
    t AS (SELECT sum(n)::DOUBLE AS n, sum(w) AS w FROM s),
    r AS (SELECT s.source, t.n * s.w / t.w / s.n AS rate FROM s, t),
    p AS (SELECT source, rate, greatest(1, ceil(rate / {PART}))::INT AS parts FROM r),
    d AS (SELECT source, rate, parts, k,
            sum(exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS below
          FROM p, range(0, {LONGEST + 1}) x(k)),
    c AS (SELECT source, any_value(rate) AS rate, any_value(parts) AS parts, list(below ORDER BY k) AS below FROM d GROUP BY source),
    i AS (SELECT *, md5(concat_ws('|', doc_id::VARCHAR, coalesce(text, ''))) AS one FROM documents),
    e AS (SELECT *, one || coalesce('#' || nullif(row_number() OVER (PARTITION BY one) - 1, 0), '') AS me FROM i),
    m AS (SELECT e.*, c.rate, c.parts, c.below FROM e JOIN c ON e.source IS NOT DISTINCT FROM c.source),
    u AS (SELECT m.*, list_sum(list_transform(range(1, parts + 1), lambda i: len(list_filter(below,
            lambda b: b <= ('0x' || substr(md5(concat_ws('|', '{seed}', me, i::VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0))))::BIGINT AS copies FROM m)
    SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, copies, round(rate, 9) AS rate
    FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM u WHERE copies > 0)
    """
