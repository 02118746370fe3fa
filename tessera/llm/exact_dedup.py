"""Exact duplicates by deterministic block naming.

A text without white space is a sequence of blocks of ``BLOCK`` bytes. Equal
blocks get the same integer name: the blocks are dealt into parts by hash,
sorted there, and numbered, so a name is (part, place among the distinct
blocks of the part). Then adjacent names are paired and the pairs named the
same way, level by level, until each document has one name. Names stand for
contents, never for hashes of them, so two documents share (levels, name) if
and only if their texts are equal: no collision is possible, and no text is
ever compared with more than its neighbours in a sort.

Each text crosses the network once, as blocks of the first level. A block that
holds more than 1 / ``hot_share`` of all block rows (copies, a common header) is
named beforehand from its distinct values and its rows travel without their
bytes, spread over all tasks. Names of pairs and the final groups are small
rows; hot ones are looked up by broadcast.

Defined cases: null text counts as empty; empty texts are one group; of
repeated rows (same doc_id and text) one stays; a null doc_id comes after all
others in a tie; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ROW, freeze, hot_share, materialize, shuffle_width, skew_lookup

BLOCK = 4096
SPACES = "[\\x20\\x09-\\x0D]+"
_PART_BITS = 40  # a name is part << 40 | place in the part


def normalized(text: Column | str) -> Column:
    """The text without its ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), SPACES, "")


def identity_columns(text: str = "text") -> dict[str, Column]:
    """What a decision and its document have in common besides the id."""
    return {"text_sha256": F.sha2(normalized(text), 256), "points": F.char_length(F.coalesce(F.col(text), F.lit("")))}


def _parts(df: DataFrame) -> int:
    return 64 * shuffle_width(df.sparkSession)


def _blocks(docs: DataFrame, block: int) -> DataFrame:
    """Block rows: ROW, pos, n_blocks, block, and (at pos 0) what the result
    needs of the document."""
    info = identity_columns()
    own = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()
    data = docs.select("doc_id", "text", own.alias(ROW))
    data = data.withColumn("__t_norm", normalized("text"))
    data = data.select(
        ROW,
        F.struct("doc_id", info["points"].cast("long").alias("points"), F.sha2("__t_norm", 256).alias("text_sha256")).alias("info"),
        F.col("__t_norm").cast("binary").alias("__t_bytes"),
    ).withColumn("n_blocks", F.greatest(F.lit(1), F.expr(f"(octet_length(__t_bytes) + {block - 1}) div {block}")))
    at = F.posexplode(F.expr(f"transform(sequence(0L, n_blocks - 1), i -> substring(__t_bytes, int(i * {block} + 1), {block}))"))
    rows = data.select(ROW, "n_blocks", "info", at.alias("pos", "block"))
    first = F.when(F.col("pos") == 0, F.col("info"))
    return rows.select(ROW, F.col("pos").cast("long").alias("pos"), "n_blocks", first.alias("info"), "block")


def _name(df: DataFrame, part: str, order: list, spread: list[str]) -> Column:
    """Integer name: part and place among the distinct values of the part."""
    place = F.dense_rank().over(Window.partitionBy(part, *spread).orderBy(*order)).cast("long")
    return F.shiftleft(F.col(part).cast("long"), _PART_BITS) + place


def name_blocks(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """First level: every block of every text with its name."""
    rows = _blocks(docs, block)
    parts = _parts(docs)
    count = rows.groupBy(F.xxhash64("block").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    count = materialize(count, "block-counts")
    total = count.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Hashes only choose which blocks are named beforehand: fewer than hot_share.
    hot = [r[0] for r in count.filter(F.col("n") * hot_share(docs.sparkSession) > F.lit(total)).select("h").collect()]
    is_hot = F.xxhash64("block").isin(hot) if hot else F.lit(False)
    known = rows.filter(is_hot).groupBy("block").agg(F.count(F.lit(1)).alias("n")).select("block")
    if hot:
        # The distinct values of those hashes, numbered from -1 down.
        known = materialize(known, "hot-blocks")
        place = -F.row_number().over(Window.orderBy("block")).cast("long")
        known = F.broadcast(known.select(F.col("block").alias("__t_hot"), place.alias("__t_name")))
        rows = rows.join(known, F.col("block") == F.col("__t_hot"), "left")
    else:
        rows = rows.withColumn("__t_name", F.lit(None).cast("long"))
    found = F.col("__t_name").isNotNull()
    rows = rows.select(
        ROW, "pos", "n_blocks", "info", "__t_name",
        F.when(~found, F.col("block")).alias("block"),
        F.when(found, F.pmod(F.xxhash64(ROW, "pos"), F.lit(parts))).otherwise(F.pmod(F.xxhash64("block"), F.lit(parts))).alias("__t_part"),
    )
    named = F.coalesce("__t_name", _name(rows, "__t_part", [F.col("block")], []))
    return materialize(rows.select(ROW, "pos", "n_blocks", "info", named.alias("name")), "block-names")


def name_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each document: ROW, info (doc_id, points, text_sha256),
    levels and name, equal for equal texts only."""
    first = name_blocks(docs, block)
    parts = _parts(docs)
    widest = first.agg(F.max("n_blocks")).first()[0] or 1
    current = first.select(ROW, "pos", "n_blocks", "name")
    done = current.filter(F.col("n_blocks") == 1).select(ROW, F.lit(0).alias("levels"), "name")
    level = 0
    while widest > 1:
        level, widest = level + 1, (widest + 1) // 2
        side = lambda i: F.max(F.when(F.pmod("pos", F.lit(2)) == i, F.col("name")))
        half = F.expr("pos div 2")
        pairs = (
            current.filter(F.col("n_blocks") > 1)
            .groupBy(ROW, half.alias("pos"), F.expr("(n_blocks + 1) div 2").alias("n_blocks"))
            .agg(side(0).alias("a"), F.coalesce(side(1), F.lit(0)).alias("b"))  # 0 names nothing
        )
        pairs = materialize(pairs, "name-pairs")
        table = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
        table = table.withColumn("part", F.pmod(F.xxhash64("a", "b"), F.lit(parts)))
        table = materialize(table.select("a", "b", "n", _name(table, "part", ["a", "b"], []).alias("name")), "pair-names")
        current = materialize(skew_lookup(pairs, table, ["a", "b"], "n", ["name"]).drop("a", "b"), "names")
        done = done.unionByName(current.filter(F.col("n_blocks") == 1).select(ROW, F.lit(level).alias("levels"), "name"))
    info = first.filter(F.col("pos") == 0).select(F.col(ROW).alias("__t_r"), "info")
    return done.join(info, F.col(ROW) == F.col("__t_r")).drop("__t_r")


def exact_dedup(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Decisions, one row per document: doc_id, keep_id, group_size, kept,
    text_sha256, points (code points of the original text). Of equal texts
    the one with most code points stays, then the smallest doc_id."""
    named = materialize(name_documents(docs, block), "identities")
    order = F.struct(-F.col("info.points"), F.col("info.doc_id").isNull(), F.col("info.doc_id"), F.col(ROW))
    groups = named.groupBy("levels", "name").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("best"))
    groups = groups.select("levels", "name", "n", F.col("best").getField("doc_id").alias("keep_id"), F.col(f"best.{ROW}").alias("keep_row"))
    groups = materialize(groups, "groups")
    rows = skew_lookup(named, groups.withColumn("group_size", F.col("n")), ["levels", "name"], "n", ["keep_id", "keep_row", "group_size"])
    return rows.select(
        *([ROW] if ROW in docs.columns else []),
        F.col("info.doc_id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col(ROW) == F.col("keep_row")).alias("kept"),
        F.col("info.text_sha256").alias("text_sha256"),
        F.col("info.points").alias("points"),
    )


def drop_exact_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = freeze(docs, "rows-to-dedup")
    chosen = exact_dedup(rows, block).filter("kept").select(ROW)
    return rows.join(chosen, ROW, "left_semi").drop(ROW)
