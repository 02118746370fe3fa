"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the whole dialogue is rendered once,
with that speaker as the assistant and the others as named users; the mask
tells which characters are the assistant's own words, to be learned from.

    <|im_start|>assistant\\n...<|im_end|>\\n
    <|im_start|>user name=bob\\n...<|im_end|>\\n

Turns are numbered over the whole conversation, then rendered in blocks of at
most ``TURNS`` turns, so that a conversation that holds a third of all rows is
not collected anywhere: it comes out as several rows, with the offset of each
in the whole text. An ordinary conversation is one row for each participant.

Turns are put in order by ranges of conversation, number, role and text, so
neither a hot conversation nor many turns of one number are in one task. The
offsets come from lengths, before anything is rendered; texts meet the
participants by conversation and block, and are rendered once.

Defined cases: ``system`` turns are rendered as such and never take part; a
null role speaks as the user ``unknown`` and never takes part; a null text is
empty; turns without a number come first; turns with equal numbers are ordered
by role, then text; repeated rows
are turns of their own; a conversation without participants gives no row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, place_in_order
from tessera.operators.sequence import same

TURNS = 256
SYSTEM = "system"
UNKNOWN = "unknown"
START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def _others_name(role: Column) -> Column:
    """How a turn is headed for everybody but its speaker."""
    return F.when(role == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), F.coalesce(role, F.lit(UNKNOWN))))


def _length(name: Column, text: Column) -> Column:
    """Characters of a rendered turn."""
    return F.length(name) + text + (len(START) + 1 + len(END))


def rotate_perspectives(turns: DataFrame, block_turns: int = TURNS) -> DataFrame:
    """conv_id, perspective, block (from 0), first_turn (place in the
    conversation), n_turns, offset (in characters), text, and mask: the spans
    (start, end) of the whole text that are the assistant's words."""
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    placed = place_in_order(rows, ["conv_id"], [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")], "turns")
    block = F.expr(f"__t_pos div {block_turns}")
    placed = placed.select("conv_id", "role", "text", F.col("__t_pos").alias("__t_place"), block.alias("block"))
    placed = materialize(placed, "placed-turns")

    # Lengths of the turns as everybody else sees them, a row a block ...
    blocks = placed.groupBy("conv_id", "block").agg(F.sum(_length(_others_name(F.col("role")), F.length("text"))).alias("size"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("from"))
    # ... which are shorter by the speaker's own turns before the block.
    speaks = placed.filter(F.col("role").isNotNull() & (F.col("role") != SYSTEM))
    own = speaks.groupBy("conv_id", F.col("role").alias("perspective"), "block").agg(F.count(F.lit(1)).alias("turns"))
    speakers = own.select(F.col("conv_id").alias("__t_conv"), "perspective").distinct()
    grid = blocks.join(speakers, blocks["conv_id"].eqNullSafe(speakers["__t_conv"])).drop("__t_conv")
    own = own.select(*[F.col(c).alias(f"__t_{c}") for c in ("conv_id", "perspective", "block")], "turns")
    grid = grid.join(own, same((grid[c], own[f"__t_{c}"]) for c in ("conv_id", "perspective", "block")), "left")
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    less = F.length(_others_name(F.col("perspective"))) - len(ASSISTANT)
    offset = F.col("from") - F.coalesce(F.sum(F.coalesce("turns", F.lit(0))).over(earlier), F.lit(0)) * less
    grid = grid.select(F.col("conv_id").alias("__t_conv"), F.col("block").alias("__t_block"), "perspective", offset.alias("offset"))

    texts = placed.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("__t_place", "role", "text"))).alias("turns"))
    seen = texts.join(grid, same([(texts["conv_id"], grid["__t_conv"]), (texts["block"], grid["__t_block"])]))

    def piece(t: Column) -> Column:
        own = t["role"].eqNullSafe(F.col("perspective"))
        head = F.concat(F.lit(START), F.when(own, F.lit(ASSISTANT)).otherwise(_others_name(t["role"])), F.lit("\n"))
        return F.struct(F.concat(head, t["text"], F.lit(END)).alias("text"), own.alias("own"), F.length(head).alias("from"), F.length(t["text"]).alias("n"))

    def add(s: Column, x: Column) -> Column:
        start = s["at"] + x["from"]
        end = start + x["n"] + len(END) - 1  # the end mark of an own turn is learned too, but not the line feed
        spans = F.when(x["own"], F.concat(s["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(s["spans"])
        return F.struct((start + x["n"] + len(END)).alias("at"), spans.alias("spans"))

    pieces = seen.select("conv_id", "perspective", "block", "offset", F.transform("turns", piece).alias("p"))
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    mask = F.aggregate("p", F.struct(F.col("offset").alias("at"), empty.alias("spans")), add, lambda s: s["spans"])
    return pieces.select(
        "conv_id",
        "perspective",
        "block",
        (F.col("block") * block_turns).alias("first_turn"),
        F.size("p").alias("n_turns"),
        "offset",
        F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"),
        mask.alias("mask"),
    )


def oracle(block_turns: int = TURNS) -> str:
    """The same rows in DuckDB's SQL; the mask as text."""
    return f"""
    WITH t AS (SELECT conv_id, role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, coalesce(text, '')) - 1 AS place FROM conversations),
    s AS (SELECT DISTINCT conv_id AS c, role AS perspective FROM t WHERE role IS NOT NULL AND role <> '{SYSTEM}'),
    h AS (SELECT conv_id, perspective, place, place // {block_turns} AS block, text, role IS NOT DISTINCT FROM perspective AS own,
            '{START}' || CASE WHEN role IS NOT DISTINCT FROM perspective THEN 'assistant' WHEN role = '{SYSTEM}' THEN '{SYSTEM}'
              ELSE 'user name=' || coalesce(role, '{UNKNOWN}') END || chr(10) AS head FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.c),
    w AS (SELECT *, head || text || '{END[:-1]}' || chr(10) AS whole FROM h),
    o AS (SELECT *, coalesce(sum(length(whole)) OVER (PARTITION BY conv_id, perspective ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM w)
    SELECT conv_id, perspective, block, block * {block_turns} AS first_turn, count(*)::INT AS n_turns, min(pos)::BIGINT AS offset,
      string_agg(whole, '' ORDER BY place) AS text,
      coalesce(string_agg((pos + length(head))::BIGINT || '-' || (pos + length(head) + length(text) + {len(END) - 1})::BIGINT, ',' ORDER BY place) FILTER (WHERE own), '') AS mask
    FROM o GROUP BY conv_id, perspective, block
    """
