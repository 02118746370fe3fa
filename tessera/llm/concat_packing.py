"""Concatenate-and-cut packing into sequences of a fixed length.

All documents form one stream of token ids (an end id closes each), which is
cut every ``capacity`` ids. Nothing is padded but the last sequence.

Two passes give every document its place in the stream without moving a text:

1. each task tokenizes its partition and notes, for every document, how many
   ids of the partition come before it; the result is written once;
2. the partitions' totals (one row a partition) are added up in order, which
   gives the first global offset of each partition, and with it that of each
   document.

A document then falls into the fixed windows that its ids cover: one piece for
each. A piece that goes on with a document from the window before is a
boundary record (``boundary``); a document of any length is cut this way, so no
sequence is larger than the capacity. Ids are little-endian unsigned 32-bit
numbers in one binary value, which pieces take substrings of; no row of ids is
shuffled. Only the offsets are broadcast: 16 bytes for each partition that was
read, so their number follows the splits of the input and nothing else.

Defined cases: a null or empty text is the end id only; repeated rows, equal
ids and null ids are documents of their own; an empty table gives an empty
result; other columns are ignored. Texts that look like special tokens are
tokenized as the tokenizer file says.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize

CAPACITY = 2048
END_ID = 1
#: Distinct chunks other than simple ones whose ids a Python worker remembers.
CHUNK_MEMORY = 100_000
BATCH = 256  # texts tokenized at a time

# What becomes of the characters of a simple text, so that every token of the
# pre-tokenizer ends with a line feed: white space separates, a digit stands
# alone, marks that touch form one token (their inner edges are taken out).
_OPEN, _CLOSE, _QUOTE = "\x01", "\x02", "\x03"
_CONTRACTION = re.compile(r"'(?:s|t|re|ve|m|ll|d)")
_READY: dict[str, "WordTokenizer"] = {}


def _repertoire() -> tuple[frozenset[str], dict[str, str]]:
    """Letters, and what replaces other characters: Latin letters and marks
    that composing leaves alone and that lower-casing maps one to one."""
    letters, others = set(), {}
    for c in map(chr, [*range(0x250), *range(0x2010, 0x2028)]):
        kind = unicodedata.category(c)[0]
        if c in " \t\r\n":
            others[c] = "\n"
        elif kind == "L":
            letters.add(c)
        elif kind == "N":
            others[c] = f"\n{c}\n"
        elif kind in "PS":
            others[c] = f"{_OPEN}{c}{_CLOSE}"
    return frozenset(letters), others


_LETTERS, _OTHERS = _repertoire()
_SIMPLE = _LETTERS | _OTHERS.keys()


def _lines(text: str) -> str | None:
    """The tokens of a simple text, lower-cased, a line each; None for others."""
    low = text.lower()
    there = set(low) - _LETTERS
    if not there <= _OTHERS.keys():
        return None
    if "'" in there:

        def contraction(m: re.Match) -> str:
            before = _OTHERS.get(low[m.start() - 1], "") if m.start() else ""
            return m[0] if before.startswith(_OPEN) else f"\n{_QUOTE}{m[0][1:]}\n"

        low = _CONTRACTION.sub(contraction, low)
    for c in there:
        low = low.replace(c, _OTHERS[c])
    return low.replace(_CLOSE + _OPEN, "").replace(_OPEN, "\n").replace(_CLOSE, "\n").replace(_QUOTE, "'") + "\n"


def _line_engine(path: str):
    """An engine for such lines with the ids of a BPE with word ends, or None
    if the file holds another kind. A line feed plays the part of the end mark."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, end = spec["model"], spec["model"].get("end_of_word_suffix")
    if model.get("type") != "BPE" or not end or model.get("dropout"):
        return None
    vocab = model["vocab"]
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if [vocab[m] for m in merged] != list(range(512, 512 + len(merged))):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    byte = {chr(b): b for b in shown}
    byte.update((chr(256 + i), b) for i, b in enumerate(sorted(set(range(256)) - set(shown))))
    ranks = {bytes(byte[c] for c in t.removesuffix(end)) + b"\n" * t.endswith(end): i for t, i in vocab.items()}
    return tiktoken.Encoding("lines", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})


class WordTokenizer:
    """Ids of whole texts as little-endian 32-bit bytes.

    Texts of Latin letters, digits and marks go through :func:`_line_engine`,
    which gives the ids of the tokenizer file in less time. Others are cut at
    spaces and line feeds, which the tokenizer drops: simple stretches go the
    same way, other chunks through ``tokenizers``, each distinct one once.
    """

    def __init__(self, path: str, memory: int = CHUNK_MEMORY):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.memory = memory
        self._tok = Tokenizer.from_file(path)
        self._engine = _line_engine(path)
        self._added = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        self._known: dict[str, bytes] = {}

    def _simple(self, text: str) -> bytes | None:
        if self._engine is None or any(t in text for t in self._added) or (lines := _lines(text)) is None:
            return None
        return self._engine.encode_to_numpy(lines).astype("<u4", copy=False).tobytes()

    def _odd(self, chunk: str) -> bytes:
        ids = self._known.get(chunk)
        if ids is None:
            if len(self._known) >= self.memory:
                self._known.clear()
            ids = np.asarray(self._tok.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()
            self._known[chunk] = ids
        return ids

    def _mixed(self, text: str) -> Iterator[bytes]:
        chunks = text.replace("\n", " ").split(" ")
        for simple, run in groupby(chunks, lambda c: _SIMPLE.issuperset(c.lower()) and not any(t in c for t in self._added)):
            if simple and self._engine is not None:
                yield self._simple(" ".join(run))
            else:
                yield from map(self._odd, run)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [b"".join(self._mixed(t)) if (ids := self._simple(t)) is None else ids for t in texts]


def tokenizer(path: str, memory: int = CHUNK_MEMORY) -> WordTokenizer:
    """One tokenizer for each Python worker and file."""
    if path not in _READY:
        _READY[path] = WordTokenizer(path)
    _READY[path].memory = memory
    return _READY[path]


def token_stream(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, key: str = "doc_id", text: str = "text", chunk_memory: int = CHUNK_MEMORY
) -> DataFrame:
    """First pass, written once: key, part, before (ids of the part that come
    before the document), doc_tokens and ids."""
    kind = docs.schema[key].dataType.simpleString()
    end = np.asarray([end_id], dtype="<u4").tobytes()
    names = [key, "part", "before", "doc_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_path, chunk_memory)
        part, before = TaskContext.get().partitionId(), 0
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                ids = [d + end for d in tok.encode([t or "" for t in batch.column(1).to_pylist()])]
                sizes = np.array([len(d) // 4 for d in ids], dtype="int64")
                starts = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                arrays = [batch.column(0), pa.array(np.full(len(ids), part, dtype="int32")), pa.array(starts), pa.array(sizes), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    stream = docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, part int, before long, doc_tokens long, ids binary")
    return materialize(stream, "token-stream")


def part_offsets(stream: DataFrame) -> DataFrame:
    """Second pass: part and base, the number of ids in all parts before it."""
    totals = stream.groupBy("part").agg(F.max(F.col("before") + F.col("doc_tokens")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    return totals.select(F.col("part").alias("__t_part"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def cut_windows(stream: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of a token stream: its key, start, length, ids, doc_tokens,
    sequence_id, offset and boundary."""
    if capacity < 1:
        raise ValueError("the capacity must be positive")
    placed = stream.join(F.broadcast(part_offsets(stream)), F.col("part") == F.col("__t_part"))
    placed = placed.withColumn("__t_at", F.col("base") + F.col("before"))
    windows = F.expr(f"sequence(__t_at div {capacity}, (__t_at + doc_tokens - 1) div {capacity})")

    def piece(w):
        start = F.greatest(F.lit(0).cast("long"), w * capacity - F.col("__t_at"))
        end = F.least(F.col("doc_tokens"), (w + 1) * capacity - F.col("__t_at"))
        ids = F.substring(F.col("ids"), (start * 4 + 1).cast("int"), ((end - start) * 4).cast("int"))
        return F.struct(
            start.alias("start"), (end - start).alias("length"), ids.alias("ids"),
            w.alias("sequence_id"), (F.col("__t_at") + start - w * capacity).alias("offset"),
        )

    key = stream.columns[0]
    pieces = placed.select(F.col(f"`{key}`"), "doc_tokens", F.inline(F.transform(windows, piece)))
    return pieces.withColumn("boundary", F.col("start") > 0)


def concat_and_cut(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
    chunk_memory: int = CHUNK_MEMORY,
) -> DataFrame:
    """Tokenize ``docs`` and cut their stream: one row a piece, with its ids."""
    return cut_windows(token_stream(docs, tokenizer_path, end_id, key, text, chunk_memory), capacity)


def assemble_sequences(pieces: DataFrame) -> DataFrame:
    """The training sequences: sequence_id, ids (binary, at most the capacity)
    and, piece by piece, the lengths, for attention masks."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.col("p.length").alias("lengths"))
