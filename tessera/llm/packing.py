"""Best-fit packing of token sequences, large items by matching.

Documents become token ids (an end id closes each), documents longer than the
capacity are cut into pieces, and the pieces are packed into sequences of at
most ``capacity`` tokens:

* pieces above one third of the capacity fit at most twice into a sequence;
  they are paired by greedy matching, the largest with the largest that fits;
* the smaller ones, in descending length, go to the fullest sequence that
  still has room (best fit), or open a new one.

Lengths are integers from 1 to the capacity, so both rules depend on the
number of pieces of each length only. The driver sees that histogram (at most
``capacity`` rows, whatever the corpus holds) and answers with runs: "pieces
number a to b of length n go to sequences c, c+1, ..., k in each, from offset
o". The pieces are numbered inside their length and placed by Spark; a length
that holds a third of all rows is numbered in hashed parts.

Defined cases: a null or empty text is one piece that holds the end id only;
repeated rows, equal ids and null ids are packed as rows of their own; an
empty table gives an empty result; other columns are ignored. Texts that look
like special tokens are tokenized as the tokenizer file says.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ROW, freeze, shuffle_width
from tessera.operators.sequence import rank_in_groups

CAPACITY = 1024
END_ID = 2
#: Distinct chunks whose ids a Python worker remembers, in two generations: when
#: the young half is full it becomes the old one, and the old one is forgotten.
CHUNK_MEMORY = 480_000

# A byte-level BPE never merges over a single space or line feed that stands
# between two visible characters, nor between a letter and a closing mark, so
# texts are cut there; chunks repeat, and each distinct one is encoded once.
_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
_WORD = re.compile(r" (?<=\S )(?=\S)")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_SPACE = re.compile(r"\s")
_NOT_LATIN = re.compile(r"[^\0-\u024f]")
_MARKS = frozenset(".,;:!?")
_READY: dict[str, "ChunkTokenizer"] = {}


def _plain(text: str) -> bool:
    """All white space of the text is single spaces and line feeds inside."""
    odd = ("  ", " \n", "\n ", "\n\n")
    return not (any(x in text for x in odd) or text[:1].isspace() or text[-1:].isspace() or _OTHER_SPACE.search(text))


def _merge_engine(path: str):
    """The same vocabulary in a faster BPE engine, for any text and for plain
    ones, or None if the file holds more than plain byte-level BPE with ids in
    merge order."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    if spec["normalizer"] or not plain or model.get("type") != "BPE" or model.get("dropout"):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    byte = {chr(b): b for b in shown}
    byte.update((chr(256 + i), b) for i, b in enumerate(sorted(set(range(256)) - set(shown))))
    added = {x["content"] for x in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if [model["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
        return None
    # Without the look-ahead for runs of white space, which plain texts do not have.
    pattern = public_tokenizers.PATTERN.replace(r"|\s+(?!\S)", "")
    return [tiktoken.Encoding(n, pat_str=p, mergeable_ranks=ranks, special_tokens={}) for n, p in (("merges", public_tokenizers.PATTERN), ("plain", pattern))]


class ChunkTokenizer:
    """Ids of whole texts as little-endian 32-bit bytes.

    The tokenizer file decides the ids. Plain texts of Latin letters, digits
    and marks go whole through :func:`_merge_engine`, which gives the same ids
    in less time. Others go chunk by chunk: simple chunks through the engine,
    and all others, and whatever looks like an added token, through the
    ``tokenizers`` library. A chunk is kept without the space before it:
    ``" "`` has the ids with that space, ``""`` those at the start of a line.
    """

    def __init__(self, path: str, memory: int = CHUNK_MEMORY):
        self.memory = memory
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._fast, self._whole = _merge_engine(path) or (None, None)
        self._added = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        self._line_feed = np.asarray(self._tok.encode("\n", add_special_tokens=False).ids, dtype="<u4")
        self._known: dict[str, dict[str, bytes]] = {"": {}, " ": {}}
        self._old: dict[str, dict[str, bytes]] = {"": {}, " ": {}}

    def _ids(self, text: str) -> np.ndarray:
        latin = self._fast and not _NOT_LATIN.search(text) and not any(t in text for t in self._added)
        ids = self._fast.encode_ordinary(text) if latin else self._tok.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4")

    def _encode(self, chunks: list[str]) -> Iterator[bytes]:
        """Ids of plain chunks, many at once, one a line."""
        for at in range(0, len(chunks), 2000):
            part = chunks[at : at + 2000]
            ids = self._ids("\n".join(part))
            ends = np.flatnonzero(ids == self._line_feed[0])
            if len(self._line_feed) == 1 and len(ends) == len(part) - 1:
                data, cuts = ids.tobytes(), [-1, *ends.tolist(), len(ids)]
                yield from (data[4 * i + 4 : 4 * j] for i, j in zip(cuts, cuts[1:], strict=False))
            else:
                yield from (self._ids(c).tobytes() for c in part)

    def _learn(self, chunks: set[str], lead: str) -> None:
        known, old = self._known[lead], self._old[lead]
        again = chunks & old.keys()
        known.update((c, old[c]) for c in again)
        chunks = chunks - again
        odd = {c for c in chunks if not c or _SPACE.search(c)}
        marked = [c for c in chunks if c[-1:] in _MARKS and c[-2:-1].isalpha() and c not in odd]
        whole = chunks.difference(odd, marked).union(c[:-1] for c in marked) - known.keys()
        latin = [c for c in whole if not _NOT_LATIN.search(c)]
        for group in (latin, [c for c in whole if _NOT_LATIN.search(c)]):
            known.update(zip(group, self._encode([lead + c for c in group]), strict=True))
        known.update((c, self._ids(lead + c).tobytes()) for c in odd)
        mark = {m: self._ids(m).tobytes() for m in _MARKS}
        known.update((c, known[c[:-1]] + mark[c[-1]]) for c in marked)

    def rest(self) -> None:
        """Give up the old generation; between tasks other work needs the memory."""
        self._old = {"": {}, " ": {}}

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [self._fast and not _NOT_LATIN.search(t) and not any(a in t for a in self._added) and _plain(t) for t in texts]
        rest = iter(self._chunked([t for t, w in zip(texts, whole, strict=True) if not w]))
        return [self._whole.encode_to_numpy(t).astype("<u4", copy=False).tobytes() if w else next(rest) for t, w in zip(texts, whole, strict=True)]

    def _chunked(self, texts: list[str]) -> list[bytes]:
        cut = []
        for text in texts:
            if _plain(text):
                cut.append([line.split(" ") for line in text.split("\n")])
            else:
                cut.append([_WORD.split(line) for line in _LINE.split(text)])
        seen = {"": {words[0] for lines in cut for words in lines}, " ": set()}
        for lines in cut:
            for words in lines:
                seen[" "].update(words[1:])
        for lead, chunks in seen.items():
            fresh = chunks.difference(self._known[lead])
            if len(self._known[lead]) + len(fresh) > self.memory // 2:
                self._old[lead], self._known[lead] = self._known[lead], {}
                fresh = chunks
            self._learn(fresh, lead)
        bare, spaced, line_feed = self._known[""], self._known[" "].__getitem__, self._line_feed.tobytes()
        return [line_feed.join(bare[w[0]] + b"".join(map(spaced, w[1:])) for w in lines) for lines in cut]


def tokenizer(path: str, memory: int = CHUNK_MEMORY) -> ChunkTokenizer:
    """One tokenizer for each Python worker and file."""
    if path not in _READY:
        _READY[path] = ChunkTokenizer(path)
    _READY[path].memory = memory
    return _READY[path]


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; the first takes the rest."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, (first if first and s == 0 else capacity)) for s in starts]


def tokenize_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
    key: str = "doc_id",
    text: str = "text",
    chunk_memory: int = CHUNK_MEMORY,
) -> DataFrame:
    """One row for each piece: key, piece, start, length and, with
    ``with_ids``, the ids (little-endian unsigned 32-bit, in one binary value),
    else their ids_crc32. ``chunk_memory`` is the number of chunks that a
    Python worker may remember, a matter of time and memory only."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, {'ids binary' if with_ids else 'ids_crc32 long'}"
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_path, chunk_memory)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                cols: list[list] = [[], [], [], [], []]
                for row, data in enumerate(tok.encode(texts)):
                    data += end
                    for i, (start, length) in enumerate(cut_points(len(data) // 4, capacity)):
                        ids = data[4 * start : 4 * (start + length)]
                        for c, v in zip(cols, (row, i, start, length, ids if with_ids else zlib.crc32(ids)), strict=True):
                            c.append(v)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary() if with_ids else pa.int64()]
                arrays = [batch.column(0).take(pa.array(cols[0], pa.int32())), *(pa.array(c, k) for c, k in zip(cols[1:], kinds, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, names=[key, "piece", "start", "length", "ids" if with_ids else "ids_crc32"])
        tok.rest()

    return docs.select(key, text).mapInArrow(run, schema)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Pack ``counts[length]`` pieces of each length. Returns runs (length,
    rank_from, rank_to, first_sequence, per_sequence, offset): the pieces of
    that length with these ranks fill consecutive sequences, so many in each.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    ranked = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    rooms: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: (first sequence, how many)
    opened = 0

    def place(length: int, pieces: int, first: int, each: int, offset: int) -> None:
        at = ranked[length]
        runs.append((length, at, at + pieces, first, each, offset))
        ranked[length] = at + pieces
        left[length] -= pieces

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            # A piece matches its own length only when two are left.
            mate = next((m for m in large if m <= min(n, capacity - n) and left[m] >= (2 if m == n else 1)), None)
            pairs = left[n] if mate is None else left[n] // 2 if mate == n else min(left[n], left[mate])
            place(n, pairs, opened, 1, 0)
            if mate is not None:
                place(mate, pairs, opened, 1, n)
            rooms[capacity - n - (mate or 0)].append((opened, pairs))
            opened += pairs

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        for room in range(n, capacity + 1):  # the tightest room first
            if not left[n]:
                break
            each, stay = room // n, []
            for first, many in rooms[room]:
                full = min(many, left[n] // each)
                if full:
                    place(n, full * each, first, each, capacity - room)
                    rooms[room - each * n].append((first, full))
                    first, many = first + full, many - full
                if many and left[n]:  # the last one, partly filled
                    part = left[n]
                    place(n, part, first, part, capacity - room)
                    rooms[room - part * n].append((first, 1))
                    first, many = first + 1, many - 1
                if many:
                    stay.append((first, many))
            rooms[room] = stay
        if left[n]:
            each = capacity // n
            full, part = divmod(left[n], each)
            if full:
                place(n, full * each, opened, each, 0)
                rooms[capacity - each * n].append((opened, full))
            if part:
                place(n, part, opened + full, part, 0)
                rooms[capacity - part * n].append((opened + full, 1))
            opened += full + bool(part)
    return runs


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length``."""
    spark = pieces.sparkSession
    frozen = freeze(pieces, "pieces", "zstd")  # half of every id is zeros
    counts = {r[0]: r[1] for r in frozen.groupBy("length").count().collect()}  # at most `capacity` rows
    schema = "__t_len long, __t_from long, __t_to long, __t_first long, __t_each long, __t_at long"
    runs = spark.createDataFrame(plan_sequences(counts, capacity), schema)
    narrow = frozen.select(ROW, "length", F.pmod(F.xxhash64(ROW), F.lit(4 * shuffle_width(spark))).alias("__t_part"))
    ranked = rank_in_groups(narrow, ["length"], "__t_part", [ROW], "__t_rank")
    rank, nth = F.col("__t_rank"), F.col("__t_rank") - F.col("__t_from")
    placed = ranked.join(
        F.broadcast(runs),  # bounded by the capacity, like the histogram
        (F.col("length") == F.col("__t_len")) & (rank >= F.col("__t_from")) & (rank < F.col("__t_to")),
    ).select(
        F.col(ROW).alias("__t_placed"),
        (F.col("__t_first") + F.expr("(__t_rank - __t_from) div __t_each")).alias("sequence_id"),
        (F.col("__t_at") + F.pmod(nth, F.col("__t_each")) * F.col("length")).alias("offset"),
    )
    return frozen.join(placed, F.col(ROW) == F.col("__t_placed")).drop(ROW, "__t_placed")


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
    chunk_memory: int = CHUNK_MEMORY,
) -> DataFrame:
    """Tokenize, cut and pack ``docs``: doc_id, piece, start, length,
    ids_crc32 (, ids), sequence_id, offset. The digest is that of the placed ids."""
    pieces = tokenize_pieces(docs, tokenizer_path, capacity, end_id, with_ids, chunk_memory=chunk_memory)
    packed = pack_pieces(pieces, capacity)
    return packed.withColumn("ids_crc32", F.crc32("ids")) if with_ids else packed


def assemble_sequences(packed: DataFrame) -> DataFrame:
    """The training sequences themselves: sequence_id, ids (binary, at most the
    capacity) and doc_ids / lengths of the pieces in order, for attention masks."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.length").alias("lengths"),
    )
