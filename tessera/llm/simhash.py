"""SimHash near-duplicates by anchor points of a covering code.

Fingerprint: words of the ASCII-lower-cased text, shingles of a few words,
XXH64 of each; a bit is set if it is set in over half of the hashes. Two
documents are linked if their fingerprints differ in at most ``max_bits`` bits.

Anchors are the words of a covering code: two copies of the binary Golay code
over bits 0-22 and 23-45 (covering radius 3 each, and perfect: every block of
23 bits has exactly one code word within 3). Two fingerprints within
``max_bits`` have a point between them, at most half that far from both; that
point lies within the covering radius of its anchor, so both lie within
covering radius plus their half of the threshold. Each fingerprint therefore
goes to the anchors of all points within half the threshold of it (about ten
of 2^24), and fingerprints are compared only with those at the same anchor.

Equal fingerprints are one class from the start; no pair of copies is made.
At an anchor the links are reduced to a spanning forest, so a group gives
fewer links than members. An anchor with more than ``CROWD`` fingerprints is
not compared in one task: its members go on to the code in which every point
is an anchor (radius 0), where at most 65 meet. Components are found by
contraction rounds (``components``). All texts, words and shingles count.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; repeated rows and equal fingerprints are one class; a component
whose doc_ids are all null has a null id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep_rows, materialize, skew_lookup
from tessera.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
CROWD = 4096
_STEP = 1 << 20  # bytes of a very long text that are worked on at a time

# Generator polynomial of the binary Golay code of length 23:
# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
GOLAY_BITS = 23


def _stretches(data: bytes) -> Iterator[bytes]:
    """The text in stretches that end at white space."""
    at = 0
    while at < len(data):
        end = at + _STEP
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[at:end]
        at = end


def shingle_hashes(text: str | None, width: int = SHINGLE) -> list[int]:
    """XXH64 of every shingle; of the whole sequence if it is shorter."""
    import xxhash

    digest, hashes, words = xxhash.xxh64_intdigest, [], []
    for part in _stretches((text or "").encode("utf-8", "surrogatepass").lower()):  # bytes.lower: A-Z only
        words += part.split()  # bytes.split: 0x20 and 0x09-0x0D
        if len(words) >= width:
            line, starts, at = b" ".join(words), [0], 0
            for w in words:
                at += len(w) + 1
                starts.append(at)
            hashes += [digest(line[i : j - 1], SEED) for i, j in zip(starts, starts[width:], strict=False)]
            words = words[len(words) - width + 1 :] if width > 1 else []
    if not hashes and words:
        hashes = [digest(b" ".join(words), SEED)]
    return hashes


def majority(hashes: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes, as signed 64-bit numbers."""
    out = np.zeros(len(sizes), dtype="<u8")
    at = 0
    weights = np.uint64(1) << np.arange(64, dtype="u8")
    for i, n in enumerate(sizes):
        ones = np.zeros(64, dtype=np.int64)
        for s in range(at, at + n, 100_000):
            part = hashes[s : min(s + 100_000, at + n)]
            ones += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = weights[2 * ones > n].sum(dtype="u8") if n else 0
        at += n
    return out.view("<i8")


def fingerprint(text: Column | str, width: int = SHINGLE) -> Column:
    """The 64-bit fingerprint as a long."""

    @F.pandas_udf("long")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            found = []
            for t in series:
                h = shingle_hashes(t, width)
                found.append(majority(np.asarray(h, dtype="<u8"), [len(h)])[0])
            yield pd.Series(found, dtype="int64")

    return run(text)


def _golay_errors() -> np.ndarray:
    """By syndrome: the one pattern of at most 3 of 23 bits that has it."""
    from itertools import combinations

    errors = np.zeros(1 << 11, dtype="u4")
    for weight in range(4):
        for bits in combinations(range(GOLAY_BITS), weight):
            e = sum(1 << b for b in bits)
            errors[_syndrome(e)] = e
    return errors


def _syndrome(word: int) -> int:
    for b in range(GOLAY_BITS - 1, 10, -1):
        if word >> b & 1:
            word ^= GOLAY << (b - 11)
    return word


def _anchor_finder():
    errors = _golay_errors()
    ones = np.array([_syndrome(1 << b) for b in range(GOLAY_BITS)], dtype="u4")
    tables = []  # syndromes add up, so they can be read 8 bits at a time
    for shift in (0, 8, 16):
        table = np.zeros(256, dtype="u4")
        for b in range(8):
            if shift + b < GOLAY_BITS:
                table[(np.arange(256) >> b & 1) == 1] ^= ones[shift + b]
        tables.append(table)

    def nearest(block: np.ndarray) -> np.ndarray:
        s = tables[0][block & 255] ^ tables[1][block >> 8 & 255] ^ tables[2][block >> 16]
        return block ^ errors[s]

    return nearest


def _flips(reach: int) -> np.ndarray:
    """All patterns of at most ``reach`` bits over the 46 that are coded."""
    from itertools import combinations

    return np.array([sum(1 << b for b in c) for k in range(reach + 1) for c in combinations(range(2 * GOLAY_BITS), k)], dtype="u8")


def anchors(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(anchor, fp): every anchor that the code gives a point within half of
    ``max_bits`` of the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest, flips, mask = _anchor_finder(), _flips((max_bits + 1) // 2), np.uint64((1 << GOLAY_BITS) - 1)
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                fp = whole.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).astype("i8")
                point = fp.view("u8")[:, None] ^ flips[None, :]
                low = nearest((point & mask).astype("u4")).astype("u8")
                high = nearest((point >> np.uint64(GOLAY_BITS) & mask).astype("u4")).astype("u8")
                found = np.sort(low | high << np.uint64(GOLAY_BITS), axis=1)
                new = np.ones(found.shape, dtype=bool)
                new[:, 1:] = found[:, 1:] != found[:, :-1]
                row, _ = np.nonzero(new)
                yield pa.RecordBatch.from_arrays([pa.array(found[new].view("i8")), pa.array(fp[row])], names=["anchor", "fp"])

    return prints.select("fp").mapInArrow(run, "anchor long, fp long")


def _forest(pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spanning forest of the pairs, as (member, root)."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (r := root.setdefault(x, x)) != x:
            root[x] = root[r]
            x = r
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [(x, top(x)) for x in root if top(x) != x]


def _links(fp: np.ndarray, starts: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links inside consecutive groups of distinct fingerprints."""
    out: list[tuple[int, int]] = []
    sizes = np.diff(np.append(starts, len(fp)))
    place = np.arange(len(fp)) - np.repeat(starts, sizes)
    room = np.repeat(sizes, sizes) - place  # members from here to the group's end
    bits = fp.view("u8")
    for shift in range(1, int(sizes.max(initial=1))):
        i = np.flatnonzero(room > shift)
        near = i[np.bitwise_count(bits[i] ^ bits[i + shift]) <= max_bits]
        if len(near):
            out += _forest(zip(fp[near].tolist(), fp[near + shift].tolist(), strict=True))
    return out


def links_at_anchors(pairs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v): links between fingerprints at the same anchor that keep all of
    them connected. The caller keeps crowds away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, fp = np.zeros(0, "i8"), np.zeros(0, "i8")

        def compare(a: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, "i8")
            found = _forest(_links(f, starts, max_bits)) if len(a) else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

        for batch in batches:
            anchor = np.append(anchor, batch.column(0).to_numpy(zero_copy_only=False))
            fp = np.append(fp, batch.column(1).to_numpy(zero_copy_only=False))
            if not len(anchor):
                continue
            cut = int(np.searchsorted(anchor, anchor[-1]))  # the last group may go on
            yield compare(anchor[:cut], fp[:cut])
            anchor, fp = anchor[cut:], fp[cut:]
        yield compare(anchor, fp)

    return pairs.repartition("anchor").sortWithinPartitions("anchor", "fp").mapInArrow(run, "u long, v long")


def links_in_crowds(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The same links by the code in which every point is an anchor."""
    from itertools import combinations

    reach = (max_bits + 1) // 2
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    flips = [signed(sum(1 << b for b in c)) for k in range(reach + 1) for c in combinations(range(64), k)]
    points = prints.select("fp", F.explode(F.array(*[F.lit(x).cast("long") for x in flips])).alias("flip"))
    points = points.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    # At most len(flips) distinct fingerprints lie around a point.
    members = points.groupBy("point").agg(F.array_sort(F.collect_list("fp")).alias("fps")).filter(F.size("fps") > 1)
    if 2 * reach == max_bits:  # all around a point are within the threshold of each other: a star links them
        star = members.select(F.col("fps")[0].alias("u"), F.explode(F.expr("slice(fps, 2, size(fps))")).alias("v"))
        return star.distinct()
    pair = F.explode(F.expr("flatten(transform(fps, (a, i) -> transform(slice(fps, i + 2, size(fps)), b -> struct(a as u, b as v))))"))
    near = members.select(pair.alias("p")).select("p.u", "p.v")
    return near.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits).distinct()


def link_fingerprints(prints: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """Links (u, v) that connect what is within ``max_bits``. ``prints`` has
    distinct fingerprints ``fp``."""
    pairs = materialize(anchors(prints, max_bits), "anchors")
    crowds = materialize(pairs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("anchor"), "crowds")
    if crowds.isEmpty():
        return links_at_anchors(pairs, max_bits)
    rest = pairs.join(crowds, "anchor", "left_anti")
    packed = pairs.join(crowds, "anchor", "left_semi").select("fp").distinct()
    return links_at_anchors(rest, max_bits).unionByName(links_in_crowds(packed, max_bits))


def simhash_groups(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, fp, text_hash (XXH64 of the text, to tell
    rows apart), component_id, and stays, true for one class of each component."""
    rows = docs.select("doc_id", fingerprint("text", width).alias("fp"), F.xxhash64("text").alias("text_hash"))
    rows = materialize(rows, "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    classes = materialize(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), first.alias("first")), "classes")
    components = connected_components(link_fingerprints(classes.select("fp"), max_bits, crowd))
    labels = classes.join(components, F.col("fp") == F.col("node"), "left").select("fp", "n", "first", F.coalesce("component", "fp").alias("label"))
    labels = materialize(labels, "labels")
    best = materialize(labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("best")), "components-best")
    table = materialize(skew_lookup(labels, best, ["label"], "n", ["best"]).select("fp", "n", "best"), "fingerprint-components")
    found = skew_lookup(rows, table, ["fp"], "n", ["best"])
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    return found.select("doc_id", "fp", "text_hash", F.col("best.doc_id").alias("component_id"), stays.alias("stays"))


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, with all its columns."""
    chosen = simhash_groups(docs, width, max_bits).filter("stays")
    return keep_rows(docs, chosen, {"doc_id": F.col("doc_id"), "text_hash": F.xxhash64("text")})
