"""Fill-in-the-middle transformation over whole texts.

A text is a row of units (words with the white space before them, or single
characters). Two cuts, drawn from a hash of the document's id, part it into
prefix, middle and suffix, which are written in one of two orders:

    psm  <P>prefix<S>suffix<M>middle
    spm  <S>suffix<P>prefix<M>middle

The ends of the units are a set of offsets, held like a Roaring bitmap: offsets
with the same upper bits share a container, which is a sorted array, a bitmap
or a list of runs, whichever takes the fewest bytes. Containers come with their
cumulative cardinalities, so the k-th boundary is a search for the container
and a select inside it; both cut offsets are found this way and no list of
units is ever made.

Defined cases: a null text is empty; an empty text and one that holds a mark
stay as they are (form ``plain``), as do those that the draw leaves out; a null
id draws like an empty one; repeated rows draw alike; texts of any length are
cut whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
RATE = 50  # percent of the texts that are transformed
SPM = 80  # percent of those that put the suffix first
MARKS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM_FORM = "plain", "psm", "spm"
BATCH = 1024  # texts of an Arrow batch that are held at a time

_LOW = 16  # bits of an offset inside its container
_BITMAP_BYTES = 1 << (_LOW - 3)


class ArrayContainer:
    """Sorted 16-bit values."""

    def __init__(self, low: np.ndarray):
        self.values = low.astype("uint16")

    @staticmethod
    def size(low: np.ndarray, runs: int) -> int:
        return 2 * len(low)

    def select(self, k: int) -> int:
        return int(self.values[k])


class BitmapContainer:
    """One bit a value, with the number of bits up to the end of each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(8 * _BITMAP_BYTES, dtype=bool)
        bits[low] = True
        self.bits = np.packbits(bits, bitorder="little")
        self.upto = np.cumsum(np.bitwise_count(self.bits.view("<u8")), dtype="int64")

    @staticmethod
    def size(low: np.ndarray, runs: int) -> int:
        return _BITMAP_BYTES

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.upto, k, side="right"))
        left = k - (int(self.upto[word - 1]) if word else 0)
        inside = np.flatnonzero(np.unpackbits(self.bits[8 * word : 8 * word + 8], bitorder="little"))
        return 64 * word + int(inside[left])


class RunContainer:
    """First values of runs, with the number of values up to the end of each."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=low[0] - 2) != 1)
        self.first = low[first].astype("uint16")
        self.upto = np.append(first[1:], len(low))

    @staticmethod
    def size(low: np.ndarray, runs: int) -> int:
        return 2 + 4 * runs

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.upto, k, side="right"))
        return int(self.first[run]) + k - (int(self.upto[run - 1]) if run else 0)


CONTAINERS = ArrayContainer, BitmapContainer, RunContainer


class Boundaries:
    """A set of offsets with the k-th smallest in two searches."""

    def __init__(self, offsets: np.ndarray):
        """``offsets`` ascend and do not repeat."""
        high = offsets >> _LOW
        starts = np.flatnonzero(np.diff(high, prepend=-1))
        self.high = high[starts]
        self.upto = np.append(starts[1:], len(offsets))
        self.containers = []
        for a, b in zip(starts.tolist(), self.upto.tolist(), strict=True):
            low = offsets[a:b] & ((1 << _LOW) - 1)
            runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
            best = min(CONTAINERS, key=lambda c: c.size(low, runs))
            self.containers.append(best(low))

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.upto, k, side="right"))
        before = int(self.upto[at - 1]) if at else 0
        return (int(self.high[at]) << _LOW) + self.containers[at].select(k - before)


def word_offsets(text: str) -> np.ndarray:
    """0 and the ends of the tokens ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+``
    and of white space at the end of the text, in code points."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    space = (points == 32) | ((points >= 9) & (points <= 13))
    ends = ~space
    ends[:-1] &= space[1:]
    ends[-1:] = True
    return np.append(0, np.flatnonzero(ends) + 1)


def char_offsets(text: str) -> np.ndarray:
    return np.arange(len(text) + 1)


UNITS = {"words": word_offsets, "chars": char_offsets}


def draws(doc_id, seed: int = SEED) -> list[int]:
    """h1 to h4: the first four 32-bit numbers of the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def transform(doc_id, text: str, units: str = "words", rate: int = RATE, spm: int = SPM, seed: int = SEED):
    """(n, form, prefix length, middle length, output) of one text."""
    edges = Boundaries(UNITS[units](text))
    n = len(edges) - 1
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or any(m in text for m in MARKS):
        return n, PLAIN, None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = edges.select(a), edges.select(b)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return n, SPM_FORM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    docs: DataFrame, units: str = "words", rate: int = RATE, spm: int = SPM, seed: int = SEED, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The key, n (units), form, prefix_chars, middle_chars and output of every row."""
    if units not in UNITS:
        raise ValueError(f"units must be one of {', '.join(UNITS)}")
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                made = zip(*(transform(d, t or "", units, rate, spm, seed) for d, t in rows), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(made, kinds, strict=True))], names=names)

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that an output was made from. A transformed text holds no mark
    of its own, so the first of each kind is the one that was written."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))

    def parts(first: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, len(PREFIX) + 1, F.length(output))
        one = F.substring_index(body, first, 1)
        rest = F.substring(body, F.length(one) + len(first) + 1, F.length(output))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.length(two) + len(MIDDLE) + 1, F.length(output))

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    return F.when(form == PSM, psm).when(form == SPM_FORM, F.concat(prefix, middle, suffix)).otherwise(output)


def oracle(rate: int = RATE, spm: int = SPM, seed: int = SEED) -> str:
    """The query's rows in DuckDB's SQL."""
    return rf"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS h,
                 regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
    h AS (SELECT *, len(w)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
            ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {rate} THEN '{PLAIN}'
                 WHEN h4 % 100 < {spm} THEN '{SPM_FORM}' ELSE '{PSM}' END AS form FROM h),
    p AS (SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:], '') AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> '{PLAIN}' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> '{PLAIN}' THEN length(middle) END AS middle_chars,
      sha256(CASE form WHEN '{PLAIN}' THEN text WHEN '{PSM}' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
             ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
      sha256(prefix || middle || suffix) AS restored_sha256
    FROM p
    """
