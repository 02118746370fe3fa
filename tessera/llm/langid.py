"""Language identification by averaged hashed subword embeddings.

A text is the mean of the embeddings of the hashed byte n-grams of its words
(runs of letters, lower-cased, with their ends marked); a linear softmax over
that mean gives the language. Embeddings and softmax are trained together by
stochastic gradient descent in numpy, on a bounded sample of labelled rows
(``SAMPLE_PER_LANGUAGE`` rows of each of the ``LANGUAGES`` most frequent
languages, those with the smallest hashes; of a text longer than
``SAMPLE_CHARS`` characters a stretch of that length, at a hashed place; with
many languages fewer rows and shorter stretches, so that the driver holds at most
``SAMPLE_TOTAL`` characters). Languages are counted over all rows first, and only rows whose hash is small
enough for their language's count are looked at further, so the sample is no
larger to move in a large table than in a small one. Each fifth sampled row of a
language is kept for calibration (a language of fewer rows is only learned):
a temperature that makes the scores honest, and two bounds below which a
prediction is rejected, each the quantile under which half of ``MISSED`` of the
correct predictions lie. One is a bound of the score. A softmax over few
languages is sure of any text, so the other is a bound of how familiar the text
is: its n-grams' mean log-frequency in the training rows, all languages weighing
the same, against what is usual for the language told and for its length.

Because the softmax is linear, every n-gram has fixed contributions to the
scores; prediction adds these up over whole texts, each distinct word of a
batch once.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
rejected; without a labelled row every text is; repeated rows get equal
predictions; a null doc_id is never learned from and not held out; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import unit

BUCKETS = 1 << 16
WIDTH = 16
NGRAMS = (1, 2, 3, 4)
SAMPLE_PER_LANGUAGE = 800
SAMPLE_CHARS = 20_000
SAMPLE_TOTAL = 128_000_000
LEAST_PER_LANGUAGE = 100
LANGUAGES = 200  # a model has BUCKETS doubles for each: 105 MB
EPOCHS = 4
RATE = 0.5
#: Each n-gram has a small share of a text, so its step is longer by this factor.
GRAM_RATE = 20.0
MISSED = 0.001
UNKNOWN = "und"
#: Distinct words whose contributions a Python worker remembers at most.
WORD_MEMORY = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    found = _WORD.findall(text.lower()) if text else []
    # The pattern also takes numerals such as a superscript two.
    return found if any(c.isalpha() for w in found for c in w) else []


def word_grams(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words in one array, and how many each has."""
    data = [b"<" + w.encode("utf-8", "surrogatepass") + b">" for w in vocabulary]
    sizes = np.array([len(d) for d in data], dtype=np.int64)
    code = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(data)), sizes)
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(code))  # bytes to the word's end
    buckets, owner = [], []
    h = np.zeros(len(code), dtype=np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        nxt = np.zeros(len(code), dtype=np.uint64)
        nxt[: len(code) - n + 1] = code[n - 1 :]
        h = (h + nxt + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if n in NGRAMS:
            at = room >= n
            buckets.append((h[at] >> np.uint64(20)) % np.uint64(BUCKETS))
            owner.append(word[at])
    owner_all = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    order = np.argsort(owner_all, kind="stable")
    return np.concatenate(buckets)[order].astype(np.int64), np.bincount(owner_all, minlength=len(data))


@dataclass
class LanguageModel:
    """Contribution of each n-gram bucket to each language's score."""

    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    bias: np.ndarray
    temperature: float
    threshold: float
    familiar: np.ndarray  # log-frequency of each bucket
    usual: np.ndarray  # mean familiarity of each language's texts
    spread: float  # variance between texts, as a multiple of that of one n-gram
    strange: float

    def ease(self, familiarity, grams, language):
        """How familiar texts are for their language and number of n-grams."""
        return (familiarity - self.usual[language]) / np.sqrt(1 / grams + self.spread)

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Adds up contributions; remembers those of the words it has met."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.weights = np.column_stack([model.weights, model.familiar]).astype(np.float32)
        self.place: dict[str, int] = {}
        self.sums = np.zeros((0, len(model.languages) + 2), dtype=np.float32)

    def _learn(self, fresh: list[str]) -> None:
        """Rows of ``sums``: scores and familiarity added up over a word's n-grams, and their number."""
        rows = [self.sums]
        for at in range(0, len(fresh), 50_000):
            part = fresh[at : at + 50_000]
            buckets, counts = word_grams(part)
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            sums = np.add.reduceat(self.weights[buckets], starts, axis=0)
            rows.append(np.column_stack([sums, counts.astype(np.float32)]))
        self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh)), strict=True))
        self.sums = np.concatenate(rows)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = []
        for at in range(0, len(texts), 512):
            out += self._predict([words(t) if self.model.languages else [] for t in texts[at : at + 512]])
        return out

    def _predict(self, found: list[list[str]]) -> list[tuple[str, float, bool]]:
        model, out = self.model, []
        met = set().union(*found)
        if len(self.place) + len(met) > WORD_MEMORY:
            self.place, self.sums = {}, self.sums[:0]
        self._learn(list(met.difference(self.place)))
        for each in found:
            if not each:
                out.append((UNKNOWN, 0.0, True))
                continue
            at = np.fromiter(map(self.place.__getitem__, each), dtype=np.int64, count=len(each))
            total = self.sums[at].sum(axis=0, dtype=np.float64)
            p = _softmax((total[:-2] / total[-1] + model.bias) / model.temperature)
            best = int(p.argmax())
            strange = model.ease(total[-2] / total[-1], total[-1], best) < model.strange
            out.append((model.languages[best], float(p[best]), bool(p[best] < model.threshold or strange)))
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _features(text: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Buckets of a text, their shares and the number of its n-grams."""
    found, times = np.unique(np.array(words(text), dtype=object), return_counts=True)
    buckets, counts = word_grams(found.tolist())
    ids, at = np.unique(buckets, return_inverse=True)
    share = np.bincount(at, weights=np.repeat(times, counts))
    return ids, share / share.sum(), float(share.sum())


def held_back(target: np.ndarray) -> np.ndarray:
    """Rows for calibration: each fifth row of a language. Without a language of
    five rows, the last row of each that has two."""
    order = np.argsort(target, kind="stable")
    sizes = np.bincount(target)
    place = np.empty(len(target), dtype=np.int64)
    place[order] = np.arange(len(target)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = place % 5 == 4
    return kept if kept.any() else (place > 0) & (place == sizes[target] - 1)


def train(rows: list[tuple[str, str]], seed: int = 7) -> LanguageModel:
    """``rows``: (text, language) pairs in a fixed order, the sample."""
    rows = [(t, g) for t, g in rows if words(t)]
    languages = sorted({g for _, g in rows})
    k = len(languages)
    if not k:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0, np.zeros(BUCKETS), np.zeros(0), 0.0, 0.0)
    target = np.array([languages.index(g) for _, g in rows])
    data = [_features(t) for t, _ in rows]
    kept = held_back(target)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    out, bias = np.zeros((WIDTH, k)), np.zeros(k)
    chosen = np.flatnonzero(~kept)
    step, steps = 0, EPOCHS * len(chosen)
    for _ in range(EPOCHS):
        for i in rng.permutation(chosen):
            ids, share, _ = data[i]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = share @ table[ids]
            grad = _softmax(hidden @ out + bias)
            grad[target[i]] -= 1
            back = out @ grad
            out -= rate * np.outer(hidden, grad)
            bias -= rate * grad
            table[ids] -= (GRAM_RATE * rate * share)[:, None] * back
    weights = table @ out
    check = np.flatnonzero(kept) if kept.any() else chosen
    scores = np.array([data[i][1] @ weights[data[i][0]] + bias for i in check])
    loss = lambda t: -np.log(np.maximum(_softmax(scores / t)[np.arange(len(check)), target[check]], 1e-12)).mean()
    temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    p = _softmax(scores / temperature)
    told = p.argmax(axis=1)
    right = told == target[check]
    # Each language's shares add up to one.
    seen, rows_of = np.zeros(BUCKETS), np.bincount(target[chosen], minlength=k)
    for i in chosen:
        seen[data[i][0]] += data[i][1] / rows_of[target[i]]
    familiar = np.log(seen / k + 1 / (BUCKETS * len(chosen)))
    grams = np.array([data[i][2] for i in check])
    found = np.array([data[i][1] @ familiar[data[i][0]] for i in check])
    usual, spread = _usual(found[right], grams[right], told[right], k)
    model = LanguageModel(languages, weights, bias, temperature, 0.0, familiar, usual, spread, -np.inf)
    if kept.any() and right.any():
        model.threshold = float(np.quantile(p.max(axis=1)[right], MISSED / 2))
        model.strange = float(np.quantile(model.ease(found, grams, told)[right], MISSED / 2))
    return model


def _usual(found: np.ndarray, grams: np.ndarray, told: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """Mean familiarity of each language, and the spread by which the variance
    is in proportion to 1 / grams + spread."""
    if not len(found):
        return np.zeros(k), 0.0
    sizes = np.bincount(told, minlength=k)
    mean = np.bincount(told, weights=found, minlength=k) / np.maximum(sizes, 1)
    # Nothing is known of a language without a text: as the least familiar.
    usual = np.where(sizes > 0, mean, mean[sizes > 0].min())
    square = (found - usual[told]) ** 2

    def loss(r: float) -> float:
        v = 1 / grams + r
        return float(np.log(np.maximum((square / v).mean(), 1e-12)) + np.log(v).mean())

    return usual, float(min(np.geomspace(1e-6, 1, 61), key=loss))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows that are never learned from: CRC-32 of the id's text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def sample_bounds(languages: int, per_language: int = SAMPLE_PER_LANGUAGE, chars: int = SAMPLE_CHARS, total: int = SAMPLE_TOTAL) -> tuple[int, int]:
    """Rows of each language, and characters of each row, within the total."""
    rows = min(per_language, max(LEAST_PER_LANGUAGE, total // (languages * chars)))
    return rows, min(chars, total // (languages * rows))


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, chars: int = SAMPLE_CHARS) -> LanguageModel:
    """Train on a bounded sample of the labelled rows that are not held out."""
    letter = F.col("text").rlike("\\p{L}")
    usable = docs.select("doc_id", "text", "lang").filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out() & letter)
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return train([])
    per_language, chars = sample_bounds(len(counts), per_language, chars)
    # Twice as many as needed may pass, so that enough do.
    shares = docs.sparkSession.createDataFrame([(r[0], 2.0 * per_language / r[1]) for r in counts], "__t_lang string, __t_share double")
    drawn = usable.withColumn("__t_u", unit(1, F.col("doc_id"), F.col("text")))
    drawn = drawn.join(F.broadcast(shares), F.col("lang") == F.col("__t_lang")).filter(F.col("__t_u") < F.col("__t_share"))
    # A long text is cut before it moves.
    over = F.char_length("text") - chars
    start = F.floor(unit(2, F.col("doc_id"), F.col("text")) * (over + 1)).cast("int") + 1
    drawn = drawn.withColumn("text", F.when(over > 0, F.substring(F.col("text"), start, F.lit(chars))).otherwise(F.col("text"))).filter(letter)
    sample = drawn.withColumn("__t_n", F.row_number().over(Window.partitionBy("lang").orderBy("__t_u", "doc_id", "text")))
    rows = sample.filter(F.col("__t_n") <= per_language).orderBy("__t_n", "lang").select("text", "lang").collect()
    return train([(r[0], r[1]) for r in rows])


def prediction(model: LanguageModel, docs: DataFrame, text: str = "text") -> Column:
    """Struct (lang_pred, score, rejected) for each whole text. The model sent
    to the executors has BUCKETS numbers a language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scorers: list[Scorer] = []

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = scorers[0] if scorers else shared.value.scorer()
        scorers[:] = [scorer]
        for texts in series:
            yield pd.DataFrame(scorer.predict(texts.tolist()), columns=["lang_pred", "score", "rejected"])

    # Not to be run again for a filter on its result.
    return run.asNondeterministic()(F.col(text))


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document."""
    model = model or fit(docs)
    rows = docs.select("doc_id", prediction(model, docs).alias("p"))
    return rows.select("doc_id", held_out().alias("held_out"), "p.lang_pred", "p.score", "p.rejected")


def keep_identified(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """The rows whose language is told with confidence, with all their columns."""
    model = model or fit(docs)
    tagged = docs.withColumn("__t_language", prediction(model, docs))
    return tagged.filter(~F.col("__t_language.rejected")).drop("__t_language")
