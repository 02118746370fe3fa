"""Review text operators: tokens, cleaning, word counts, aspect statistics.

Input: a reviews DataFrame ``id, comment, aspect, category, sentiment``.
The tokenizer and the stop-word filter are built-in column expressions
(:mod:`tessera.functions.text`), so texts are processed whole, inside the
scan's task, with no Python in the loop. Stop words are a list or a table of
any size (column ``word``); word counts drop them by an anti join of the
counted words, not of every token. Counts are partial-aggregated before any
shuffle; heavy words and the few aspect / category values are
absorbed by that map-side combine.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.functions.text import java_trim, normalise_stopwords, tokens
from tessera.operators.topk import ranked_text, top_k_per_group

# ---- fixed values of the reference jobs -----------------------------------
SENTIMENTS = ("positive", "negative")
ASPECT_TAG = "ASPECT"
CATEGORY_TAG = "CATEGORY"
WORD_FREQUENCY_THRESHOLD = 500   # "more than 500" occurrences
TOP_WORDS = 5
# -----------------------------------------------------------------------------


def tokenize(reviews: DataFrame) -> DataFrame:
    """One row per token: ``id, pos`` (1-based, after empty tokens are
    dropped) ``, token``."""
    return reviews.select("id", F.posexplode(tokens("comment")).alias("p", "token")).select(
        "id", (F.col("p") + 1).alias("pos"), "token"
    )


Stopwords = Iterable[str] | DataFrame


def stopword_table(spark: SparkSession, stopwords: Stopwords) -> DataFrame:
    """Stop words as a table ``word``: trimmed, lower-cased, each once."""
    if not isinstance(stopwords, DataFrame):
        return spark.createDataFrame([(w,) for w in normalise_stopwords(stopwords)], "word string")
    word = F.lower(java_trim("word"))
    return stopwords.select(word.alias("word")).filter(F.length("word") > 0).distinct()


def clean_text(reviews: DataFrame, stopwords: Stopwords) -> DataFrame:
    """``id, clean``: surviving tokens joined by a space; reviews left with
    no token are dropped.

    A list of stop words is checked inside the task; a table is anti-joined
    with the tokens, which are then put back together in their order.
    """
    if isinstance(stopwords, DataFrame):
        stop = stopword_table(reviews.sparkSession, stopwords)
        rows = reviews.select("id", F.monotonically_increasing_id().alias("row"), "comment")
        each = rows.select("id", "row", F.posexplode(tokens("comment")).alias("pos", "word"))
        kept = each.join(stop, "word", "left_anti").groupBy("id", "row")
        parts = F.array_sort(F.collect_list(F.struct("pos", "word")))  # the tokens of one review
        return kept.agg(parts.alias("t")).select("id", F.array_join("t.word", " ").alias("clean"))
    cleaned = text.clean_text("comment", stopwords)
    # The emptiness test sits inside the generator: a plain filter on
    # ``clean`` would be pushed below the projection, re-deriving the whole
    # cleaned text (tokenize, filter, join) a second time in the filter.
    kept = F.filter(F.array(cleaned), lambda c: F.length(c) > 0)
    return reviews.select("id", F.explode(kept).alias("clean"))


def _word_counts(reviews: DataFrame, stopwords: Stopwords, group: list[str], min_length: int) -> DataFrame:
    words = reviews.select(*group, F.explode(tokens("comment")).alias("word"))
    counts = words.filter(F.length("word") >= min_length).groupBy(*group, "word").agg(F.count(F.lit(1)).alias("n"))
    # The anti join sees each counted word once, not every occurrence.
    return counts.join(stopword_table(reviews.sparkSession, stopwords), "word", "left_anti")


def word_frequency(
    reviews: DataFrame, stopwords: Stopwords, threshold: int = WORD_FREQUENCY_THRESHOLD
) -> DataFrame:
    """Words (not stop words, any length) occurring more than ``threshold``
    times over all reviews."""
    return _word_counts(reviews, stopwords, [], 1).filter(F.col("n") > threshold)


def aspect_category_counts(reviews: DataFrame) -> DataFrame:
    """Counts per aspect and per category from one scan: ``kind`` is
    ``ASPECT`` or ``CATEGORY``. Blank values are not counted, so each kind
    totals the number of reviews with a non-blank value."""
    tagged = F.explode(
        F.array(
            F.struct(F.lit(ASPECT_TAG).alias("kind"), java_trim("aspect").alias("value")),
            F.struct(F.lit(CATEGORY_TAG).alias("kind"), java_trim("category").alias("value")),
        )
    )
    return (
        reviews.select(tagged.alias("t"))
        .select("t.kind", "t.value")
        .filter(F.col("value").isNotNull() & (F.length("value") > 0))
        .groupBy("kind", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def aspect_sentiment(reviews: DataFrame) -> DataFrame:
    """Positive and negative review counts per aspect (other sentiments
    are ignored; an aspect with neither does not appear)."""
    s = F.lower(java_trim("sentiment"))
    return (
        reviews.select(java_trim("aspect").alias("aspect"), s.alias("s"))
        .filter((F.length("aspect") > 0) & F.col("s").isin(*SENTIMENTS))
        .groupBy("aspect")
        .agg(F.count_if(F.col("s") == "positive").alias("positive"),
             F.count_if(F.col("s") == "negative").alias("negative"))
    )


def aspect_extremes(reviews: DataFrame) -> DataFrame:
    """The aspect with the most negative and the one with the most positive
    reviews (ties: smallest aspect name): rows ``kind, aspect, n``.

    Both winners come from one global aggregate of ``min(struct(-n, aspect))``
    (partial aggregation, no sort, no single-partition window).
    """
    counts = aspect_sentiment(reviews)
    best = counts.agg(
        F.min(F.struct((-F.col("negative")).alias("k"), F.col("aspect").alias("a"))).alias("neg"),
        F.min(F.struct((-F.col("positive")).alias("k"), F.col("aspect").alias("a"))).alias("pos"),
    )
    rows = F.explode(
        F.array(
            F.struct(F.lit("most_negative").alias("kind"), F.col("neg.a").alias("aspect"),
                     (-F.col("neg.k")).alias("n")),
            F.struct(F.lit("most_positive").alias("kind"), F.col("pos.a").alias("aspect"),
                     (-F.col("pos.k")).alias("n")),
        )
    )
    return best.filter(F.col("neg").isNotNull()).select(rows.alias("r")).select("r.kind", "r.aspect", "r.n")


def _top_words(counts: DataFrame, group: list[str], k: int) -> DataFrame:
    ranked = top_k_per_group(counts, group, [F.col("n").desc(), F.col("word").asc()], k)
    item = F.concat(F.col("word"), F.lit("("), F.col("n").cast("string"), F.lit(")"))
    return ranked_text(ranked, group, item, output="top_words")


#: Rows (id, sentiment) that are sent to every task rather than texts to them.
BROADCAST_LABELS = 1_000_000


def category_sentiment_top_words(
    reviews: DataFrame, stopwords: Stopwords, k: int = TOP_WORDS, sentiments: DataFrame | None = None, broadcast_labels: int = BROADCAST_LABELS
) -> DataFrame:
    """Per (category, positive|negative): the k most frequent words longer
    than one character, as ``w(n) w(n) ...`` (ties by word).

    ``sentiments`` (``id, sentiment``) gives the sentiments where the reviews
    have none of their own. Only labelled reviews are tokenized, and their words
    are counted per category and sentiment at once. Up to ``broadcast_labels``
    labels (some 30 MB) are counted and broadcast, so that texts stay where they
    are; more meet the texts by shuffle, or, with both tables in buckets of the id
    (:mod:`tessera.sources.bucketed`), without one.
    """
    category = java_trim("category").alias("category")
    wanted = F.lower(java_trim("sentiment"))
    if sentiments is not None:
        labelled = sentiments.select("id", wanted.alias("sentiment")).filter(F.col("sentiment").isin(*SENTIMENTS))
        if broadcast_labels and labelled.count() <= broadcast_labels:
            labelled = F.broadcast(labelled)
        base = reviews.select("id", category, "comment").filter(F.length("category") > 0).join(labelled, "id")
        counts = _word_counts(base, stopwords, ["category", "sentiment"], 2)
        return _top_words(counts, ["category", "sentiment"], k)
    base = reviews.select(category, wanted.alias("sentiment"), "comment").filter(
        (F.length("category") > 0) & F.col("sentiment").isin(*SENTIMENTS)
    )
    counts = _word_counts(base, stopwords, ["category", "sentiment"], 2)
    return _top_words(counts, ["category", "sentiment"], k)


def category_top_words(reviews: DataFrame, stopwords: Stopwords, k: int = TOP_WORDS) -> DataFrame:
    """Per category (any sentiment): the k most frequent words longer than
    one character, as ``w(n) w(n) ...``."""
    base = reviews.select(java_trim("category").alias("category"), "comment").filter(
        F.length("category") > 0
    )
    counts = _word_counts(base, stopwords, ["category"], 2)
    return _top_words(counts, ["category"], k)
