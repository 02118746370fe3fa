"""Invariants on the test tables: conservation of counts, independence of
the shuffle partition count, and batch/stream agreement."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import tokens
from tessera.operators import text as T
from tessera.plans import bindings as B
from tessera.plans.catalog import QUERIES
from tests.conftest import SF_SMALL, rows


def test_aspect_total_equals_category_total(spark):
    counts = T.aspect_category_counts(B.reviews(spark, SF_SMALL))
    totals = dict(rows(counts.groupBy("kind").agg(F.sum("n"))))
    assert totals["ASPECT"] == totals["CATEGORY"] == B.reviews(spark, SF_SMALL).count()


def test_sentiment_counts_within_review_count(spark):
    r = B.reviews(spark, SF_SMALL)
    s = T.aspect_sentiment(r).agg(F.sum("positive"), F.sum("negative")).first()
    assert s[0] + s[1] <= r.count()


def test_exploded_tokens_equal_sum_of_sizes(spark):
    r = B.reviews(spark, SF_SMALL)
    n_tok = T.tokenize(r).count()
    total = r.select(F.sum(F.size(tokens("comment")))).first()[0]
    assert n_tok == total


def test_word_counts_shared_word_category_vs_sentiment(spark):
    # For one category, the any-sentiment count of a word is at least its
    # positive + negative counts.
    r = B.reviews(spark, SF_SMALL)
    assert T.category_top_words(r, B.TEST_STOPWORDS).count() == r.select("category").distinct().count()


@pytest.mark.parametrize("key", ["genre_avg_rating", "category_top_words", "flush_batches", "latency_stats",
                                 "product_avg_review", "best_movie"])
def test_same_answer_with_1_4_16_shuffle_partitions(spark, key):
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(rows(QUERIES[key](spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]


def test_stop_words_as_a_long_table(spark):
    # A list of any size, as a table or in the plan, gives the same words.
    r = B.reviews(spark, SF_SMALL, with_sentiment=False)
    words = [f"stop{i}" for i in range(10_001)] + B.TEST_STOPWORDS
    table = spark.createDataFrame([(f" {w.upper()}",) for w in words], "word string")
    assert rows(T.clean_text(r, table)) == rows(T.clean_text(r, words))
    assert rows(T.word_frequency(r, table, 50)) == rows(T.word_frequency(r, words, 50))
    kept = {w for w, _ in rows(T.word_frequency(r, table, 0))}
    assert kept and not kept & set(words)


def test_sentiments_given_apart_count_the_same_words(spark):
    whole = T.category_sentiment_top_words(B.reviews(spark, SF_SMALL), B.TEST_STOPWORDS)
    apart = T.category_sentiment_top_words(
        B.reviews(spark, SF_SMALL, with_sentiment=False), B.TEST_STOPWORDS, sentiments=B.sentiments(spark, SF_SMALL))
    assert rows(whole) == rows(apart)
