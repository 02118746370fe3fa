"""The reference's jobs end to end: its input files in, its text outputs out.

Each function reads the lab's input files with :mod:`tessera.sources.datasets`,
runs the operators and writes one key TAB value folder per job in the
reference's layout (:mod:`tessera.functions.formats`), in the order of the
MapReduce keys (movie ids, as text, where the title is printed); the report
jobs write their console tables as text lines. Nothing is collected to the driver; every job is one
Spark plan ending in a file sink.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import formats as FM
from tessera.functions.scalars import fixed2
from tessera.operators import commerce as C
from tessera.operators import ratings as R
from tessera.operators import text as T
from tessera.sources import datasets as DS
from tessera.sources.sinks import report_cells, write_tsv


def _write(lines: DataFrame, out_dir: str, name: str, sort: bool = True) -> str:
    path = os.path.join(out_dir, name)
    write_tsv(lines, path, sort_by=["key"] if sort else None)
    return path


# ---- fixed values: what the best-movie report prints before its four cells --
BEST_MOVIE_LABELS = ("ID Phim: ", "Ten Phim: ", "Diem TB: ", "Luot danh gia: ")
# -----------------------------------------------------------------------------


def run_rating_jobs(
    spark: SparkSession,
    movies: str,
    ratings: Sequence[str],
    users: str,
    out_dir: str,
    movies_header: str | None = None,
    ratings_header: str | None = None,
    users_header: str | None = None,
    min_support: int = 5,
) -> dict[str, str]:
    """Movie averages (+ best movie), genre averages, gender and age pivots
    and rating counts; returns the output folder of each job."""
    m = DS.read_movies(spark, movies, header=movies_header, limit_split=False)
    r = DS.read_ratings(spark, list(ratings), header=ratings_header)
    u = DS.read_users(spark, users, header=users_header)

    def by_movie(stats: DataFrame, lines: Callable[[DataFrame], DataFrame], name: str) -> str:
        return _write(lines(stats.orderBy("movie_id")), out_dir, name, sort=False)

    counts = R.rating_count(r).select(F.col("movie_id").alias("key"), F.col("n_ratings").cast("string").alias("value"))
    return {
        "rating_count": _write(counts, out_dir, "rating_count"),
        "movie_avg_rating": by_movie(R.movie_avg_rating(r, m), FM.movie_lines, "movie_avg_rating"),
        "best_movie": _write(FM.best_movie_line(R.best_movie(r, m, min_support), min_support), out_dir, "best_movie"),
        "genre_avg_rating": _write(FM.genre_lines(R.genre_avg_rating(r, m)), out_dir, "genre_avg_rating"),
        "gender_avg_pivot": by_movie(R.gender_avg_pivot(r, u, m), FM.gender_pivot_lines, "gender_avg_pivot"),
        "age_avg_pivot": by_movie(R.age_avg_pivot(r, u, m), FM.age_pivot_lines, "age_avg_pivot"),
    }


def run_report_jobs(
    spark: SparkSession,
    movies: str,
    ratings: Sequence[str],
    users: str,
    occupations: str,
    out_dir: str,
    movies_header: str | None = None,
    ratings_header: str | None = None,
    users_header: str | None = None,
    min_support: int = 5,
) -> dict[str, str]:
    """The console reports: best movie, ranked genres, gender, age,
    occupation and year; returns the folder of each report's text lines."""
    m = DS.read_movies(spark, movies, header=movies_header)
    r = DS.read_ratings(spark, list(ratings), header=ratings_header)
    u = DS.read_users(spark, users, header=users_header)
    o = DS.read_occupations(spark, occupations)
    mean, movie = ("avg_rating", "f2", None), F.col("movie_id").asc()
    shown = (F.col("movie_id"), F.col("title"), fixed2("avg_rating"), F.col("n_ratings").cast("string"))
    best = F.explode(F.array(*[F.concat(F.lit(label), c) for label, c in zip(BEST_MOVIE_LABELS, shown, strict=True)]))
    gender = [("title", "s", 40), ("gender_label", "s", 10), mean]
    age = [("title", "s", 40), ("age_group", "s", 12), mean]
    occupation = [("occupation", "s", 25), ("avg_rating", "f2", 12), ("n_ratings", "d", None)]
    year = [("year", "d", 10), ("avg_rating", "f2", 10), ("n_ratings", "d", None)]
    reports = {
        "best_movie": R.best_movie(r, m, min_support).select(best.alias("line")),
        "genre": report_cells(
            R.genre_avg_rating_ranked(r, m), [("genre", "s", 20), mean], [F.desc("avg_rating"), F.asc("genre")]),
        "gender": report_cells(R.gender_avg_long(r, u, m), gender, [movie, F.col("gender")], title_col="title"),
        "age": report_cells(R.age_avg_long(r, u, m), age, [movie, F.col("age_group")], title_col="title"),
        "occupation": report_cells(R.occupation_stats(r, u, o), occupation, [F.col("occupation_id")]),
        "year": report_cells(R.yearly_stats(r), year, [F.col("year")]),
    }
    out = {}
    for name, lines in reports.items():
        out[name] = os.path.join(out_dir, name)
        lines.write.mode("overwrite").text(out[name])
    return out


def run_review_jobs(
    spark: SparkSession, reviews: str, stopwords: T.Stopwords, out_dir: str, threshold: int = 500
) -> dict[str, str]:
    """Cleaning, aspect/category counts, word frequency, aspect sentiment and
    the two top-word reports, each with its job's arity rule."""
    arity = DS.REVIEW_MIN_FIELDS
    clean_in = DS.read_reviews(spark, reviews, arity["clean"])
    stats_in = DS.read_reviews(spark, reviews, arity["stats"])
    senti_in = DS.read_reviews(spark, reviews, arity["sentiment"])
    words_in = DS.read_reviews(spark, reviews, arity["category_words"])
    cleaned = T.clean_text(clean_in, stopwords).select(F.col("id").alias("key"), F.col("clean").alias("value"))
    freq = T.word_frequency(clean_in, stopwords, threshold).select(
        F.col("word").alias("key"), F.col("n").cast("string").alias("value"))
    return {
        "clean_text": _write(cleaned, out_dir, "clean_text"),
        "aspect_category_counts": _write(FM.tagged_count_lines(T.aspect_category_counts(stats_in)), out_dir,
                                         "aspect_category_counts"),
        "word_frequency": _write(freq, out_dir, "word_frequency"),
        "aspect_sentiment": _write(FM.sentiment_lines(T.aspect_sentiment(senti_in)), out_dir, "aspect_sentiment"),
        "category_sentiment_top_words": _write(
            FM.top_words_lines(T.category_sentiment_top_words(senti_in, stopwords)), out_dir,
            "category_sentiment_top_words"),
        "category_top_words": _write(FM.top_words_lines(T.category_top_words(words_in, stopwords)), out_dir,
                                     "category_top_words"),
    }


def run_commerce_jobs(spark: SparkSession, base_path: str, out_dir: str, revenue_year: int) -> dict[str, str]:
    """The seven e-commerce answers as CSV folders with a header."""
    t = DS.read_ecommerce(spark, base_path)
    answers = {
        "overall_stats": C.overall_stats(t["orders"], t["customers"], t["items"]),
        "orders_by_country": C.orders_by_country(t["orders"], t["customers"]),
        "orders_by_month": C.orders_by_month(t["orders"]),
        "review_score_mean": C.review_score_mean(t["reviews"]),
        "review_score_histogram": C.review_score_histogram(t["reviews"]),
        "revenue_by_category": C.revenue_by_category(t["items"], t["orders"], t["products"], revenue_year),
        "top_products": C.top_products(t["items"]),
        "product_avg_review": C.product_avg_review(t["items"], t["reviews"]),
        "delivery_diff_days": C.delivery_diff_days(t["items"], t["orders"]),
    }
    out = {}
    for name, df in answers.items():
        path = os.path.join(out_dir, name)
        df.write.mode("overwrite").option("header", True).csv(path)
        out[name] = path
    return out
