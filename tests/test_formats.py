"""Text forms of the reference outputs, checked against lines of its
shipped result files (F11, F12, K1, O1)."""

from pyspark.sql import functions as F

from tessera.functions import formats as FM
from tessera.functions.scalars import json_field, round_half_even, truncate_int
from tessera.sources.sinks import write_tsv


def test_movie_and_genre_lines(spark):
    m = spark.createDataFrame([("Toy Story (1995)", 4.25, 2)], "title string, avg_rating double, n_ratings long")
    assert tuple(FM.movie_lines(m).first()) == ("Toy Story (1995)", "AverageRating: 4.25 (TotalRatings: 2)")
    g = spark.createDataFrame([("Action", 3.725, 20)], "genre string, avg_rating double, n_ratings long")
    assert tuple(FM.genre_lines(g).first()) == ("Action:", "3.73 (TotalRatings: 20)")


def test_pivot_lines_with_na(spark):
    g = spark.createDataFrame([("Spotlight (2015)", None, 4.0)], "title string, male_avg double, female_avg double")
    assert tuple(FM.gender_pivot_lines(g).first()) == ("Spotlight (2015):", "Male_Avg: N/A, Female_Avg: 4.00")
    a = spark.createDataFrame(
        [("Spotlight (2015)", None, 4.0, None, None)],
        "title string, avg_0_18 double, avg_18_35 double, avg_35_50 double, avg_50_plus double")
    assert tuple(FM.age_pivot_lines(a).first()) == (
        "Spotlight (2015):", "[0-18: N/A, 18-35: 4.00, 35-50: N/A, 50+: N/A]")


def test_review_lines(spark):
    s = spark.createDataFrame([("CLEANLINESS", 1121, 227)], "aspect string, positive long, negative long")
    assert tuple(FM.sentiment_lines(s).first()) == ("CLEANLINESS", "Positive: 1121, Negative: 227")
    c = spark.createDataFrame([("ASPECT", "COMFORT", 1373)], "kind string, value string, n long")
    assert tuple(FM.tagged_count_lines(c).first()) == ("ASPECT: COMFORT", "1373")
    t = spark.createDataFrame([("FACILITIES", "negative", "không(125) bơi(66)")],
                              "category string, sentiment string, top_words string")
    assert tuple(FM.top_words_lines(t).first()) == ("FACILITIES:negative", "không(125) bơi(66)")


def test_best_movie_line(spark):
    b = spark.createDataFrame([("Heat", 4.5)], "title string, avg_rating double")
    assert FM.best_movie_line(b).first()["value"] == (
        "Heat is the highest rated movie with an average rating of 4.5 among movies with at least 5 ratings.")


def test_sorted_tsv_output(spark, tmp_path):
    df = spark.createDataFrame([("b", "2"), ("a", "1"), ("é", "3"), ("Z", "0")], "key string, value string")
    write_tsv(df.repartition(3), str(tmp_path / "o"), sort_by=["key"])
    lines = []
    for p in sorted((tmp_path / "o").glob("part-*")):
        lines += p.read_text(encoding="utf-8").splitlines()
    assert lines == ["Z\t0", "a\t1", "b\t2", "é\t3"]


def test_rounding_and_truncation(spark):
    df = spark.createDataFrame([(2.675, 0.125, 61.9, '{"k": 5}')], "a double, b double, x double, j string")
    r = df.select(round_half_even("b", 2), truncate_int("x"), json_field("j", "$.k"),
                  json_field("j", "$.missing", F.lit("0"))).first()
    assert tuple(r) == (0.12, 61, "5", "0")


def test_fixed2_half_up_like_java(spark):
    # H5: Java's %.2f rounds the decimal text half-up (1.005 -> 1.01,
    # 2.675 -> 2.68); an empty class prints N/A.
    from tessera.functions.scalars import fixed2

    df = spark.createDataFrame([(4.125,), (2.675,), (1.005,), (None,)], "v double")
    assert [r[0] for r in df.select(fixed2("v")).collect()] == ["4.13", "2.68", "1.01", "N/A"]


def test_timestamp_ntz_epoch_and_year(spark):
    # Parquet timestamps load as timestamp_ntz; epoch maths go through
    # to_timestamp with the session zone pinned to UTC.
    import datetime as dt

    from tessera.functions.scalars import calendar_year, epoch_seconds

    df = spark.createDataFrame([(dt.datetime(2021, 1, 1, 0, 0, 0),)], "ts timestamp_ntz")
    r = df.select(epoch_seconds("ts"), calendar_year("ts", df.schema["ts"].dataType)).first()
    assert tuple(r) == (1609459200.0, 2021)
