"""Text forms of the reference's key/value outputs.

Each function takes the DataFrame an operator returns and gives
``key, value`` string columns, ready for :func:`tessera.sources.sinks.write_tsv`
(key TAB value, the MapReduce text output). Numbers use ``%.2f`` (HALF_UP,
see :func:`tessera.functions.scalars.fixed2`); an empty class prints
``N/A``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import fixed2

# ---- fixed values: output layouts of the reference jobs ---------------------
#   movie:      <title>            AverageRating: 4.25 (TotalRatings: 2)
#   genre:      <genre>:           3.73 (TotalRatings: 20)
#   gender:     <title>:           Male_Avg: N/A, Female_Avg: 4.00
#   age:        <title>:           [0-18: N/A, 18-35: 4.00, 35-50: N/A, 50+: N/A]
#   sentiment:  <aspect>           Positive: 1121, Negative: 227
#   counts:     ASPECT: <value>    1364
#   top words:  <category>:<sentiment>   w(125) w(66) ...
#   best movie: RESULT:            <title> is the highest rated movie with an
#               average rating of <avg> among movies with at least 5 ratings.
AGE_CELL_LABELS = ["0-18", "18-35", "35-50", "50+"]
# -----------------------------------------------------------------------------


def movie_lines(df: DataFrame) -> DataFrame:
    """From :func:`movie_avg_rating`."""
    value = F.concat(
        F.lit("AverageRating: "), fixed2("avg_rating"), F.lit(" (TotalRatings: "),
        F.col("n_ratings").cast("string"), F.lit(")"),
    )
    return df.select(F.col("title").alias("key"), value.alias("value"))


def genre_lines(df: DataFrame) -> DataFrame:
    """From :func:`genre_avg_rating`."""
    value = F.concat(fixed2("avg_rating"), F.lit(" (TotalRatings: "), F.col("n_ratings").cast("string"), F.lit(")"))
    return df.select(F.concat(F.col("genre"), F.lit(":")).alias("key"), value.alias("value"))


def gender_pivot_lines(df: DataFrame) -> DataFrame:
    """From :func:`gender_avg_pivot`."""
    value = F.concat(F.lit("Male_Avg: "), fixed2("male_avg"), F.lit(", Female_Avg: "), fixed2("female_avg"))
    return df.select(F.concat(F.col("title"), F.lit(":")).alias("key"), value.alias("value"))


def age_pivot_lines(df: DataFrame) -> DataFrame:
    """From :func:`age_avg_pivot` (its four ``avg_*`` columns in order)."""
    cols = [c for c in df.columns if c.startswith("avg_")]
    cells = [F.concat(F.lit(f"{label}: "), fixed2(c)) for label, c in zip(AGE_CELL_LABELS, cols)]
    value = F.concat(F.lit("["), F.concat_ws(", ", *cells), F.lit("]"))
    return df.select(F.concat(F.col("title"), F.lit(":")).alias("key"), value.alias("value"))


def sentiment_lines(df: DataFrame) -> DataFrame:
    """From :func:`aspect_sentiment`."""
    value = F.format_string("Positive: %d, Negative: %d", F.col("positive"), F.col("negative"))
    return df.select(F.col("aspect").alias("key"), value.alias("value"))


def tagged_count_lines(df: DataFrame) -> DataFrame:
    """From :func:`aspect_category_counts`: ``ASPECT: x`` / ``CATEGORY: y``."""
    key = F.concat(F.col("kind"), F.lit(": "), F.col("value"))
    return df.select(key.alias("key"), F.col("n").cast("string").alias("value"))


def top_words_lines(df: DataFrame) -> DataFrame:
    """From :func:`category_sentiment_top_words` (``category:sentiment``)
    or :func:`category_top_words` (``category``)."""
    key = (
        F.concat(F.col("category"), F.lit(":"), F.col("sentiment")) if "sentiment" in df.columns
        else F.col("category")
    )
    return df.select(key.alias("key"), F.col("top_words").alias("value"))


def best_movie_line(df: DataFrame, min_support: int = 5) -> DataFrame:
    """From :func:`best_movie`: the RESULT line (the mean printed in full,
    as the reference concatenates the raw double)."""
    value = F.concat(
        F.col("title"), F.lit(" is the highest rated movie with an average rating of "),
        F.col("avg_rating").cast("string"),
        F.lit(f" among movies with at least {min_support} ratings."),
    )
    return df.select(F.lit("RESULT:").alias("key"), value.alias("value"))
