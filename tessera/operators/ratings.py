"""Rating statistics by movie, genre, gender, age, occupation and year.

Inputs are DataFrames with these columns (extra columns are ignored):

* ratings: ``user_id, movie_id, rating, ts`` (``ts`` epoch seconds or a
  timestamp)
* users: ``user_id, gender, age, occupation_id``
* movies: ``movie_id, title, genres`` (``a|b|c``)
* occupations: ``occupation_id, name``

Every statistic is aggregated to one row per movie (or per user class) with
partial aggregation *before* the lookup join that adds titles, so the join
sees one row per movie instead of one per rating. Dimensions are expected to
be unique on their key; use :func:`tessera.operators.joins.unique_by_key`
first when they are not. All output is independent of partitioning: every
tie is broken on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import (
    AGE_GROUPS_4,
    age_group_4,
    age_group_7,
    calendar_year,
    gender_label,
    is_male,
)
from tessera.functions.text import split_multi_value
from tessera.operators.joins import lookup_with_default
from tessera.operators.skew import join_spread

# Ratings are summed at this scale.
RATING = "decimal(18,6)"

# ---- fixed values: defaults printed for a movie or occupation not found ----
DEFAULT_TITLE = "Unknown"                 # MapReduce average job, RDD age job
DEFAULT_TITLE_BEST = "Unknown Title"      # RDD best-movie job
DEFAULT_TITLE_GENDER = "Unknown ID"       # RDD gender job
DEFAULT_TITLE_PREFIX = "Movie_"           # MapReduce pivots: Movie_<id>
DEFAULT_OCCUPATION = ("Unknown (", ")")   # RDD occupation job: Unknown (<id>)
# -----------------------------------------------------------------------------


def _with_title(stats: DataFrame, movies: DataFrame, default) -> DataFrame:
    return lookup_with_default(stats, movies, "movie_id", "title", default)


def _prefixed_default():
    return F.concat(F.lit(DEFAULT_TITLE_PREFIX), F.col("movie_id").cast("string"))


def union_ratings(*parts: DataFrame) -> DataFrame:
    """Several rating inputs as one table (union all, by column name)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rating_count(ratings: DataFrame) -> DataFrame:
    """Number of ratings per movie (map-side combined)."""
    return ratings.groupBy("movie_id").agg(F.count(F.lit(1)).alias("n_ratings"))


def mean(value: str | Column) -> Column:
    """Mean of non-null values, summed as decimals so that it does not depend
    on the order in which partitions are added up."""
    c = F.col(value) if isinstance(value, str) else value
    return F.sum(c.cast(RATING)).cast("double") / F.count(c)


def movie_stats(ratings: DataFrame) -> DataFrame:
    """Mean and count of ratings per movie."""
    return ratings.groupBy("movie_id").agg(mean("rating").alias("avg_rating"), F.count("rating").alias("n_ratings"))


def movie_avg_rating(ratings: DataFrame, movies: DataFrame, default: str = DEFAULT_TITLE) -> DataFrame:
    """Mean and count per rated movie with its title (``default`` if the
    movie is unknown). Movies without ratings do not appear."""
    return _with_title(movie_stats(ratings), movies, F.lit(default)).select(
        "movie_id", "title", "avg_rating", "n_ratings"
    )


def rating_partials(ratings: DataFrame) -> DataFrame:
    """``movie_id, s, n``: what a mean needs of a part of the ratings."""
    return ratings.groupBy("movie_id").agg(F.sum(F.col("rating").cast(RATING)).alias("s"), F.count("rating").alias("n"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partials of several parts as one row a movie."""
    return partials.groupBy("movie_id").agg(F.sum("s").cast("decimal(28,6)").alias("s"), F.sum("n").alias("n"))


def stats_of_partials(partials: DataFrame) -> DataFrame:
    """:func:`movie_stats` from the partials of all parts."""
    return merge_partials(partials).select("movie_id", (F.col("s").cast("double") / F.col("n")).alias("avg_rating"), F.col("n").alias("n_ratings"))


def best_movie(
    ratings: DataFrame, movies: DataFrame, min_support: int = 5, default: str = DEFAULT_TITLE_BEST
) -> DataFrame:
    """The movie with the highest mean among those with at least
    ``min_support`` ratings; ties go to the smallest id, whatever its type.
    One row, or none.

    The top-1 is a global ``min`` over a struct (partial aggregation, no
    sort and no single-partition window); only the winner is joined with
    the titles.
    """
    stats = movie_stats(ratings).filter((F.col("n_ratings") >= min_support) & F.col("avg_rating").isNotNull())
    order = F.struct((-F.col("avg_rating")).alias("worse"), "movie_id", "avg_rating", "n_ratings")
    best = stats.agg(F.min(order).alias("b")).filter(F.col("b").isNotNull())
    winner = best.select("b.movie_id", "b.avg_rating", "b.n_ratings")
    return _with_title(winner, movies, F.lit(default)).select("movie_id", "title", "avg_rating", "n_ratings")


def genre_avg_rating(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Mean and count per genre; a rating counts once for each genre of its
    movie. Ratings of unknown movies are dropped (inner join).

    Ratings are first reduced to (sum, count) per movie, the per-movie rows
    are joined with the movies and exploded by genre, and the partial sums
    are added up per genre. Genres are few and hot, which partial
    aggregation absorbs.
    """
    per_movie = ratings.groupBy("movie_id").agg(
        F.sum(F.col("rating").cast(RATING)).alias("s"), F.count("rating").alias("n")
    )
    genres = movies.select("movie_id", F.explode(split_multi_value("genres")).alias("genre"))
    return (
        per_movie.join(genres, "movie_id")
        .groupBy("genre")
        .agg((F.sum("s").cast("double") / F.sum("n")).alias("avg_rating"), F.sum("n").alias("n_ratings"))
    )


def genre_avg_rating_ranked(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Genres by mean rating, best first (ties by genre name)."""
    return (
        genre_avg_rating(ratings, movies)
        .select("genre", "avg_rating")
        .orderBy(F.col("avg_rating").desc(), F.col("genre").asc())
    )


def _rated_by_users(ratings: DataFrame, users: DataFrame, *cols: str, spread: bool = False) -> DataFrame:
    """Ratings with user attributes (inner: unknown users are dropped).

    A shuffle join on ``user_id``; AQE splits a user that holds a large
    share of all ratings into several tasks. With ``spread`` such users are
    found beforehand (one more pass over the ids) and looked up by broadcast,
    for sessions without AQE and inputs known to be skewed.
    """
    rated, attributes = ratings.select("user_id", "movie_id", "rating"), users.select("user_id", *cols)
    return join_spread(rated, attributes, "user_id") if spread else rated.join(attributes, "user_id")


# Places that movies are dealt to; only their spread over tasks depends on it.
PLACES = 1 << 16


def _movies_together(rated: DataFrame) -> DataFrame:
    """The same rows, those of a movie beside each other, for aggregates with
    one group or more a movie.

    AQE merges the shuffle partitions of the user join by their bytes, up to one
    per core, so such a task meets nearly all movies and held a group of each
    (hundreds of bytes) besides the sorts of the join. Here the narrow rows
    move first and a task holds the groups of its own movies only. AQE splits
    the place of a hot movie; what is left of each movie (a row a task) moves
    to the final aggregate. Without AQE nothing is merged or split, and the
    rows stay where they are.
    """
    if rated.sparkSession.conf.get("spark.sql.adaptive.enabled").lower() != "true":
        return rated
    # A place, not the movie itself: rows dealt by a grouping key would have to stay whole, and nothing be split.
    place = F.pmod(F.xxhash64("movie_id"), F.lit(PLACES)).cast("int")
    return rated.withColumn("__t_place", place).hint("rebalance", F.col("__t_place")).drop("__t_place")


def gender_avg_pivot(ratings: DataFrame, users: DataFrame, movies: DataFrame, spread: bool = False) -> DataFrame:
    """Per movie: mean rating by male users (``M``, any case) and by all
    others. A null mean means no rating in that class ("N/A")."""
    rated = _movies_together(_rated_by_users(ratings, users, "gender", spread=spread))
    male = is_male("gender")
    stats = rated.groupBy("movie_id").agg(
        mean(F.when(male, F.col("rating"))).alias("male_avg"),
        mean(F.when(~male | F.col("gender").isNull(), F.col("rating"))).alias("female_avg"),
    )
    return _with_title(stats, movies, _prefixed_default()).select(
        "movie_id", "title", "male_avg", "female_avg"
    )


def gender_avg_long(ratings: DataFrame, users: DataFrame, movies: DataFrame, spread: bool = False) -> DataFrame:
    """Mean per (movie, raw gender value), with the display label."""
    rated = _movies_together(_rated_by_users(ratings, users, "gender", spread=spread))
    stats = rated.groupBy("movie_id", "gender").agg(mean("rating").alias("avg_rating"))
    return _with_title(stats, movies, F.lit(DEFAULT_TITLE_GENDER)).select(
        "movie_id", "title", "gender", gender_label("gender").alias("gender_label"), "avg_rating"
    )


def age_buckets(users: DataFrame) -> DataFrame:
    """Both age groupings per user."""
    return users.select(
        "user_id", "age", age_group_4("age").alias("age_group_4"), age_group_7("age").alias("age_group_7")
    )


AGE_PIVOT_COLUMNS = ["avg_0_18", "avg_18_35", "avg_35_50", "avg_50_plus"]


def age_avg_pivot(ratings: DataFrame, users: DataFrame, movies: DataFrame, spread: bool = False) -> DataFrame:
    """Per movie: mean rating in each of the four age groups; all four
    columns are always present, null where the group has no rating.

    Written as conditional aggregates over a fixed group list: one
    aggregation, no pivot value discovery pass.
    """
    rated = _movies_together(_rated_by_users(ratings, users, "age", spread=spread)).withColumn("grp", age_group_4("age"))
    aggs = [
        mean(F.when(F.col("grp") == label, F.col("rating"))).alias(name)
        for label, name in zip(AGE_GROUPS_4, AGE_PIVOT_COLUMNS)
    ]
    stats = rated.groupBy("movie_id").agg(*aggs)
    return _with_title(stats, movies, _prefixed_default()).select("movie_id", "title", *AGE_PIVOT_COLUMNS)


def age_avg_long(ratings: DataFrame, users: DataFrame, movies: DataFrame, spread: bool = False) -> DataFrame:
    """Mean per (movie, seven-way age group)."""
    rated = _movies_together(_rated_by_users(ratings, users, "age", spread=spread)).withColumn("age_group", age_group_7("age"))
    stats = rated.groupBy("movie_id", "age_group").agg(mean("rating").alias("avg_rating"))
    return _with_title(stats, movies, F.lit(DEFAULT_TITLE)).select("movie_id", "title", "age_group", "avg_rating")


def occupation_stats(ratings: DataFrame, users: DataFrame, occupations: DataFrame, spread: bool = False) -> DataFrame:
    """Mean and count per occupation of the rating user, with the
    occupation's name (``Unknown (<id>)`` when it has none)."""
    rated = _rated_by_users(ratings, users, "occupation_id", spread=spread)
    stats = rated.groupBy("occupation_id").agg(
        mean("rating").alias("avg_rating"), F.count("rating").alias("n_ratings")
    )
    pre, post = DEFAULT_OCCUPATION
    default = F.concat(F.lit(pre), F.col("occupation_id").cast("string"), F.lit(post))
    return lookup_with_default(
        stats, occupations, "occupation_id", "name", default, output="occupation"
    ).select("occupation_id", "occupation", "avg_rating", "n_ratings")


def yearly_stats(ratings: DataFrame) -> DataFrame:
    """Mean and count per calendar year of the rating time (UTC)."""
    year = calendar_year("ts", ratings.schema["ts"].dataType).alias("year")
    return (
        ratings.groupBy(year)
        .agg(mean("rating").alias("avg_rating"), F.count("rating").alias("n_ratings"))
        .orderBy("year")
    )


def user_occupations(users: DataFrame, occupations: DataFrame) -> DataFrame:
    """Each user with the name of the occupation (lookup with default)."""
    pre, post = DEFAULT_OCCUPATION
    default = F.concat(F.lit(pre), F.col("occupation_id").cast("string"), F.lit(post))
    return lookup_with_default(
        users.select("user_id", "occupation_id"), occupations, "occupation_id", "name", default,
        output="occupation",
    ).select("user_id", "occupation_id", "occupation")
