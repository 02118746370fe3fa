"""Readers for the reference's own input files.

The lab inputs are plain text: comma lines for movies / ratings / users /
occupations, ``;`` lines for hotel reviews, ``;`` CSV files with a header
for the e-commerce tables. Each reader returns the column names the
operators expect. Ids stay strings (the reference keys on the text), numbers
are cast strictly: a bad number fails the job, as ``parseInt`` did, unless
``strict=False`` turns it into null.

Movies, users and occupations are lookup tables: of several lines with one
key the last counts, as in the reference's maps, so that a join with them
never multiplies rows.

Headers are dropped only when given (``header=`` the exact line); every
copy of that line is removed, as the reference's first-line filter did.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.operators.joins import unique_by_key
from tessera.sources.delimited import LINE, drop_header_lines, parse_delimited, read_lines, read_semicolon_csv

# ---- fixed values: field counts each reference job requires of a line ------
REVIEW_MIN_FIELDS = {
    "clean": 2,            # text preprocessing: id;comment
    "stats": 4,            # aspect / category counts
    "sentiment": 5,        # aspect sentiment, category-sentiment top words
    "category_words": 4,   # category top words
}
# -----------------------------------------------------------------------------


def _lines(spark: SparkSession, paths: str | Sequence[str], header: str | None, numbered: bool = False) -> DataFrame:
    lines = read_lines(spark, paths, numbered)
    return drop_header_lines(lines, header) if header is not None else lines


def _lookup(lines: DataFrame, columns: list[str], **parse) -> DataFrame:
    """Parsed lines, the last one for each value of the first column."""
    rows = parse_delimited(lines, columns, sep=",", keep=[LINE], **parse)
    return unique_by_key(rows, columns[0], LINE).select(*columns)


def read_movies(spark: SparkSession, paths: str | Sequence[str], header: str | None = None,
                limit_split: bool = True, min_fields: int = 2) -> DataFrame:
    """``movie_id, title, genres`` from ``id,title,genres`` lines.

    ``limit_split=True`` is the RDD jobs' ``split(",", 3)``: the title ends
    at the first comma after the id and the genres field keeps the rest of
    the line. ``False`` is the MapReduce jobs' plain split, where a comma in
    a title shifts the genres to the next piece of the title (SURVEY H11).
    Lines with fewer than ``min_fields`` fields are skipped; a missing
    field is null.
    """
    lines = _lines(spark, paths, header, numbered=True)
    return _lookup(lines, ["movie_id", "title", "genres"], min_fields=min_fields, limit=3 if limit_split else -1)


def read_ratings(spark: SparkSession, paths: str | Sequence[str], header: str | None = None,
                 strict: bool = True) -> DataFrame:
    """``user_id, movie_id, rating, ts`` from ``user,movie,rating,epoch``
    lines; several files (``ratings_1``, ``ratings_2``) are one table."""
    return parse_ratings(_lines(spark, paths, header), strict)


def parse_ratings(lines: DataFrame, strict: bool = True) -> DataFrame:
    """:func:`read_ratings` of lines that are there already, or still to come."""
    return parse_delimited(
        lines, ["user_id", "movie_id", "rating", "ts"], sep=",", min_fields=3,
        types={"rating": T.DoubleType(), "ts": T.LongType()}, strict=strict,
    )


def read_users(spark: SparkSession, paths: str | Sequence[str], header: str | None = None,
               strict: bool = True) -> DataFrame:
    """``user_id, gender, age, occupation_id`` from comma lines."""
    lines = _lines(spark, paths, header, numbered=True)
    columns = ["user_id", "gender", "age", "occupation_id"]
    return _lookup(lines, columns, min_fields=3, types={"age": T.IntegerType()}, strict=strict)


def read_occupations(spark: SparkSession, paths: str | Sequence[str], header: str | None = None) -> DataFrame:
    """``occupation_id, name`` from ``id,name`` lines."""
    return _lookup(_lines(spark, paths, header, numbered=True), ["occupation_id", "name"], min_fields=2)


def read_reviews(spark: SparkSession, paths: str | Sequence[str], min_fields: int = 2,
                 header: str | None = None) -> DataFrame:
    """``id, comment, aspect, category, sentiment`` from ``;`` lines.

    ``min_fields`` is the job's arity guard (:data:`REVIEW_MIN_FIELDS`),
    counted the Java way (trailing empty fields do not count); fields a line
    does not have are null.
    """
    return parse_delimited(
        _lines(spark, paths, header), ["id", "comment", "aspect", "category", "sentiment"], sep=";",
        min_fields=min_fields,
    )


ECOMMERCE_SCHEMAS = {
    "customers": ("Customer_List.csv",
                  "customer_trx_id string, subscriber_id string, customer_country string"),
    "items": ("Order_Items.csv",
              "order_id string, order_item_id int, product_id string, seller_id string, price double, "
              "freight_value double, shipping_limit_date timestamp"),
    "reviews": ("Order_Reviews.csv", "review_id string, order_id string, review_score int"),
    "orders": ("Orders.csv",
               "order_id string, customer_trx_id string, order_purchase_timestamp timestamp, "
               "order_delivered_carrier_date timestamp"),
    "products": ("Products.csv", "product_id string, product_category_name string"),
}


def read_ecommerce(spark: SparkSession, base_path: str) -> dict[str, DataFrame]:
    """The five e-commerce tables (``;`` CSV with a header), columns by their
    header names with explicit types -- no inference pass over the data. Keys: ``customers, items,
    reviews, orders, products``."""
    base = base_path.rstrip("/")
    return {
        name: read_semicolon_csv(spark, f"{base}/{file}", schema)
        for name, (file, schema) in ECOMMERCE_SCHEMAS.items()
    }
