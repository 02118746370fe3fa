"""Bindings of the operators' input tables to the driver's test tables.

Each binding is a plain projection / join over the parquet tables in an
``sf`` directory, so its size grows with the data. The same bindings are
written in DuckDB SQL in :mod:`tessera.plans.oracle` for the oracle.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import json_field

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Stop words used with the test tables: the ten most frequent tokens of
# ``documents`` (fixed values of the binding).
TEST_STOPWORDS = ["the", "of", "de", "and", "to", "in", "la", "a", "der", "is"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ---------------------------------------------------------------- ratings ----

def ratings(spark: SparkSession, sf_dir: str, with_user: bool = True) -> DataFrame:
    """Ratings from ``lineitem``; the rating user comes from ``orders``.

    Every line has its order, so queries that do not read ``user_id`` pass
    ``with_user=False`` and skip the join of two fact tables.
    """
    li = table(spark, sf_dir, "lineitem")
    cols = [F.col("l_partkey").alias("movie_id"), F.col("l_quantity").alias("rating"), F.col("l_shipdate").alias("ts")]
    if not with_user:
        return li.select(*cols)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("o_custkey").alias("user_id"), *cols)


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second rating input: one rating per event."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "user_id", F.col("event_id").alias("movie_id"), F.col("value").alias("rating"), F.to_timestamp("ts").alias("ts")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    gender = (
        F.when(seg == "BUILDING", "M").when(seg == "MACHINERY", "m").when(seg == "HOUSEHOLD", "F").otherwise(seg)
    )
    return c.select(
        F.col("c_custkey").alias("user_id"),
        gender.alias("gender"),
        (F.lit(10) + F.col("c_custkey") % 60).alias("age"),
        F.col("c_nationkey").alias("occupation_id"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.col("p_brand")).alias("genres"),
    )


def occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("occupation_id"), F.col("n_name").alias("name"))


# ---------------------------------------------------------------- reviews ----

def reviews(spark: SparkSession, sf_dir: str, with_sentiment: bool = True, with_comment: bool = True) -> DataFrame:
    """Reviews from ``documents`` (+ sentiment from ``labels``).

    ``labels`` has at most one row per ``doc_id``, so the left join never
    changes the review rows; queries that do not read ``sentiment`` or
    ``comment`` leave them out, and the latter's join moves narrow rows only.
    """
    text = ["text"] if with_comment else []
    d = table(spark, sf_dir, "documents").select("doc_id", *text, "source", "lang")
    cols = [F.col("doc_id").alias("id"), *[F.col(t).alias("comment") for t in text]]
    cols += [F.col("source").alias("aspect"), F.col("lang").alias("category")]
    if not with_sentiment:
        return d.select(*cols)
    return d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left").select(*cols, _sentiment())


def sentiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, sentiment`` of the labelled reviews."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), _sentiment())


def stopwords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in TEST_STOPWORDS], "word string")


def _sentiment() -> Column:
    by_quality = F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative")
    return by_quality.otherwise("neutral").alias("sentiment")


# --------------------------------------------------------------- commerce ----

def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sub = F.when(F.col("c_custkey") % 100 != 0, F.col("c_custkey") % 100)
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_trx_id"),
        sub.alias("subscriber_id"),
        F.col("n_name").alias("customer_country"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_tax") * F.col("l_quantity")).alias("freight_value"),
        F.col("l_shipdate").alias("shipping_limit_date"),
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    score = (
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("int"))
        .when(F.col("o_orderkey") % 97 == 0, F.lit(9))
        .otherwise(F.substring("o_orderpriority", 1, 1).cast("int"))
    )
    return o.select(
        F.col("o_orderkey").alias("review_id"), F.col("o_orderkey").alias("order_id"), score.alias("review_score")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_trx_id"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_orderdate").alias("order_delivered_carrier_date"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    cat = F.when(F.col("p_type") != "ECONOMY", F.col("p_type"))
    return p.select(F.col("p_partkey").alias("product_id"), cat.alias("product_category_name"))


# ------------------------------------------------------------- detections ----

def _synthetic_boxes(k: Column) -> Column:
    """``k % 4`` boxes; box i: (10i, k, 10i+50, k+100), confidence
    ((7k + 13i) % 100) / 100, class i % 2."""
    def box(_, i):
        return F.struct(
            (F.lit(10) * i).cast("int").alias("x1"),
            k.cast("int").alias("y1"),
            (F.lit(10) * i + 50).cast("int").alias("x2"),
            (k + 100).cast("int").alias("y2"),
            (((k * 7 + i * 13) % 100) / F.lit(100.0)).cast("double").alias("confidence"),
            (i % 2).cast("int").alias("cls"),
        )

    return F.transform(F.array_repeat(F.lit(0), (k % 4).cast("int")), box)


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw detections, one row per frame: every box of the model with its
    class, before the person/confidence filter."""
    return detections_from_events(table(spark, sf_dir, "events"))


def detections_from_events(e: DataFrame) -> DataFrame:
    """The detection projection of ``events`` (works on a stream too)."""
    # k is parsed once in its own projection; the optimizer keeps it there
    # rather than re-parsing the JSON for every reference in the boxes.
    with_k = e.select(
        F.col("event_id").alias("frame_id"),
        F.col("ts").alias("ts"),
        F.col("user_id").alias("source"),
        F.col("value").alias("process_ms"),
        json_field("props", "$.k").cast("int").alias("_k"),
    )
    return with_k.select("frame_id", "ts", "source", "process_ms", _synthetic_boxes(F.col("_k")).alias("raw_boxes"))


def frames_as_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames for the scoring operator: document text as opaque bytes."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select(F.col("doc_id").alias("frame_id"), F.encode("text", "UTF-8").alias("image"))



# ------------------------------------------------- documents as other inputs --

def document_events(d: DataFrame) -> DataFrame:
    """``documents`` in the columns of ``events``, a table that grows with the
    corpus: one event a document, some without a source."""
    k = F.col("doc_id")
    return d.select(
        k.alias("event_id"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + k * 1_500_000).alias("ts"),
        F.when(k % 50 != 0, F.floor(k / 5)).alias("user_id"),
        ((F.col("n_chars") % 1000) / F.lit(4.0)).alias("value"),
        F.concat(F.lit('{"k": '), (F.col("n_chars") % 100).cast("string"), F.lit("}")).alias("props"),
    )


def document_ratings(d: DataFrame) -> DataFrame:
    """One rating a document; a third of them by one user."""
    k = F.col("doc_id")
    return d.select(
        F.when(k % 3 == 0, F.lit(-1).cast("long")).otherwise(k).alias("user_id"),
        F.floor(k / 20).alias("movie_id"),
        (F.col("n_chars") % 9 / 2 + 0.5).alias("rating"),
        (F.lit(1_700_000_000) + k).alias("ts"),
    )


def label_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from ``labels``, and the one of a third of all ratings."""
    gender = F.when(F.col("quality") == 1, "M").otherwise("F")
    own = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("user_id"), gender.alias("gender"))
    return own.unionByName(spark.createDataFrame([(-1, "m")], "user_id long, gender string"))
