"""The registered queries: operator + binding, and the oracle SQL for each.

``QUERIES[key](spark, sf_dir)`` returns a DataFrame; ``ORACLE[key]`` is the
DuckDB statement expected to give the same multiset of rows (same column
names). Keys without an oracle get the driver's row-count check only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import ratings as R
from tessera.operators import text as T
from tessera.operators import commerce as C
from tessera.operators import detections as D
from tessera.sources import delimited as SRC
from tessera.sources import special as S
from tessera.functions import formats as FM
from tessera.sources import datasets as DS
from tessera.sources.datasets import ECOMMERCE_SCHEMAS
from tessera.sources.sinks import (
    RESULTS_SCHEMA,
    read_results_csv,
    read_tsv,
    report_lines,
    write_results_csv,
    write_tsv,
)
from tessera.streaming import detections as SD
from tessera.session import scratch_path
from tessera.plans import bindings as B
from tessera.plans import oracle as O

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


# Support threshold of best_movie on the test tables: every movie has at
# least 5 ratings there, so the "at least N ratings" rule is exercised at 30.
BEST_MOVIE_SUPPORT = 30

# ================================================================ ratings ====

RAT = O.with_(O.B_RATINGS, O.B_EVENT_RATINGS, O.B_USERS, O.B_MOVIES, O.B_OCC)


@register("rating_count", RAT + """
SELECT movie_id, count(*) AS n_ratings FROM b_ratings GROUP BY movie_id""")
def q_rating_count(spark, sf):
    return R.rating_count(B.ratings(spark, sf, with_user=False))


@register("movie_avg_rating", RAT + """
SELECT r.movie_id, coalesce(m.title, 'Unknown') AS title, avg(r.rating) AS avg_rating,
       count(r.rating) AS n_ratings
FROM b_ratings r LEFT JOIN b_movies m ON r.movie_id = m.movie_id
GROUP BY r.movie_id, m.title""")
def q_movie_avg_rating(spark, sf):
    return R.movie_avg_rating(B.ratings(spark, sf, with_user=False), B.movies(spark, sf))


@register("best_movie", RAT + f"""
SELECT s.movie_id, coalesce(m.title, 'Unknown Title') AS title, s.avg_rating, s.n_ratings
FROM (SELECT movie_id, avg(rating) AS avg_rating, count(rating) AS n_ratings
      FROM b_ratings GROUP BY movie_id HAVING count(rating) >= {BEST_MOVIE_SUPPORT}
      ORDER BY avg_rating DESC, movie_id ASC LIMIT 1) s
LEFT JOIN b_movies m ON s.movie_id = m.movie_id""")
def q_best_movie(spark, sf):
    return R.best_movie(B.ratings(spark, sf, with_user=False), B.movies(spark, sf), min_support=BEST_MOVIE_SUPPORT)


_GENRE_SQL = RAT + """,
g AS (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM b_movies)
SELECT g.genre, avg(r.rating) AS avg_rating, count(r.rating) AS n_ratings
FROM b_ratings r JOIN g ON r.movie_id = g.movie_id
GROUP BY g.genre"""


@register("genre_avg_rating", _GENRE_SQL)
def q_genre_avg_rating(spark, sf):
    return R.genre_avg_rating(B.ratings(spark, sf, with_user=False), B.movies(spark, sf))


@register("genre_avg_rating_ranked", "SELECT genre, avg_rating FROM (" + _GENRE_SQL + ") t")
def q_genre_avg_rating_ranked(spark, sf):
    return R.genre_avg_rating_ranked(B.ratings(spark, sf, with_user=False), B.movies(spark, sf))


@register("gender_avg_pivot", RAT + """
SELECT r.movie_id, coalesce(m.title, 'Movie_' || CAST(r.movie_id AS VARCHAR)) AS title,
       avg(CASE WHEN upper(u.gender) = 'M' THEN r.rating END) AS male_avg,
       avg(CASE WHEN upper(u.gender) = 'M' THEN NULL ELSE r.rating END) AS female_avg
FROM b_ratings r JOIN b_users u ON r.user_id = u.user_id
LEFT JOIN b_movies m ON r.movie_id = m.movie_id
GROUP BY r.movie_id, m.title""")
def q_gender_avg_pivot(spark, sf):
    return R.gender_avg_pivot(B.ratings(spark, sf), B.users(spark, sf), B.movies(spark, sf))


@register("gender_avg_long", RAT + """
SELECT r.movie_id, coalesce(m.title, 'Unknown ID') AS title, u.gender,
       CASE u.gender WHEN 'M' THEN 'Nam (M)' WHEN 'F' THEN 'Nu (F)' ELSE u.gender END AS gender_label,
       avg(r.rating) AS avg_rating
FROM b_ratings r JOIN b_users u ON r.user_id = u.user_id
LEFT JOIN b_movies m ON r.movie_id = m.movie_id
GROUP BY r.movie_id, m.title, u.gender""")
def q_gender_avg_long(spark, sf):
    return R.gender_avg_long(B.ratings(spark, sf), B.users(spark, sf), B.movies(spark, sf))


# The labels of the reports, as in tessera.functions.scalars.
_AGE4 = """CASE WHEN age < 18 THEN '0-18' WHEN age <= 35 THEN '18-35'
            WHEN age <= 50 THEN '35-50' ELSE '50+' END"""
_AGE7 = """CASE WHEN age < 18 THEN 'Duoi 18' WHEN age <= 24 THEN '18-24' WHEN age <= 34 THEN '25-34'
            WHEN age <= 44 THEN '35-44' WHEN age <= 49 THEN '45-49' WHEN age <= 55 THEN '50-55'
            ELSE 'Tren 56' END"""


@register("age_bucket", RAT + f"""
SELECT user_id, age, {_AGE4} AS age_group_4, {_AGE7} AS age_group_7 FROM b_users""")
def q_age_bucket(spark, sf):
    return R.age_buckets(B.users(spark, sf))


@register("age_avg_pivot", RAT + f"""
SELECT r.movie_id, coalesce(m.title, 'Movie_' || CAST(r.movie_id AS VARCHAR)) AS title,
       avg(CASE WHEN u.grp = '0-18' THEN r.rating END) AS avg_0_18,
       avg(CASE WHEN u.grp = '18-35' THEN r.rating END) AS avg_18_35,
       avg(CASE WHEN u.grp = '35-50' THEN r.rating END) AS avg_35_50,
       avg(CASE WHEN u.grp = '50+' THEN r.rating END) AS avg_50_plus
FROM b_ratings r JOIN (SELECT user_id, {_AGE4} AS grp FROM b_users) u ON r.user_id = u.user_id
LEFT JOIN b_movies m ON r.movie_id = m.movie_id
GROUP BY r.movie_id, m.title""")
def q_age_avg_pivot(spark, sf):
    return R.age_avg_pivot(B.ratings(spark, sf), B.users(spark, sf), B.movies(spark, sf))


@register("age_avg_long", RAT + f"""
SELECT r.movie_id, coalesce(m.title, 'Unknown') AS title, u.age_group, avg(r.rating) AS avg_rating
FROM b_ratings r JOIN (SELECT user_id, {_AGE7} AS age_group FROM b_users) u ON r.user_id = u.user_id
LEFT JOIN b_movies m ON r.movie_id = m.movie_id
GROUP BY r.movie_id, m.title, u.age_group""")
def q_age_avg_long(spark, sf):
    return R.age_avg_long(B.ratings(spark, sf), B.users(spark, sf), B.movies(spark, sf))


@register("occupation_stats", RAT + """
SELECT u.occupation_id,
       coalesce(o.name, 'Unknown (' || CAST(u.occupation_id AS VARCHAR) || ')') AS occupation,
       avg(r.rating) AS avg_rating, count(r.rating) AS n_ratings
FROM b_ratings r JOIN b_users u ON r.user_id = u.user_id
LEFT JOIN b_occ o ON u.occupation_id = o.occupation_id
GROUP BY u.occupation_id, o.name""")
def q_occupation_stats(spark, sf):
    return R.occupation_stats(B.ratings(spark, sf), B.users(spark, sf), B.occupations(spark, sf))


@register("yearly_stats", RAT + """
SELECT CAST(year(ts) AS INTEGER) AS year, avg(rating) AS avg_rating, count(rating) AS n_ratings
FROM b_ratings GROUP BY year(ts)""")
def q_yearly_stats(spark, sf):
    return R.yearly_stats(B.ratings(spark, sf, with_user=False))


@register("lookup_with_default", RAT + """
SELECT u.user_id, u.occupation_id,
       coalesce(o.name, 'Unknown (' || CAST(u.occupation_id AS VARCHAR) || ')') AS occupation
FROM b_users u LEFT JOIN b_occ o ON u.occupation_id = o.occupation_id""")
def q_lookup_with_default(spark, sf):
    return R.user_occupations(B.users(spark, sf), B.occupations(spark, sf))


@register("union_ratings", RAT + """
SELECT user_id, movie_id, rating, ts FROM b_ratings
UNION ALL
SELECT user_id, movie_id, rating, ts FROM b_event_ratings""")
def q_union_ratings(spark, sf):
    # The two rating inputs of the reference.
    return R.union_ratings(B.ratings(spark, sf), B.event_ratings(spark, sf))


# ================================================================= text =====

REV = O.with_(O.B_REVIEWS, O.B_TOKENS)
_STOP = B.TEST_STOPWORDS


@register("tokenize", O.with_(O.B_REVIEWS) + """
SELECT id, CAST(unnest(range(1, len(arr) + 1)) AS INTEGER) AS pos, unnest(arr) AS token
FROM (SELECT id, list_filter(
        list_transform(regexp_split_to_array(lower(comment), '[ \\t\\n\\x0B\\f\\r[:punct:]]+'),
                       lambda t: regexp_replace(t, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')),
        lambda t: t <> '') AS arr
      FROM b_reviews) s""")
def q_tokenize(spark, sf):
    return T.tokenize(B.reviews(spark, sf, with_sentiment=False))


@register("clean_text", O.with_(O.B_REVIEWS) + f"""
SELECT id, array_to_string(list_filter(
         list_transform(regexp_split_to_array(lower(comment), '[ \\t\\n\\x0B\\f\\r[:punct:]]+'),
                        lambda t: regexp_replace(t, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')),
         lambda t: t <> '' AND t NOT IN {O.STOPWORDS_SQL}), ' ') AS clean
FROM b_reviews
WHERE length(array_to_string(list_filter(
         list_transform(regexp_split_to_array(lower(comment), '[ \\t\\n\\x0B\\f\\r[:punct:]]+'),
                        lambda t: regexp_replace(t, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')),
         lambda t: t <> '' AND t NOT IN {O.STOPWORDS_SQL}), ' ')) > 0""")
def q_clean_text(spark, sf):
    return T.clean_text(B.reviews(spark, sf, with_sentiment=False), _STOP)


@register("word_frequency", REV + f"""
SELECT token AS word, count(*) AS n FROM b_tokens
WHERE token NOT IN {O.STOPWORDS_SQL}
GROUP BY token HAVING count(*) > 500""")
def q_word_frequency(spark, sf):
    return T.word_frequency(B.reviews(spark, sf, with_sentiment=False), B.stopwords(spark))


_JTRIM = "regexp_replace({c}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


@register("aspect_category_counts", O.with_(O.B_REVIEWS) + f"""
SELECT 'ASPECT' AS kind, v AS value, count(*) AS n
FROM (SELECT {_JTRIM.format(c='aspect')} AS v FROM b_reviews) a WHERE length(v) > 0 GROUP BY v
UNION ALL
SELECT 'CATEGORY' AS kind, v AS value, count(*) AS n
FROM (SELECT {_JTRIM.format(c='category')} AS v FROM b_reviews) c WHERE length(v) > 0 GROUP BY v""")
def q_aspect_category_counts(spark, sf):
    return T.aspect_category_counts(B.reviews(spark, sf, with_sentiment=False, with_comment=False))


_ASPECT_SENT = f"""
SELECT aspect, count(*) FILTER (WHERE s = 'positive') AS positive,
       count(*) FILTER (WHERE s = 'negative') AS negative
FROM (SELECT {_JTRIM.format(c='aspect')} AS aspect, lower({_JTRIM.format(c='sentiment')}) AS s
      FROM b_reviews) r
WHERE length(aspect) > 0 AND s IN ('positive', 'negative')
GROUP BY aspect"""


@register("aspect_sentiment", O.with_(O.B_REVIEWS) + _ASPECT_SENT)
def q_aspect_sentiment(spark, sf):
    return T.aspect_sentiment(B.reviews(spark, sf, with_comment=False))


@register("aspect_extremes", O.with_(O.B_REVIEWS, "c AS (" + _ASPECT_SENT + ")") + """
SELECT * FROM (SELECT 'most_negative' AS kind, aspect, negative AS n FROM c
               ORDER BY negative DESC, aspect ASC LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'most_positive' AS kind, aspect, positive AS n FROM c
               ORDER BY positive DESC, aspect ASC LIMIT 1)""")
def q_aspect_extremes(spark, sf):
    return T.aspect_extremes(B.reviews(spark, sf, with_comment=False))


@register("category_sentiment_top_words", REV + f""",
c AS (SELECT {_JTRIM.format(c='category')} AS category, lower({_JTRIM.format(c='sentiment')}) AS sentiment,
             token AS word, count(*) AS n
      FROM b_tokens
      WHERE length(token) > 1 AND token NOT IN {O.STOPWORDS_SQL}
        AND length({_JTRIM.format(c='category')}) > 0
        AND lower({_JTRIM.format(c='sentiment')}) IN ('positive', 'negative')
      GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY category, sentiment ORDER BY n DESC, word ASC) AS rn FROM c)
SELECT category, sentiment, string_agg(word || '(' || CAST(n AS VARCHAR) || ')', ' ' ORDER BY rn) AS top_words
FROM r WHERE rn <= 5 GROUP BY category, sentiment""")
def q_category_sentiment_top_words(spark, sf):
    return T.category_sentiment_top_words(
        B.reviews(spark, sf, with_sentiment=False), B.stopwords(spark), sentiments=B.sentiments(spark, sf))


@register("category_top_words", REV + f""",
c AS (SELECT {_JTRIM.format(c='category')} AS category, token AS word, count(*) AS n
      FROM b_tokens
      WHERE length(token) > 1 AND token NOT IN {O.STOPWORDS_SQL}
        AND length({_JTRIM.format(c='category')}) > 0
      GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, word ASC) AS rn FROM c)
SELECT category, string_agg(word || '(' || CAST(n AS VARCHAR) || ')', ' ' ORDER BY rn) AS top_words
FROM r WHERE rn <= 5 GROUP BY category""")
def q_category_top_words(spark, sf):
    return T.category_top_words(B.reviews(spark, sf, with_sentiment=False), B.stopwords(spark))


# ============================================================= commerce =====

COM = O.with_(O.B_CUSTOMERS, O.B_ITEMS, O.B_SCORES, O.B_ORDERS, O.B_PRODUCTS)
# The purchase year of the revenue report on the test tables (orders span
# 1995-2001).
REVENUE_YEAR = 1998


@register("overall_stats", COM + """
SELECT 'total_orders' AS metric, CAST(count(*) AS BIGINT) AS value FROM b_orders
UNION ALL
SELECT 'total_customers', CAST(count(DISTINCT subscriber_id) + max(CASE WHEN subscriber_id IS NULL THEN 1 ELSE 0 END) AS BIGINT)
FROM b_customers
UNION ALL
SELECT 'total_sellers', CAST(count(DISTINCT seller_id) + max(CASE WHEN seller_id IS NULL THEN 1 ELSE 0 END) AS BIGINT)
FROM b_items""")
def q_overall_stats(spark, sf):
    return C.overall_stats(B.orders(spark, sf), B.customers(spark, sf), B.order_items(spark, sf))


@register("orders_by_country", COM + """
SELECT c.customer_country, count(o.order_id) AS total_orders
FROM b_customers c JOIN b_orders o ON c.customer_trx_id = o.customer_trx_id
GROUP BY c.customer_country
ORDER BY total_orders DESC, c.customer_country ASC NULLS FIRST LIMIT 10""")
def q_orders_by_country(spark, sf):
    return C.orders_by_country(B.orders(spark, sf), B.customers(spark, sf))


@register("orders_by_month", COM + """
SELECT CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
       CAST(month(order_purchase_timestamp) AS INTEGER) AS month, count(order_id) AS total_orders
FROM b_orders GROUP BY 1, 2""")
def q_orders_by_month(spark, sf):
    return C.orders_by_month(B.orders(spark, sf))


@register("review_score_mean", COM + """
SELECT avg(review_score) AS avg_score FROM b_scores
WHERE review_score IS NOT NULL AND review_score BETWEEN 1 AND 5""")
def q_review_score_mean(spark, sf):
    return C.review_score_mean(B.order_reviews(spark, sf))


@register("review_score_histogram", COM + """
SELECT review_score, count(review_id) AS n_reviews FROM b_scores
WHERE review_score IS NOT NULL AND review_score BETWEEN 1 AND 5 GROUP BY review_score""")
def q_review_score_histogram(spark, sf):
    return C.review_score_histogram(B.order_reviews(spark, sf))


@register("revenue_by_category", COM + f"""
SELECT p.product_category_name,
       CAST(sum(CAST(i.price + i.freight_value AS DECIMAL(18,4))) AS DOUBLE) AS total_revenue
FROM b_items i JOIN b_orders o ON i.order_id = o.order_id
JOIN b_products p ON i.product_id = p.product_id
WHERE year(o.order_purchase_timestamp) = {REVENUE_YEAR}
GROUP BY p.product_category_name""")
def q_revenue_by_category(spark, sf):
    return C.revenue_by_category(
        B.order_items(spark, sf), B.orders(spark, sf), B.products(spark, sf), REVENUE_YEAR
    )


@register("top_products", COM + """
SELECT product_id, count(order_item_id) AS total_sold FROM b_items
GROUP BY product_id ORDER BY total_sold DESC, product_id ASC NULLS FIRST LIMIT 5""")
def q_top_products(spark, sf):
    return C.top_products(B.order_items(spark, sf))


@register("product_avg_review", COM + """
SELECT i.product_id, avg(s.review_score) AS avg_review_score
FROM b_items i JOIN b_scores s ON i.order_id = s.order_id
WHERE s.review_score IS NOT NULL
GROUP BY i.product_id""")
def q_product_avg_review(spark, sf):
    return C.product_avg_review(B.order_items(spark, sf), B.order_reviews(spark, sf))


@register("delivery_diff_days", COM + """
SELECT o.order_id, o.order_delivered_carrier_date, i.shipping_limit_date,
       CAST(datediff('day', i.shipping_limit_date, o.order_delivered_carrier_date) AS INTEGER) AS delivery_diff_days
FROM b_items i JOIN b_orders o ON i.order_id = o.order_id
WHERE o.order_delivered_carrier_date IS NOT NULL AND i.shipping_limit_date IS NOT NULL""")
def q_delivery_diff_days(spark, sf):
    return C.delivery_diff_days(B.order_items(spark, sf), B.orders(spark, sf))


# =========================================================== detections =====

DET = O.with_(O.B_FRAMES, O.B_BOXES, O.B_PERSONS)
# Local time zone of the results file on the test tables (the shipped file
# was written at UTC+7).
RESULTS_ZONE = "+07:00"
# The flush rule on the test tables: events are sparse (about 14 per hour),
# so the tick is one hour with batches of 5 rows.
FLUSH_TICK_SECONDS = 3600

_BOXES_JSON_SQL = """'[' || coalesce((SELECT string_agg('{"x1": ' || CAST(p.x1 AS VARCHAR) || ', "y1": ' || CAST(p.y1 AS VARCHAR)
    || ', "x2": ' || CAST(p.x2 AS VARCHAR) || ', "y2": ' || CAST(p.y2 AS VARCHAR)
    || ', "confidence": ' || CAST(p.confidence AS VARCHAR) || '}', ', ' ORDER BY p.i)
  FROM b_persons p WHERE p.frame_id = f.frame_id), '') || ']'"""

_PERSON_COUNT_SQL = DET + """
SELECT f.frame_id, CAST((SELECT count(*) FROM b_persons p WHERE p.frame_id = f.frame_id) AS INTEGER) AS person_count
FROM b_frames f"""

_RESULTS_SQL = DET + f"""
SELECT f.frame_id, epoch_us(f.ts) / 1000000.0 AS timestamp,
       strftime(f.ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS datetime_str,
       CAST((SELECT count(*) FROM b_persons p WHERE p.frame_id = f.frame_id) AS INTEGER) AS person_count,
       coalesce(f.process_ms, 0.0) AS process_ms,
       {_BOXES_JSON_SQL} AS boxes_json
FROM b_frames f"""


def _records(spark, sf):
    return D.detection_records(B.detections(spark, sf))


@register("person_boxes", DET + """
SELECT frame_id, CAST(i AS INTEGER) AS box_index, x1, y1, x2, y2, confidence FROM b_persons""")
def q_person_boxes(spark, sf):
    return D.person_boxes(B.detections(spark, sf))


@register("person_count", _PERSON_COUNT_SQL)
def q_person_count(spark, sf):
    return D.person_count(B.detections(spark, sf))


@register("frame_datetime", DET + """
SELECT frame_id, epoch_us(ts) / 1000000.0 AS timestamp,
       strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS datetime_str
FROM b_frames""")
def q_frame_datetime(spark, sf):
    return D.frame_datetime(_records(spark, sf), RESULTS_ZONE)


@register("flush_batches", DET + f""",
t AS (SELECT frame_id, ts,
             CAST(floor((epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events)) / {FLUSH_TICK_SECONDS * 1_000_000}) AS BIGINT) AS tick
      FROM b_frames),
r AS (SELECT *, row_number() OVER (PARTITION BY tick ORDER BY ts, frame_id) AS rn FROM t)
SELECT frame_id, tick, CAST((rn - 1) // 5 AS BIGINT) AS batch, CAST((rn - 1) % 5 AS INTEGER) AS row_in_batch
FROM r""")
def q_flush_batches(spark, sf):
    rec = _records(spark, sf)
    t0 = B.table(spark, sf, "events").select(F.min("ts")).scalar()
    return D.flush_batches(rec, t0, interval_seconds=FLUSH_TICK_SECONDS, max_rows=D.FLUSH_ROWS)


@register("frame_stats", DET + """
SELECT count(*) AS n_frames, avg(c) AS avg_person_count, max(c) AS max_person_count
FROM (SELECT f.frame_id, CAST((SELECT count(*) FROM b_persons p WHERE p.frame_id = f.frame_id) AS INTEGER) AS c
      FROM b_frames f) s""")
def q_frame_stats(spark, sf):
    return D.frame_stats(_records(spark, sf))


@register("latency_stats", DET + """,
v AS (SELECT source, frame_id, process_ms FROM b_frames WHERE process_ms IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY process_ms, frame_id) AS rn,
             count(*) OVER (PARTITION BY source) AS n FROM v)
SELECT source, count(*) AS n_frames,
       CAST(sum(CAST(process_ms AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_ms,
       min(process_ms) AS min_ms, max(process_ms) AS max_ms,
       max(CASE WHEN rn = greatest(1, CAST(ceil(n * 0.5) AS BIGINT)) THEN process_ms END) AS p50_ms,
       max(CASE WHEN rn = greatest(1, CAST(ceil(n * 0.95) AS BIGINT)) THEN process_ms END) AS p95_ms
FROM r GROUP BY source""")
def q_latency_stats(spark, sf):
    return D.latency_stats(_records(spark, sf), ["source"], (0.5, 0.95))


@register("score_frames", """
SELECT doc_id AS frame_id, CAST(strlen(text) % 5 AS INTEGER) AS person_count FROM documents""")
def q_score_frames(spark, sf):
    scored = D.score_frames(B.frames_as_bytes(spark, sf), D.byte_length_scorer)
    return scored.select("frame_id", "person_count")


@register("base64_roundtrip", """
SELECT doc_id AS frame_id, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes,
       to_base64(encode(text)) AS b64, from_base64(to_base64(encode(text))) = encode(text) AS roundtrip_ok
FROM documents""")
def q_base64_roundtrip(spark, sf):
    return S.base64_roundtrip(B.frames_as_bytes(spark, sf))


@register("results_csv_roundtrip", "SELECT *, person_count AS n_boxes FROM (" + _RESULTS_SQL + ") s")
def q_results_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "results-csv")
    write_results_csv(D.results_table(_records(spark, sf), RESULTS_ZONE), path, mode="overwrite")
    back = read_results_csv(spark, path)
    return back.select(*RESULTS_SCHEMA.fieldNames(), F.size("boxes").cast("int").alias("n_boxes"))


# ============================================================ streaming =====

def _event_stream(spark, sf):
    """The events table as a file stream."""
    schema = B.table(spark, sf, "events").schema
    # A pattern, as the source takes folders and patterns but no single file.
    return SD.read_stream(spark, f"{sf}/events.parque[t]", schema)


@register("stream_person_counts", _PERSON_COUNT_SQL)
def q_stream_person_counts(spark, sf):
    stream = B.detections_from_events(_event_stream(spark, sf))
    out, ckpt = SD.new_paths(spark, "stream-person-counts")
    SD.run_to_end(SD.stream_person_counts(stream, out, ckpt))
    return spark.read.parquet(out).select("frame_id", "person_count")


@register("stream_running_total", """
SELECT user_id AS source, count(*) AS total FROM events GROUP BY user_id""")
def q_stream_running_total(spark, sf):
    stream = _event_stream(spark, sf).withColumnRenamed("user_id", "source")
    out, ckpt = SD.new_paths(spark, "stream-running-total")
    SD.run_to_end(SD.stream_running_total(stream, out, ckpt, key="source"))
    return SD.read_running_total(spark, out, key="source")


@register("stream_results_sink", _RESULTS_SQL)
def q_stream_results_sink(spark, sf):
    stream = B.detections_from_events(_event_stream(spark, sf))
    out, ckpt = SD.new_paths(spark, "stream-results")
    SD.run_to_end(SD.stream_results_sink(stream, out, ckpt, RESULTS_ZONE, trigger=None))
    return read_results_csv(spark, out, parse_boxes=False).select(*RESULTS_SCHEMA.fieldNames())


# ============================================================== sources =====

_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer"
_CUSTOMER_TYPES = {"c_custkey": "bigint", "c_nationkey": "int"}
_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


def _line(sep, *cells):
    """Cells joined to a line; a null is an empty field and moves no other."""
    return F.concat_ws(sep, *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cells])


def _customer_lines(spark, sf):
    """Customer rows as ``;`` lines with a trailing empty field (Java drops
    it, so the arity is 4), plus the nation rows as 2-field lines that the
    arity guard must skip."""
    c = B.table(spark, sf, "customer")
    n = B.table(spark, sf, "nation")
    long_lines = c.select(
        _line(";", "c_custkey", "c_name", "c_nationkey", "c_mktsegment", F.lit("")).alias("value")
    )
    short_lines = n.select(_line(";", "n_nationkey", "n_name").alias("value"))
    return long_lines.unionByName(short_lines)


@register("parse_delimited", _CUSTOMER_SQL)
def q_parse_delimited(spark, sf):
    return SRC.parse_delimited(_customer_lines(spark, sf), _CUSTOMER_COLS, sep=";", types=_CUSTOMER_TYPES)


_HEADER = "c_custkey;c_name;c_nationkey;c_mktsegment"


@register("drop_header_lines", _CUSTOMER_SQL)
def q_drop_header_lines(spark, sf):
    header = spark.createDataFrame([(_HEADER,), (_HEADER,)], "value string")
    lines = header.unionByName(_customer_lines(spark, sf))
    kept = SRC.drop_header_lines(lines, _HEADER)
    return SRC.parse_delimited(kept, _CUSTOMER_COLS, sep=";", types=_CUSTOMER_TYPES)


# Java's %.2f rounds half up on the decimal digits of the number.
_F2 = "round({x}::VARCHAR::DECIMAL(38, 20), 2)::DECIMAL(38, 2)::VARCHAR"


@register("report_lines", RAT + f""",
s AS (SELECT r.movie_id, coalesce(m.title, 'Unknown ID') AS title, u.gender,
       CASE u.gender WHEN 'M' THEN 'Nam (M)' WHEN 'F' THEN 'Nu (F)' ELSE u.gender END AS label, avg(r.rating) AS a
  FROM b_ratings r JOIN b_users u ON r.user_id = u.user_id LEFT JOIN b_movies m ON r.movie_id = m.movie_id
  GROUP BY r.movie_id, m.title, u.gender ORDER BY r.movie_id, u.gender LIMIT 30),
c AS (SELECT *, CASE WHEN length(title) > 38 THEN substr(title, 1, 35) || '...' ELSE title END AS t FROM s)
SELECT rpad(t, greatest(40, length(t))::INT, ' ') || ' | ' || rpad(label, greatest(10, length(label))::INT, ' ') || ' | '
       || {_F2.format(x='a')} AS line FROM c""")
def q_report_lines(spark, sf):
    stats = R.gender_avg_long(B.ratings(spark, sf), B.users(spark, sf), B.movies(spark, sf))
    return report_lines(
        stats, [("title", 40), ("gender_label", 10)], "avg_rating",
        [F.col("movie_id"), F.col("gender")], limit=30, title_col="title",
    )


@register("tsv_roundtrip", """
SELECT CASE WHEN c_custkey % 3 = 0 THEN '#' || c_custkey ELSE ' ' || c_custkey END AS key,
       CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN '  ' || c_name || '  '
            WHEN c_custkey % 5 = 2 THEN c_name || chr(9) || '"' ELSE c_name END AS value FROM customer""")
def q_tsv_roundtrip(spark, sf):
    c, k = B.table(spark, sf, "customer"), F.col("c_custkey")
    value = (
        F.when(k % 5 == 0, "").when(k % 5 == 1, F.concat(F.lit("  "), "c_name", F.lit("  ")))
        .when(k % 5 == 2, F.concat("c_name", F.lit('\t"'))).otherwise(F.col("c_name"))
    )
    key = F.concat(F.when(k % 3 == 0, "#").otherwise(" "), k.cast("string"))
    path = scratch_path(spark, "tsv")
    write_tsv(c.select(key.alias("key"), value.alias("value")), path, sort_by=["key"])
    return read_tsv(spark, path)


@register("semicolon_csv_by_name", O.with_(O.B_ORDERS) + """
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_trx_id AS VARCHAR) AS customer_trx_id,
       order_purchase_timestamp, order_delivered_carrier_date FROM b_orders""")
def q_semicolon_csv_by_name(spark, sf):
    """Orders written as the shop exports them, columns in another order and
    one that is not asked for, read back by their header names."""
    path = scratch_path(spark, "orders-csv")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    B.orders(spark, sf).select(
        text("order_delivered_carrier_date").alias("Order_Delivered_Carrier_Date"),
        F.lit("a;b").alias("Remark"),
        F.col("customer_trx_id").alias("Customer_Trx_ID"),
        text("order_purchase_timestamp").alias("Order_Purchase_Timestamp"),
        F.col("order_id").alias("Order_ID"),
    ).write.option("sep", ";").option("header", True).option("escape", '"').csv(path)
    return SRC.read_semicolon_csv(spark, path, ECOMMERCE_SCHEMAS["orders"][1])


def _write_lines(df, name, *cells, sep):
    path = scratch_path(df.sparkSession, name)
    df.select(_line(sep, *cells)).write.text(path)
    return path


@register("rating_files_report", RAT + f""",
s AS (SELECT movie_id, sum(CAST(rating AS DECIMAL(18,6)))::DOUBLE / count(*) AS a, count(*) AS n
      FROM (SELECT movie_id, rating FROM b_ratings UNION ALL SELECT movie_id, rating FROM b_event_ratings) GROUP BY movie_id)
SELECT coalesce(trim(m.title), 'Unknown') AS key,
       'AverageRating: ' || {_F2.format(x='s.a')} || ' (TotalRatings: ' || s.n || ')' AS value
FROM s LEFT JOIN b_movies m ON s.movie_id = m.movie_id""")
def q_rating_files_report(spark, sf):
    """Movies and two rating inputs as the reference's text files, and the
    movie report through its text output."""
    m, r, e = B.movies(spark, sf), B.ratings(spark, sf), B.event_ratings(spark, sf)
    movies = _write_lines(m, "movies-txt", "movie_id", "title", F.concat("genres", F.lit(",more")), sep=",")
    row = ["user_id", "movie_id", F.col("rating").cast("string"), F.unix_seconds(F.to_timestamp("ts"))]
    ratings = [_write_lines(x, "ratings-txt", *row, sep=",") for x in (r, e)]
    stats = R.movie_avg_rating(DS.read_ratings(spark, ratings), DS.read_movies(spark, movies))
    path = scratch_path(spark, "movie-report")
    write_tsv(FM.movie_lines(stats.orderBy("movie_id")), path)
    return read_tsv(spark, path)


@register("review_files_sentiment", """
SELECT o_orderstatus AS aspect, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS positive,
       count(*) FILTER (WHERE o_orderkey % 3 = 1) AS negative
FROM orders WHERE o_orderkey % 3 IN (0, 1) GROUP BY o_orderstatus""")
def q_review_files_sentiment(spark, sf):
    """Orders as ``;`` review lines, a third of them without a sentiment."""
    k = F.col("o_orderkey")
    sentiment = F.when(k % 3 == 0, " Positive ").when(k % 3 == 1, "NEGATIVE").otherwise("")
    path = _write_lines(
        B.table(spark, sf, "orders"), "reviews-txt", k, "o_orderpriority", "o_orderstatus", F.lit("ROOMS"), sentiment, sep=";")
    return T.aspect_sentiment(DS.read_reviews(spark, path, DS.REVIEW_MIN_FIELDS["sentiment"]))


@register("parse_tolerant", """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS c_nationkey FROM customer""")
def q_parse_tolerant(spark, sf):
    c = B.table(spark, sf, "customer")
    number = F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey").cast("string")).otherwise(F.col("c_name"))
    lines = c.select(_line(",", "c_custkey", number).alias("value"))
    return SRC.parse_delimited(lines, ["c_custkey", "c_nationkey"], types=_CUSTOMER_TYPES, strict=False)


@register("stream_two_outputs", _PERSON_COUNT_SQL)
def q_stream_two_outputs(spark, sf):
    """The replies of the stream that also stores its results, for the frames
    that both outputs hold."""
    stream = B.detections_from_events(_event_stream(spark, sf))
    out, ckpt = SD.new_paths(spark, "stream-two-outputs")
    replies = scratch_path(spark, "stream-replies")
    SD.run_to_end(SD.stream_results_sink(stream, out, ckpt, RESULTS_ZONE, replies=replies, trigger=None))
    sent = spark.read.schema("frame_id long, person_count int").json(replies).select("frame_id", "person_count")
    stored = read_results_csv(spark, out, parse_boxes=False).select("frame_id", "person_count")
    return stored.join(sent, ["frame_id", "person_count"])


@register("stream_score_frames", """
SELECT doc_id AS frame_id, CAST(strlen(text) % 5 AS INTEGER) AS person_count FROM documents""")
def q_stream_score_frames(spark, sf):
    """Frames arrive as JSON lines {frame_id, timestamp, image_b64} (the
    documents' text as the image bytes); the stream decodes and scores them."""
    path = scratch_path(spark, "frames-json-input")
    frames = B.frames_as_bytes(spark, sf).select(
        # documents carry no capture time; the field is kept for the wire format
        "frame_id", F.lit(0.0).alias("timestamp"), S.b64encode("image").alias("image_b64")
    )
    frames.write.json(path)
    out, ckpt = SD.new_paths(spark, "stream-score-frames")
    SD.run_to_end(SD.stream_score_frames(SD.read_frame_stream(spark, path), D.byte_length_scorer, out, ckpt))
    return spark.read.parquet(out).select("frame_id", "person_count")


@register("stream_flush_batches", DET + f""",
t AS (SELECT source, frame_id, ts,
             CAST(floor((epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events)) / {FLUSH_TICK_SECONDS * 1_000_000}) AS BIGINT) AS tick
      FROM b_frames),
r AS (SELECT *, row_number() OVER (PARTITION BY source, tick ORDER BY ts, frame_id) AS rn FROM t)
SELECT source, frame_id, tick, CAST((rn - 1) // 5 AS BIGINT) AS batch, CAST((rn - 1) % 5 AS INTEGER) AS row_in_batch
FROM r""")
def q_stream_flush_batches(spark, sf):
    """The flush rule of every source as a stateful stream over the events
    (arrival order = time order); must equal the batch closed form."""
    t0 = B.table(spark, sf, "events").agg(F.unix_micros(F.to_timestamp(F.min("ts")))).first()[0]
    stream = B.detections_from_events(_event_stream(spark, sf))
    out, ckpt = SD.new_paths(spark, "stream-flush")
    SD.run_to_end(SD.stream_flush_batches(
        stream, t0, out, ckpt, interval_seconds=FLUSH_TICK_SECONDS, max_rows=D.FLUSH_ROWS, source_cols=["source"],
        ticks_per_key=4096))
    return spark.read.parquet(out).select("source", "frame_id", "tick", "batch", "row_in_batch")
