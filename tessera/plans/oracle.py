"""DuckDB SQL for every registered query: the independent oracle.

Each statement starts from the driver's pre-registered views (the raw
tables) and restates the binding of :mod:`tessera.plans.bindings` as CTEs,
then computes the query's answer directly, without the tricks the Spark
plans use (aggregate-before-join, struct max, distributed ranking).
"""

from __future__ import annotations

B_RATINGS = """b_ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS movie_id, l_quantity AS rating, l_shipdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

B_EVENT_RATINGS = """b_event_ratings AS (
  SELECT user_id, event_id AS movie_id, value AS rating, ts FROM events)"""

B_USERS = """b_users AS (
  SELECT c_custkey AS user_id,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'M' WHEN 'MACHINERY' THEN 'm'
              WHEN 'HOUSEHOLD' THEN 'F' ELSE c_mktsegment END AS gender,
         10 + c_custkey % 60 AS age, c_nationkey AS occupation_id
  FROM customer)"""

B_MOVIES = """b_movies AS (
  SELECT p_partkey AS movie_id, p_name AS title, concat(p_type, '|', p_brand) AS genres
  FROM part)"""

B_OCC = """b_occ AS (
  SELECT n_nationkey AS occupation_id, n_name AS name FROM nation)"""

B_REVIEWS = """b_reviews AS (
  SELECT d.doc_id AS id, d.text AS comment, d.source AS aspect, d.lang AS category,
         CASE WHEN l.quality = 1 THEN 'positive' WHEN l.quality = 0 THEN 'negative'
              ELSE 'neutral' END AS sentiment
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

B_CUSTOMERS = """b_customers AS (
  SELECT c_custkey AS customer_trx_id, nullif(c_custkey % 100, 0) AS subscriber_id,
         n_name AS customer_country
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

B_ITEMS = """b_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_extendedprice AS price, l_tax * l_quantity AS freight_value,
         l_shipdate AS shipping_limit_date
  FROM lineitem)"""

B_SCORES = """b_scores AS (
  SELECT o_orderkey AS review_id, o_orderkey AS order_id,
         CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 97 = 0 THEN 9
              ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS review_score
  FROM orders)"""

B_ORDERS = """b_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_trx_id,
         o_orderdate AS order_purchase_timestamp, o_orderdate AS order_delivered_carrier_date
  FROM orders)"""

B_PRODUCTS = """b_products AS (
  SELECT p_partkey AS product_id, nullif(p_type, 'ECONOMY') AS product_category_name FROM part)"""

# One row per (frame, box) of the synthetic model output, with the class.
B_FRAMES = """b_frames AS (
  SELECT event_id AS frame_id, ts, user_id AS source, value AS process_ms,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events)"""

B_BOXES = """b_boxes AS (
  SELECT frame_id, k, i,
         CAST(10 * i AS INTEGER) AS x1, CAST(k AS INTEGER) AS y1,
         CAST(10 * i + 50 AS INTEGER) AS x2, CAST(k + 100 AS INTEGER) AS y2,
         CAST(((k * 7 + i * 13) % 100) / 100.0 AS DOUBLE) AS confidence,
         CAST(i % 2 AS INTEGER) AS cls
  FROM (SELECT frame_id, k, unnest(range(0, k % 4)) AS i FROM b_frames))"""

B_PERSONS = """b_persons AS (
  SELECT * FROM b_boxes WHERE cls = 0 AND confidence >= 0.4)"""

# Tokens of every review, position 1-based after empty tokens are dropped.
B_TOKENS = """b_tokens AS (
  SELECT id, aspect, category, sentiment,
         unnest(list_filter(
           list_transform(regexp_split_to_array(lower(comment), '[ \\t\\n\\x0B\\f\\r[:punct:]]+'),
                          lambda t: regexp_replace(t, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')),
           lambda t: t <> '')) AS token
  FROM b_reviews)"""

STOPWORDS_SQL = "('the', 'of', 'de', 'and', 'to', 'in', 'la', 'a', 'der', 'is')"


# Documents in the columns of events, in the place of that table.
B_DOCUMENT_EVENTS = """events AS (
  SELECT doc_id AS event_id, make_timestamp(1700000000000000 + doc_id * 1500000) AS ts,
         CASE WHEN doc_id % 50 <> 0 THEN doc_id // 5 END AS user_id, (n_chars % 1000) / 4.0::DOUBLE AS value,
         '{"k": ' || (n_chars % 100) || '}' AS props
  FROM documents)"""

B_DOCUMENT_RATINGS = """b_document_ratings AS (
  SELECT CASE WHEN doc_id % 3 = 0 THEN -1 ELSE doc_id END AS user_id, doc_id // 20 AS movie_id,
         (n_chars % 9) / 2.0::DOUBLE + 0.5 AS rating, 1700000000 + doc_id AS ts
  FROM documents)"""

B_LABEL_USERS = """b_label_users AS (
  SELECT doc_id AS user_id, CASE WHEN quality = 1 THEN 'M' ELSE 'F' END AS gender FROM labels
  UNION ALL SELECT -1, 'm')"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
