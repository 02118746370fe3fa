"""Order, revenue, review and delivery reports.

Inputs (column names of the e-commerce tables, lower-cased):

* customers: ``customer_trx_id, subscriber_id, customer_country``
* orders: ``order_id, customer_trx_id, order_purchase_timestamp,
  order_delivered_carrier_date``
* items: ``order_id, order_item_id, product_id, seller_id, price,
  freight_value, shipping_limit_date``
* reviews: ``review_id, order_id, review_score``
* products: ``product_id, product_category_name``

Fact tables are reduced to one row per join key before they meet another
large table (orders per customer, revenue per product, scores per order),
so joins see key-level rows, and partial aggregation does the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sums of money are exact: each amount is cast to this decimal before
# summing, and the total is cast back to double.
MONEY = "decimal(18,4)"


def _distinct_with_null(col: str):
    """``select(c).distinct().count()``: a null counts as one more value."""
    return F.count_distinct(col) + F.max(F.col(col).isNull().cast("int"))


def overall_stats(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """``metric, value`` rows: total orders, distinct subscribers and
    distinct sellers (null counted as a value, as ``distinct().count()``
    does). Three global aggregates, stacked as rows."""
    n_orders = orders.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("total_orders").alias("metric"), F.col("value").cast("long").alias("value")
    )
    n_customers = customers.agg(_distinct_with_null("subscriber_id").alias("value")).select(
        F.lit("total_customers").alias("metric"), F.coalesce(F.col("value"), F.lit(0)).cast("long").alias("value")
    )
    n_sellers = items.agg(_distinct_with_null("seller_id").alias("value")).select(
        F.lit("total_sellers").alias("metric"), F.coalesce(F.col("value"), F.lit(0)).cast("long").alias("value")
    )
    return n_orders.unionByName(n_customers).unionByName(n_sellers)


def orders_by_country(orders: DataFrame, customers: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` countries by number of orders (ties by country name).

    Orders are counted per customer first; the per-customer counts meet
    the customer table, then add up per country.
    """
    per_customer = orders.filter(F.col("order_id").isNotNull()).groupBy("customer_trx_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        customers.select("customer_trx_id", "customer_country")
        .join(per_customer, "customer_trx_id")
        .groupBy("customer_country")
        .agg(F.sum("n").alias("total_orders"))
        .orderBy(F.col("total_orders").desc(), F.col("customer_country").asc_nulls_first())
        .limit(top)
    )


def orders_by_month(orders: DataFrame) -> DataFrame:
    """Orders per (year, month) of purchase: year ascending, month
    descending (the reference report's order)."""
    ts = F.col("order_purchase_timestamp")
    return (
        orders.filter(F.col("order_id").isNotNull())
        .groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"))
        .agg(F.count(F.lit(1)).alias("total_orders"))
        .orderBy(F.col("year").asc(), F.col("month").desc())
    )


def _valid_scores(reviews: DataFrame) -> DataFrame:
    return reviews.filter(F.col("review_score").isNotNull() & F.col("review_score").between(1, 5))


def review_score_mean(reviews: DataFrame) -> DataFrame:
    """Mean of the valid (1..5) review scores: one row."""
    return _valid_scores(reviews).agg(F.avg("review_score").alias("avg_score"))


def review_score_histogram(reviews: DataFrame) -> DataFrame:
    """Number of reviews per valid score, by score."""
    return (
        _valid_scores(reviews)
        .groupBy("review_score")
        .agg(F.count("review_id").alias("n_reviews"))
        .orderBy("review_score")
    )


def _year_range(col: str, year: int):
    """``year(col) == year`` as a range, so it reaches parquet statistics."""
    c = F.col(col)
    return (c >= F.lit(f"{year:04d}-01-01 00:00:00")) & (c < F.lit(f"{year + 1:04d}-01-01 00:00:00"))


def revenue_by_category(
    items: DataFrame, orders: DataFrame, products: DataFrame, year: int
) -> DataFrame:
    """Revenue (price + freight) per product category for orders purchased
    in ``year``, largest first. Amounts are summed exactly as decimals.

    Items of the year's orders are summed per product before the product
    join, so the product table meets one row per sold product.
    """
    year_orders = orders.filter(_year_range("order_purchase_timestamp", year)).select("order_id")
    revenue = (F.col("price") + F.col("freight_value")).cast(MONEY)
    per_product = (
        items.select("order_id", "product_id", revenue.alias("revenue"))
        .join(year_orders, "order_id")
        .groupBy("product_id")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return (
        per_product.join(products.select("product_id", "product_category_name"), "product_id")
        .groupBy("product_category_name")
        .agg(F.sum("revenue").cast("double").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc(), F.col("product_category_name").asc_nulls_first())
    )


def top_products(items: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` products by number of items sold (ties by id)."""
    return (
        items.groupBy("product_id")
        .agg(F.count("order_item_id").alias("total_sold"))
        .orderBy(F.col("total_sold").desc(), F.col("product_id").asc_nulls_first())
        .limit(top)
    )


def product_avg_review(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean review score per product over items joined to the reviews of
    their order (many-to-many: a review counts once per item of its
    order; only null scores are dropped).

    Reviews are summed per order first, so each item meets at most one row
    and the sums are added per product -- the same numbers as the row-level
    join, in one exchange of the items.
    """
    per_order = reviews.filter(F.col("review_score").isNotNull()).groupBy("order_id").agg(
        F.sum("review_score").alias("s"), F.count("review_score").alias("c")
    )
    return (
        items.select("order_id", "product_id").join(per_order, "order_id")
        .groupBy("product_id")
        .agg((F.sum("s").cast("double") / F.sum("c")).alias("avg_review_score"))
    )


def delivery_diff_days(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per item of an order with both dates: carrier date, shipping limit
    and their signed difference in calendar days."""
    o = orders.select("order_id", "order_delivered_carrier_date")
    return (
        items.select("order_id", "shipping_limit_date")
        .join(o, "order_id")
        .filter(F.col("order_delivered_carrier_date").isNotNull() & F.col("shipping_limit_date").isNotNull())
        .select(
            "order_id",
            "order_delivered_carrier_date",
            "shipping_limit_date",
            F.datediff("order_delivered_carrier_date", "shipping_limit_date").alias("delivery_diff_days"),
        )
    )
