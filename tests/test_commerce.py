"""Commerce reports on hand-made tables."""

import datetime as dt

import pytest

from tessera.operators import commerce as C
from tests.conftest import rows

ITEMS = ("order_id long, order_item_id int, product_id long, seller_id long, price double, "
         "freight_value double, shipping_limit_date timestamp")
ORDERS = ("order_id long, customer_trx_id long, order_purchase_timestamp timestamp, "
          "order_delivered_carrier_date timestamp")
D = dt.datetime


@pytest.fixture()
def tables(spark):
    customers = spark.createDataFrame(
        [(1, 1, "VN"), (2, None, "VN"), (3, 1, "FR"), (4, 2, None)],
        "customer_trx_id long, subscriber_id long, customer_country string",
    )
    orders = spark.createDataFrame(
        [(100, 1, D(2024, 3, 1), D(2024, 3, 5)), (101, 1, D(2024, 5, 1), None),
         (102, 3, D(2023, 12, 31), D(2024, 1, 2)), (103, 4, D(2024, 5, 2), D(2024, 5, 1))],
        ORDERS,
    )
    items = spark.createDataFrame(
        [(100, 1, 7, 1, 10.1, 0.2, D(2024, 3, 3)), (100, 2, 8, None, 1.005, None, D(2024, 3, 3)),
         (101, 1, 7, 2, 5.0, 1.0, D(2024, 5, 3)), (102, 1, 7, 1, 2.0, 2.0, D(2024, 1, 1)),
         (103, 1, 9, 3, 3.3, 0.7, D(2024, 5, 3))],
        ITEMS,
    )
    reviews = spark.createDataFrame(
        [(1, 100, 5), (2, 100, 3), (3, 101, None), (4, 102, 9), (5, 103, 1)],
        "review_id long, order_id long, review_score int",
    )
    products = spark.createDataFrame([(7, "toys"), (8, None), (9, "toys")], "product_id long, product_category_name string")
    return customers, orders, items, reviews, products


def test_overall_stats_counts_null_as_value(spark, tables):
    customers, orders, items, _, _ = tables
    got = dict(rows(C.overall_stats(orders, customers, items)))
    # H6: subscribers {1, 2, null} -> 3; sellers {1, 2, 3, null} -> 4.
    assert got == {"total_orders": 4, "total_customers": 3, "total_sellers": 4}


def test_orders_by_country(spark, tables):
    customers, orders, *_ = tables
    got = [tuple(r) for r in C.orders_by_country(orders, customers).collect()]
    assert got == [("VN", 2), (None, 1), ("FR", 1)]


def test_orders_by_month_order(spark, tables):
    _, orders, *_ = tables
    got = [tuple(r) for r in C.orders_by_month(orders).collect()]
    assert got == [(2023, 12, 1), (2024, 5, 2), (2024, 3, 1)]


def test_review_mean_and_histogram_skip_invalid(spark, tables):
    reviews = tables[3]
    assert C.review_score_mean(reviews).first()["avg_score"] == 3.0
    assert [tuple(r) for r in C.review_score_histogram(reviews).collect()] == [(1, 1), (3, 1), (5, 1)]


def test_revenue_exact_and_null_operand(spark, tables):
    _, orders, items, _, products = tables
    got = rows(C.revenue_by_category(items, orders, products, 2024))
    # H7: null freight makes the item's revenue null (skipped by sum).
    # toys: 10.1+0.2 + 5.0+1.0 + 3.3+0.7 = 20.3 exactly; 2023 order excluded.
    assert got == [(None, None), ("toys", 20.3)]


def test_product_avg_review_fan_out(spark, tables):
    _, _, items, reviews, _ = tables
    got = dict(rows(C.product_avg_review(items, reviews)))
    # Order 100 has two items and two reviews; each item sees both.
    # product 7: order 100 (5, 3) + order 102 (9) -> (5+3+9)/3; null review dropped.
    assert got == {7: 17 / 3, 8: 4.0, 9: 1.0}


def test_product_avg_review_matches_row_level_join(spark, tables):
    _, _, items, reviews, _ = tables
    from pyspark.sql import functions as F
    brute = (items.join(reviews.filter(F.col("review_score").isNotNull()), "order_id")
             .groupBy("product_id").agg(F.avg("review_score").alias("a")))
    assert rows(brute) == rows(C.product_avg_review(items, reviews))


def test_top_products_ties_by_id(spark, tables):
    items = tables[2]
    assert [tuple(r) for r in C.top_products(items, top=2).collect()] == [(7, 3), (8, 1)]


def test_delivery_diff_signed_days(spark, tables):
    _, orders, items, _, _ = tables
    got = rows(C.delivery_diff_days(items, orders), "order_id", "delivery_diff_days")
    assert got == [(100, 2), (100, 2), (102, 1), (103, -2)]
