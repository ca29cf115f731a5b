"""Small inputs with known results."""

from __future__ import annotations

from datetime import date

from pyspark.sql import types as T

from starmart.sources import PRODUCTS, TRANSACTIONS, USERS, Star, with_date_as

TEXT_DATED_USERS = with_date_as(USERS, T.StringType())
TEXT_DATED_TRANSACTIONS = with_date_as(TRANSACTIONS, T.StringType())

# A shop with eight users, ten products and eight days of sales, whose golden
# results are in test_reports.py.
# user_id, name, country
SHOP_USERS = [
    (1, "John", "USA"),
    (2, "Sarah", "USA"),
    (3, "Kacper", "Poland"),
    (4, "Maria", "Poland"),
    (5, "Emma", "Poland"),
    (6, "Anna", "Germany"),
    (7, "Peter", "Germany"),
    (8, "Lucas", "France"),
]
# product_id, name, category, price
SHOP_PRODUCTS = [
    (1, "Product A", "Category 1", 10.0),
    (2, "Product B", "Category 1", 5.0),
    (3, "Product C", "Category 1", 8.0),
    (9, "Product I", "Category 1", 3.0),
    (4, "Product D", "Category 2", 25.0),
    (5, "Product E", "Category 2", 12.0),
    (6, "Product F", "Category 2", 50.0),
    (10, "Product J", "Category 2", 15.0),
    (7, "Product G", "Category 3", 100.0),
    (8, "Product H", "Category 3", 70.0),
]
# transaction_id, user_id, product_id, quantity, transaction_date
SHOP_SALES = [
    (1, 1, 1, 3, "2025-01-01"),
    (2, 2, 2, 10, "2025-01-01"),
    (3, 3, 3, 5, "2025-01-02"),
    (4, 4, 4, 2, "2025-01-02"),
    (5, 5, 5, 1, "2025-01-02"),
    (6, 1, 5, 15, "2025-01-03"),
    (7, 6, 6, 1, "2025-01-03"),
    (8, 7, 3, 3, "2025-01-03"),
    (9, 4, 7, 1, "2025-01-03"),
    (10, 3, 9, 4, "2025-01-03"),
    (11, 5, 4, 1, "2025-01-03"),
    (12, 1, 8, 1, "2025-01-04"),
    (13, 2, 7, 1, "2025-01-04"),
    (14, 3, 9, 3, "2025-01-04"),
    (15, 8, 10, 1, "2025-01-04"),
    (16, 4, 4, 4, "2025-01-05"),
    (17, 6, 1, 6, "2025-01-05"),
    (18, 7, 2, 6, "2025-01-05"),
    (19, 1, 2, 5, "2025-01-06"),
    (20, 8, 4, 2, "2025-01-06"),
    (21, 5, 5, 1, "2025-01-06"),
    (22, 3, 1, 6, "2025-01-07"),
    (23, 4, 5, 1, "2025-01-07"),
    (24, 1, 3, 10, "2025-01-07"),
    (25, 7, 2, 3, "2025-01-07"),
    (26, 2, 8, 1, "2025-01-08"),
    (27, 4, 4, 2, "2025-01-08"),
    (28, 5, 5, 1, "2025-01-08"),
]


def shop_rows():
    """The shop with the columns that no report reads filled in."""
    users = [
        (i, name, f"{name}@example.com", country, f"{i} Main St", date(2024, 1, 1))
        for i, name, country in SHOP_USERS
    ]
    products = [
        (i, name, category, f"About {name}", price) for i, name, category, price in SHOP_PRODUCTS
    ]
    sales = [(*sale, date.fromisoformat(day)) for *sale, day in SHOP_SALES]
    return users, products, sales


def shop(spark, extra_users=(), extra_products=(), extra_sales=()) -> Star:
    users, products, sales = shop_rows()
    return Star(
        spark.createDataFrame([*users, *extra_users], USERS),
        spark.createDataFrame([*products, *extra_products], PRODUCTS),
        spark.createDataFrame([*sales, *extra_sales], TRANSACTIONS),
    )


def rows(df):
    return [tuple(row) for row in df.collect()]
