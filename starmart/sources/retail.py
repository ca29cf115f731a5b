"""The star schema and the run metrics, read from the supplied order-processing tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Star(NamedTuple):
    users: DataFrame
    products: DataFrame
    transactions: DataFrame


# The columns read here. Declared, so that building a query reads no file footer.
_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE",
    "events": "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE",
}


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _users(spark: SparkSession, folder: str) -> DataFrame:
    customers, nations = _read(spark, folder, "customer"), _read(spark, folder, "nation")
    return customers.join(nations, F.expr("c_nationkey = n_nationkey")).selectExpr(
        "c_custkey AS user_id",
        "c_name AS name",
        "lower(replace(c_name, '#', '.')) || '@example.com' AS email",
        "n_name AS country",
        "c_mktsegment AS address",
        "DATE '2000-06-01' AS signup_date",
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS name",
        "p_type AS category",
        "concat_ws(' ', p_brand, p_size) AS description",
        "p_retailprice AS price",
    )


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders = _read(spark, folder, "lineitem"), _read(spark, folder, "orders")
    return lines.join(orders, F.expr("l_orderkey = o_orderkey")).selectExpr(
        "l_orderkey AS transaction_id",
        "o_custkey AS user_id",
        "l_partkey AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(o_orderdate AS DATE) AS transaction_date",
    )


_TABLES = {"users": _users, "products": _products, "transactions": _transactions}


def retail_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Customers as users, parts as products, order lines as transactions."""
    return _TABLES[table](spark, folder)


def retail_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as timed steps: the event type stands for the experiment."""
    return _read(spark, folder, "events").selectExpr(
        "event_type AS experiment",
        "user_id % 3 AS run",
        "CASE WHEN event_id % 2 = 0 THEN 'silver' ELSE 'gold' END AS stage",
        "CAST(event_id % 5 AS STRING) AS item",
        "value AS transform_s",
        "value / 10 AS write_s",
        "1L AS rows",
        "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status",
        "'steps of ' || event_type AS description",
    )
