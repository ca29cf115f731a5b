"""Sales measures over the star schema.

Dimensions may be of any size: none is hinted for broadcast, Spark broadcasts one when it
is below the session's threshold. Where the fact is shuffled it is the left side of the join,
the side that Spark splits when a key is hot, or it has been pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import both_parts, quoted, split_exact
from starmart.operators.skew import HotKeys

# A sale is a decimal where its price is one without loss, else a double; see ``split_exact``.
_AMOUNTS = ("_price * quantity AS amount", "_odd_price * quantity AS odd_amount")
_SUMS = ("sum(amount) AS amount", "sum(odd_amount) AS odd_amount")
_TOTAL = both_parts("sum(amount)", "sum(odd_amount)")


def _priced(
    transactions: DataFrame, products: DataFrame, how: str, hot: HotKeys | None = None
) -> DataFrame:
    """The fact with ``_price`` or ``_odd_price`` of its product; NULL if a left join finds none."""
    price, odd_price = split_exact("price")
    prices = products.selectExpr(
        "product_id AS _product_id", f"{price} AS _price", f"{odd_price} AS _odd_price"
    )
    return (hot or HotKeys()).join(transactions, prices, "product_id", "_product_id", how)


def daily_sales(
    transactions: DataFrame, products: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """``total_sales`` per day with at least one transaction.

    A transaction of an unknown product counts as 0 but keeps its day in the series.
    """
    dated = "CAST(transaction_date AS DATE) AS transaction_date"
    return (
        _priced(transactions, products, "left", hot)
        .selectExpr(dated, *_AMOUNTS)
        .groupBy("transaction_date")
        .agg(F.expr(f"coalesce({_TOTAL}, 0D) AS total_sales"))
    )


def user_spend(
    transactions: DataFrame,
    users: DataFrame,
    products: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``total_spent`` per user and name, for users that bought a known product.

    The fact is reduced to a row per user before it meets the users.
    """
    spend = (
        _priced(transactions, products, "inner", hot)
        .selectExpr("user_id", *_AMOUNTS)
        .groupBy("user_id")
        .agg(*map(F.expr, _SUMS))
    )
    return (
        spend.join(users.select("user_id", "name"), "user_id")
        .groupBy("user_id", "name")
        .agg(F.expr(f"{_TOTAL} AS total_spent"))
    )


def product_quantity(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """``total_quantity_sold`` per product that sold, reduced before it meets the products."""
    sold = transactions.groupBy("product_id").agg(F.expr("sum(quantity) AS _sold"))
    return (
        sold.join(products.select("product_id", "category", "name"), "product_id")
        .groupBy("category", "product_id", "name")
        .agg(F.expr("CAST(sum(_sold) AS BIGINT) AS total_quantity_sold"))
    )


def segment_performance(
    users: DataFrame,
    transactions: DataFrame,
    products: DataFrame,
    by: str = "country",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Sales, distinct transactions and distinct buyers per user segment.

    A tree of partial aggregates over one scan of the fact: a row per user and transaction meets
    the users; then, per segment, a row per transaction and one per buyer, which are counted. A
    segment without any transaction appears with zeros: it comes from a row per segment rather
    than from an outer join starting at the users, which could neither broadcast the users nor
    split a hot one.
    """
    segment = quoted(by)
    sales = (
        _priced(transactions, products, "left", hot)
        .selectExpr("transaction_id", "user_id", *_AMOUNTS)
        .groupBy("user_id", "transaction_id")
        .agg(*map(F.expr, _SUMS))
    )
    segments = users.selectExpr("user_id AS _user_id", segment)
    met = sales.join(segments, F.expr("user_id = _user_id"))
    # The transaction with its amounts, the buyer without: each is one row per segment after this.
    counted = met.selectExpr(
        segment,
        """inline(array(
            named_struct('_transaction', transaction_id, '_buyer', NULL,
                'amount', amount, 'odd_amount', odd_amount),
            named_struct('_transaction', NULL, '_buyer', user_id,
                'amount', NULL, 'odd_amount', NULL)))""",
    )
    counted = counted.groupBy(by, "_transaction", "_buyer").agg(*map(F.expr, _SUMS))
    measured = counted.unionByName(segments.select(by).distinct(), True)
    return measured.groupBy(by).agg(
        F.expr(f"coalesce({_TOTAL}, 0D) AS total_sales"),
        F.expr("count(_transaction) AS total_transactions"),
        F.expr("count(_buyer) AS total_users"),
    )
