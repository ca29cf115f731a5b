"""The five gold reports, from cleaned tables to ordered results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators import (
    HotKeys,
    daily_sales,
    fill_gaps,
    moving_average,
    period_over_period,
    product_quantity,
    segment_performance,
    top_k,
    top_n_per_group,
    user_spend,
)

Report = Callable[..., DataFrame]


def top_spenders(
    users: DataFrame,
    products: DataFrame,
    transactions: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The ten users that spent most; equal spenders in order of their id."""
    spend = user_spend(transactions, users, products, hot)
    return top_k(spend, "total_spent", k=10, tie_break=["user_id"])


def top_products_by_category(
    users: DataFrame,
    products: DataFrame,
    transactions: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The five best-selling products of each category, ties included.

    The fact is summed per product before it meets the products, so ``hot`` keys need nothing.
    """
    sold = product_quantity(transactions, products)
    best = top_n_per_group(sold, ["category"], "total_quantity_sold", n=5)
    return best.orderBy("category", "rank", "product_id").select(
        "category", "product_id", "name", "total_quantity_sold"
    )


def performance_analysis_by_country(
    users: DataFrame,
    products: DataFrame,
    transactions: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Sales, transactions and buyers per country, best first; idle countries show zeros.

    There are only so many countries: they are sorted in one task, without the sampling pass
    that a range partitioning takes.
    """
    countries = segment_performance(users, transactions, products, by="country", hot=hot)
    return countries.repartition(1).orderBy(F.desc("total_sales"), "country")


def daily_series(
    transactions: DataFrame, products: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Sales per calendar day, which both daily reports start from; a row per day."""
    daily = daily_sales(transactions, products, hot)
    return fill_gaps(daily, "transaction_date", ["total_sales"])


def sales_moving_average(
    users: DataFrame,
    products: DataFrame,
    transactions: DataFrame,
    series: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Sales per calendar day and their seven-day average."""
    if series is None:
        series = daily_series(transactions, products, hot)
    averaged = moving_average(
        series, "transaction_date", "total_sales", rows=7, result_as="moving_average_sales"
    )
    return averaged.selectExpr(
        "transaction_date", "CAST(total_sales AS DOUBLE)", "moving_average_sales"
    ).orderBy("transaction_date")


def day_to_day_sales(
    users: DataFrame,
    products: DataFrame,
    transactions: DataFrame,
    series: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Sales per calendar day, the day before and the change in percent."""
    if series is None:
        series = daily_series(transactions, products, hot)
    compared = period_over_period(
        series, "transaction_date", "total_sales", previous_as="previous_day_sales"
    )
    return compared.selectExpr(
        "transaction_date",
        "CAST(total_sales AS DOUBLE)",
        "CAST(previous_day_sales AS DOUBLE)",
        "percent_change",
    ).orderBy("transaction_date")


# The report names, which also name their tables and folders.
REPORTS: dict[str, Report] = {
    "day_to_day_sales": day_to_day_sales,
    "top_spenders": top_spenders,
    "performance_analysis_by_country": performance_analysis_by_country,
    "sales_moving_average": sales_moving_average,
    "top_products_by_category": top_products_by_category,
}

# The reports over ``daily_series``; run together, they can share it.
DAILY_REPORTS = ("day_to_day_sales", "sales_moving_average")
