"""One query per operator: ``(spark, folder) -> DataFrame`` over the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from pathlib import Path
from uuid import uuid4

import starmart.plans
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from starmart import operators as op
from starmart import sinks, sources
from starmart.functions import parsed_date
from starmart.plans import (
    REFERENCES,
    REPORTS,
    run_medallion,
    run_silver,
    run_sql_reports,
    scratch_folder,
)
from starmart.sources import Star

Query = Callable[[SparkSession, str], DataFrame]

NOISE_LEVEL, NOISE_NULL_SHARE, EXACT_LEVEL = 0.3, 0.5, 0.03
NOISE_TODAY = date(2025, 1, 1)
NOISE_KEYS = {
    "users": ["user_id"],
    "products": ["product_id"],
    "transactions": ["transaction_id", "product_id"],
}
BASELINE = "view"
PRUNED_CATEGORIES = ["ECONOMY", "SMALL"]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which every engine writes alike."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, T.DateType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _rounded(df: DataFrame) -> DataFrame:
    """Statistics to six places: their last digits depend on the order of the rows."""
    return df.select(
        *[
            F.round(f.name, 6).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- inputs -----------------------------------------------------------------------------


def raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return sources.retail_table(spark, folder, table)


def noisy(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return op.inject_noise(
        raw(spark, folder, table),
        NOISE_KEYS[table],
        level=NOISE_LEVEL,
        null_share=NOISE_NULL_SHARE,
        today=NOISE_TODAY,
    )


def _noisy_tables(spark: SparkSession, folder: str) -> list[tuple[str, DataFrame]]:
    return [(table, noisy(spark, folder, table)) for table in NOISE_KEYS]


def silver(spark: SparkSession, folder: str, table: str, source=raw) -> DataFrame:
    """The cleaned table, references not yet enforced."""
    return op.clean(source(spark, folder, table), table)


def silver_star(
    spark: SparkSession, folder: str, source=raw, hot: op.HotKeys | None = None
) -> Star:
    """The cleaned tables; transactions refer to cleaned users and products only.

    Reports that join them on the same keys in the same job are given the fact's hot keys, see
    ``report``.
    """
    tables = {name: silver(spark, folder, name, source) for name in Star._fields}
    references = {key: tables[dim] for key, dim in REFERENCES.items()}
    tables["transactions"] = op.enforce_fks(tables["transactions"], references, hot)
    return Star(**tables)


_HOT_KEYS: dict[tuple[str, str], op.HotKeys] = {}


def hot_keys(spark: SparkSession, folder: str) -> op.HotKeys:
    """Users and products that hold a large share of the fact; one pass over its keys.

    Kept per session and folder, as table statistics are: after a change of the files they may
    cost balance, never a result.
    """
    found = spark.sparkContext.applicationId, folder
    if found not in _HOT_KEYS:
        keys = list(REFERENCES)
        fact = raw(spark, folder, "transactions")
        _HOT_KEYS[found] = op.find_hot_keys(fact, keys, ["transaction_id", *keys])
    return _HOT_KEYS[found]


def report(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A report from raw tables; references and prices join in one job, hot keys in pieces."""
    hot = hot_keys(spark, folder)
    return REPORTS[name](*silver_star(spark, folder, hot=hot), hot=hot)


def _dates_as_text(df: DataFrame, key: str, col: str) -> DataFrame:
    """The date as raw files may hold it: bad text, nothing, empty, too old or in order."""
    text = f"""CASE {key} % 5 WHEN 0 THEN 'invalid-date' WHEN 1 THEN NULL WHEN 2 THEN ''
        WHEN 3 THEN '1899-01-01' ELSE CAST({col} AS STRING) END"""
    return df.withColumn(col, F.expr(text))


def _rule(table: str, *columns: str) -> list[op.Rule]:
    return [rule for rule in op.TABLE_RULES[table] if rule.column in columns]


# --- scans ------------------------------------------------------------------------------


@query
def scan_csv_bronze(spark, folder):
    path = f"{scratch_folder(spark)}/users.csv"
    sinks.write_csv(noisy(spark, folder, "users"), path)
    return sources.read_bronze(spark, path, "users")


@query
def scan_csv_dateformat(spark, folder):
    path = f"{scratch_folder(spark)}/transactions.csv"
    sinks.write_csv(noisy(spark, folder, "transactions"), path)
    rows = sources.read_bronze(spark, path, "transactions", date_format="yyyy-MM-dd")
    return _plain(rows)


@query
def scan_parquet_silver(spark, folder):
    path = f"{scratch_folder(spark)}/transactions"
    sinks.write_parquet(silver_star(spark, folder).transactions, path)
    return _plain(sources.read_silver(spark, path))


@query
def scan_partitioned_products(spark, folder):
    path = f"{scratch_folder(spark)}/products"
    products = silver(spark, folder, "products")
    sinks.write_parquet(products, path, partition_by="category")
    read = sources.read_silver(spark, path, sources.PRODUCTS)
    return read.where(F.col("category").isin(PRUNED_CATEGORIES))


@query
def scan_run_metrics_json(spark, folder):
    path = sinks.write_run_metrics(sources.retail_runs(spark, folder), scratch_folder(spark))
    return sources.read_run_metrics(spark, path)


@query
def scan_other_scheme(spark, folder):
    """Bronze and silver behind a scheme that only this query's readers and writers know."""
    base, store = sources.qualified(spark, scratch_folder(spark)), f"shop-{uuid4().hex}"
    links = {f"/{layer}": f"{base}/{layer}" for layer in ("bronze", "silver")}
    options = sources.io_options(sources.mount_conf(store, links))
    bronze, silver_layer = (f"viewfs://{store}{layer}" for layer in links)
    for name, table in _noisy_tables(spark, folder):
        sinks.write_csv(table, f"{bronze}/{name}.csv", options)
    return _plain(run_silver(spark, bronze, silver_layer, options=options)["transactions"])


@query
def sql_report(spark, folder):
    file = Path(starmart.plans.__file__).parent / "sql" / "top_spenders.sql"
    return run_sql_reports(spark, [file], **silver_star(spark, folder)._asdict())["top_spenders"]


# --- sinks ------------------------------------------------------------------------------


@query
def sink_parquet_roundtrip(spark, folder):
    path = f"{scratch_folder(spark)}/users"
    sinks.write_parquet(silver(spark, folder, "users"), path)
    return _plain(sources.read_silver(spark, path))


@query
def sink_parquet_codec(spark, folder):
    path = f"{scratch_folder(spark)}/products"
    sinks.write_parquet(silver(spark, folder, "products"), path, compression="uncompressed")
    return sources.read_silver(spark, path)


@query
def sink_partitioned(spark, folder):
    path = f"{scratch_folder(spark)}/products"
    sinks.write_parquet(silver(spark, folder, "products"), path, partition_by="category")
    return sources.read_silver(spark, path, sources.PRODUCTS)


@query
def sink_gold_table(spark, folder):
    database = "starmart_gold"  # one for all calls: the table is replaced
    sinks.ensure_database(spark, database)
    countries = report(spark, folder, "performance_analysis_by_country")
    return spark.table(
        sinks.write_table(countries, database, "performance_analysis_by_country", single_file=True)
    )


@query
def sink_gold_parquet(spark, folder):
    path = f"{scratch_folder(spark)}/gold/day_to_day_sales"
    days = report(spark, folder, "day_to_day_sales")
    sinks.write_parquet(days, path, single_file=True)
    return _plain(sources.read_silver(spark, path))


@query
def sink_csv_roundtrip(spark, folder):
    path = f"{scratch_folder(spark)}/products.csv"
    sinks.write_csv(silver(spark, folder, "products"), path)
    return sources.read_bronze(spark, path, "products")


@query
def sink_run_metrics_json(spark, folder):
    path = sinks.write_run_metrics(sources.retail_runs(spark, folder), scratch_folder(spark))
    return _rounded(op.stage_totals(sources.read_run_metrics(spark, path)))


# --- cleaning ---------------------------------------------------------------------------


@query
def clean_null_ids(spark, folder):
    rows = noisy(spark, folder, "transactions")
    return _plain(op.clean(rows, op.known_keys(rows)))


@query
def clean_positive_ids(spark, folder):
    rows = noisy(spark, folder, "transactions")
    return _plain(op.clean(rows, op.positive_keys(rows)))


@query
def clean_quantity(spark, folder):
    rows = noisy(spark, folder, "transactions")
    return _plain(op.clean(rows, _rule("transactions", "quantity")))


@query
def clean_transaction_date(spark, folder):
    rows = raw(spark, folder, "transactions")
    rows = _dates_as_text(rows, "transaction_id", "transaction_date")
    return op.clean(rows, _rule("transactions", "transaction_date"))


@query
def clean_price(spark, folder):
    return op.clean(noisy(spark, folder, "products"), _rule("products", "price"))


@query
def clean_product_text(spark, folder):
    rules = _rule("products", "name", "category", "description")
    return op.clean(noisy(spark, folder, "products"), rules)


@query
def clean_user_text(spark, folder):
    rules = _rule("users", "name", "country", "address")
    return _plain(op.clean(noisy(spark, folder, "users"), rules))


@query
def clean_email(spark, folder):
    return _plain(op.clean(noisy(spark, folder, "users"), _rule("users", "email")))


@query
def clean_signup_date(spark, folder):
    rows = raw(spark, folder, "users")
    return op.clean(_dates_as_text(rows, "user_id", "signup_date"), _rule("users", "signup_date"))


@query
def clean_users(spark, folder):
    return _plain(op.clean(noisy(spark, folder, "users"), "users"))


@query
def clean_products(spark, folder):
    return op.clean(noisy(spark, folder, "products"), "products")


@query
def clean_transactions(spark, folder):
    return _plain(op.clean(noisy(spark, folder, "transactions"), "transactions"))


@query
def reject_predicates(spark, folder):
    users = noisy(spark, folder, "users")
    return _plain(
        users.where("user_id IS NULL OR user_id <= 0 OR email IS NULL OR email NOT LIKE '%@%'")
    )


@query
def quality_report(spark, folder):
    reports = [
        op.quality_report(table, name).select(F.lit(name).alias("table_name"), "*")
        for name, table in _noisy_tables(spark, folder)
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query
def silver_write_counts(spark, folder):
    """The quality report of a silver job, counted while it wrote."""
    base = scratch_folder(spark)
    for name, table in _noisy_tables(spark, folder):
        sinks.write_csv(table, f"{base}/bronze/{name}.csv")
    return run_silver(spark, f"{base}/bronze", f"{base}/silver").quality_report(spark)


@query
def sink_replace(spark, folder):
    """A table replaced by rows read from itself, then left alone by a write that fails."""
    path = f"{scratch_folder(spark)}/users"
    sinks.write_parquet(silver(spark, folder, "users"), path)
    users = sources.read_silver(spark, path)
    sinks.write_parquet(users.withColumn("name", F.upper("name")), path)
    broken = F.expr("IF(user_id % 2 = 0, raise_error('planned'), name)")
    try:
        sinks.write_parquet(sources.read_silver(spark, path).withColumn("name", broken), path)
    except Exception as failure:
        if "planned" not in str(failure):
            raise
    return _plain(sources.read_silver(spark, path))


@query
def try_parse_date(spark, folder):
    rows = raw(spark, folder, "transactions")
    rows = _dates_as_text(rows, "transaction_id", "transaction_date")
    parsed = parsed_date("transaction_date", T.StringType())
    return _plain(
        rows.selectExpr("transaction_id", "transaction_date", f"{parsed} AS parsed_date")
    )


# --- integrity and joins ----------------------------------------------------------------


@query
def fk_enforce_users(spark, folder):
    users = silver(spark, folder, "users", source=noisy)
    return _plain(op.enforce_fk(noisy(spark, folder, "transactions"), users, "user_id"))


@query
def fk_enforce_products(spark, folder):
    products = silver(spark, folder, "products", source=noisy)
    return _plain(op.enforce_fk(noisy(spark, folder, "transactions"), products, "product_id"))


@query
def fk_enforce_both(spark, folder):
    return _plain(silver_star(spark, folder, source=noisy).transactions)


@query
def fk_orphans(spark, folder):
    users = silver(spark, folder, "users", source=noisy)
    return _plain(op.orphans(noisy(spark, folder, "transactions"), users, "user_id"))


def _lookup(spark, folder, sort_merge):
    _, products, transactions = silver_star(spark, folder)
    return op.join_dimension(transactions, products, "product_id", sort_merge=sort_merge).select(
        "transaction_id", "product_id", "category", "quantity", "price"
    )


@query
def join_broadcast(spark, folder):
    return _lookup(spark, folder, sort_merge=False)


@query
def join_sort_merge(spark, folder):
    return _lookup(spark, folder, sort_merge=True)


# --- aggregates and calendar ------------------------------------------------------------


@query
def date_bounds(spark, folder):
    return _plain(op.date_bounds(silver_star(spark, folder).transactions, "transaction_date"))


@query
def daily_sales(spark, folder):
    _, products, transactions = silver_star(spark, folder)
    daily = op.daily_sales(transactions, products)
    return _plain(daily.withColumn("total_sales", F.col("total_sales").cast("double")))


@query
def product_quantity(spark, folder):
    _, products, transactions = silver_star(spark, folder)
    return op.product_quantity(transactions, products)


@query
def distinct_keys(spark, folder):
    return silver_star(spark, folder).transactions.select("user_id").distinct()


@query
def table_counts(spark, folder):
    return op.row_counts(silver_star(spark, folder)._asdict())


@query
def category_counts(spark, folder):
    best = report(spark, folder, "top_products_by_category")
    return best.groupBy("category").agg(F.count("*").alias("rows"))


@query
def date_spine(spark, folder):
    return _plain(op.date_spine(silver_star(spark, folder).transactions, "transaction_date"))


@query
def date_spine_fill(spark, folder):
    _, products, transactions = silver_star(spark, folder)
    filled = op.fill_from_spine(
        op.daily_sales(transactions, products),
        op.date_spine(transactions, "transaction_date"),
        "transaction_date",
        ["total_sales"],
    )
    return _plain(filled.withColumn("total_sales", F.col("total_sales").cast("double")))


# --- reports ----------------------------------------------------------------------------


@query
def top_spenders(spark, folder):
    return report(spark, folder, "top_spenders")


@query
def top_n_per_group(spark, folder):
    return report(spark, folder, "top_products_by_category")


@query
def country_performance(spark, folder):
    return report(spark, folder, "performance_analysis_by_country")


@query
def day_to_day_sales(spark, folder):
    return _plain(report(spark, folder, "day_to_day_sales"))


@query
def sales_moving_average(spark, folder):
    return _plain(report(spark, folder, "sales_moving_average"))


@query
def money_extremes(spark, folder):
    """Totals of prices that cleaning accepts but no decimal of six places holds."""
    products, transactions = (raw(spark, folder, t) for t in ("products", "transactions"))
    known = transactions.join(products.select("product_id"), "product_id", "left_semi")
    prices = {
        "tiny": ("4e-7D", 1e-7),
        "huge": ("1e13D", 1e13),
        "mixed": ("CASE WHEN product_id % 2 = 0 THEN 4e-7D ELSE price END", 1.0),
    }
    totals = []
    for kind, (price, unit) in prices.items():
        daily = op.daily_sales(known, products.withColumn("price", F.expr(price)))
        total = F.round(F.col("total_sales") / unit, 3).alias("total")
        totals.append(daily.select(F.lit(kind).alias("kind"), "transaction_date", total))
    return _plain(totals[0].unionByName(totals[1]).unionByName(totals[2]))


@query
def csv_line_breaks(spark, folder):
    """Texts with line breaks of each kind, written as CSV and read again: a row stays a row."""
    users, path = raw(spark, folder, "users"), f"{scratch_folder(spark)}/users.csv"
    breaks = F.expr("element_at(array('\\n', '\\r', '\\r\\n', ' \\n\\n'), CAST(user_id % 4 AS INT) + 1)")
    sinks.write_csv(users.withColumn("address", F.concat("address", breaks, "name")), path)
    return _plain(sources.read_bronze(spark, path, "users"))


_SALES_ORDER = ["transaction_date", "transaction_id", "product_id", "user_id", "quantity"]


@query
def long_moving_average(spark, folder):
    """Each sale with the mean quantity of the last seven: a series as long as the fact."""
    sales = silver(spark, folder, "transactions")
    averaged = op.long_moving_average(sales, _SALES_ORDER, "quantity", scratch_folder(spark))
    return _rounded(_plain(averaged))


@query
def long_period_over_period(spark, folder):
    """Each sale beside the third one before it."""
    sales = silver(spark, folder, "transactions")
    compared = op.long_period_over_period(
        sales, _SALES_ORDER, "quantity", scratch_folder(spark), offset=3
    )
    return _rounded(_plain(compared))


@query
def long_fill_gaps(spark, folder):
    """A day per customer key, as a calendar with a gap at every key without an order."""
    orders = raw(spark, folder, "transactions").groupBy("user_id").agg(
        F.countDistinct("transaction_id").alias("orders")
    )
    days = orders.selectExpr(
        "date_add(DATE '1970-01-01', CAST(user_id AS INT)) AS day", "orders"
    )
    return _plain(op.long_fill_gaps(days, "day", ["orders"], scratch_folder(spark), block_rows=500))


# --- noise ------------------------------------------------------------------------------


@query
def inject_noise_users(spark, folder):
    return _plain(noisy(spark, folder, "users"))


@query
def inject_noise_products(spark, folder):
    return noisy(spark, folder, "products")


@query
def inject_noise_transactions(spark, folder):
    return _plain(noisy(spark, folder, "transactions"))


@query
def inject_noise_exact(spark, folder):
    users = raw(spark, folder, "users")
    return _plain(
        op.inject_noise(users, "user_id", level=EXACT_LEVEL, exact=True, today=NOISE_TODAY)
    )


# --- run metrics ------------------------------------------------------------------------


@query
def run_summary(spark, folder):
    return _rounded(op.summarise_runs(sources.retail_runs(spark, folder)))


@query
def stage_totals(spark, folder):
    return _rounded(op.stage_totals(sources.retail_runs(spark, folder)))


@query
def group_vs_baseline(spark, folder):
    summary = op.summarise_runs(sources.retail_runs(spark, folder))
    return _rounded(op.group_vs_baseline(summary, BASELINE))


@query
def layer_share(spark, folder):
    return _rounded(op.layer_share(op.summarise_runs(sources.retail_runs(spark, folder))))


@query
def group_distribution(spark, folder):
    return _rounded(op.group_distribution(sources.retail_runs(spark, folder)))


@query
def group_runs(spark, folder):
    return _rounded(op.group_runs(sources.retail_runs(spark, folder)))


# --- all layers -------------------------------------------------------------------------


@query
def medallion_end_to_end(spark, folder):
    base = scratch_folder(spark)
    for name, table in _noisy_tables(spark, folder):
        sinks.write_csv(table, f"{base}/bronze/{name}.csv")
    reports = run_medallion(spark, f"{base}/bronze", f"{base}/silver", f"{base}/gold")
    return reports["performance_analysis_by_country"]
