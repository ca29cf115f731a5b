from datetime import date

import pytest
from fixtures import TEXT_DATED_TRANSACTIONS, TEXT_DATED_USERS
from pyspark.sql import types as T

from starmart.operators import clean, key_columns, quality_report, row_counts
from starmart.sources import PRODUCTS, TRANSACTIONS, USERS

GOOD_USER = (7, "Ada", "ada@example.com", "UK", "1 High St", "2023-01-15")
GOOD_PRODUCT = (7, "Lamp", "Home", "A lamp", 19.5)
GOOD_SALE = (7, 1, 10, 2, "2025-01-01")


def variants(row, position, values):
    return [row[:position] + (value,) + row[position + 1 :] for value in values]


def survivors(spark, schema, table, bad_rows, good):
    df = spark.createDataFrame([*bad_rows, good], schema)
    return [tuple(r) for r in clean(df, table).collect()]


@pytest.mark.parametrize(
    "position, bad",
    [
        (0, [None, 0, -1, -99]),
        (1, [None, ""]),
        (2, [None, "", "invalid_email", "user_at_example.com"]),
        (3, [None, ""]),
        (4, [None, ""]),
        (5, [None, "", "1899-01-01", "1500-12-31", "invalid-date", "2000-01-01"]),
    ],
)
def test_bad_users_are_dropped(spark, position, bad):
    bad_rows = variants(GOOD_USER, position, bad)
    assert survivors(spark, TEXT_DATED_USERS, "users", bad_rows, GOOD_USER) == [GOOD_USER]


@pytest.mark.parametrize(
    "position, bad",
    [
        (0, [None, 0, -1, -99]),
        (1, [None, ""]),
        (2, [None, ""]),
        (3, [None, ""]),
        (4, [None, -10.0, 0.0, -99.0, float("nan")]),
    ],
)
def test_bad_products_are_dropped(spark, position, bad):
    bad_rows = variants(GOOD_PRODUCT, position, bad)
    assert survivors(spark, PRODUCTS, "products", bad_rows, GOOD_PRODUCT) == [GOOD_PRODUCT]


@pytest.mark.parametrize(
    "position, bad",
    [
        (0, [None, 0, -1, -99]),
        (1, [None, 0, -1]),
        (2, [None, 0, -99]),
        (3, [None, 0, -1, -99]),
        (4, [None, "", "1899-01-01", "1500-12-31", "invalid-date", "2000-01-01"]),
    ],
)
def test_bad_transactions_are_dropped(spark, position, bad):
    bad_rows = variants(GOOD_SALE, position, bad)
    kept = survivors(spark, TEXT_DATED_TRANSACTIONS, "transactions", bad_rows, GOOD_SALE)
    assert kept == [GOOD_SALE]


def test_good_rows_stay_as_they_are(spark):
    # The first day after the limit, blanks as text and repeated rows are all fine.
    sale = GOOD_SALE[:4] + ("2000-01-02",)
    df = spark.createDataFrame([sale, sale], TEXT_DATED_TRANSACTIONS)
    assert [tuple(r) for r in clean(df, "transactions").collect()] == [sale, sale]
    blank = GOOD_USER[:1] + (" ",) + GOOD_USER[2:]
    df = spark.createDataFrame([blank], TEXT_DATED_USERS)
    assert clean(df, "users").count() == 1


def test_dates_may_be_typed_already(spark):
    sales = [GOOD_SALE[:4] + (day,) for day in (date(1999, 1, 1), date(2020, 1, 1), None)]
    df = spark.createDataFrame(sales, TRANSACTIONS)
    assert [r.transaction_date for r in clean(df, "transactions").collect()] == [date(2020, 1, 1)]


def test_keys_may_be_floating_point(spark):
    schema = T.StructType(
        [T.StructField(f.name, T.DoubleType() if i < 3 else f.dataType)
         for i, f in enumerate(TEXT_DATED_TRANSACTIONS)]
    )
    bad = [(float("nan"), 1.0, 10.0, 2, "2025-01-01"), (None, 1.0, 10.0, 2, "2025-01-01")]
    df = spark.createDataFrame([(7.0, 1.0, 10.0, 2, "2025-01-01"), *bad], schema)
    assert [r.transaction_id for r in clean(df, "transactions").collect()] == [7.0]


def test_unknown_table_gets_the_key_rules_only(spark):
    df = spark.createDataFrame([(1, ""), (0, "x"), (None, "y")], "x_id_old int, name string")
    assert key_columns(df) == ["x_id_old"]
    assert [tuple(r) for r in clean(df, "other").collect()] == [(1, "")]
    assert clean(spark.createDataFrame([(None,)], "name string"), "other").count() == 1


def test_report_counts_a_row_under_each_rule_it_fails(spark):
    bad = [(None, "", "Home", "x", 1.0), (0, "Lamp", "Home", "x", -1.0)]
    df = spark.createDataFrame([GOOD_PRODUCT, *bad], PRODUCTS)
    report = {r.rule: tuple(r)[1:] for r in quality_report(df, "products").collect()}
    assert report["product_id_known"] == (1, 3, 1, 2)
    assert report["product_id_positive"] == (2, 3, 1, 2)
    assert report["price_positive"][0] == 1
    assert report["name_present"][0] == 1
    assert report["category_present"][0] == 0


def test_cleaning_is_one_filter_and_pushed_down(spark, conf, tmp_path):
    conf(maxMetadataStringLength="10000")
    df = spark.createDataFrame([GOOD_USER], TEXT_DATED_USERS)
    df.withColumn("signup_date", df.signup_date.cast("date")).write.parquet(str(tmp_path / "u"))
    users = clean(spark.read.schema(USERS).parquet(str(tmp_path / "u")), "users")
    plan = users._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Filter ") == 1 and "Exchange" not in physical
    assert "GreaterThan(user_id,0)" in physical and "GreaterThan(signup_date" in physical


def test_row_counts(spark):
    counts = row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert sorted(tuple(r) for r in counts.collect()) == [("a", 3), ("b", 0)]
