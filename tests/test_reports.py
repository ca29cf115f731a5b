from datetime import date
from pathlib import Path

import pytest
from fixtures import rows, shop, shop_rows
from pyspark.sql import functions as F

from starmart import plans
from starmart.operators import daily_sales, segment_performance, user_spend
from starmart.plans import REPORTS, run_sql_reports

# The shop's daily totals and the reports that follow from its sales.
DAILY = [80.0, 102.0, 391.0, 194.0, 190.0, 87.0, 167.0, 132.0]
CHANGES = [None, 27.5, 283.3333, -50.3836, -2.0619, -54.2105, 91.9540, -20.9581]
AVERAGES = [80.0, 91.0, 191.0, 191.75, 191.4, 174.0, 173.0, 180.428571]
SPENDERS = {1: 385.0, 4: 312.0, 2: 220.0, 3: 121.0, 6: 110.0, 7: 69.0, 8: 65.0, 5: 61.0}
COUNTRIES = [("USA", 605.0, 8, 2), ("Poland", 494.0, 13, 3), ("Germany", 179.0, 5, 2),
             ("France", 65.0, 2, 1)]
BEST = {
    "Category 1": [(2, 24), (3, 18), (1, 15), (9, 7)],
    "Category 2": [(5, 19), (4, 11), (6, 1), (10, 1)],
    "Category 3": [(7, 2), (8, 2)],
}


def report(name, star):
    return REPORTS[name](*star)


def test_top_spenders(spark):
    result = report("top_spenders", shop(spark))
    assert result.columns == ["user_id", "name", "total_spent"]
    assert [(r.user_id, r.total_spent) for r in result.collect()] == list(SPENDERS.items())


def test_top_spenders_keeps_ten_and_breaks_ties_by_id(spark):
    users = [(i, "x", "x@x", "USA", "x", date(2024, 1, 1)) for i in range(20, 40)]
    sales = [(i, i, 7, 5, date(2025, 1, 8)) for i in range(20, 40)]
    result = report("top_spenders", shop(spark, extra_users=users, extra_sales=sales)).collect()
    assert [r.user_id for r in result] == list(range(20, 30))


def test_top_spenders_ignores_unknown_users_and_products(spark):
    day = date(2025, 1, 8)
    star = shop(spark, extra_sales=[(90, 99, 7, 100, day), (91, 1, 99, 100, day)])
    totals = {r.user_id: r.total_spent for r in report("top_spenders", star).collect()}
    assert totals == SPENDERS


def test_top_products(spark):
    result = report("top_products_by_category", shop(spark))
    assert result.columns == ["category", "product_id", "name", "total_quantity_sold"]
    found = {}
    for category, product, _, sold in rows(result):
        found.setdefault(category, []).append((product, sold))
    assert found == BEST and list(found) == sorted(BEST)


def test_country_performance(spark):
    result = report("performance_analysis_by_country", shop(spark))
    assert result.columns == ["country", "total_sales", "total_transactions", "total_users"]
    assert rows(result) == COUNTRIES


def test_idle_country_shows_zeros_and_unknown_products_still_count(spark):
    users = [(9, "Ida", "i@x", "Norway", "x", date(2024, 1, 1)),
             (10, "Ole", "o@x", None, "x", date(2024, 1, 1))]
    star = shop(spark, extra_users=users, extra_sales=[(90, 8, 99, 3, date(2025, 1, 8))])
    found = {r[0]: tuple(r)[1:] for r in report("performance_analysis_by_country", star).collect()}
    assert found["Norway"] == (0.0, 0, 0) and found[None] == (0.0, 0, 0)
    assert found["France"] == (65.0, 3, 1)


def test_segments_may_be_any_user_column(spark):
    users, products, sales = shop(spark)
    found = segment_performance(users, sales, products, by="name").collect()
    assert {r.name: r.total_sales for r in found}["John"] == SPENDERS[1]


def test_repeated_rows_are_kept(spark):
    """Nothing is deduplicated: a sale that was loaded twice counts twice, its id once."""
    _, _, sales = shop_rows()
    star = shop(spark, extra_sales=sales)
    assert rows(report("performance_analysis_by_country", star))[0] == ("USA", 1210.0, 8, 2)
    users, products, _ = shop(spark)
    doubled = user_spend(shop(spark).transactions, users.unionAll(users), products)
    assert {r.user_id: r.total_spent for r in doubled.collect()}[1] == 2 * SPENDERS[1]


def test_day_to_day(spark):
    result = report("day_to_day_sales", shop(spark))
    assert result.columns == [
        "transaction_date", "total_sales", "previous_day_sales", "percent_change",
    ]
    found = rows(result)
    assert [r[0] for r in found] == [date(2025, 1, d) for d in range(1, 9)]
    assert [r[1] for r in found] == DAILY
    assert [r[2] for r in found] == [None, *DAILY[:-1]]
    assert [r[3] and round(r[3], 4) for r in found] == CHANGES


def test_moving_average(spark):
    result = report("sales_moving_average", shop(spark))
    assert result.columns == ["transaction_date", "total_sales", "moving_average_sales"]
    found = rows(result)
    assert [r[1] for r in found] == DAILY
    assert [round(r[2], 6) for r in found] == AVERAGES


def test_days_without_sales_are_zero(spark):
    star = shop(spark, extra_sales=[(90, 1, 1, 1, date(2025, 1, 11))])
    found = rows(report("day_to_day_sales", star))
    assert [r[1] for r in found[8:]] == [0.0, 0.0, 10.0]
    assert [r[3] for r in found[8:]] == [-100.0, None, None]


def test_a_day_of_unknown_products_is_in_the_series(spark):
    star = shop(spark, extra_sales=[(90, 1, 99, 1, date(2025, 1, 9))])
    assert rows(report("sales_moving_average", star))[-1][:2] == (date(2025, 1, 9), 0.0)


def test_text_dates_are_read(spark):
    _, products, sales = shop(spark)
    text = sales.withColumn("transaction_date", sales.transaction_date.cast("string"))
    assert sorted(float(r[1]) for r in daily_sales(text, products).collect()) == sorted(DAILY)


@pytest.mark.parametrize("name", REPORTS)
def test_no_transactions(spark, name):
    users, products, sales = shop(spark)
    result = REPORTS[name](users, products, sales.limit(0)).collect()
    if name == "performance_analysis_by_country":
        assert {tuple(r)[1:] for r in result} == {(0.0, 0, 0)} and len(result) == 4
    else:
        assert result == []


@pytest.mark.parametrize(
    "price, factor", [(4e-7, 4e-7), (1e13, 1e13), (float("inf"), float("inf")), (12.3456789, 12.3456789)]
)
def test_no_accepted_price_is_rounded_dropped_or_refused(spark, price, factor):
    star = shop(spark)
    priced = star.products.withColumn("price", F.lit(price))
    sold = star.transactions.groupBy("transaction_date").agg(F.sum("quantity").alias("n"))
    quantity = dict(sold.collect())
    found = dict(daily_sales(star.transactions, priced).collect())
    assert found == {day: pytest.approx(n * factor, rel=1e-12) for day, n in quantity.items()}
    for name in ("top_spenders", "performance_analysis_by_country", "sales_moving_average"):
        assert REPORTS[name](star.users, priced, star.transactions).collect()
    file = Path(plans.__file__).parent / "sql" / "top_spenders.sql"
    tables = {"users": star.users, "products": priced, "transactions": star.transactions}
    by_sql = run_sql_reports(spark, [file], **tables)["top_spenders"]
    totals = {r.user_id: r.total_spent for r in REPORTS["top_spenders"](**tables).collect()}
    assert {r.user_id: r.total_spent for r in by_sql.collect()} == pytest.approx(totals)


def test_odd_and_ordinary_prices_add_up(spark):
    star = shop(spark)
    odd = star.products.withColumn("price", F.expr("if(product_id = 5, 1e13, price)"))
    plain = star.products.withColumn("price", F.expr("if(product_id = 5, 0, price)"))
    only = star.products.withColumn("price", F.expr("if(product_id = 5, 1e13, 0)"))
    totals = [dict(daily_sales(star.transactions, p).collect()) for p in (odd, plain, only)]
    assert all(totals[0][day] == totals[1][day] + totals[2][day] for day in totals[0])
