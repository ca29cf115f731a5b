"""Hot keys without any session option: found, split in both joins on them, results as before."""

import re

import pytest
from fixtures import rows, shop
from pyspark.sql import functions as F

from starmart.operators import (
    HotKeys,
    daily_sales,
    enforce_fks,
    find_hot_keys,
    join_dimension,
    orphans,
)
from starmart.operators.sales import _priced
from starmart.plans import REPORTS


@pytest.fixture
def hot_shop(spark):
    sales = spark.range(1, 90_001, 1, 12).selectExpr(
        "id AS transaction_id", "1 + id % 3000 AS user_id",
        "if(id % 3 = 0, 1, 1 + id % 5000) AS product_id", "cast(id % 7 AS int) AS quantity",
        "date_add(DATE '2025-01-01', cast(id % 50 AS int)) AS transaction_date",
    )
    products = spark.range(1, 5001).selectExpr(
        "id AS product_id", "'p' || id AS name", "'c' AS category", "'d' AS description",
        "id / 4 AS price",
    )
    users = spark.range(1, 3001).selectExpr("id AS user_id", "'u' AS name", "'x' AS country")
    return users, products, sales


def fixed(conf):
    """Shuffle joins that nothing splits or merges while the job runs."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__enabled="false",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="32",
    )


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_one_bounded_count_finds_them(spark, hot_shop):
    _, _, sales = hot_shop
    hot = find_hot_keys(sales, ["user_id", "product_id"], ["transaction_id"])
    assert hot.fans == {"user_id": {}, "product_id": {1: 22}}
    texts = sales.selectExpr("if(product_id = 1, 'a', CAST(product_id AS STRING)) AS k")
    assert find_hot_keys(texts, ["k"], []).fans == {"k": {"a": 22}}
    nothing = find_hot_keys(sales.where("false"), ["user_id"], [])
    assert nothing.fans == {"user_id": {}}
    nulls = sales.selectExpr("CAST(NULL AS BIGINT) AS user_id")
    assert find_hot_keys(nulls, ["user_id"], []).fans == {"user_id": {}}
    with pytest.raises(TypeError):
        find_hot_keys(sales.selectExpr("1.5D AS k"), ["k"], [])


def test_a_hot_product_is_split_in_both_joins_on_it(hot_shop, conf):
    fixed(conf)
    _, products, sales = hot_shop
    assert largest_share(enforce_fks(sales, {"product_id": products})) > 0.3
    hot = find_hot_keys(sales, ["product_id"], ["transaction_id", "user_id"])
    kept = enforce_fks(sales, {"product_id": products}, hot)
    priced = _priced(kept, products, "left", hot)
    assert largest_share(kept) < 0.1 and largest_share(priced) < 0.1
    result = daily_sales(kept, products, hot)
    found = sum(r.total_sales for r in result.collect())
    assert float(found) == sales.join(products, "product_id").selectExpr(
        "sum(quantity * price)"
    ).first()[0]
    # The second join finds the fact where the first one left it: one shuffle of it, one of each
    # dimension side, one of the daily sums.
    assert len(re.findall(r"Exchange hashpartitioning", plan_of(result))) == 4


@pytest.mark.parametrize("name", REPORTS)
def test_reports_are_the_same_with_hot_keys(spark, name):
    users, products, sales = shop(spark)
    keys = ["user_id", "product_id"]
    hot = find_hot_keys(sales, keys, ["transaction_id", *keys], pieces=8)
    assert hot.fans["user_id"] and hot.fans["product_id"]
    plain = enforce_fks(sales, {"user_id": users, "product_id": products})
    salted = enforce_fks(sales, {"user_id": users, "product_id": products}, hot)
    expected = rows(REPORTS[name](users, products, plain))
    assert rows(REPORTS[name](users, products, salted, hot=hot)) == expected


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_dimension_joins_are_the_same(spark, how):
    day = __import__("datetime").date(2025, 1, 9)
    _, products, sales = shop(spark, extra_sales=[(101, 1, 999, 4, day), (102, 1, None, 1, day)])
    hot = find_hot_keys(sales, ["product_id"], ["transaction_id"], pieces=8)
    plain = join_dimension(sales, products, "product_id", how)
    salted = join_dimension(sales, products, "product_id", how, hot=hot)
    assert salted.columns == plain.columns
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))


def test_outer_joins_from_the_dimension_are_refused(spark):
    _, products, sales = shop(spark)
    with pytest.raises(ValueError):
        join_dimension(sales, products, "product_id", "right", hot=HotKeys({"product_id": {1: 2}}))


def test_without_hot_values_the_plan_is_the_plain_one(spark):
    users, _, sales = shop(spark)
    plan = plan_of(enforce_fks(sales, {"user_id": users}, HotKeys({"user_id": {}})))
    assert "Generate" not in plan and "_salt" not in plan
    assert orphans(sales, users, "user_id").count() == 0
