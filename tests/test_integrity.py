from datetime import date

import pytest
from fixtures import rows, shop

from starmart.operators import enforce_fk, enforce_fks, join_dimension, orphans

DAY = date(2025, 1, 9)
STRAY = [(101, 99, 1, 4, DAY), (102, 1, 999, 2, DAY), (103, 888, 777, 3, DAY)]
NO_KEY = (104, None, 1, 1, DAY)


def test_rows_with_unknown_keys_go(spark):
    users, products, sales = shop(spark, extra_sales=[*STRAY, NO_KEY])
    kept = enforce_fks(sales, {"user_id": users, "product_id": products})
    assert sorted(r.transaction_id for r in kept.collect()) == list(range(1, 29))
    assert kept.columns == sales.columns


def test_repeated_dimension_keys_do_not_multiply(spark):
    users, _, sales = shop(spark)
    assert enforce_fk(sales, users.unionAll(users), "user_id").count() == 28


def test_orphans_are_the_complement(spark):
    users, _, sales = shop(spark, extra_sales=[*STRAY, NO_KEY])
    assert sorted(r.transaction_id for r in orphans(sales, users, "user_id").collect()) == [
        101,
        103,
        104,
    ]
    kept = enforce_fk(sales, users, "user_id")
    assert kept.count() + orphans(sales, users, "user_id").count() == sales.count()


def test_the_dimension_key_may_have_another_name(spark):
    users, _, sales = shop(spark, extra_sales=STRAY)
    renamed = users.withColumnRenamed("user_id", "id")
    assert enforce_fk(sales, renamed, "user_id", "id").count() == 29


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_strategies_agree(spark, how):
    _, products, sales = shop(spark, extra_sales=STRAY)
    automatic = join_dimension(sales, products, "product_id", how)
    merged = join_dimension(sales, products, "product_id", how, sort_merge=True)
    assert sorted(map(repr, rows(automatic))) == sorted(map(repr, rows(merged)))
    assert "SortMergeJoin" in executed(merged)


def test_large_dimensions_are_not_broadcast(spark, conf):
    _, products, sales = shop(spark)
    assert "BroadcastHashJoin" in executed(join_dimension(sales, products, "product_id"))
    conf(autoBroadcastJoinThreshold="-1")
    assert "Broadcast" not in executed(join_dimension(sales, products, "product_id"))


def test_a_hot_key_is_split(spark, conf):
    """A third of the fact under one key: the join reads that partition in several tasks."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__parallelismFirst="false",
    )
    fact = spark.range(0, 60_000, 1, 8).selectExpr(
        "id AS transaction_id", "if(id % 3 = 0, 1, id % 5000) AS user_id"
    )
    users = spark.range(1, 4000).selectExpr("id AS user_id", "cast(id AS string) AS name")
    expected = fact.where("user_id BETWEEN 1 AND 3999").count()
    for result in (enforce_fk(fact, users, "user_id"), join_dimension(fact, users, "user_id")):
        assert result.count() == expected
        plan = executed(result)
        assert "SortMergeJoin(skew=true)" in plan
