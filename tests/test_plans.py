"""The shapes that make the reports hold at scale, read from executed plans."""

import re

import pytest
from fixtures import rows, shop

import __spark_entry__ as contract
from starmart.operators import daily_sales, enforce_fks, inject_noise
from starmart.plans import REPORTS, SPLIT_HOT_KEYS, cluster_conf
from starmart.sinks import write_parquet
from starmart.sources import TABLES, Star, read_silver


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("silver"))
    for name, table in shop(spark)._asdict().items():
        write_parquet(table, f"{folder}/{name}")
    return Star(*[read_silver(spark, f"{folder}/{name}") for name in TABLES])


def planned(df):
    """The physical plan before execution."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", REPORTS)
def test_no_cross_join_and_no_python(star, name):
    plan = planned(REPORTS[name](*star))
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Pandas"):
        assert operator not in plan


@pytest.mark.parametrize("name", REPORTS)
def test_the_fact_is_read_once_and_pruned(star, conf, name):
    conf(maxMetadataStringLength="10000")
    result = REPORTS[name](*star)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "quantity" in s]
    assert len(scans) == 1
    users = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "user_id" in s]
    assert not any("address" in s or "email" in s for s in users)


@pytest.mark.parametrize("name", [name for name in REPORTS if name != "top_products_by_category"])
def test_the_fact_is_never_the_broadcast_side(star, name):
    """Not even here, where it is as small as the dimensions. (Products join sums per product.)"""
    plan = planned(REPORTS[name](*star))
    assert "BroadcastExchange" in plan
    for broadcast in plan.split("BroadcastExchange")[1:]:
        scan = re.search(r"FileScan parquet \[([^\]]*)\]", broadcast).group(1)
        assert "quantity" not in scan


def test_references_are_semi_joins_without_distinct(star):
    users, products, sales = star
    plan = planned(enforce_fks(sales, {"user_id": users, "product_id": products}))
    assert plan.count("LeftSemi") == 2 and "Aggregate" not in plan


def test_user_spend_is_reduced_before_the_users_join(star, conf):
    conf(autoBroadcastJoinThreshold="-1")
    plan = planned(REPORTS["top_spenders"](*star))
    assert "TakeOrderedAndProject" in plan
    # Fact by product, prices, spend by user, users: nothing is shuffled again after the join.
    assert plan.count("Exchange hashpartitioning") == 4


def test_reports_do_not_depend_on_broadcasting(star, conf):
    expected = {name: rows(report(*star)) for name, report in REPORTS.items()}
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    assert {name: rows(report(*star)) for name, report in REPORTS.items()} == expected


def test_a_hot_product_is_split_in_both_joins_on_it(spark, conf):
    """References and prices in one job: two joins on the same key, a third of it in one value."""
    small = {
        "autoBroadcastJoinThreshold": "-1",
        "adaptive__autoBroadcastJoinThreshold": "-1",
        "adaptive__skewJoin__skewedPartitionThresholdInBytes": "40KB",
        "adaptive__skewJoin__skewedPartitionFactor": "1.5",
        "adaptive__advisoryPartitionSizeInBytes": "40KB",
        "adaptive__coalescePartitions__parallelismFirst": "false",
    }
    conf(**small, **{k.removeprefix("spark.sql.").replace(".", "__"): v
                     for k, v in SPLIT_HOT_KEYS.items()})
    sales = spark.range(1, 90_001, 1, 12).selectExpr(
        "id AS transaction_id", "1 + id % 3000 AS user_id",
        "if(id % 3 = 0, 1, 1 + id % 5000) AS product_id", "cast(id % 7 AS int) AS quantity",
        "date_add(DATE '2025-01-01', cast(id % 50 AS int)) AS transaction_date",
    )
    products = spark.range(1, 5001).selectExpr("id AS product_id", "id / 4 AS price")
    result = daily_sales(enforce_fks(sales, {"product_id": products}), products)
    found = sum(r.total_sales for r in result.collect())
    expected = sales.join(products, "product_id").selectExpr("sum(quantity * price)").first()[0]
    assert float(found) == expected
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("SortMergeJoin(skew=true)") == 2


def test_cluster_settings_grow_with_the_shuffle():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert cluster_conf(0)[key] == "200"
    assert cluster_conf(20 * 2**40)[key] == "81920"


def test_countries_are_counted_in_one_tree_over_one_scan(star, conf):
    conf(autoBroadcastJoinThreshold="-1", maxMetadataStringLength="10000")
    result = REPORTS["performance_analysis_by_country"](*star)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Expand" not in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sum("transaction_id" in s for s in schemas) == 1
    # The users are joined once; a second, narrower scan lists the countries.
    assert sum("user_id" in s and "transaction_id" not in s for s in schemas) == 1
    assert plan.count("SortMergeJoin") == 2


def test_exact_noise_takes_three_scans(star):
    noisy = inject_noise(star.users, "user_id", level=0.3, exact=True)
    noisy.collect()
    plan = noisy._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet", plan)) <= 3


@pytest.mark.parametrize("name", ["top_spenders", "sink_gold_table", "fk_enforce_both"])
def test_queries_leave_the_session_as_it_was(spark, name):
    before = {r["key"]: r["value"] for r in spark.sql("SET").collect()}
    contract.queries()[name](spark, contract.SMOKE_FOLDER).count()
    assert {r["key"]: r["value"] for r in spark.sql("SET").collect()} == before
