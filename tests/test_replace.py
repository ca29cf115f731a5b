"""Replacing layers: a failed write leaves the old rows, an interrupted one is made good."""

import pytest
from fixtures import rows, shop
from pyspark.sql import functions as F

from starmart.plans import run_gold, run_silver
from starmart.sinks import recover, write_csv, write_parquet


def _broken(df):
    """Fails in the task of the last rows, after others have been written."""
    return df.withColumn("name", F.expr("IF(user_id = 6, raise_error('planned'), name)"))


@pytest.fixture
def users(spark):
    return shop(spark).users.repartition(4, "user_id")


@pytest.mark.parametrize("by", [None, "country"])
def test_a_failed_write_leaves_the_old_rows(spark, users, tmp_path, by):
    path = str(tmp_path / "users")
    write_parquet(users, path, partition_by=by)
    before = sorted(map(repr, rows(spark.read.parquet(path))))
    with pytest.raises(Exception, match="planned"):
        write_parquet(_broken(users), path, partition_by=by)
    assert sorted(map(repr, rows(spark.read.parquet(path)))) == before
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["users"]


def test_a_table_may_be_replaced_by_its_own_rows(spark, users, tmp_path):
    path = str(tmp_path / "users")
    write_parquet(users, path)
    write_parquet(spark.read.parquet(path).where("user_id > 2"), path)
    assert spark.read.parquet(path).where("user_id <= 2").count() == 0


def test_an_exchange_that_was_interrupted_is_made_good(spark, users, tmp_path):
    path = tmp_path / "users"
    write_parquet(users, str(path))
    path.rename(tmp_path / ".users.replaced.abc")
    assert recover(spark, str(path)) and not recover(spark, str(path))
    assert spark.read.parquet(str(path)).count() == users.count()
    path.rename(tmp_path / ".users.replaced.abc")
    write_parquet(users.limit(1), str(path))
    assert spark.read.parquet(str(path)).count() == 1


def test_a_failed_silver_job_leaves_a_layer_that_gold_can_read(spark, tmp_path):
    for name, table in shop(spark)._asdict().items():
        write_csv(table, f"{tmp_path}/bronze/{name}.csv")
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    run_silver(spark, bronze, silver)
    before = rows(run_gold(spark, silver, f"{tmp_path}/gold")["top_spenders"])
    (tmp_path / "bronze/transactions.csv").rename(tmp_path / "elsewhere")
    with pytest.raises(Exception, match="transactions.csv"):
        run_silver(spark, bronze, silver)
    (tmp_path / "silver/users").rename(tmp_path / "silver/.users.replaced.abc")
    assert rows(run_gold(spark, silver, f"{tmp_path}/gold")["top_spenders"]) == before
