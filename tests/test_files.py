from datetime import date, datetime
from pathlib import Path

import pytest
from fixtures import TEXT_DATED_USERS, rows, shop
from pyspark.sql.utils import AnalysisException

from starmart.plans import registered, run_sql_reports, scratch_folder
from starmart.sinks import (
    ensure_database,
    write_csv,
    write_parquet,
    write_run_metrics,
    write_table,
)
from starmart.sources import PRODUCTS, RUNS, USERS, read_bronze, read_run_metrics, read_silver


def write(path: Path, text: str) -> str:
    path.write_text(text)
    return str(path)


def test_bronze_survives_foreign_habits(spark, tmp_path):
    """Keys as floats, empty cells, doubled quotes, bad numbers, rows cut short."""
    path = write(
        tmp_path / "transactions.csv",
        "transaction_id,user_id,product_id,quantity,transaction_date\n"
        "1.0,2,3.0,4.0,2024-05-06\n"
        "2,,3,x,not-a-date\n"
        "3,2.5,1e3,-99.0,\n"
        "4,9\n",
    )
    assert rows(read_bronze(spark, path, "transactions")) == [
        (1, 2, 3, 4, "2024-05-06"),
        (2, None, 3, None, "not-a-date"),
        (3, None, 1000, -99, None),
        (4, 9, None, None, None),
    ]
    typed = read_bronze(spark, path, "transactions", date_format="yyyy-MM-dd")
    assert [r.transaction_date for r in typed.collect()] == [date(2024, 5, 6), None, None, None]
    assert dict(typed.dtypes) == {
        "transaction_id": "bigint", "user_id": "bigint", "product_id": "bigint",
        "quantity": "int", "transaction_date": "date",
    }


def test_bronze_text_and_prices(spark, tmp_path):
    path = write(
        tmp_path / "products.csv",
        'product_id,name,category,description,price\n1,"The ""big"" one, red",Home,"a\\b",19.99\n',
    )
    assert rows(read_bronze(spark, path, "products")) == [
        (1, 'The "big" one, red', "Home", "a\\b", 19.99)
    ]


def test_bronze_columns_must_match_the_header(spark, tmp_path):
    path = write(tmp_path / "p.csv", "product_id,category,name,description,price\n1,a,b,c,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_bronze(spark, path, "products").collect()


def test_csv_round_trip(spark, tmp_path):
    users = [(1, 'An "odd", name', "a@b", "UK", "x\\y", "2024-01-01"),
             (None, None, "a@b", "", "z", "bad")]
    write_csv(spark.createDataFrame(users, TEXT_DATED_USERS), str(tmp_path / "users.csv"))
    read = read_bronze(spark, str(tmp_path / "users.csv"), "users")
    assert sorted(rows(read), key=repr) == sorted(
        [users[0], (None, None, "a@b", None, "z", "bad")], key=repr
    )


def data_files(path):
    return [f for f in Path(path).rglob("*.parquet")]


def test_parquet_round_trip_keeps_schema_and_replaces(spark, tmp_path):
    users = shop(spark).users
    path = str(tmp_path / "users")
    write_parquet(users, path)
    write_parquet(users, path)
    read = read_silver(spark, path)
    assert sorted(rows(read)) == sorted(rows(users)) and read.schema == users.schema


@pytest.mark.parametrize(
    "codec, mark", [("snappy", ".snappy."), ("uncompressed", ""), (None, ".snappy."), ("gzip", ".gz.")]
)
def test_codec(spark, tmp_path, codec, mark):
    write_parquet(shop(spark).users, str(tmp_path / "u"), compression=codec)
    files = data_files(tmp_path / "u")
    assert files and all(mark in f.name for f in files)
    assert mark or not any(".snappy." in f.name for f in files)


def test_partitioned_products(spark, tmp_path, conf):
    conf(maxMetadataStringLength="10000")
    products = shop(spark).products.replace({"Category 1": "001"}, subset=["category"])
    path = str(tmp_path / "products")
    write_parquet(products, path, partition_by="category")
    assert {p.name for p in Path(path).glob("category=*")} == {
        "category=001", "category=Category 2", "category=Category 3",
    }
    read = read_silver(spark, path, PRODUCTS)
    assert read.columns == products.columns
    assert sorted(rows(read)) == sorted(rows(products))
    pruned = read.where("category = '001'")
    assert pruned.count() == 4
    plan = pruned._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(category" in plan


def test_partition_column_is_optional(spark, tmp_path):
    write_parquet(shop(spark).users, str(tmp_path / "u"), partition_by="category")
    assert read_silver(spark, str(tmp_path / "u")).count() == 8


def test_a_hot_partition_value_is_written_by_many_tasks(spark, tmp_path, conf):
    conf(adaptive__advisoryPartitionSizeInBytes="100KB")
    df = spark.range(0, 200_000, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, 'hot', string(id % 5)) AS category", "uuid() AS text"
    )
    write_parquet(df, str(tmp_path / "t"), partition_by="category")
    assert len(data_files(tmp_path / "t" / "category=hot")) > 5
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_single_file(spark, tmp_path):
    report = spark.range(0, 1000, 1, 8).orderBy("id")
    write_parquet(report, str(tmp_path / "r"), single_file=True)
    assert len(data_files(tmp_path / "r")) == 1
    assert [r.id for r in read_silver(spark, str(tmp_path / "r")).collect()] == list(range(1000))


def test_tables(spark, tmp_path):
    location = str(tmp_path / "gold db")
    ensure_database(spark, "gold_test", location)
    ensure_database(spark, "gold_test")
    try:
        name = write_table(shop(spark).users, "gold_test", "users")
        write_table(shop(spark).users.limit(3), "gold_test", "users", single_file=True)
        assert spark.table(name).count() == 3
        assert data_files(location)
    finally:
        spark.sql("DROP DATABASE gold_test CASCADE")


def test_run_metrics_round_trip(spark, tmp_path):
    runs = spark.createDataFrame(
        [("a", 1, "gold", "r", 0.1, 0.2, 3, "success", "d"),
         ("b", 2, "gold", "r", None, None, None, "failed", None)], RUNS
    )
    path = write_run_metrics(runs, str(tmp_path), at=datetime(2025, 1, 2, 3, 4, 5))
    assert "/runs_20250102_030405_" in path
    assert sorted(rows(read_run_metrics(spark, path)), key=repr) == sorted(rows(runs), key=repr)


def test_sql_reports(spark, tmp_path, caplog):
    count = write(tmp_path / "count.sql", "SELECT count(*) AS n FROM users")
    missing = tmp_path / "missing.sql"
    results = run_sql_reports(spark, [count, missing], users=shop(spark).users)
    assert list(results) == ["count"] and "missing.sql" in caplog.text
    # The view is gone, the result still runs.
    assert not spark.catalog.tableExists("users")
    assert rows(results["count"]) == [(8,)]


def test_sql_reports_stop_at_a_bad_query(spark, tmp_path):
    bad = write(tmp_path / "bad.sql", "SELECT nothing FROM nowhere")
    with pytest.raises(AnalysisException):
        run_sql_reports(spark, [bad], users=shop(spark).users)
    assert not spark.catalog.tableExists("users")


def test_registered_views(spark):
    with registered(spark, users=shop(spark).users):
        assert spark.sql("SELECT * FROM users").count() == 8
    assert not spark.catalog.tableExists("users")


def test_scratch_is_shared_and_new(spark, conf):
    one, two = scratch_folder(spark), scratch_folder(spark)
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("master", ["local[2]", "spark://host:7077"])
def test_scratch_without_a_checkpoint_folder_lies_in_the_warehouse(master):
    class Conf:
        values = {"spark.master": master, "spark.sql.warehouse.dir": "hdfs://shared/warehouse/"}

        def get(self, key, *default):
            return self.values.get(key, *default)

    class Session:
        conf = Conf()

    assert scratch_folder(Session()).startswith("hdfs://shared/warehouse/_scratch/")


def test_a_row_with_line_breaks_stays_a_row(spark, tmp_path):
    texts = ["two\nlines", "an\rold one", "a\r\nforeign one", 'quoted "\n" break', "plain"]
    users = spark.createDataFrame(
        [(i, text, "a@b", "USA", text, date(2024, 1, 1)) for i, text in enumerate(texts, 1)],
        USERS,
    )
    write_csv(users, f"{tmp_path}/users.csv")
    found = {r.user_id: r.address for r in read_bronze(spark, f"{tmp_path}/users.csv", "users").collect()}
    blank = [t.replace("\r\n", " ").replace("\n", " ").replace("\r", " ") for t in texts]
    assert found == dict(enumerate(blank, 1))


def test_runs_written_in_the_same_second_are_kept(spark, tmp_path):
    runs = spark.createDataFrame([("a", 1, "gold", "r", 0.1, None, 3, "success", "d")], RUNS)
    moment = datetime(2025, 1, 2, 3, 4, 5)
    paths = {write_run_metrics(runs, str(tmp_path), at=moment) for _ in range(2)}
    assert [read_run_metrics(spark, path).count() for path in paths] == [1, 1]
