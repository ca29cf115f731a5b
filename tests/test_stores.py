"""Paths on other file systems: session options by scheme, and layers behind another scheme."""

from uuid import uuid4

import pytest
from fixtures import rows, shop

from starmart.plans import run_medallion
from starmart.sinks import write_csv
from starmart.sources import Store, io_options, mount_conf, qualified, scheme_of, store_conf


def test_schemes():
    paths = ["s3a://b/x", "GS://b/x", "/data/x", "data:x", "file:/x", "viewfs://t/x"]
    assert [scheme_of(p) for p in paths] == ["s3a", "gs", "", "", "file", "viewfs"]


def test_a_local_job_needs_nothing():
    assert store_conf("/data/bronze", "file:///data/silver", "hdfs://n/x") == {}


def test_a_bucket_brings_connector_credentials_and_committer():
    conf = store_conf("gs://shop/bronze", "gs://shop/silver", key_file="/keys/shop.json")
    assert conf["spark.jars.packages"].count("gcs-connector") == 1
    assert conf["spark.hadoop.fs.gs.impl"].endswith("GoogleHadoopFileSystem")
    assert conf["spark.hadoop.google.cloud.auth.service.account.json.keyfile"] == "/keys/shop.json"
    assert "factory.scheme.gs" in " ".join(conf)
    assert "keyfile" not in " ".join(store_conf("gs://shop/bronze"))


def test_stores_add_up():
    conf = store_conf("gs://a/x", "s3a://b/y", "/z")
    assert conf["spark.hadoop.fs.s3a.committer.name"] == "magic"
    assert conf["spark.jars.packages"].count("spark-hadoop-cloud") == 1
    assert store_conf("oss://a/x", extra={"oss": Store(hadoop={"fs.oss.impl": "C"})}) == {
        "spark.hadoop.fs.oss.impl": "C"
    }


def test_an_unknown_scheme_fails_early():
    with pytest.raises(ValueError, match="ftp"):
        store_conf("ftp://host/x")


def test_io_options_are_the_file_system_settings():
    assert io_options({"spark.hadoop.fs.x": "1", "spark.sql.y": "2"}) == {"fs.x": "1"}


def test_all_layers_behind_another_scheme(spark, tmp_path):
    star = shop(spark)._asdict()
    for name, table in star.items():
        write_csv(table, f"{tmp_path}/bronze/{name}.csv")
    plain = run_medallion(spark, *[f"{tmp_path}/{x}" for x in ("bronze", "silver", "gold")])
    store = f"shop-{uuid4().hex}"
    links = {f"/{x}": qualified(spark, f"{tmp_path}/far/{x}") for x in ("bronze", "silver", "gold")}
    options = io_options(mount_conf(store, links))
    far = [f"viewfs://{store}{folder}" for folder in links]
    for name, table in star.items():
        write_csv(table, f"{far[0]}/{name}.csv", options)
    found = run_medallion(spark, *far, options=options)
    assert {n: rows(r) for n, r in found.items()} == {n: rows(r) for n, r in plain.items()}
    assert (tmp_path / "far/gold/top_spenders").is_dir()
    assert found["top_spenders"].inputFiles()[0].startswith("viewfs://")
    # Only those readers and writers know the store.
    with pytest.raises(Exception, match="Mount table"):
        spark.read.parquet(f"viewfs://other-{store}/silver/users").count()
