"""Object stores and other file systems behind paths: what a session needs to reach them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.parse import urlsplit

import pyspark
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Store:
    """What Spark lacks for a scheme: Maven packages, the file system's class, where a key file is
    named, and how tasks commit files without renaming them one by one."""

    packages: tuple[str, ...] = ()
    hadoop: Mapping[str, str] = field(default_factory=dict)
    key_file: Mapping[str, str] = field(default_factory=dict)
    committer: Mapping[str, str] = field(default_factory=dict)


_CLOUD_COMMITS = {
    "spark.sql.sources.commitProtocolClass": (
        "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol"
    ),
    "spark.sql.parquet.output.committer.class": (
        "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter"
    ),
}
_MANIFEST = "org.apache.hadoop.mapreduce.lib.output.committer.manifest.ManifestCommitterFactory"
_SPARK_CLOUD = f"org.apache.spark:spark-hadoop-cloud_2.13:{pyspark.__version__}"

# Published connectors and their settings, by scheme. ``{key_file}`` is filled in.
STORES: dict[str, Store] = {
    "gs": Store(
        packages=("com.google.cloud.bigdataoss:gcs-connector:hadoop3-2.2.5", _SPARK_CLOUD),
        hadoop={"fs.gs.impl": "com.google.cloud.hadoop.fs.gcs.GoogleHadoopFileSystem"},
        key_file={
            "google.cloud.auth.service.account.enable": "true",
            "google.cloud.auth.service.account.json.keyfile": "{key_file}",
        },
        committer={
            "spark.hadoop.mapreduce.outputcommitter.factory.scheme.gs": _MANIFEST,
            **_CLOUD_COMMITS,
        },
    ),
    "s3a": Store(
        packages=(_SPARK_CLOUD,),
        hadoop={"fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"},
        key_file={"fs.s3a.security.credential.provider.path": "{key_file}"},
        committer={"spark.hadoop.fs.s3a.committer.name": "magic", **_CLOUD_COMMITS},
    ),
    "abfss": Store(
        packages=(_SPARK_CLOUD,),
        hadoop={"fs.abfss.impl": "org.apache.hadoop.fs.azurebfs.SecureAzureBlobFileSystem"},
        key_file={"hadoop.security.credential.provider.path": "{key_file}"},
        committer={
            "spark.hadoop.mapreduce.outputcommitter.factory.scheme.abfss": _MANIFEST,
            **_CLOUD_COMMITS,
        },
    ),
    # Part of Hadoop, with atomic renames: nothing to add.
    "file": Store(),
    "hdfs": Store(),
    "viewfs": Store(),
}


def scheme_of(path: str) -> str:
    """The scheme of a path; empty for one on the session's default file system."""
    scheme = urlsplit(path).scheme
    return scheme.lower() if "://" in path or path.startswith("file:") else ""


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the session's default file system, if it has none."""
    hadoop = spark._jsc.hadoopConfiguration()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(hadoop).makeQualified(where).toString()


def store_conf(
    *paths: str, key_file: str | None = None, extra: Mapping[str, Store] | None = None
) -> dict[str, str]:
    """Options for the builder of a session that reads and writes ``paths``.

    Connector packages, file system classes, credentials from ``key_file`` (without one, those
    that the machine provides) and committers that suit a store without atomic renames.
    Paths of different stores add up; two that need different commit protocols do not occur
    among ``STORES``. ``extra`` adds or replaces stores. An unknown scheme is an error here rather
    than in a task.
    """
    stores = {**STORES, **(extra or {})}
    conf: dict[str, str] = {}
    packages: dict[str, None] = {}
    for scheme in dict.fromkeys(map(scheme_of, paths)):
        if not scheme:
            continue
        if scheme not in stores:
            raise ValueError(f"no connector known for {scheme}://; known: {', '.join(stores)}")
        store = stores[scheme]
        packages.update(dict.fromkeys(store.packages))
        settings = {**store.hadoop, **(store.key_file if key_file else {})}
        for name, value in settings.items():
            conf[f"spark.hadoop.{name}"] = value.format(key_file=key_file)
        conf.update(store.committer)
    if packages:
        conf["spark.jars.packages"] = ",".join(packages)
    return conf


def io_options(conf: Mapping[str, str]) -> dict[str, str]:
    """The file system settings among session options, as options of one reader or writer.

    They reach the driver and all tasks of that read or write; the session stays as it is.
    """
    prefix = "spark.hadoop."
    return {name.removeprefix(prefix): v for name, v in conf.items() if name.startswith(prefix)}


def mount_conf(table: str, links: Mapping[str, str]) -> dict[str, str]:
    """Session options under which ``viewfs://{table}{folder}`` is the target of each link.

    One name for layers that lie in different stores.
    """
    return {
        f"spark.hadoop.fs.viewfs.mounttable.{table}.link.{folder}": target
        for folder, target in links.items()
    }
