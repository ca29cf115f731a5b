"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if it is missing; an existing one keeps its location."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def write_table(
    df: DataFrame,
    database: str,
    table: str,
    compression: str | None = "snappy",
    single_file: bool = False,
) -> str:
    """Replace ``database.table`` and return its quoted name.

    ``single_file`` is for ordered reports of bounded size: their last stage becomes one task.
    """
    name = f"`{database}`.`{table}`"
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode("overwrite").format("parquet")
    if compression:
        writer = writer.option("compression", compression)
    writer.saveAsTable(name)
    return name
