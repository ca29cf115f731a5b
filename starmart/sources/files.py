"""Readers for the layers' files. A path may use any scheme Hadoop has a file system for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmart.functions import quoted, whole_number
from starmart.sources.schemas import RUNS, TABLES

# Quotes inside a field are doubled, as spreadsheet-style writers do.
CSV_DIALECT = {"header": True, "escape": '"'}


def read_bronze(
    spark: SparkSession,
    path: str,
    table: str,
    date_format: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw CSV of one table with its declared columns.

    The file is scanned as text and typed by expressions, so one bad cell becomes NULL and
    never costs the row; integers written as ``7.0`` stay integers. Dates stay text for the
    quality rules to judge, or are parsed here if ``date_format`` is given (NULL when bad).
    ``options`` are settings of the path's file system, see ``io_options``.
    """
    schema = TABLES[table]
    scanned = T.StructType(
        [
            T.StructField(
                f.name,
                T.DateType()
                if date_format and isinstance(f.dataType, T.DateType)
                else T.StringType(),
            )
            for f in schema.fields
        ]
    )
    reader = spark.read.schema(scanned).options(**CSV_DIALECT, enforceSchema=False)
    reader = reader.options(**(options or {}))
    if date_format:
        reader = reader.option("dateFormat", date_format)
    return reader.csv(path).selectExpr(
        *[f"{_typed(f.name, f.dataType)} AS {quoted(f.name)}" for f in schema.fields]
    )


def _typed(name: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegralType):
        return whole_number(name, dtype)
    if isinstance(dtype, T.DoubleType):
        return f"try_cast({quoted(name)} AS DOUBLE)"
    return quoted(name)


def read_silver(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A cleaned table.

    Parquet carries its own schema; pass one for a partitioned table, whose partition
    values would otherwise be guessed from directory names and moved to the end.
    """
    reader = spark.read.options(**(options or {}))
    if schema is None:
        return reader.parquet(path)
    return reader.schema(schema).parquet(path).select(*schema.fieldNames())


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).json(path)
