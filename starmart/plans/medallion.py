"""The layer jobs: raw CSV to cleaned Parquet to reports."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from contextlib import ExitStack
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.operators import clean_and_count, enforce_fks, observed_report
from starmart.plans.reports import DAILY_REPORTS, REPORTS, daily_series
from starmart.plans.sql_reports import run_sql_reports
from starmart.plans.storage import persisted
from starmart.sinks import ensure_database, recover, write_parquet, write_table
from starmart.sources import TABLES, conform, read_bronze, read_silver

log = logging.getLogger(__name__)

# The fact's references, by key column.
REFERENCES = {"user_id": "users", "product_id": "products"}


class SilverTables(dict):
    """The silver tables by name; ``counts`` are those of each table's rules and writes."""

    def __init__(self) -> None:
        super().__init__()
        self.counts: dict[str, dict[str, int]] = {}

    def quality_report(self, spark: SparkSession) -> DataFrame:
        return observed_report(spark, self.counts)


def run_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    date_format: str | None = None,
    compression: str | None = "snappy",
    partition_products_by: str | None = None,
    options: Mapping[str, str] | None = None,
) -> SilverTables:
    """Clean ``{bronze}/{table}.csv`` into ``{silver}/{table}`` and return the silver tables.

    Dates are read as Spark casts text, or strictly in ``date_format``; silver holds dates.
    Dimensions are written before the fact and read back for its references: the raw files
    are parsed once, and a lost executor costs a re-read of small cleaned files. ``options``
    are settings of the file systems behind the paths, see ``io_options``.

    What the rules drop is counted while a table is written (see ``clean_and_count``), and so
    is what is written; each raw file is read once. A table is replaced when its write has succeeded: after a
    failure the layer holds the tables of this run up to there and the others as they were.
    """
    tables = SilverTables()
    for table, schema in TABLES.items():
        raw = read_bronze(spark, f"{bronze}/{table}.csv", table, date_format, options)
        cleaned, written = Observation(), Observation()
        rows = clean_and_count(raw, table, cleaned)
        if table == "transactions":
            rows = enforce_fks(rows, {key: tables[dim] for key, dim in REFERENCES.items()})
        path = f"{silver}/{table}"
        partition_by = partition_products_by if table == "products" else None
        rows = conform(rows, schema).observe(written, F.count(F.lit(1)).alias("rows_written"))
        write_parquet(rows, path, compression, partition_by, options=options)
        tables.counts[table] = {**cleaned.get, **written.get}
        tables[table] = read_silver(spark, path, schema, options)
        log.info("silver table written: %s", path)
    return tables


def run_gold(
    spark: SparkSession,
    silver: str,
    gold: str | None = None,
    database: str | None = None,
    location: str | None = None,
    reports: Iterable[str] = REPORTS,
    sql_files: Sequence[str | Path] = (),
    cache: bool = False,
    single_file: bool = False,
    compression: str | None = "snappy",
    schemas: Mapping[str, StructType] | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Compute reports over the silver tables and return them as written.

    They go to ``{gold}/{report}`` as Parquet or to tables of ``database`` (made at ``location``
    if it is missing): the named ``reports``, then those of ``sql_files`` under their stems.
    ``cache`` keeps the dimensions, which several reports read, and never the fact; the daily series, which two
    reports start from, is always computed once. Declare ``schemas`` of partitioned tables
    (see ``read_silver``). ``options`` are settings of the file systems behind the paths.
    """
    if (gold is None) == (database is None):
        raise ValueError("give either a gold folder or a database")
    declared = schemas or {}
    for name in TABLES:
        recover(spark, f"{silver}/{name}", options)
    tables = {
        name: read_silver(spark, f"{silver}/{name}", declared.get(name), options)
        for name in TABLES
    }
    if database:
        ensure_database(spark, database, location)

    def write(name: str, report: DataFrame) -> DataFrame:
        if database:
            return spark.table(write_table(report, database, name, compression, single_file))
        path = f"{gold}/{name}"
        write_parquet(report, path, compression, single_file=single_file, options=options)
        return read_silver(spark, path, options=options)

    names = list(reports)
    written: dict[str, DataFrame] = {}
    with ExitStack() as kept:
        if cache:
            dims = {name: tables[name] for name in REFERENCES.values()}
            tables.update(zip(dims, kept.enter_context(persisted(*dims.values()))))
        shared: dict[str, DataFrame] = {}
        if set(DAILY_REPORTS) <= set(names):
            # A row per day: keeping it saves the second report a pass over the fact.
            series = daily_series(tables["transactions"], tables["products"])
            shared["series"] = kept.enter_context(persisted(series))[0]
        for name in names:
            extra = shared if name in DAILY_REPORTS else {}
            written[name] = write(name, REPORTS[name](**tables, **extra))
            log.info("report written: %s", name)
        for name, report in run_sql_reports(spark, sql_files, **tables).items():
            written[name] = write(name, report)
            log.info("report written: %s", name)
    return written


def run_medallion(
    spark: SparkSession,
    bronze: str,
    silver: str,
    gold: str | None = None,
    *,
    date_format: str | None = None,
    compression: str | None = "snappy",
    partition_products_by: str | None = None,
    options: Mapping[str, str] | None = None,
    **gold_options,
) -> dict[str, DataFrame]:
    """Both layer jobs in order; the options are those of ``run_silver`` and ``run_gold``."""
    run_silver(spark, bronze, silver, date_format, compression, partition_products_by, options)
    gold_options = {"schemas": TABLES, "options": options, **gold_options}
    return run_gold(spark, silver, gold, compression=compression, **gold_options)
