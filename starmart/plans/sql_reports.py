"""Reports given as SQL text."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


@contextmanager
def registered(spark: SparkSession, **tables: DataFrame) -> Iterator[None]:
    """The tables as temporary views inside the block."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)


def run_sql_reports(
    spark: SparkSession, files: Sequence[str | Path], **tables: DataFrame
) -> dict[str, DataFrame]:
    """The result of each SQL file over the tables, under the file's stem.

    A missing file is logged and left out; a query that fails stops the run. Results are
    resolved against the tables at once, so they stay valid after the views are gone.
    """
    results: dict[str, DataFrame] = {}
    with registered(spark, **tables):
        for file in map(Path, files):
            if not file.is_file():
                log.error("no such report: %s", file)
                continue
            results[file.stem] = spark.sql(file.read_text())
    return results
