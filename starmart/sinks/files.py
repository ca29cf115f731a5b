"""File sinks."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import quoted
from starmart.sinks.replace import replace_folder
from starmart.sources.files import CSV_DIALECT


def write_parquet(
    df: DataFrame,
    path: str,
    compression: str | None = "snappy",
    partition_by: str | None = None,
    single_file: bool = False,
    options: Mapping[str, str] | None = None,
) -> None:
    """Parquet with a codec; ``None`` leaves the session's default, for plain files name
    ``"uncompressed"``.

    ``partition_by`` is ignored if the table has no such column. Rows of a partition value
    are brought together before the write, in pieces of the session's advisory size: small
    values get one file each and a hot one is spread over many tasks.

    ``single_file`` is for ordered reports of bounded size: their last stage becomes one task.
    ``options`` are settings of the path's file system, see ``io_options``. What the path held is
    replaced once all tasks have committed, see ``replace_folder``.
    """
    if partition_by in df.columns:
        df = df.hint("rebalance", partition_by)
    elif partition_by is not None:
        partition_by = None
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode("overwrite").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if compression:
        writer = writer.option("compression", compression)
    replace_folder(df.sparkSession, path, writer.parquet, options)


def write_csv(df: DataFrame, path: str, options: Mapping[str, str] | None = None) -> None:
    """CSV with a header in each file, written by all tasks; NULL and "" are both empty.

    A line is a row, so that files can be split: line breaks in texts become blanks.
    """
    lines = [
        F.regexp_replace(quoted(field.name), r"\r\n|\r|\n", " ").alias(field.name)
        if isinstance(field.dataType, T.StringType)
        else F.col(quoted(field.name))
        for field in df.schema.fields
    ]
    writer = df.select(*lines).write.mode("overwrite").options(**(options or {}))
    replace_folder(df.sparkSession, path, writer.options(**CSV_DIALECT).csv, options)


def write_run_metrics(runs: DataFrame, folder: str, at: datetime | None = None) -> str:
    """JSON lines under a new name that carries the time; returns the path."""
    moment = at or datetime.now(timezone.utc)
    path = f"{folder.rstrip('/')}/runs_{moment:%Y%m%d_%H%M%S}_{uuid4().hex[:12]}"
    runs.write.mode("errorifexists").json(path)
    return path
