"""Run both layers under each tuning profile and compare them with the untuned one.

Prints the summary of the runs and the speed-ups; the rows behind them are written as run
metrics. ``python bench_profiles.py [profile ...]``, inputs as for ``bench.py``.
"""

from __future__ import annotations

import sys
import time

from bench import FOLDER, RUNS, session
from catalogue.queries import NOISE_KEYS
from pyspark.sql import DataFrame, SparkSession
from starmart.operators import (
    clean,
    enforce_fks,
    group_vs_baseline,
    inject_noise,
    layer_share,
    summarise_runs,
)
from starmart.operators.run_metrics import SUCCESS
from starmart.plans import PROFILES, REFERENCES, REPORTS, Profile, persisted, profile, scratch_folder
from starmart.sinks import write_csv, write_parquet, write_run_metrics
from starmart.sources import (
    TABLES,
    Star,
    conform,
    read_bronze,
    read_run_metrics,
    read_silver,
    retail_table,
)
from starmart.sources import RUNS as RUNS_SCHEMA


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def step(df: DataFrame, path: str, settings: Profile, partition_by: str | None, single: bool):
    """Seconds to compute the result, seconds to write it, its rows."""
    transform = timed(lambda: df.write.format("noop").mode("overwrite").save())
    write = timed(lambda: write_parquet(df, path, settings.compression, partition_by, single))
    return transform, write, df.sparkSession.read.parquet(path).count()


def run_layers(spark: SparkSession, settings: Profile, bronze: str, out: str):
    """Yield (stage, item, transform seconds, write seconds, rows)."""
    tables: dict[str, DataFrame] = {}
    for table, schema in TABLES.items():
        rows = clean(read_bronze(spark, f"{bronze}/{table}.csv", table), table)
        if table == "transactions":
            rows = enforce_fks(rows, {key: tables[dim] for key, dim in REFERENCES.items()})
        path, partition_by = f"{out}/silver/{table}", None
        if table == "products":
            partition_by = settings.partition_by
        yield "silver", table, *step(conform(rows, schema), path, settings, partition_by, False)
        tables[table] = read_silver(spark, path, schema)

    with persisted(*(tables.values() if settings.cache else ())):
        for table in tables.values():
            if settings.cache:
                table.count()
        for name, report in REPORTS.items():
            path = f"{out}/gold/{name}"
            result = report(*Star(**tables))
            yield "gold", name, *step(result, path, settings, None, settings.single_file)


def recorded(name: str, run: int, settings: Profile, steps) -> list[tuple]:
    """The steps of a run as rows; one that fails ends its run, is recorded and stops no other."""
    rows: list[tuple] = []
    try:
        for stage, item, transform, write, count in steps:
            rows.append(
                (name, run, stage, item, transform, write, count, SUCCESS, settings.description)
            )
    except Exception as error:
        print(f"{name}, run {run} failed: {error}", file=sys.stderr)
        stage = rows[-1][2] if rows else "silver"
        rows.append((name, run, stage, "failed", None, None, None, "failed", settings.description))
    return rows


def main(names: list[str]) -> None:
    spark = session()
    base = scratch_folder(spark)
    for table, key in NOISE_KEYS.items():
        noisy = inject_noise(retail_table(spark, FOLDER, table), key, level=0.03)
        write_csv(noisy, f"{base}/bronze/{table}.csv")

    list(run_layers(spark, PROFILES["baseline"], f"{base}/bronze", f"{base}/warm-up"))
    measured = []
    for name in names or PROFILES:
        with profile(spark, PROFILES[name]) as settings:
            for run in range(1, RUNS + 1):
                out = f"{base}/{name}_run{run}"
                measured += recorded(
                    name, run, settings, run_layers(spark, settings, f"{base}/bronze", out)
                )
    path = write_run_metrics(spark.createDataFrame(measured, RUNS_SCHEMA), base)
    summary = summarise_runs(read_run_metrics(spark, path))
    summary.drop("description").show(truncate=False)
    layer_share(summary).show(truncate=False)
    group_vs_baseline(summary, "baseline").show(truncate=False)
    print("run metrics:", path)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
