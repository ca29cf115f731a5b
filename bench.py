"""Time the layer jobs and the registered reports; prints one JSON line.

The silver and gold figures follow the published baseline: mean of three runs in a warm JVM,
transformation time only. Every result is produced in full (the ``noop`` sink), not
counted, since a count lets the optimizer leave out most of a report.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from catalogue.queries import NOISE_KEYS, QUERIES
from starmart.operators import clean, enforce_fks, inject_noise
from starmart.plans import REFERENCES, REPORTS, run_silver, scratch_folder
from starmart.sinks import write_csv
from starmart.sources import TABLES, Star, conform, read_bronze, read_silver, retail_table

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UPS, RUNS = 2, 3
SMALL_DIMENSION, SMALL_FACT = 10_000, 18_000

# Registered queries timed from the supplied tables, cleaning included.
FROM_RAW = [
    "top_spenders",
    "top_n_per_group",
    "country_performance",
    "day_to_day_sales",
    "sales_moving_average",
    "clean_transactions",
    "fk_enforce_both",
    "quality_report",
    "inject_noise_transactions",
    "join_sort_merge",
    "run_summary",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("starmart-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(build) -> float:
    """Time to build, plan and run a query once."""
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def means(jobs: dict) -> dict[str, float]:
    """Mean seconds per job, over passes through all of them."""
    passes = [{name: seconds(job) for name, job in jobs.items()} for _ in range(WARM_UPS + RUNS)]
    return {name: round(sum(p[name] for p in passes[WARM_UPS:]) / RUNS, 3) for name in jobs}


def silver_jobs(spark: SparkSession, bronze: str) -> dict:
    def cleaned(table: str) -> DataFrame:
        path = f"{bronze}/{table}.csv"
        return conform(clean(read_bronze(spark, path, table), table), TABLES[table])

    def transactions() -> DataFrame:
        return enforce_fks(
            cleaned("transactions"), {key: cleaned(dim) for key, dim in REFERENCES.items()}
        )

    return {
        "silver_users": lambda: cleaned("users"),
        "silver_products": lambda: cleaned("products"),
        "silver_transactions": transactions,
    }


def counted(build) -> float:
    start = time.perf_counter()
    build().count()
    return time.perf_counter() - start


def like_for_like(spark: SparkSession) -> dict[str, float]:
    """Both layers at the size and by the method of the published figures: 10,000 users and
    products and 18,000 transactions in cached tables, timed by a count and in full."""
    users = retail_table(spark, FOLDER, "users").where(f"user_id <= {SMALL_DIMENSION}")
    products = retail_table(spark, FOLDER, "products").where(f"product_id <= {SMALL_DIMENSION}")
    sales = (
        retail_table(spark, FOLDER, "transactions")
        .where(f"user_id <= {SMALL_DIMENSION} AND product_id <= {SMALL_DIMENSION}")
        .orderBy("transaction_id", "product_id")
        .limit(SMALL_FACT)
    )
    raw = Star(users.cache(), products.cache(), sales.cache())
    cleaned = {name: clean(table, name) for name, table in raw._asdict().items()}
    references = {key: cleaned[dim] for key, dim in REFERENCES.items()}
    cleaned["transactions"] = enforce_fks(cleaned["transactions"], references)
    silver = Star(**cleaned)
    jobs = {
        "silver": (raw, [lambda table=table: table for table in silver]),
        "gold": (silver, [lambda report=report: report(*silver) for report in REPORTS.values()]),
    }
    found = {}
    for layer, (inputs, steps) in jobs.items():  # silver before its tables are cached
        for table in inputs:
            table.cache().count()
        for how, timer in (("count", counted), ("in_full", seconds)):
            passes = [sum(map(timer, steps)) for _ in range(WARM_UPS + RUNS)]
            found[f"{layer}_{how}"] = round(sum(passes[WARM_UPS:]) / RUNS, 3)
    for table in (*raw, *silver):
        table.unpersist()
    return found


def main() -> None:
    spark = session()
    base = scratch_folder(spark)
    bronze, silver = f"{base}/bronze", f"{base}/silver"
    for table, key in NOISE_KEYS.items():
        noisy = inject_noise(retail_table(spark, FOLDER, table), key, level=0.03)
        write_csv(noisy, f"{bronze}/{table}.csv")
    run_silver(spark, bronze, silver)

    jobs = silver_jobs(spark, bronze)
    star = Star(*[read_silver(spark, f"{silver}/{table}") for table in TABLES])
    for name, report in REPORTS.items():
        jobs[f"gold_{name}"] = lambda report=report: report(*star)
    for name in FROM_RAW:
        jobs[name] = lambda name=name: QUERIES[name](spark, FOLDER)

    found = means(jobs)
    stages = {
        stage: round(sum(s for name, s in found.items() if name.startswith(stage)), 3)
        for stage in ("silver_", "gold_")
    }
    print(
        json.dumps(
            {
                "metric": "silver and gold transformation time, mean of 3 runs",
                "value": round(sum(stages.values()), 3),
                "unit": "sec",
                "silver": stages["silver_"],
                "gold": stages["gold_"],
                "baseline_size": like_for_like(spark),
                "queries": found,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
