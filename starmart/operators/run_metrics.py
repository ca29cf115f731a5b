"""Statistics over timed runs: flat rows of one timed step each, see ``RUNS``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import SECONDS, exact_total, over, quoted

SUCCESS = "success"
STAGES = ("silver", "gold")


def _mean(col: str) -> Column:
    return F.expr(exact_total(quoted(col), SECONDS)) / F.count(col)


def stage_totals(runs: DataFrame) -> DataFrame:
    """One row per run: seconds spent transforming and writing, by stage and in total.

    A run succeeded if all of its steps did.
    """
    sums = []
    for measure in ("transform_s", "write_s"):
        for stage in STAGES:
            here = f"CASE WHEN stage = '{stage}' THEN {measure} END"
            seconds = f"coalesce({exact_total(here, SECONDS)}, 0D)"
            sums.append(F.expr(seconds).alias(f"{stage}_{measure}"))
        sums.append(F.expr(exact_total(measure, SECONDS)).alias(f"total_{measure}"))
    # Each measure is totalled by itself: a step may lack one of them.
    transform, write = (exact_total(measure, SECONDS) for measure in ("transform_s", "write_s"))
    total = f"coalesce({transform} + {write}, {transform}, {write})"
    return runs.groupBy("experiment", "run").agg(
        *sums,
        F.expr(total).alias("total_s"),
        F.bool_and(F.col("status") == SUCCESS).alias("succeeded"),
        F.min("description").alias("description"),
    )


def _successful(runs: DataFrame) -> DataFrame:
    return stage_totals(runs).where("succeeded")


def summarise_runs(runs: DataFrame) -> DataFrame:
    """One row per experiment with a successful run, fastest first."""
    return (
        _successful(runs)
        .groupBy("experiment")
        .agg(
            F.min("description").alias("description"),
            F.count("*").alias("successful_runs"),
            _mean("silver_transform_s").alias("avg_silver_s"),
            _mean("gold_transform_s").alias("avg_gold_s"),
            _mean("total_transform_s").alias("avg_total_s"),
            _mean("total_write_s").alias("avg_write_s"),
            F.min("total_transform_s").alias("min_total_s"),
            F.max("total_transform_s").alias("max_total_s"),
            F.stddev_pop("total_transform_s").alias("std_total_s"),
        )
        .orderBy("avg_total_s", "experiment")
    )


def group_vs_baseline(summary: DataFrame, baseline: str) -> DataFrame:
    """How many times faster than the named experiment each other one is, and seconds saved.

    The baseline's mean is a scalar subquery; without that experiment there are no rows.
    """
    mean = summary.where(F.col("experiment") == baseline).select("avg_total_s").scalar()
    return (
        summary.where(F.col("experiment") != baseline)
        .withColumn("baseline_s", mean)
        .where(F.col("baseline_s").isNotNull())
        .select(
            "experiment",
            "avg_total_s",
            "baseline_s",
            F.try_divide("baseline_s", "avg_total_s").alias("times_faster"),
            (F.col("baseline_s") - F.col("avg_total_s")).alias("saved_s"),
        )
    )


def layer_share(summary: DataFrame) -> DataFrame:
    """The share of each stage in an experiment's mean time, in percent."""
    both = F.col("avg_silver_s") + F.col("avg_gold_s")
    return summary.select(
        "experiment",
        *[
            F.try_divide(F.col(f"avg_{stage}_s") * 100, both).alias(f"{stage}_percent")
            for stage in STAGES
        ],
    )


def group_distribution(runs: DataFrame) -> DataFrame:
    """Mean, spread and quartiles of the run totals per experiment (a value per run).

    Quartiles lie between neighbouring totals in proportion and are exact, see ``quantiles``; no
    list of an experiment's totals is kept and none is sorted.
    """
    value = "total_transform_s"
    totals = _successful(runs).where(F.col(value).isNotNull())
    shares = {"median_s": 0.5, "q1_s": 0.25, "q3_s": 0.75}
    spread = totals.groupBy("experiment").agg(
        _mean(value).alias("mean_s"),
        F.stddev_pop(value).alias("std_s"),
        F.min(value).alias("min_s"),
        F.max(value).alias("max_s"),
    )
    found = quantiles(totals, "experiment", value, shares)
    found = spread.join(
        found.withColumnRenamed("experiment", "_e"), F.col("experiment").eqNullSafe(F.col("_e"))
    )
    order = ["mean_s", "median_s", "std_s", "min_s", "max_s", "q1_s", "q3_s"]
    return found.select("experiment", *order)


def quantiles(
    df: DataFrame, group: str, value: str, shares: Mapping[str, float], accuracy: int = 2000
) -> DataFrame:
    """A row per group with exact quantiles of a numeric column, a column per share.

    A quantile lies ``share * (n - 1)`` places above the least value, between neighbours in
    proportion. Found by narrowing instead of sorting: a sketch of fixed size per group brackets
    the two places; values below the bracket are only counted, those inside are counted per
    distinct value, and a running count over these, about ``8 / accuracy`` of the group, picks the
    two. Should a bracket miss a place, it becomes the whole range.

    NULLs are left out; NaN is above all numbers; a NULL group is a group.
    """
    rows = df.select(F.col(quoted(group)).alias("_g"), F.col(quoted(value)).alias("_v")).where(
        "_v IS NOT NULL"
    )
    margin = 4 / accuracy
    ends = [end for share in shares.values() for end in (share - margin, share + margin)]
    listed = ", ".join(f"{min(1.0, max(0.0, end))!r}D" for end in ends)
    sketched = rows.groupBy("_g").agg(
        F.count("*").alias("_n"),
        F.min("_v").alias("_least"),
        F.max("_v").alias("_most"),
        F.expr(f"percentile_approx(_v, array({listed}), {accuracy})").alias("_ends"),
    )

    columns = ", ".join(
        f"named_struct('share', {i}, 'at', {share!r}D * (_n - 1),"
        f" 'low', _ends[{2 * i}], 'high', _ends[{2 * i + 1}])"
        for i, share in enumerate(shares.values())
    )
    wanted = sketched.selectExpr("_g AS _t", "_least", "_most", f"inline(array({columns}))")
    # What lies below each bracket; the whole range where a place is not inside.
    brackets = (
        rows.join(wanted, F.expr("_g <=> _t"))
        .groupBy("_t", "share", "at", "low", "high", "_least", "_most")
        .agg(F.expr("count_if(_v < low) AS _below"), F.expr("count_if(_v <= high) AS _upto"))
        .withColumn("_hit", F.expr("floor(at) >= _below AND ceil(at) < _upto"))
        .selectExpr(
            "_t",
            "share",
            "at",
            "IF(_hit, low, _least) AS low",
            "IF(_hit, high, _most) AS high",
            "IF(_hit, _below, 0L) AS _below",
        )
    )
    target = ["_g", "share", "at", "_below"]
    running = over(target, ["_v"], rows=("UNBOUNDED PRECEDING", "1 PRECEDING"))
    # A value fills the places _first to _first + _rows - 1; the two places weigh by nearness.
    near, part = "floor(at)", "(at - floor(at))"
    covers = "({0} >= _first AND {0} < _first + _rows)"
    weight = (
        f"CASE WHEN {covers.format(near)} THEN 1 - {part} ELSE 0D END"
        f" + CASE WHEN {covers.format(near + ' + 1')} THEN {part} ELSE 0D END"
    )
    weighed = (
        rows.join(brackets, F.expr("_g <=> _t AND _v BETWEEN low AND high"))
        .groupBy(*target, "_v")
        .agg(F.count("*").alias("_rows"))
        .selectExpr("*", f"_below + coalesce(sum(_rows) {running}, 0L) AS _first")
        .selectExpr("_g", "share", "_v", f"{weight} AS _w")
        .where("_w > 0")
    )
    results = [
        F.sum(F.when(F.col("share") == i, F.col("_w") * F.col("_v"))).alias(name)
        for i, name in enumerate(shares)
    ]
    return weighed.groupBy("_g").agg(*results).withColumnRenamed("_g", group)


def group_runs(runs: DataFrame) -> DataFrame:
    """The run totals of each experiment in ascending order, a row per run.

    Rows rather than a list per experiment, which would gather the experiment in one task.
    """
    return (
        _successful(runs)
        .select("experiment", "run", "total_transform_s")
        .orderBy("experiment", "total_transform_s", "run")
    )
