import random
import statistics

import numpy as np
import pytest

from starmart.operators import (
    group_distribution,
    group_runs,
    group_vs_baseline,
    layer_share,
    quantiles,
    stage_totals,
    summarise_runs,
)
from starmart.sources import RUNS


def step(experiment, run, stage, item, transform, write=0.5, status="success"):
    return (experiment, run, stage, item, transform, write, 10, status, f"about {experiment}")


def run(experiment, number, silver, gold, status="success"):
    return [
        step(experiment, number, "silver", "users", silver / 2),
        step(experiment, number, "silver", "sales", silver / 2),
        step(experiment, number, "gold", "report", gold, status=status),
    ]


@pytest.fixture(scope="module")
def runs(spark):
    data = [
        *run("baseline", 1, 4.0, 12.0), *run("baseline", 2, 3.0, 13.0), *run("baseline", 3, 4.0, 14.0),
        *run("tuned", 1, 1.0, 1.0), *run("tuned", 2, 1.0, 3.0), *run("tuned", 3, 9.0, 9.0, "failed"),
        *run("single", 1, 2.0, 6.0), *run("broken", 1, 1.0, 1.0, "failed"),
    ]
    return spark.createDataFrame(data, RUNS)


def by_name(df):
    return {r.experiment: r for r in df.collect()}


def test_stage_totals(runs):
    totals = {(r.experiment, r.run): r for r in stage_totals(runs).collect()}
    first = totals["baseline", 1]
    assert (first.silver_transform_s, first.gold_transform_s, first.total_transform_s) == (4, 12, 16)
    assert (first.silver_write_s, first.gold_write_s, first.total_write_s) == (1.0, 0.5, 1.5)
    assert first.total_s == 17.5 and first.succeeded
    assert not totals["tuned", 3].succeeded and len(totals) == 8


def test_summary(runs):
    found = summarise_runs(runs).collect()
    assert [r.experiment for r in found] == ["tuned", "single", "baseline"]
    tuned = found[0]
    assert (tuned.successful_runs, tuned.avg_silver_s, tuned.avg_gold_s) == (2, 1.0, 2.0)
    assert (tuned.avg_total_s, tuned.min_total_s, tuned.max_total_s) == (3.0, 2.0, 4.0)
    assert tuned.std_total_s == statistics.pstdev([2.0, 4.0])
    assert tuned.avg_write_s == 1.5 and tuned.description == "about tuned"
    assert found[1].std_total_s == 0.0


def test_against_baseline(runs):
    summary = summarise_runs(runs)
    found = by_name(group_vs_baseline(summary, "baseline"))
    mean = np.mean([16.0, 16.0, 18.0])
    assert set(found) == {"tuned", "single"}
    assert found["tuned"].times_faster == pytest.approx(mean / 3)
    assert found["tuned"].saved_s == pytest.approx(mean - 3)
    assert group_vs_baseline(summary, "nowhere").collect() == []


def test_layer_share(runs):
    found = by_name(layer_share(summarise_runs(runs)))
    assert (found["single"].silver_percent, found["single"].gold_percent) == (25.0, 75.0)


def test_distribution(runs):
    found = by_name(group_distribution(runs))
    totals = [16.0, 16.0, 18.0]
    base = found["baseline"]
    assert base.mean_s == pytest.approx(np.mean(totals)) and base.median_s == 16.0
    assert base.std_s == pytest.approx(np.std(totals))
    assert (base.min_s, base.max_s) == (16.0, 18.0)
    assert [base.q1_s, base.q3_s] == list(np.percentile(totals, [25, 75]))
    assert set(found) == {"baseline", "tuned", "single"}


def test_runs_in_order(runs):
    found = [(r.experiment, r.total_transform_s) for r in group_runs(runs).collect()]
    assert found == [
        ("baseline", 16.0), ("baseline", 16.0), ("baseline", 18.0),
        ("single", 8.0), ("tuned", 2.0), ("tuned", 4.0),
    ]


def test_no_time_at_all(spark):
    data = [step("idle", 1, "silver", "users", 0.0), step("idle", 1, "gold", "report", 0.0)]
    summary = summarise_runs(spark.createDataFrame(data, RUNS))
    assert by_name(layer_share(summary))["idle"].silver_percent is None


def test_a_step_without_a_write_time_keeps_its_own(spark):
    steps = [step("e", 1, "silver", "a", 1.0, None), step("e", 1, "gold", "b", 2.0, 3.0)]
    row = stage_totals(spark.createDataFrame(steps, RUNS)).first()
    assert (row.total_transform_s, row.total_write_s, row.total_s) == (3.0, 3.0, 6.0)


def test_times_below_a_nanosecond_count(spark):
    steps = [step("e", 1, "silver", str(i), 1e-12, 0.0) for i in range(10)]
    row = stage_totals(spark.createDataFrame(steps, RUNS)).first()
    assert row.total_transform_s == pytest.approx(1e-11)


def test_quartiles_keep_no_list_of_totals(runs):
    plan = group_distribution(runs)._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan  # a sketch of fixed size is no list


def _plain_quantile(values, share):
    values = sorted(values)
    at = share * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


@pytest.mark.parametrize("accuracy", [20, 2000])
def test_quantiles_are_exact_whatever_the_sketch(spark, accuracy):
    """With a coarse sketch the brackets are narrow or miss; ties, one row, a NULL group."""
    draw = random.Random(4)
    groups = {
        "even": [draw.random() for _ in range(3000)],
        "skewed": [draw.random() ** 30 * 1e9 for _ in range(2001)],
        "ties": [float(i % 3) for i in range(1000)],
        "one": [7.5],
        "two": [-1.0, 4.0],
        None: [-draw.random() for _ in range(50)],
    }
    data = [(g, v) for g, values in groups.items() for v in values] + [("even", None)]
    draw.shuffle(data)
    shares = {"low": 0.25, "mid": 0.5, "high": 0.95, "top": 1.0}
    df = spark.createDataFrame(data, "g string, v double")
    found = {r.g: r for r in quantiles(df, "g", "v", shares, accuracy).collect()}
    assert set(found) == set(groups)
    for group, values in groups.items():
        for name, share in shares.items():
            assert found[group][name] == pytest.approx(_plain_quantile(values, share), rel=1e-12)


def test_quartiles_sort_no_run_totals(spark):
    runs = spark.createDataFrame([("a", i, "silver", "x", float(i), 0.0, 1, "success", "d")
                                  for i in range(30)], RUNS)
    plan = group_distribution(runs)._jdf.queryExecution().optimizedPlan().toString()
    for below in plan.split("Window [")[1:]:
        # Windows run over counts per distinct value inside a bracket.
        assert "Aggregate [_g" in below.split("\n")[1] or "Aggregate [_g" in below.split("\n")[2]
