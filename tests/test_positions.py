"""Long ordered series in blocks, against the plain windows."""

from datetime import date, timedelta

import pytest
from fixtures import rows

from starmart.operators import (
    fill_gaps,
    long_fill_gaps,
    long_moving_average,
    long_period_over_period,
    moving_average,
    over_blocks,
    period_over_period,
    with_positions,
)


@pytest.fixture
def series(spark):
    # Equal values of the first column, NULL values, shuffled, in more partitions than one.
    return spark.range(0, 1000, 1, 7).selectExpr(
        "id * 7919 % 1000 DIV 3 AS day", "id AS step",
        "IF(id % 11 = 0, NULL, CAST(id * 31 % 17 AS DOUBLE)) AS amount",
    )


def ordered(df):
    return sorted(map(repr, rows(df)))


def test_positions_are_dense_and_in_order(series, tmp_path):
    placed = with_positions(series, ["day", "step"], str(tmp_path)).orderBy("_position").collect()
    assert [r._position for r in placed] == list(range(1000))
    assert [(r.day, r.step) for r in placed] == sorted((r.day, r.step) for r in placed)


@pytest.mark.parametrize("block_rows", [6, 97, 100_000])
def test_equal_to_the_plain_windows(series, tmp_path, block_rows):
    single = series.withColumn("at", series.day * 1000 + series.step)
    average = long_moving_average(
        single, ["day", "step"], "amount", f"{tmp_path}/a", rows=7, block_rows=block_rows
    )
    assert ordered(average) == ordered(moving_average(single, "at", "amount", rows=7))
    change = long_period_over_period(
        single, ["day", "step"], "amount", f"{tmp_path}/p", offset=4, block_rows=block_rows
    )
    assert ordered(change) == ordered(period_over_period(single, "at", "amount", offset=4))


def test_gaps_across_blocks(spark, tmp_path):
    first = date(2020, 2, 1)
    days = [(first + timedelta(days=i * i % 900), float(i)) for i in range(30)]
    daily = spark.createDataFrame(sorted(set(days)), "day date, amount double").dropDuplicates(["day"])
    long = long_fill_gaps(daily, "day", ["amount"], f"{tmp_path}/f", fill=-1, block_rows=4)
    assert ordered(long) == ordered(fill_gaps(daily, "day", ["amount"], fill=-1))


def test_no_window_over_a_single_partition(series, tmp_path):
    result = long_moving_average(series, ["day", "step"], "amount", str(tmp_path), block_rows=50)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    windows = [line for line in plan.splitlines() if " Window [" in line]
    # One over the numbers of rows per partition; the series itself is partitioned.
    assert sum("_rows" in line for line in windows) == 1
    assert all("_rows" in line or "_block" in line for line in windows)


def test_empty_series(spark, tmp_path):
    none = spark.createDataFrame([], "day date, amount double")
    assert long_moving_average(none, ["day"], "amount", f"{tmp_path}/e").collect() == []
    assert long_fill_gaps(none, "day", ["amount"], f"{tmp_path}/g").collect() == []


def test_a_block_must_hold_what_its_neighbours_see(series, tmp_path):
    with pytest.raises(ValueError):
        over_blocks(series, ["step"], lambda part: part, str(tmp_path), before=9, block_rows=8)
