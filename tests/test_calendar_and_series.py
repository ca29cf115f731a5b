from datetime import date, timedelta

import pandas as pd
from fixtures import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starmart.operators import (
    date_bounds,
    date_spine,
    fill_from_spine,
    fill_gaps,
    moving_average,
    period_over_period,
)

START = date(2024, 2, 27)
SERIES = "day date, value int"


def series(spark, values):
    """Values by day offset from the start."""
    data = [(START + timedelta(days=d), v) for d, v in values.items()]
    return spark.createDataFrame(data, SERIES)


def test_bounds_and_spine(spark):
    df = series(spark, {4: 1, 0: 2})
    assert rows(date_bounds(df, "day")) == [(START, START + timedelta(days=4))]
    spine = sorted(rows(date_spine(df, "day")))
    assert spine == [(START + timedelta(days=d),) for d in range(5)]


def test_empty_input_has_no_spine(spark):
    df = series(spark, {0: 1}).limit(0)
    assert rows(date_bounds(df, "day")) == [(None, None)]
    assert rows(date_spine(df, "day")) == []
    assert rows(fill_gaps(df, "day", ["value"])) == []


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.integers(0, 40), st.integers(-5, 5), min_size=1, max_size=12))
def test_both_ways_of_filling_agree_with_pandas(spark, values):
    df = series(spark, values)
    by_lead = sorted(rows(fill_gaps(df, "day", ["value"])))
    by_spine = sorted(rows(fill_from_spine(df, date_spine(df, "day"), "day", ["value"])))
    whole = pd.Series(values).sort_index()
    whole = whole.reindex(range(whole.index.min(), whole.index.max() + 1), fill_value=0)
    expected = [(START + timedelta(days=int(d)), int(v)) for d, v in whole.items()]
    assert by_lead == by_spine == expected


def test_gaps_are_filled_per_partition(spark):
    a, b = series(spark, {0: 1, 2: 2}), series(spark, {5: 3})
    df = a.selectExpr("'a' AS shop", "*").unionAll(b.selectExpr("'b' AS shop", "*"))
    filled = sorted(rows(fill_gaps(df, "day", ["value"], partition_by=["shop"])))
    assert [(s, v) for s, _, v in filled] == [("a", 1), ("a", 0), ("a", 2), ("b", 3)]


def test_missing_values_stay_missing_on_present_days(spark):
    df = spark.createDataFrame([(START, None), (START + timedelta(days=2), 4)], SERIES)
    assert [v for _, v in sorted(rows(fill_gaps(df, "day", ["value"])))] == [None, 0, 4]


def test_change_needs_an_earlier_value_other_than_zero(spark):
    df = series(spark, {0: 0, 1: 5, 2: 10, 3: 4})
    found = period_over_period(df, "day", "value").orderBy("day")
    assert [tuple(r)[2:] for r in found.collect()] == [
        (None, None), (0, None), (5, 100.0), (10, -60.0),
    ]
    two_back = period_over_period(df, "day", "value", offset=2).orderBy("day")
    assert [r.percent_change for r in two_back.collect()] == [None, None, None, -20.0]


def test_short_frames_divide_by_their_length(spark):
    values = {d: d * d for d in range(10)}
    found = moving_average(series(spark, values), "day", "value", rows=4).orderBy("day")
    expected = pd.Series(values).rolling(4, min_periods=1).mean()
    assert [r.moving_average for r in found.collect()] == list(expected)


def test_series_operators_by_partition(spark):
    df = series(spark, {0: 2, 1: 4}).crossJoin(spark.createDataFrame([("a",), ("b",)], "shop string"))
    change = period_over_period(df, "day", "value", partition_by=["shop"])
    assert sorted((r.shop, r.percent_change or 0) for r in change.collect()) == [
        ("a", 0), ("a", 100.0), ("b", 0), ("b", 100.0),
    ]
    mean = moving_average(df, "day", "value", partition_by=["shop"]).orderBy("shop", "day")
    assert [r.moving_average for r in mean.collect()] == [2.0, 3.0, 2.0, 3.0]
