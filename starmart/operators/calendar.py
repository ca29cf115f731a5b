"""Calendars: the days a table spans and series without missing days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starmart.functions import over, quoted


def date_bounds(df: DataFrame, col: str) -> DataFrame:
    """One row with the first and last day; both NULL for an empty table."""
    day = f"CAST({quoted(col)} AS DATE) AS _day"
    return df.selectExpr(day).selectExpr("min(_day) AS min_date", "max(_day) AS max_date")


def date_spine(df: DataFrame, col: str) -> DataFrame:
    """Every day between the bounds, one row each; no rows for an empty table."""
    days = f"explode(sequence(min_date, max_date, INTERVAL 1 DAY)) AS {quoted(col)}"
    return date_bounds(df, col).selectExpr(days)


def fill_from_spine(
    daily: DataFrame, spine: DataFrame, col: str, values: Sequence[str], fill: float = 0
) -> DataFrame:
    """Values per day of a given spine, ``fill`` where the series has no row."""
    filled = [f"coalesce({quoted(v)}, {fill}) AS {quoted(v)}" for v in values]
    return spine.join(daily, col, "left").selectExpr(quoted(col), *filled)


def fill_gaps(
    daily: DataFrame,
    col: str,
    values: Sequence[str],
    fill: float = 0,
    partition_by: Sequence[str] = (),
    kept: Sequence[str] = (),
) -> DataFrame:
    """The series with its missing days added, holding ``fill``, in ``kept`` values the last one.

    Each day is followed by the days up to the next one present, so the series is read once
    and never joined to a calendar. Needs one row per day (and per partition): aggregate first.
    """
    day, groups = quoted(col), [quoted(c) for c in partition_by]
    next_day = f"lead({day}) {over(partition_by, [col])}"
    days = f"sequence({day}, coalesce(date_sub({next_day}, 1), {day}), INTERVAL 1 DAY)"
    spread = daily.selectExpr(*groups, *map(quoted, values), f"{days} AS _days").selectExpr(
        *groups, *map(quoted, values), "posexplode(_days) AS (_offset, _day)"
    )
    return spread.selectExpr(
        *groups,
        f"_day AS {day}",
        *[
            quoted(v) if v in kept
            else f"CASE WHEN _offset = 0 THEN {quoted(v)} ELSE {fill} END AS {quoted(v)}"
            for v in values
        ],
    )
