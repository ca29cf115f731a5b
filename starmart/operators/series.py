"""Ordered series. Without ``partition_by`` the order is global, so the whole input meets in
one task: pass aggregated series (a row per day). Rows of a fact table go through the
``long_`` functions, which work in blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starmart.functions import exact_total, over, quoted
from starmart.operators.calendar import fill_gaps
from starmart.operators.positions import BLOCK, POSITION, over_blocks


def period_over_period(
    df: DataFrame,
    order: str,
    value: str,
    offset: int = 1,
    partition_by: Sequence[str] = (),
    previous_as: str = "previous",
    change_as: str = "percent_change",
) -> DataFrame:
    """The value ``offset`` rows earlier and the change from it in percent.

    The change is NULL where there is no earlier value or the earlier value is 0.
    """
    previous = f"lag({quoted(value)}, {offset}) {over(partition_by, [order])}"
    now, before = (f"CAST({quoted(c)} AS DOUBLE)" for c in (value, previous_as))
    change = f"CASE WHEN {before} <> 0 THEN ({now} - {before}) / {before} * 100 END"
    return df.selectExpr("*", f"{previous} AS {quoted(previous_as)}").selectExpr(
        "*", f"{change} AS {quoted(change_as)}"
    )


def moving_average(
    df: DataFrame,
    order: str,
    value: str,
    rows: int = 7,
    partition_by: Sequence[str] = (),
    result_as: str = "moving_average",
) -> DataFrame:
    """Mean of the last ``rows`` rows; the first rows average what is there.

    Missing values weigh in as rows: the sum is divided by the number of rows in the frame.
    """
    frame = over(partition_by, [order], rows=(f"{rows - 1} PRECEDING", "CURRENT ROW"))
    total = f"CAST(sum({quoted(value)}) {frame} AS DOUBLE)"
    if isinstance(df.schema[value].dataType, T.DoubleType):
        total = exact_total(quoted(value), over=frame)
    return df.selectExpr("*", f"{total} / count(*) {frame} AS {quoted(result_as)}")


def long_period_over_period(
    df: DataFrame,
    order: Sequence[str],
    value: str,
    folder: str,
    offset: int = 1,
    previous_as: str = "previous",
    change_as: str = "percent_change",
    block_rows: int = 100_000,
) -> DataFrame:
    """``period_over_period`` over a series of any length, in blocks; ``order`` tells its rows apart.

    The ordered rows are written once below ``folder``, a place all executors share.
    """

    def compare(rows: DataFrame) -> DataFrame:
        return period_over_period(rows, POSITION, value, offset, [BLOCK], previous_as, change_as)

    return over_blocks(df, order, compare, folder, before=offset, block_rows=block_rows)


def long_moving_average(
    df: DataFrame,
    order: Sequence[str],
    value: str,
    folder: str,
    rows: int = 7,
    result_as: str = "moving_average",
    block_rows: int = 100_000,
) -> DataFrame:
    """``moving_average`` over a series of any length, in blocks, see above."""

    def average(part: DataFrame) -> DataFrame:
        return moving_average(part, POSITION, value, rows, [BLOCK], result_as)

    return over_blocks(df, order, average, folder, before=rows - 1, block_rows=block_rows)


def long_fill_gaps(
    daily: DataFrame,
    col: str,
    values: Sequence[str],
    folder: str,
    fill: float = 0,
    block_rows: int = 100_000,
) -> DataFrame:
    """``fill_gaps`` over a series of any length: a row per day, however many days, in blocks.

    A block's last day is filled up to the first day of the next block.
    """

    def filled(part: DataFrame) -> DataFrame:
        marks = ["_own", POSITION]
        return fill_gaps(part, col, [*values, *marks], fill, [BLOCK], kept=marks)

    return over_blocks(daily, [col], filled, folder, after=1, block_rows=block_rows)
