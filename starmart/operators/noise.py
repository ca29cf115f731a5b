"""Controlled damage: rows get one bad cell each, to try the quality rules on."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import DRAW_RANGE, quoted, row_draw

# What a bad number, a bad address and a bad date look like.
BAD_NUMBERS = (-1, -99, 0)
AT_SIGN, BAD_AT_SIGN = "@", "_at_"
BAD_DATE_DAYS_AGO = (36500, 182500)  # 100 to 500 years

_SHARE_STEPS = 1000
_SPREAD = 7919
_SLICE = 2**11


def inject_noise(
    df: DataFrame,
    key: str | Sequence[str],
    level: float = 0.03,
    null_share: float = 0.5,
    seed: int = 0,
    exact: bool = False,
    today: date | None = None,
) -> DataFrame:
    """Damage one cell in a ``level`` share of the rows.

    ``key`` names integral columns that tell rows apart; one draw derived from it decides
    everything, so the result is repeatable and needs no shuffle. The column is drawn evenly.
    The cell becomes NULL in a ``null_share`` (to a thousandth) of cases, otherwise a value
    that is wrong for its column.

    By default each row is picked on its own, so the count is ``level`` of the rows on
    average. ``exact`` damages exactly ``int(rows * level)`` rows, at the price of two more
    scans that count rows by draw; only rows equal in all columns cannot be told apart. Rows with a
    NULL key are drawn by a hash of all their columns.
    """
    keys = [key] if isinstance(key, str) else list(key)
    schema = df.schema
    whole_row = f"xxhash64({', '.join(map(quoted, df.columns))})"
    drawn = df.select("*", F.expr(row_draw(keys, seed, whole_row)).alias("_draw"))
    if exact:
        drawn = _pick_exactly(drawn, level, whole_row)
    else:
        drawn = drawn.select("*", F.expr(f"_draw < {int(level * DRAW_RANGE)}L").alias("_bad"))

    # The draw's digits: the column, then NULL or not, then which wrong value.
    width = len(schema.fields)
    to_null = f"_draw div {width} % {_SHARE_STEPS} < {round(null_share * _SHARE_STEPS)}"
    variant = f"_draw div {width * _SHARE_STEPS}"
    cells = []
    for position, field in enumerate(schema.fields):
        name, dtype = quoted(field.name), field.dataType.simpleString()
        wrong = f"try_cast({_wrong_value(field, variant, today)} AS {dtype})"
        damaged = f"CASE WHEN {to_null} THEN NULL ELSE {wrong} END"
        hit = f"_bad AND _draw % {width} = {position}"
        cells.append(f"CASE WHEN {hit} THEN {damaged} ELSE {name} END AS {name}")
    # Emitted by a generator: a later filter then reads the finished cells, where above a
    # projection it would be rewritten to evaluate all these expressions once per mention.
    return drawn.selectExpr(f"inline(array(struct({', '.join(cells)})))")


def _wrong_value(field: T.StructField, variant: str, today: date | None) -> str:
    name = field.name
    is_number = isinstance(field.dataType, T.NumericType)
    numbers = ", ".join(map(str, BAD_NUMBERS))
    bad_number = f"element_at(array({numbers}), CAST({variant} % {len(BAD_NUMBERS)} AS INT) + 1)"
    if "price" in name or "quantity" in name:
        return bad_number
    if "email" in name:
        return f"replace({quoted(name)}, '{AT_SIGN}', '{BAD_AT_SIGN}')"
    if "date" in name and not is_number:
        low, high = BAD_DATE_DAYS_AGO
        days = f"CAST({variant} * {_SPREAD} % {high - low} AS INT) + {low}"
        start = f"DATE '{today:%Y-%m-%d}'" if today else "current_date()"
        return f"date_sub({start}, {days})"
    if "_id" in name or is_number:
        return bad_number
    return "''"


def _pick_exactly(drawn: DataFrame, level: float, whole_row: str) -> DataFrame:
    """Mark the rows with the smallest draws, exactly as many as asked for.

    The last row to take is found in two scans of counts: first the slice of draws it lies in,
    then its place in that slice by draw and, where draws are equal, by a hash of the row. What
    meets in one task is a counter per slice (a million) and the rows of one slice, a
    millionth of all.
    """
    slices = drawn.groupBy(F.expr(f"_draw div {_SLICE}").alias("_slice")).count()
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.floor(F.sum("count").over(Window.partitionBy()) * F.lit(level)).cast("bigint")
    missing = wanted - F.coalesce(F.sum("count").over(before), F.lit(0))
    cut = (
        slices.select("_slice", "count", missing.alias("_missing"))
        .where((F.col("_missing") > 0) & (F.col("_missing") <= F.col("count")))
        .select("_slice", "_missing")
    )
    row = F.struct(F.col("_draw").alias("draw"), F.expr(whole_row).alias("row"))
    inside = drawn.select(F.expr(f"_draw div {_SLICE}").alias("_at"), row.alias("_row"))
    place = F.row_number().over(Window.orderBy("_row"))
    last = (
        inside.join(F.broadcast(cut), F.col("_at") == F.col("_slice"))
        .select("_row", "_missing", place.alias("_place"))
        .where(F.col("_place") == F.col("_missing"))
        .select("_row")
        .scalar()
    )
    return drawn.select("*", F.coalesce(row <= last, F.lit(False)).alias("_bad"))
