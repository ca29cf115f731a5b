"""Numbers whose sums must not depend on the order in which tasks finish."""

from __future__ import annotations

from pyspark.sql import types as T

from starmart.functions.predicates import quoted

# Prices are doubles in the data model. Summing doubles gives last digits that change with
# partitioning and task order, so every number that this type holds without loss is summed as
# a decimal. Others (tiny, huge, infinite) are summed as doubles, and the result is a double.
MONEY = T.DecimalType(18, 6)

# Clock readings, to the nanosecond.
SECONDS = T.DecimalType(28, 9)


def split_exact(value: str, unit: T.DecimalType = MONEY) -> tuple[str, str]:
    """SQL text: the value as ``unit`` and as a double; the one that loses nothing, the other NULL."""
    exact, plain = f"try_cast({value} AS {unit.simpleString()})", f"CAST({value} AS DOUBLE)"
    fits = f"CAST({exact} AS DOUBLE) <=> {plain}"
    return f"CASE WHEN {fits} THEN {exact} END", f"CASE WHEN NOT ({fits}) THEN {plain} END"


def both_parts(exact: str, rest: str) -> str:
    """SQL text: the double that two sums make; NULL only if both are."""
    exact = f"CAST({exact} AS DOUBLE)"
    return f"coalesce({exact} + {rest}, {exact}, {rest})"


def exact_total(value: str, unit: T.DecimalType = MONEY, over: str = "") -> str:
    """SQL text: the sum of a column or expression as a double, whatever the order of the rows
    as far as ``unit`` holds the values; nothing is rounded away or dropped."""
    exact, rest = (f"sum({part}) {over}" for part in split_exact(value, unit))
    return both_parts(exact, rest)


def whole_number(name: str, dtype: T.IntegralType) -> str:
    """SQL text: ``7`` or ``7.0`` as an integer, NULL for anything that is no whole number.

    A writer that stores a missing key as NaN turns the whole column into floats, so keys
    arrive as ``7.0`` and would be lost by a reader that expects integers.
    """
    plain = f"try_cast({quoted(name)} AS {dtype.simpleString()})"
    number = f"try_cast({quoted(name)} AS DECIMAL(38, 9))"
    whole = f"CASE WHEN {number} = floor({number}) THEN {number} END"
    return f"coalesce({plain}, try_cast({whole} AS {dtype.simpleString()}))"
