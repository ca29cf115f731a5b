"""Dates from columns that may hold text, dates or timestamps; as SQL text."""

from __future__ import annotations

from pyspark.sql import types as T

from starmart.functions.predicates import quoted


def parsed_date(name: str, dtype: T.DataType) -> str:
    """The column as a date, NULL where it cannot be read as one.

    A column that is already a date is used as it is, which keeps comparisons on it eligible
    for pushdown into the file scan.
    """
    if isinstance(dtype, T.DateType):
        return quoted(name)
    if isinstance(dtype, T.NumericType):
        return f"try_cast(CAST({quoted(name)} AS STRING) AS DATE)"
    return f"try_cast({quoted(name)} AS DATE)"
