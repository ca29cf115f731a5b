"""Conditions as SQL text, ready for ``where`` and easy to read in a plan or a log.

A rule set is one text: it reaches Spark in a single call, however many rules it has.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column name that is safe inside SQL text."""
    return "`" + name.replace("`", "``") + "`"


def known(name: str) -> str:
    return f"{quoted(name)} IS NOT NULL"


def present(name: str) -> str:
    """Neither NULL, which no comparison accepts, nor the empty string; blanks are text."""
    return f"{quoted(name)} <> ''"


def positive(name: str, dtype: T.DataType | None = None) -> str:
    """Above zero and a number: NULL compares as unknown, NaN as above every number."""
    above = f"{quoted(name)} > 0"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        above += f" AND NOT isnan({quoted(name)})"
    return above


def all_of(conditions: Iterable[str]) -> str:
    return " AND ".join(f"({condition})" for condition in conditions) or "true"
