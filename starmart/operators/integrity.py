"""Referential integrity between a fact and its dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.skew import HotKeys


def enforce_fk(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Fact rows whose key exists in the dimension.

    A semi-join: no DISTINCT over the dimension, no fan-out, the fact's columns as they were.
    The fact is the left side, which Spark can split when one key is hot, unless a later join
    needs the same key together; ``hot`` keys are split whatever follows.
    """
    return _match(fact, dim, key, dim_key, "left_semi", hot)


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows that ``enforce_fk`` drops, rows without a key included."""
    return _match(fact, dim, key, dim_key, "left_anti")


def enforce_fks(
    fact: DataFrame, dims: Mapping[str, DataFrame], hot: HotKeys | None = None
) -> DataFrame:
    """``enforce_fk`` for each key in turn."""
    for key, dim in dims.items():
        fact = enforce_fk(fact, dim, key, hot=hot)
    return fact


def _match(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str | None,
    how: str,
    hot: HotKeys | None = None,
) -> DataFrame:
    # Renamed and compared by condition: joining by name would move the key to the front.
    keys = dim.select(F.col(dim_key or key).alias("_known_key"))
    return (hot or HotKeys()).join(fact, keys, key, "_known_key", how)
