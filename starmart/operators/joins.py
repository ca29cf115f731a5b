"""Joining a fact to a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import quoted
from starmart.operators.skew import HotKeys


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    sort_merge: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Fact rows with the dimension's columns.

    Spark compares the dimension's size with ``spark.sql.autoBroadcastJoinThreshold`` and
    broadcasts it or shuffles both sides; ``sort_merge`` asks for the latter whatever the
    size. The fact stays on the left, where Spark can split a hot key; ``hot`` keys of
    inner, left and semi-joins are split whatever follows.
    """
    dim = dim.hint("merge") if sort_merge else dim
    if hot is None or not hot.fans.get(key):
        return fact.join(dim, key, how)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"hot keys cannot be split in a join of kind {how}")
    joined = hot.join(fact, dim.withColumnRenamed(key, "_dim_key"), key, "_dim_key", how)
    others = [F.col(quoted(c)) for c in joined.columns if c not in (key, "_dim_key")]
    return joined.select(F.col(quoted(key)), *others)
