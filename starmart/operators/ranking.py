"""Top rows, overall and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import over, quoted

# Groups whose thresholds are handed to every task: a bound of about a megabyte.
_MOST_THRESHOLDS = 10_000


def top_k(df: DataFrame, measure: str, k: int = 10, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` largest rows in descending order; each task keeps ``k`` rows at most."""
    return df.orderBy(F.desc(measure), *tie_break).limit(k)


def top_n_per_group(
    df: DataFrame,
    groups: Sequence[str],
    measure: str,
    n: int = 5,
    rank_as: str = "rank",
) -> DataFrame:
    """Rows ranked ``n`` or better within their group by ``measure``, descending.

    Equal measures share a rank and all stay, so a group may return more than ``n`` rows
    (SQL's RANK). However large a group or a tie is, no task receives it whole: what meets
    per group is ``n`` of its best rows, enough to rank every measure that qualifies, and
    the rows then join those measures. Rows below their group's n-th measure are dropped where
    they lie, before that join moves any, as long as there are at most ``_MOST_THRESHOLDS`` groups.
    """
    keys = [*groups, measure]
    best_first = over(groups, [measure], descending=True)
    best = (
        df.select(*keys)
        .selectExpr("*", f"row_number() {best_first} AS _place")
        .where(f"_place <= {n}")
    )
    ranks = (
        best.selectExpr(*map(quoted, keys), f"rank() {best_first} AS {quoted(rank_as)}")
        .distinct()
        .toDF(*[f"_best_{i}" for i in range(len(keys))], rank_as)
    )
    same = " AND ".join(f"{quoted(c)} <=> _best_{i}" for i, c in enumerate(keys))
    qualifying = df.where(_reaches(best, groups, measure, n))
    return qualifying.join(ranks, F.expr(same)).select(*df.columns, rank_as)


def _reaches(best: DataFrame, groups: Sequence[str], measure: str, n: int) -> Column:
    """Whether a row's measure reaches the n-th of its group, by a scalar subquery.

    The subquery is a map from group to n-th measure; NULL, so that every row passes, with more
    groups than the map may have. Groups of fewer rows, and NULL or NaN measures, pass too.
    """
    group = F.struct(*[F.col(quoted(c)).alias(f"_{i}") for i, c in enumerate(groups)])
    nth = (
        best.where(f"_place = {n}")
        .select(group.alias("group"), F.col(quoted(measure)).alias("nth"))
        .limit(_MOST_THRESHOLDS + 1)
    )
    thresholds = nth.agg(
        F.when(
            F.count("*") <= _MOST_THRESHOLDS,
            F.map_from_entries(F.collect_list(F.struct("group", "nth"))),
        ).alias("thresholds")
    ).scalar()
    return F.coalesce(F.col(quoted(measure)) >= thresholds[group], F.lit(True))
