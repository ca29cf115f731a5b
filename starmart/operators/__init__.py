"""Operators: plain functions from DataFrames to a lazy DataFrame."""

from starmart.operators.calendar import date_bounds, date_spine, fill_from_spine, fill_gaps
from starmart.operators.integrity import enforce_fk, enforce_fks, orphans
from starmart.operators.joins import join_dimension
from starmart.operators.noise import inject_noise
from starmart.operators.positions import over_blocks, with_positions
from starmart.operators.quality import (
    TABLE_RULES,
    Rule,
    clean,
    clean_and_count,
    key_columns,
    known_keys,
    observed_report,
    positive_keys,
    quality_report,
    row_counts,
    rules_for,
)
from starmart.operators.ranking import top_k, top_n_per_group
from starmart.operators.run_metrics import (
    group_distribution,
    group_runs,
    group_vs_baseline,
    layer_share,
    quantiles,
    stage_totals,
    summarise_runs,
)
from starmart.operators.sales import (
    daily_sales,
    product_quantity,
    segment_performance,
    user_spend,
)
from starmart.operators.series import (
    long_fill_gaps,
    long_moving_average,
    long_period_over_period,
    moving_average,
    period_over_period,
)
from starmart.operators.skew import HotKeys, find_hot_keys

__all__ = [
    "HotKeys",
    "Rule",
    "TABLE_RULES",
    "clean",
    "clean_and_count",
    "daily_sales",
    "date_bounds",
    "date_spine",
    "enforce_fk",
    "enforce_fks",
    "fill_from_spine",
    "fill_gaps",
    "find_hot_keys",
    "group_distribution",
    "group_runs",
    "group_vs_baseline",
    "inject_noise",
    "join_dimension",
    "key_columns",
    "known_keys",
    "layer_share",
    "long_fill_gaps",
    "long_moving_average",
    "long_period_over_period",
    "moving_average",
    "observed_report",
    "orphans",
    "over_blocks",
    "period_over_period",
    "positive_keys",
    "product_quantity",
    "quality_report",
    "quantiles",
    "row_counts",
    "rules_for",
    "segment_performance",
    "stage_totals",
    "summarise_runs",
    "top_k",
    "top_n_per_group",
    "user_spend",
    "with_positions",
]
