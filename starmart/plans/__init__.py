"""Compositions: the reports, the layer jobs and their settings."""

from starmart.plans.medallion import REFERENCES, run_gold, run_medallion, run_silver
from starmart.plans.profiles import PROFILES, SPLIT_HOT_KEYS, Profile, cluster_conf, profile
from starmart.plans.reports import REPORTS, daily_series
from starmart.plans.scratch import scratch_folder
from starmart.plans.sql_reports import registered, run_sql_reports
from starmart.plans.storage import persisted

__all__ = [
    "PROFILES",
    "Profile",
    "REFERENCES",
    "REPORTS",
    "SPLIT_HOT_KEYS",
    "cluster_conf",
    "daily_series",
    "persisted",
    "profile",
    "registered",
    "run_gold",
    "run_medallion",
    "run_silver",
    "run_sql_reports",
    "scratch_folder",
]
