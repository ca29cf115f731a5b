"""Schemas and readers."""

from starmart.sources.files import (
    read_bronze,
    read_run_metrics,
    read_silver,
)
from starmart.sources.retail import Star, retail_runs, retail_table
from starmart.sources.schemas import (
    PRODUCTS,
    RUNS,
    TABLES,
    TRANSACTIONS,
    USERS,
    conform,
    with_date_as,
)
from starmart.sources.stores import (
    STORES,
    Store,
    io_options,
    mount_conf,
    qualified,
    scheme_of,
    store_conf,
)

__all__ = [
    "PRODUCTS",
    "RUNS",
    "STORES",
    "Star",
    "Store",
    "TABLES",
    "TRANSACTIONS",
    "USERS",
    "conform",
    "io_options",
    "mount_conf",
    "qualified",
    "read_bronze",
    "read_run_metrics",
    "read_silver",
    "retail_runs",
    "retail_table",
    "scheme_of",
    "store_conf",
    "with_date_as",
]
