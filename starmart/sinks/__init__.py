"""Writers. Every one replaces what its target held before."""

from starmart.sinks.files import write_csv, write_parquet, write_run_metrics
from starmart.sinks.replace import recover, replace_folder
from starmart.sinks.tables import ensure_database, write_table

__all__ = [
    "ensure_database",
    "recover",
    "replace_folder",
    "write_csv",
    "write_parquet",
    "write_run_metrics",
    "write_table",
]
