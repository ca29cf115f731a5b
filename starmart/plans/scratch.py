"""Where intermediate files may go."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name in the storage that all executors share, whatever the master.

    Below ``spark.checkpoint.dir``, or below the warehouse where that is unset.
    """
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse.rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/starmart-{uuid4().hex}"
