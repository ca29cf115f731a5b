"""Named tuning profiles and the session and write settings they stand for."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

_TEN_MIB = 10 * 1024 * 1024


@dataclass(frozen=True)
class Profile:
    """Defaults: 200 shuffle partitions and everything else off."""

    description: str
    shuffle_partitions: int = 200
    adaptive: bool = False
    broadcast_threshold: int = 0
    cache: bool = False
    single_file: bool = False
    compression: str | None = None
    partition_by: str | None = None

    def session_conf(self) -> dict[str, str]:
        adaptive = str(self.adaptive).lower()
        return {
            "spark.sql.shuffle.partitions": str(self.shuffle_partitions),
            "spark.sql.adaptive.enabled": adaptive,
            "spark.sql.adaptive.coalescePartitions.enabled": adaptive,
            "spark.sql.adaptive.skewJoin.enabled": adaptive,
            "spark.sql.autoBroadcastJoinThreshold": str(self.broadcast_threshold),
        }


# The profiles that published run times refer to.
PROFILES: dict[str, Profile] = {
    "baseline": Profile("no tuning"),
    "shuffle_only": Profile("few shuffle partitions", shuffle_partitions=8),
    "aqe_only": Profile("adaptive execution", adaptive=True),
    "caching_only": Profile("cached tables", cache=True),
    "compression_only": Profile("snappy files", compression="snappy"),
    "broadcast_only": Profile("broadcast joins", broadcast_threshold=_TEN_MIB),
    "partitioning_only": Profile("products partitioned by category", partition_by="category"),
    "all_optimizations": Profile(
        "everything",
        shuffle_partitions=8,
        adaptive=True,
        broadcast_threshold=_TEN_MIB,
        cache=True,
        single_file=True,
        compression="snappy",
        partition_by="category",
    ),
    "all_but_partitioning": Profile(
        "everything but partitioned files",
        shuffle_partitions=8,
        adaptive=True,
        broadcast_threshold=_TEN_MIB,
        cache=True,
        single_file=True,
        compression="snappy",
    ),
    "shuffle_broadcast_and_aqe": Profile(
        "few shuffle partitions, broadcast joins, adaptive execution",
        shuffle_partitions=8,
        adaptive=True,
        broadcast_threshold=_TEN_MIB,
    ),
}


# Adaptive execution leaves a hot partition whole when splitting it would cost a later operator
# its partitioning, as in a semi-join on a key followed by a join on the same key. This makes
# it split and shuffle again, only where a partition is found to be hot.
SPLIT_HOT_KEYS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def cluster_conf(shuffled_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Session settings for jobs that shuffle about this much, for example the pruned columns
    of the fact.

    Shuffles start with partitions of ``partition_bytes``, small ones are merged and hot ones
    split while the job runs. Fixed partition counts, as in the profiles, suit small data only.
    """
    partitions = max(200, -(-shuffled_bytes // partition_bytes))
    return {
        **SPLIT_HOT_KEYS,
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


@contextmanager
def profile(spark: SparkSession, settings: Profile) -> Iterator[Profile]:
    """The session under a profile inside the block, as it was after it."""
    wanted = settings.session_conf()
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield settings
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
