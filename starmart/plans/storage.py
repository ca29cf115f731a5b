"""Keeping inputs that several actions share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame


@contextmanager
def persisted(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Persist the frames inside the block and release them after it, also on failure.

    For dimensions read by several reports. Partitions lost with an executor are recomputed.
    """
    kept = tuple(frame.persist() for frame in frames)
    try:
        yield kept
    finally:
        for frame in kept:
            frame.unpersist()
