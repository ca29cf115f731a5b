"""Rows of a long ordered series: dense positions, and blocks with the rows around them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import quoted

# Bits that monotonically_increasing_id() leaves to the row within its partition.
_ROW_BITS = 33
POSITION, BLOCK = "_position", "_block"
_OWN = "_own"


def with_positions(df: DataFrame, order: Sequence[str], folder: str) -> DataFrame:
    """The rows with ``_position``: 0, 1, ... in the order of the columns ``order``.

    Range partitions, sorted within and written below ``folder``, hold the rows in order; the
    rows of the partitions before (a number per partition) are added to a row's place in
    its own. No task sees more than a partition. Equal rows take any order among themselves.
    """
    keys = [F.col(quoted(c)) for c in order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.parquet(f"{folder}/sorted")
    schema = ranged.withColumn("_at", F.lit(0).cast("long")).schema
    placed = df.sparkSession.read.schema(schema).parquet(f"{folder}/sorted")
    part = F.shiftright("_at", _ROW_BITS)
    parts = placed.groupBy(part.alias("_part")).agg(
        F.count("*").alias("_rows"), F.min("_at").alias("_from")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(
        "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_from")).alias("_shift")
    )
    return (
        placed.join(shifts, part == F.col("_part"))
        .withColumn(POSITION, F.col("_at") + F.col("_shift"))
        .drop("_at", "_part", "_shift")
    )


def over_blocks(
    df: DataFrame,
    order: Sequence[str],
    operator: Callable[[DataFrame], DataFrame],
    folder: str,
    before: int = 0,
    after: int = 0,
    block_rows: int = 100_000,
) -> DataFrame:
    """What ``operator`` gives for a series that is too long for one task.

    The series is cut into blocks of ``block_rows`` rows, each handed the ``before`` last rows of
    the block before it and the ``after`` first rows of the next. ``operator`` gets all of them
    with ``_position`` and ``_block`` and must use windows partitioned by ``_block`` that look no
    farther than those rows; of its result only a block's own rows are kept. It must keep
    the column ``_own``.
    """
    if before > block_rows or after > block_rows:
        raise ValueError("a block must hold the rows that its neighbours look at")
    placed = with_positions(df, order, folder)
    block = F.expr(f"{POSITION} div {block_rows}L")
    within = F.col(POSITION) % block_rows
    copies = F.array_compact(
        F.array(
            block,
            F.when(within >= block_rows - before, block + 1),
            F.when((within < after) & (block > 0), block - 1),
        )
    )
    dealt = placed.withColumn(BLOCK, F.explode(copies)).withColumn(_OWN, F.col(BLOCK) == block)
    return operator(dealt).where(_OWN).drop(_OWN, BLOCK, POSITION)
