"""Exact inner-product search with a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count as numbers
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.vectors import matrix, usable
from starmart.plans import scratch_folder

# Bounds of the index that hold for any input: rings of all pivots fit in every task.
MOST_PIVOTS, RINGS = 256, 64
_RING_ROWS, _QUERY_ROWS, _BLOCK = 20_000, 20_000, 512
# Rings that the first round expands for each query; every later round expands thrice as many.
_FIRST_RINGS = 4
_HITS = "query long, vec_id long, copies long, score long"


def _whole(vectors: pa.Array, width: int, grid: int) -> np.ndarray:
    return np.floor(grid * matrix(vectors, width))


def _from_bytes(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.float64).reshape(-1, width)


def _best(asked: pa.Table, ring: pa.Table, width: int, k: int) -> Iterator[pa.Table]:
    """The ``k`` highest products of each query, none below its limit; ties to the smaller id."""
    ring = ring.sort_by([("vec_id", "ascending")])  # null ids come last
    rows, copies = ring.column("row").to_numpy(), ring.column("copies").to_numpy()
    vectors = _from_bytes(ring.column("v"), width)
    queries, limits = asked.column("query").to_numpy(), asked.column("limit").to_numpy()
    wanted = _from_bytes(asked.column("q"), width)
    for low in range(0, len(queries), _BLOCK):
        part = slice(low, low + _BLOCK)
        scores = wanted[part] @ vectors.T
        # A query is no candidate of its own; its further copies are.
        own = queries[part][:, None] == rows[None, :]
        scores[own & (copies == 1)[None, :]] = -np.inf
        scores[scores < limits[part][:, None]] = -np.inf
        top = min(k, scores.shape[1])
        # The k-th highest score, then all above it and the first of those equal to it.
        bar = -np.partition(-scores, top - 1, axis=1)[:, top - 1]
        row, column = np.nonzero((scores >= bar[:, None]) & (scores > -np.inf))
        order = np.lexsort((column, -scores[row, column], row))
        row, column = row[order], column[order]
        place = np.arange(len(row)) - np.searchsorted(row, row, "left")
        row, column = row[place < k], column[place < k]
        yield pa.table(
            {
                "query": pa.array(queries[part][row], pa.int64()),
                "vec_id": ring.column("vec_id").take(pa.array(column)),
                "copies": pa.array(copies[column] - own[row, column], pa.int64()),
                "score": pa.array(scores[row, column].astype(np.int64), pa.int64()),
            }
        )


def _build(vectors: DataFrame, folder: str, grid: int) -> tuple[DataFrame, np.ndarray, int]:
    """The written index, its pivots and the vectors' width.

    A row of the index stands for all rows of one id and one vector (``copies`` of them).
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).filter(usable("embedding"))
    count, width = rows.agg(F.count("*"), F.max(F.size("embedding"))).first()
    width = width or 1
    wanted = min(MOST_PIVOTS, max(2, int(sqrt(count) / 16)))
    threshold = min(1.0, 8 * wanted / max(count, 1))
    drawn = rows.withColumn("_draw", F.xxhash64("vec_id", "embedding"))
    share = F.pmod(F.col("_draw"), F.lit(1 << 30)) < int(threshold * (1 << 30)) + 1

    def lowest(some: DataFrame) -> list:
        return some.distinct().orderBy("_draw", "vec_id").limit(wanted).collect()

    chosen = lowest(drawn.filter(share)) or lowest(drawn)
    pivots = np.zeros((max(1, len(chosen)), width))
    for i, row in enumerate(chosen):
        pivots[i, : len(row.embedding)] = np.floor(grid * np.array(row.embedding))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                x = _whole(part.column(1), width, grid)
                far = _distances(x, pivots)
                pivot = far.argmin(1)
                distance = far[np.arange(len(x)), pivot]
                ring = np.minimum(distance // (grid / 16), RINGS - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(pivot.astype(np.int32)),
                        pa.array(ring),
                        pa.array(distance),
                        pa.array(np.linalg.norm(x, axis=1)),
                        pa.array([v.tobytes() for v in x + 0.0], pa.binary()),
                    ],
                    names=["vec_id", "pivot", "ring", "distance", "norm", "v"],
                )

    keyed = rows.mapInArrow(
        key, "vec_id long, pivot int, ring int, distance double, norm double, v binary"
    )
    each = [F.first(c).alias(c) for c in ("pivot", "ring", "distance", "norm")]
    grouped = keyed.groupBy("vec_id", "v").agg(F.count("*").alias("copies"), *each)
    # The number is drawn once, when the index is written.
    grouped.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index"), pivots, width


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _reach(x: np.ndarray, pivots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The highest product that a vector of each ring may have with each query."""
    norm, highest = np.linalg.norm(x, axis=1)[:, None], bounds[:, 4][None, :]
    to_pivot = _distances(x, pivots)[:, bounds[:, 0].astype(int)]
    gap = np.maximum(bounds[:, 2][None, :] - to_pivot, to_pivot - bounds[:, 3][None, :])
    gap = np.maximum(gap - 1e-6, 0)
    return np.minimum((norm**2 + highest**2 - gap**2) / 2, norm * highest) + 1e-3


def search(
    vectors: DataFrame, query: str = "vec_id % 50 = 0", k: int = 5, grid: int = 256
) -> tuple[DataFrame, float]:
    """What ``top_k_products`` returns, and the share of all pairs of query and row that was scored."""
    spark, folder = vectors.sparkSession, scratch_folder(vectors.sparkSession)
    index, pivots, width = _build(vectors, folder, grid)
    rings = (
        index.groupBy("pivot", "ring")
        .agg(F.min("distance"), F.max("distance"), F.max("norm"), F.count("*"))
        .collect()
    )
    bounds = np.array([[*r] for r in rings], dtype=np.float64).reshape(-1, 6)
    queries = spark.read.parquet(f"{folder}/index").filter(query)

    def visit(low: int, high: int):
        """Rows that send each query to its rings from place ``low`` to ``high``, highest bound first."""

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, _BLOCK):
                    part = batch.slice(at, _BLOCK)
                    limits = part.column(2).to_numpy(zero_copy_only=False)
                    reach = _reach(_from_bytes(part.column(1), width), pivots, bounds)
                    order = np.argsort(-reach, axis=1, kind="stable")[:, low:high]
                    row, place = np.nonzero(np.take_along_axis(reach, order, 1) >= limits[:, None])
                    ring, row = order[row, place], pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(row),
                            pa.array(bounds[ring, 0].astype(np.int32)),
                            pa.array(bounds[ring, 1].astype(np.int32)),
                            part.column(2).take(row),
                            part.column(1).take(row),
                        ],
                        names=["query", "pivot", "ring", "limit", "q"],
                    )

        return send

    def score(asked: pa.Table, ring: pa.Table) -> pa.Table:
        kinds = [(n, pa.int64()) for n in ("query", "vec_id", "copies", "score")]
        tables = [pa.schema(kinds).empty_table()]
        if asked.num_rows and ring.num_rows:
            tables += _best(asked, ring, width, k)
        return pa.concat_tables(tables)

    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
    ranked = Window.partitionBy("query").orderBy(*order)

    def top(hits: DataFrame) -> DataFrame:
        """The first ``k`` of each query, copies counted; ``before`` of them come before a row."""
        first = hits.withColumn("_n", F.row_number().over(ranked)).filter(F.col("_n") <= k)
        earlier = F.sum("copies").over(ranked.rowsBetween(Window.unboundedPreceding, -1))
        kept = first.drop("_n").withColumn("before", F.coalesce(earlier, F.lit(0)))
        return kept.filter(F.col("before") < k)

    hits, pairs, low, width_of_round = None, 0, 0, _FIRST_RINGS
    for number in numbers():
        asking = queries.select("row", "v").withColumn("limit", F.lit(float("-inf")))
        if hits is not None:
            full = hits.filter(F.col("before") + F.col("copies") >= k)
            limits = full.select(F.col("query").alias("row"), F.col("score").cast("double").alias("_l"))
            asking = asking.join(limits, "row", "left").select(
                "row", "v", F.coalesce("_l", "limit").alias("limit")
            )
        sent = asking.mapInArrow(
            visit(low, low + width_of_round),
            "query long, pivot int, ring int, limit double, q binary",
        )
        asked = {(r[0], r[1]): r[2] for r in sent.groupBy("pivot", "ring").count().collect()}
        if not asked:
            break
        # Bounded by the number of rings: pieces of the ring's rows and of its queries.
        places = [
            (r[0], r[1], -(-r[5] // _RING_ROWS), -(-asked[r[0], r[1]] // _QUERY_ROWS))
            for r in rings
            if (r[0], r[1]) in asked
        ]
        pairs += sum(asked.get((r[0], r[1]), 0) * r[5] for r in rings)
        split = spark.createDataFrame(places, "pivot int, ring int, parts int, lots int")
        group = ["pivot", "ring", "part", "lot"]

        def every(name: str):
            return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

        placed = index.join(F.broadcast(split), ["pivot", "ring"]).select(
            "row", "vec_id", "copies", "v", "pivot", "ring",
            F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("part"),
            every("lots").alias("lot"),
        )
        dealt = sent.join(F.broadcast(split), ["pivot", "ring"]).select(
            "query", "limit", "q", "pivot", "ring",
            F.pmod(F.xxhash64("query"), F.col("lots")).cast("int").alias("lot"),
            every("parts").alias("part"),
        )
        found = dealt.groupBy(*group).cogroup(placed.groupBy(*group)).applyInArrow(score, _HITS)
        top(found if hits is None else hits.drop("before").union(found)).write.parquet(
            f"{folder}/round-{number}"
        )
        hits = spark.read.parquet(f"{folder}/round-{number}")
        low, width_of_round = low + width_of_round, 3 * width_of_round
    if hits is None:
        hits = spark.createDataFrame([], f"{_HITS}, before long")
    again = queries.select(
        F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("copies").alias("_times")
    )
    last = F.least(F.col("before") + F.col("copies"), F.lit(k))
    ranks = F.explode(F.sequence(F.col("before") + 1, last)).alias("rank")
    result = hits.join(again, "query").select(
        "query_id", F.col("vec_id"), "score", "_times", ranks
    )
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))).alias("_time")
    result = result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", times)
    of_all = queries.count() * bounds[:, 5].sum()
    return result.drop("_time"), pairs / of_all if of_all else 0.0


def top_k_products(
    vectors: DataFrame, query: str = "vec_id % 50 = 0", k: int = 5, grid: int = 256
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query row.

    Components become ``floor(grid * x)``. Candidates are all rows but the query's own; ties go to
    the smaller id, null ids last. Exact: vectors are keyed by their nearest pivot and their
    distance to it, in rings of equal width (the last one open). By the triangle inequality, a vector
    of a ring is no nearer than the query's own distance to the pivot lies outside the ring; so its
    product has an upper bound. Each query expands rings in the order of their bounds, some in
    each round (4, 12, 36, ...). After a round its k-th score is its new limit, and it stops at the first
    ring whose bound is below. Only rings that are asked for are read.

    Rings are split by a hash of the row where they are large, and so are a ring's queries; pivots (the
    vectors with the lowest hash) and rings are limited in number, not in size. Vectors that are
    null, empty or hold null or non-finite components take no part. A null id is a candidate, and no
    query unless ``query`` says so. Shorter vectors count as if they ended in zeros. Rows that
    repeat an id and vector are candidates each, also of one another, and queries each; they
    are scored once. Products are exact while they stay below 2**53. Other columns are not read.
    """
    return search(vectors, query, k, grid)[0]
