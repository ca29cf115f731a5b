"""Near-duplicate vectors by E8 lattice hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.graph import components
from starmart.llm.vectors import matrix, usable
from starmart.plans import scratch_folder

_BLOCK = 1024
_SCALE = 6.0
# Twice the 240 shortest vectors of the lattice: pairs of ones, and halves with an even sign.
_PAIRS = [
    [s if k == i else t if k == j else 0 for k in range(8)]
    for i, j in combinations(range(8), 2)
    for s, t in product((2, -2), repeat=2)
]
_HALVES = [list(s) for s in product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
SHORTEST = np.array(_PAIRS + _HALVES, dtype=np.float64) / 2


def nearest_e8(points: np.ndarray) -> np.ndarray:
    """The E8 lattice point nearest to each row: the better of two shifted copies of D8."""

    def d8(x: np.ndarray) -> np.ndarray:
        whole = np.rint(x)
        error = x - whole
        odd = np.flatnonzero(whole.sum(1) % 2)
        worst = np.abs(error[odd]).argmax(1)
        whole[odd, worst] += np.where(error[odd, worst] >= 0, 1, -1)
        return whole

    even, shifted = d8(points), d8(points - 0.5) + 0.5
    nearer = ((points - even) ** 2).sum(1) <= ((points - shifted) ** 2).sum(1)
    return np.where(nearer[:, None], even, shifted)


def _cell_keys(cells: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit key of lattice points in a table."""
    whole = np.rint(2 * cells).astype(np.int64).astype(np.uint64)
    key = np.full(len(whole), table + 1, dtype=np.uint64)
    for column in whole.T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


class LatticeTables:
    """Random projections to 8 dimensions, scaled so that cells hold few vectors.

    The scale is one for all tables, so that a pair is found or not whatever the number of vectors
    (``count`` is not used). In smaller cells near vectors would seldom be neighbours.
    """

    def __init__(self, width: int, count: int, tables: int, probes: int, seed: int):
        scale = _SCALE * sqrt(max(width, 8) / 64)
        random = np.random.default_rng(seed)
        self._maps = [
            np.linalg.qr(random.normal(size=(max(width, 8), 8)))[0][:width] * scale
            for _ in range(tables)
        ]
        self._probes = probes

    def keys(self, units: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per table: the key of each vector's own cell, and keys of the nearest other cells."""
        for table, projection in enumerate(self._maps):
            points = units @ projection
            own = nearest_e8(points)
            closeness = (points - own) @ SHORTEST.T
            nearest = np.argpartition(-closeness, self._probes, axis=1)[:, : self._probes]
            around = (own[:, None, :] + SHORTEST[nearest]).reshape(-1, 8)
            probed = _cell_keys(around, table).reshape(len(units), self._probes)
            yield _cell_keys(own, table), probed


def _sketch(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, their step, and how far the vector they stand for is from the unit vector."""
    step = np.maximum(np.abs(units).max(1), 1e-12) / 127
    small = np.rint(units / step[:, None]).astype(np.int8)
    return small, step, np.linalg.norm(units - small * step[:, None], axis=1) + 1e-7


def _pairs_of_cell(own: slice, small, step, error, keys, near: float) -> Iterator[tuple]:
    """Pairs of a vector whose cell this is with any vector seen here, in blocks."""
    width = len(keys)
    homes = own.stop - own.start
    for at in range(own.start, own.start + homes, _BLOCK):
        a = slice(at, min(at + _BLOCK, own.stop))
        for low in range(0, width, _BLOCK):
            b = slice(low, min(low + _BLOCK, width))
            cosine = (small[a].astype(np.float32) @ small[b].astype(np.float32).T).astype(np.float64)
            cosine *= step[a][:, None] * step[b][None, :]
            # |x.y - x'.y'| <= |x - x'| + |y - y'| * |x'|
            slack = error[a][:, None] + error[b][None, :] * (1 + error[a][:, None])
            i, j = np.nonzero(cosine + slack >= near)
            left, right = keys[a][i], keys[b][j]
            sure = cosine[i, j] - slack[i, j] >= near
            other = left != right
            yield (
                np.minimum(left, right)[other],
                np.maximum(left, right)[other],
                sure[other],
            )


def _found(cells: DataFrame, near: float, width: int) -> DataFrame:
    """Pairs ``a < b`` of near vectors, and whether their sketches alone prove it."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns(batch):
            key, node, home, step, error = (
                batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 3, 4)
            )
            data = b"".join(batch.column(5).to_pylist())
            small = np.frombuffer(data, np.int8).reshape(len(key), width)
            return key, node, home, step, error, small

        def pairs(key, node, home, step, error, small):
            edges = np.flatnonzero(np.diff(key)) + 1
            for low, high in zip([0, *edges], [*edges, len(key)]):
                homes = int(home[low:high].sum())
                if homes and high - low > 1:
                    part = slice(low, high)
                    for a, b, sure in _pairs_of_cell(
                        slice(0, homes), small[part], step[part], error[part], node[part], near
                    ):
                        if len(a):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(a), pa.array(b), pa.array(sure)], names=["a", "b", "sure"]
                            )

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = columns(batch)
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now))
            last = np.searchsorted(now[0], now[0][-1], "left")
            yield from pairs(*(x[:last] for x in now)) if last else ()
            held = tuple(x[last:] for x in now)
        if held is not None:
            yield from pairs(*held)

    dealt = cells.repartition("cell").sortWithinPartitions("cell", F.col("home").desc())
    found = dealt.mapInArrow(match, "a long, b long, sure boolean")
    return found.groupBy("a", "b").agg(F.max("sure").alias("sure"))


def near_vectors(
    vectors: DataFrame, near: float = 0.9, tables: int = 6, probes: int = 8, seed: int = 0
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding``.

    Equal vectors are taken together. Each vector is projected at random to 8 dimensions in several
    tables and decoded to the nearest E8 lattice point, its cell; it is compared with the
    vectors of its cell and of the ``probes`` neighbouring cells nearest to it. A
    sketch of a byte per component, with its known error, decides most pairs; the others are
    decided by the cosine of the vectors in double precision. No pair below ``near`` links. A pair at
    ``near`` exactly is found with a probability of about 0.995, nearer ones almost surely.

    ``n_links`` counts the rows a row links to, ``component_id`` is the smallest ``vec_id`` that links reach,
    ``kept`` whether it is the row's own. Null, empty and zero vectors and those with null or non-finite
    components link to nothing. Shorter vectors are compared as if they ended in zeros. Rows
    with a null ``vec_id`` take part; they name no component unless there is no other id (``kept`` is then
    true). Repeated rows are vectors of their own. Other columns are not read.
    """
    spark, folder = vectors.sparkSession, scratch_folder(vectors.sparkSession)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    nonzero = F.exists("embedding", lambda x: x != 0)
    good = rows.filter(usable("embedding") & nonzero)
    distinct = good.groupBy("embedding").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies")
    )
    distinct.withColumn("node", F.monotonically_increasing_id()).write.parquet(f"{folder}/distinct")
    distinct = spark.read.parquet(f"{folder}/distinct")
    count, width = distinct.agg(F.count("*"), F.max(F.size("embedding"))).first()
    width = width or 8
    hashing = LatticeTables(width, max(count, 1), tables, probes, seed)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                x = matrix(part.column(1), width)
                x /= np.abs(x).max(1, keepdims=True)
                units = x / np.linalg.norm(x, axis=1, keepdims=True)
                small, step, error = _sketch(units)
                node = part.column(0).to_numpy()
                data = pa.array([row.tobytes() for row in small], pa.binary())
                with np.errstate(over="ignore"):
                    for own, probed in hashing.keys(units):
                        for cell, home in [(own, True), *((c, False) for c in probed.T)]:
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(cell),
                                    pa.array(node),
                                    pa.array(np.full(len(node), home)),
                                    pa.array(step),
                                    pa.array(error),
                                    data,
                                ],
                                names=["cell", "node", "home", "step", "error", "small"],
                            )

    cells = distinct.select("node", "embedding").mapInArrow(
        hashed, "cell long, node long, home boolean, step double, error double, small binary"
    )
    _found(cells, near, width).write.parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = matrix(batch.column(2), width), matrix(batch.column(3), width)
            x, y = (v / np.abs(v).max(1, keepdims=True) for v in (x, y))
            norms = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
            linked = pa.array((x * y).sum(1) / norms >= near)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(linked), batch.column(1).filter(linked)], names=["a", "b"]
            )

    left = distinct.select(F.col("node").alias("a"), F.col("embedding").alias("x"))
    right = distinct.select(F.col("node").alias("b"), F.col("embedding").alias("y"))
    doubtful = found.filter(~F.col("sure")).join(left, "a").join(right, "b")
    checked = doubtful.select("a", "b", "x", "y").mapInArrow(exact, "a long, b long")
    found.filter("sure").select("a", "b").union(checked).write.parquet(f"{folder}/links")
    links = spark.read.parquet(f"{folder}/links")

    weights = distinct.select(F.col("node").alias("b"), "copies")
    both = links.union(links.select("b", "a"))
    degree = both.join(weights, "b").groupBy(F.col("a").alias("node"))
    degree = degree.agg(F.sum("copies").alias("others"))
    label = components(links, f"{folder}/rounds")
    named = (
        distinct.join(degree, "node", "left")
        .join(label, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    least = named.groupBy("label").agg(F.min("least").alias("component"))
    named = named.join(least, "label").select(
        F.col("embedding").alias("_embedding"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
        "component",
    )
    joined = rows.join(named, F.col("embedding") == F.col("_embedding"), "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
