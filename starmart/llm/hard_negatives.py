"""Hard negatives: anchors of a cluster share one candidate list, sorted once by an angular bound."""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.vectors import matrix, usable
from starmart.plans import scratch_folder

# The clusters are fitted on so many anchors and the lists cut on so many rows, at most.
SAMPLE, MOST_CLUSTERS = 2048, 128
# Shares of a list, from its top, at which the search looks whether anyone still walks.
STOPS = (1 / 64, 1 / 16, 1 / 4)
_PART_VALUES, _LOT, _CHUNK = 1_500_000, 2048, 1024
# Added to every cosine, far above the rounding of angles.
_SLACK = 1e-6
_LEAST, _MOST = -(2**63) + 1, 2**63 - 1
_HITS = "row long, demand int, vec_id long, score long"


class Lists(NamedTuple):
    """What every task knows of the candidate lists: one per cluster of anchors."""

    centroids: np.ndarray
    spread: np.ndarray  # the largest angle between a centroid and its anchors
    stops: np.ndarray  # per cluster, the keys at which its list is cut, descending

    def keys(self, x: np.ndarray) -> np.ndarray:
        """Per vector and cluster, what no product with a unit anchor of the cluster exceeds."""
        norm = np.linalg.norm(x, axis=1)
        gap = np.maximum(angles(x, norm, self.centroids) - self.spread[None, :], 0)
        return norm[:, None] * (np.cos(gap) + _SLACK)

    def segments(self, keys: np.ndarray) -> np.ndarray:
        return (keys[:, :, None] < self.stops[None, :, :]).sum(2)


def angles(x: np.ndarray, norm: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    unit = x / np.where(norm > 0, norm, 1)[:, None]
    return np.arccos(np.clip(unit @ centroids.T, -1, 1))


def unpacked(packed: list[bytes], kind: np.dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), kind).reshape(-1, width).astype(np.float64)


def fit_centroids(x: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Unit centres by spherical k-means; the first ones are spread over the given order."""
    norm = np.linalg.norm(x, axis=1)
    unit = x[norm > 0] / norm[norm > 0][:, None]
    if not len(unit):
        return np.eye(1, x.shape[1])
    centres = unit[np.linspace(0, len(unit) - 1, min(count, len(unit))).astype(int)]
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        length = np.linalg.norm(sums, axis=1)
        centres = np.where(length[:, None] > 0, sums / np.where(length > 0, length, 1)[:, None], centres)
    return centres


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as int64; sums that doubles cannot hold are taken exactly,
    and beyond the range of a long held at its ends."""
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if largest < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(a) @ whole(b).T
    return np.clip(exact, _LEAST, _MOST).astype(np.int64)


def walk_list(
    asked: pa.Table, listed: pa.Table, kind: np.dtype, width: int, k: int, same: bool
) -> pa.Table:
    """The ``k`` best of a stretch of a list for each demand, best first, ties to smaller ids.

    The stretch is walked by descending key. A demand stops when no later product can
    reach its least score or the k-th one it has.
    """
    order = np.argsort(-listed.column("key").to_numpy(), kind="stable")
    listed = listed.take(pa.array(order))
    keys, rows = (listed.column(n).to_numpy() for n in ("key", "row"))
    labels, data = listed.column("label").to_numpy(), listed.column("v").combine_chunks()
    ids = listed.column("vec_id").combine_chunks()
    rank = np.empty(len(rows), np.int64)
    rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(rows))

    def decoded(column: pa.Array) -> np.ndarray:
        return unpacked(column.to_pylist(), kind, width)

    anchor_rows, first, owner = np.unique(
        asked.column("row").to_numpy(), return_index=True, return_inverse=True
    )
    anchors = decoded(asked.column("v").combine_chunks().take(pa.array(first)))
    anchor_labels = asked.column("label").to_numpy()[first]
    norm, least, most, need = (
        asked.column(n).to_numpy() for n in ("norm", "least", "most", "need")
    )
    need = need.copy()
    # Hits so far: the demand, its score and the place of the candidate.
    who, score, place = (np.zeros(0, np.int64) for _ in range(3))
    for low in range(0, len(rows), _CHUNK):
        open_ = np.flatnonzero(norm * keys[low] >= need)
        if not len(open_):
            break
        part = slice(low, low + _CHUNK)
        used, inner = np.unique(owner[open_], return_inverse=True)
        scores = products(anchors[used], decoded(data[part]))
        alike = anchor_labels[used][:, None] == labels[part][None, :]
        fits = (alike == same) & (anchor_rows[used][:, None] != rows[part][None, :])
        scores = np.where(fits, scores, _LEAST - 1)[inner]
        scores[(scores < least[open_][:, None]) | (scores > most[open_][:, None])] = _LEAST - 1
        top = min(k, scores.shape[1])
        bar = -np.partition(-np.maximum(scores, _LEAST), top - 1, axis=1)[:, top - 1]
        bar = np.maximum(bar, need[open_])
        row, column = np.nonzero(scores >= bar[:, None])
        who = np.concatenate((who, open_[row]))
        score = np.concatenate((score, scores[row, column]))
        place = np.concatenate((place, column + low))
        best = np.lexsort((rank[place], -score, who))
        who, score, place = who[best], score[best], place[best]
        at = np.arange(len(who)) - np.searchsorted(who, who, "left")
        full = who[at == k - 1]
        need[full] = np.maximum(need[full], score[at == k - 1])
        who, score, place = (x[at < k] for x in (who, score, place))
    return pa.table(
        {
            "row": asked.column("row").combine_chunks().take(pa.array(who)),
            "demand": asked.column("demand").combine_chunks().take(pa.array(who)),
            "vec_id": ids.take(pa.array(place)),
            "score": pa.array(score, pa.int64()),
        }
    )


class SharedLists:
    """Candidate vectors of a table in one list per cluster of its anchors, and walks along them.

    ``index`` holds every row: ``row`` (a key), ``vec_id``, ``label``, ``norm`` and the whole
    numbers ``floor(grid * x)`` packed in ``v``; ``anchors`` those of the condition with their
    cluster. Centroids and the stops of the lists are fitted on bounded samples and change
    only what is skipped, never a result.
    """

    def __init__(self, vectors: DataFrame, anchors: str, grid: int, folder: str):
        self.spark, self.folder = vectors.sparkSession, folder
        rows = vectors.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        ).filter(F.col("label").isNotNull() & usable("embedding"))
        largest = F.max(F.array_max(F.transform("embedding", F.abs)))
        width, most = rows.agg(F.max(F.size("embedding")), largest).first()
        self.width = width or 1
        fits = (most or 0) * grid + 1 < 2**15
        self.kind = np.dtype(np.int16 if fits else np.float64)
        self._part_rows = max(64, _PART_VALUES // self.width)
        self.index = self._written(self._packed(rows, grid), "index")
        self._cluster(anchors)

    def _written(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.folder}/{name}")

    def _packed(self, rows: DataFrame, grid: int) -> DataFrame:
        width, kind = self.width, self.kind

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low in range(0, batch.num_rows, 4096):
                    part = batch.slice(low, 4096)
                    x = np.floor(grid * matrix(part.column("embedding"), width))
                    v = pa.array([row.tobytes() for row in x.astype(kind)], pa.binary())
                    norm = pa.array(np.linalg.norm(x, axis=1))
                    kept = [part.column(name) for name in ("row", "vec_id", "label")]
                    yield pa.RecordBatch.from_arrays(
                        [*kept, norm, v], names=["row", "vec_id", "label", "norm", "v"]
                    )

        return rows.mapInArrow(pack, "row long, vec_id long, label long, norm double, v binary")

    def _sample(self, frame: DataFrame) -> np.ndarray:
        found = frame.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").collect()
        return unpacked([bytes(row.v) for row in found], self.kind, self.width)

    def _cluster(self, condition: str) -> None:
        chosen = self.index.filter(condition)
        count = chosen.count()
        wanted = min(MOST_CLUSTERS, max(1, round(sqrt(count) / 2)))
        centroids = fit_centroids(self._sample(chosen), wanted)
        kind, width = self.kind, self.width

        def values(column: pa.Array) -> np.ndarray:
            return unpacked(column.to_pylist(), kind, width)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = values(batch.column("v"))
                far = angles(x, np.linalg.norm(x, axis=1), centroids)
                cluster = far.argmin(1)
                angle = far[np.arange(len(x)), cluster]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cluster.astype(np.int32)), pa.array(angle)],
                    names=[*batch.schema.names, "cluster", "angle"],
                )

        schema = "row long, vec_id long, label long, norm double, v binary, cluster int, angle double"
        self.anchors = self._written(chosen.mapInArrow(place, schema), "anchors")
        spread = np.zeros(len(centroids))
        for row in self.anchors.groupBy("cluster").agg(F.max("angle").alias("most")).collect():
            spread[row.cluster] = row.most
        lists = Lists(centroids, spread, np.zeros((len(centroids), len(STOPS))))
        keys = lists.keys(self._sample(self.index))
        if len(keys):
            lists = lists._replace(stops=np.quantile(keys, 1 - np.array(STOPS), axis=0).T)
        self.lists = lists

        def count_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            segments = len(STOPS) + 1
            found, top = np.zeros((len(centroids), segments), np.int64), np.zeros(len(centroids))
            for batch in batches:
                keys = lists.keys(values(batch.column("v")))
                top = np.maximum(top, keys.max(0, initial=0))
                for number, column in enumerate(lists.segments(keys).T):
                    found[number] += np.bincount(column, minlength=segments)
            cluster, segment = np.nonzero(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cluster.astype(np.int32)),
                    pa.array(segment.astype(np.int32)),
                    pa.array(found[cluster, segment]),
                    pa.array(top[cluster]),
                ],
                names=["cluster", "segment", "rows", "top"],
            )

        counted = self.index.select("v").mapInArrow(
            count_segments, "cluster int, segment int, rows long, top double"
        )
        self._rows: dict[tuple[int, int], int] = {}
        self._top = np.zeros(len(centroids))
        totals = counted.groupBy("cluster", "segment").agg(
            F.sum("rows").alias("rows"), F.max("top").alias("top")
        )
        for row in totals.collect():
            self._rows[row.cluster, row.segment] = row.rows
            self._top[row.cluster] = max(self._top[row.cluster], row.top)

    def _upper(self, segment: int) -> np.ndarray:
        return self._top if segment == 0 else self.lists.stops[:, segment - 1]

    def _sent(self, segment: int, needs: dict[int, tuple[float, int]]) -> DataFrame:
        """The candidates of a segment, dealt to the parts and lots of clusters that still walk."""
        lists, part_rows, counted = self.lists, self._part_rows, self._rows
        kind, width = self.kind, self.width

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = lists.keys(unpacked(batch.column("v").to_pylist(), kind, width))
                at = lists.segments(keys)
                row = batch.column("row").to_numpy()
                # Fibonacci hashing: the high bits of the product are spread evenly.
                mixed = (row.astype(np.uint64) * np.uint64(11400714819323198485)) >> np.uint64(32)
                for cluster, (need, lots) in needs.items():
                    found = np.flatnonzero((at[:, cluster] == segment) & (keys[:, cluster] >= need))
                    parts = -(-counted.get((cluster, segment), 1) // part_rows)
                    part = (mixed[found] % np.uint64(parts)).astype(np.int32)
                    for lot in range(lots if len(found) else 0):
                        taken = batch.take(pa.array(found))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(found), cluster, np.int32)),
                                pa.array(part),
                                pa.array(np.full(len(found), lot, np.int32)),
                                *[taken.column(n) for n in ("row", "vec_id", "label", "v")],
                                pa.array(keys[found, cluster]),
                            ],
                            names=["cluster", "part", "lot", "row", "vec_id", "label", "v", "key"],
                        )

        return self.index.mapInArrow(
            send,
            "cluster int, part int, lot int, row long, vec_id long, label long, v binary, key double",
        )

    def _per_cluster(self, numbers: np.ndarray) -> Column:
        """The number of a row's cluster."""
        listed = F.array(*[F.lit(float(x)) for x in numbers])
        return F.element_at(listed, F.col("cluster") + 1)

    def walk(self, demands: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        """``row, demand, rank, vec_id, score``: the ``k`` best candidates of every demand.

        ``demands`` has ``row`` and ``demand`` (a key), an anchor's ``label``, ``norm``, ``v`` and
        ``cluster``, and the ``least`` and ``most`` score wanted. Candidates are rows of the
        same label as the anchor, or of others, never the anchor's own row. The lists are walked
        segment by segment; a demand goes on while the bound at the next segment's top reaches
        its least score and its k-th one.
        """
        demands = self._written(demands, f"{name}-demands")
        hits = self.spark.createDataFrame([], _HITS)
        best = Window.partitionBy("row", "demand").orderBy(
            F.col("score").desc(), F.col("vec_id").asc_nulls_last()
        )
        kind, width = self.kind, self.width

        def score(asked: pa.Table, listed: pa.Table) -> pa.Table:
            return walk_list(asked, listed, kind, width, k, same)

        for segment in range(len(STOPS) + 1):
            reached = hits.groupBy("row", "demand").agg(
                F.count("*").alias("_n"), F.min("score").alias("_kth")
            )
            known = reached.filter(F.col("_n") == k).drop("_n")
            need = F.greatest(F.col("least"), F.coalesce(F.col("_kth"), F.col("least")))
            upper = self._per_cluster(self._upper(segment))
            walking = (
                demands.join(known, ["row", "demand"], "left")
                .withColumn("need", need)
                .filter(F.col("norm") * upper >= F.col("need"))
            )
            walking = self._written(walking.drop("_kth"), f"{name}-walking-{segment}")
            least_key = F.when(F.col("norm") > 0, F.col("need") / F.col("norm"))
            least_key = F.min(F.coalesce(least_key, F.lit(float("-inf"))))
            clusters = walking.groupBy("cluster").agg(F.count("*").alias("n"), least_key.alias("key"))
            needs = {r.cluster: (r.key, -(-r.n // _LOT)) for r in clusters.collect()}
            if not needs:
                break
            sizes = np.zeros((2, len(self.lists.centroids)))
            for cluster, (_, lots) in needs.items():
                rows = self._rows.get((cluster, segment), 0)
                sizes[:, cluster] = max(1, -(-rows // self._part_rows)), lots
            parts, lots = (self._per_cluster(x).cast("int") for x in sizes)
            asking = walking.withColumn(
                "part", F.explode(F.sequence(F.lit(0), parts - 1))
            ).withColumn("lot", F.pmod(F.xxhash64("row", "demand"), lots).cast("int"))
            group = ["cluster", "part", "lot"]
            asked = asking.groupBy(*group)
            found = asked.cogroup(self._sent(segment, needs).groupBy(*group)).applyInArrow(score, _HITS)
            ranked = hits.unionByName(found).withColumn("_rank", F.row_number().over(best))
            kept = ranked.filter(F.col("_rank") <= k).drop("_rank")
            hits = self._written(kept, f"{name}-hits-{segment}")
        return hits.withColumn("rank", F.row_number().over(best))


def mine_hard_negatives(
    vectors: DataFrame,
    anchors: str = "vec_id % 100 = 0",
    positives: int = 5,
    negatives: int = 10,
    band: tuple[int, int] = (30, 90),
    grid: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(grid * x)``; scores are integer inner products. The positives of
    a row that meets ``anchors`` are the ``positives`` best other rows of its label (all, if
    fewer). For each of them the ``negatives`` best rows of other labels follow whose score
    lies within ``band`` percent of the positive's. Higher scores come first, ties by smaller
    ``vec_id``. Exact.

    Anchors are clustered by angle. For each cluster all rows are keyed once by
    ``norm * cos(angle to the centroid - the cluster's spread)``, which no member's score divided
    by the member's norm exceeds, and form one list by descending key; members walk it in
    stretches, which lie in many tasks, until the next key certifies that nothing better follows. Lists
    are split by a hash of the row and anchors into lots, so hot clusters, labels and vectors
    are spread.

    Rows with a null label or vector, an empty vector, or a null or non-finite component take
    no part. A null id is no anchor; as a candidate it comes last among ties. Rows that repeat an
    id, with the same vector or another, are rows of their own: only an anchor's own row is
    excluded. Shorter vectors end in zeros. Scores beyond a long are held at its ends. A
    positive with a negative score has an empty band. Empty tables give no rows; other columns
    are not read.
    """
    lists = SharedLists(vectors, anchors, grid, scratch_folder(vectors.sparkSession))
    asker = ["row", "label", "norm", "v", "cluster"]
    any_score = [F.lit(_LEAST).alias("least"), F.lit(_MOST).alias("most")]
    wanted = lists.anchors.select(*asker, F.lit(0).alias("demand"), *any_score)
    found = lists.walk(wanted, positives, same=True, name="positives")

    def percent(share: int) -> Column:
        return F.col("positive_score").cast("decimal(20,0)") * share / 100

    pairs = (
        found.select(
            "row",
            F.col("rank").alias("demand"),
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        .join(lists.anchors.withColumnRenamed("vec_id", "anchor_id"), "row")
        .withColumn("least", F.ceil(percent(band[0])).cast("long"))
        .withColumn("most", F.floor(percent(band[1])).cast("long"))
        .filter(F.col("least") <= F.col("most"))
    )
    told = ["anchor_id", "positive_id", "positive_score"]
    pairs = lists._written(pairs.select(*asker, "demand", "least", "most", *told), "pairs")
    mined = lists.walk(pairs.drop(*told), negatives, same=False, name="negatives")
    return mined.join(pairs.select("row", "demand", *told), ["row", "demand"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
