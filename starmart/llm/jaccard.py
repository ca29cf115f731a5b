"""Exact Jaccard join of word shingle sets in metric space."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from functools import cache
from math import ceil, exp, floor, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.graph import components
from starmart.llm.words import forget_kept, slices, split_words
from starmart.plans import scratch_folder

_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
     0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    dtype=np.uint64,
)
# A region whose sets have more entries than this is split before it is joined.
REGION_ENTRIES = 6_000_000
_PART_ENTRIES = 500_000
_PIVOTS, _SPLITS = 8, 3
# How often sets without enough keys in common with others are left out.
_ROUNDS = 2
# Links of a pivot from which on the windows of all other sets are worth looking at.
_DENSE = 8


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a shorter text is one shingle."""
    if not len(words):
        return words
    width = min(size, len(words))
    total = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for i in range(width):
        total += _mix(words[i : len(words) - width + 1 + i] * _MULTIPLIERS[i % 8] + np.uint64(i))
    return np.unique(_mix(total + np.uint64(width)))


def _sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and shingle set of each text."""
    import xxhash

    forget_kept()

    for low, some in slices(texts):
        distinct, places, bounds = split_words(pc.ascii_lower(some))
        hashes = (xxhash.xxh64_intdigest(word) for word in distinct)
        words = np.fromiter(hashes, np.uint64, len(distinct))[places]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            yield low + i, _shingles(words[a:b], size)


def _fingerprint(shingles: np.ndarray) -> bytes | None:
    if not len(shingles):
        return None
    halves = [np.add.reduce(_mix(shingles * m)) for m in _MULTIPLIERS[:2]]
    return np.array([*halves], dtype=np.uint64).tobytes()


class Signatures:
    """Keys of which any two sets with Jaccard similarity ``near`` or more share at least one.

    Two such sets of together ``s`` elements differ in at most ``(1 - near) / (1 + near) * s``.
    Cut all elements by hash into more buckets than that, and in one bucket the sets are equal:
    each bucket that is not empty gives a key. Buckets depend on a class of sizes; sets near the
    border of two classes also give the keys of the border. Spare buckets make up for those empty in
    both sets; a set with more empty buckets than spare ones adds the elements that its
    similarity cannot do without (all but the largest ``ceil(near * size) - 1``).

    With spare buckets more than one is equal: each that is neither differing nor empty in both. A set
    needs as many keys in common with another as ``signed`` says; the last two bits of a key tell to
    which of the set's sizes or borders it belongs.
    """

    def __init__(self, near: Fraction):
        self._near = near
        self._starts = [1]

    @cache
    def _buckets(self, low: int, high_sum: Fraction) -> tuple[int, int]:
        need = floor((1 - self._near) / (1 + self._near) * high_sum) + 1
        empty = need * exp(-low / need)
        spare = ceil(empty + 3 * sqrt(empty)) if need > 1 else 0
        return need + spare, spare

    def _keys(self, size: int) -> Iterator[tuple[int, int, int]]:
        """Number of a key, its buckets and how many of them are spare."""
        starts = self._starts
        while starts[-1] <= size:
            starts.append(max(starts[-1] + 1, ceil(Fraction(3, 2) * starts[-1])))
        k = bisect_right(starts, size)
        low, top = starts[k - 1], starts[k] - 1
        yield 2 * k, *self._buckets(low, Fraction(2 * top))
        for border, below in ((k - 1, starts[k - 1] - 1), (k, top)):
            if not below:
                continue
            above = below / self._near
            least = ceil(self._near * (below + 1))
            if least <= size <= above:
                yield 2 * border + 1, *self._buckets(least, below + above)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        return self.signed(shingles)[0]

    def signed(self, shingles: np.ndarray) -> tuple[np.ndarray, int]:
        """The keys of a set, and how many it needs of each kind: six bits for each value of a key's last two."""
        size, found, needs, poor = len(shingles), [], [1] * 4, False
        with np.errstate(over="ignore"):
            for key, buckets, spare in self._keys(size):
                bucket = (shingles >> np.uint64(16)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                inside = bucket[order]
                heads = np.flatnonzero(np.diff(inside, prepend=np.uint64(buckets)))
                sums = np.add.reduceat(_mix(shingles[order] + np.uint64(key)), heads)
                names = _mix(sums + (inside[heads] << np.uint64(16)) * _MULTIPLIERS[2])
                found.append(names & ~np.uint64(3) | np.uint64(key % 4))
                empty = buckets - len(heads)
                needs[key % 4] = min(63, max(1, spare + 1 - empty))
                poor |= empty > spare
            if poor:
                needed = size - ceil(self._near * size) + 1
                found.append(_mix(shingles[:needed] ^ _MULTIPLIERS[3]))
                needs = [1] * 4
        return np.concatenate(found).view(np.int64), sum(n << 6 * i for i, n in enumerate(needs))


def near_classes(
    fingerprints: list[bytes], sets: list[np.ndarray], near: Fraction
) -> list[tuple[bytes, bytes]]:
    """Each set of a region with the first set of its class (sets that links connect).

    Pivots are taken in turn. The sets that may link to a pivot hold one of its rarest elements,
    as many as its similarity cannot do without; an inverted index gives them, and those near
    enough join its class. If they are several, the distances of all sets to the pivot are taken:
    since the distance is a metric, a set can only link to sets whose distance to the pivot
    differs by no more than the join's own distance. Once all sets in that window are of its class,
    a set needs no further look.
    """
    order = sorted(range(len(sets)), key=lambda i: fingerprints[i])
    first: dict[bytes, int] = {}
    order = [i for i in order if first.setdefault(fingerprints[i], i) == i]
    sizes = np.array([len(sets[i]) for i in order], dtype=np.int64)
    count = len(order)
    _, element = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    element = element.astype(np.int32)
    members = np.repeat(np.arange(count, dtype=np.int32), sizes)
    members = members[np.argsort(element, kind="stable")]
    holders = np.bincount(element)
    lists = np.concatenate(([0], np.cumsum(holders)))
    ends = np.cumsum(sizes)
    reach = float(1 - near) + 1e-9
    label = np.arange(count)
    settled = np.zeros(count, dtype=bool)

    def held_by(elements: np.ndarray) -> np.ndarray:
        starts, lengths = lists[elements], holders[elements]
        before = np.cumsum(lengths) - lengths
        return members[np.repeat(starts - before, lengths) + np.arange(lengths.sum())]

    for pivot in range(count):
        if settled[pivot]:
            continue
        settled[pivot] = True
        size = sizes[pivot]
        mine = element[ends[pivot] - size : ends[pivot]]
        needed = size - ceil(near * size) + 1
        rare = mine[np.argpartition(holders[mine], needed - 1)[:needed]]
        may = np.unique(held_by(rare))
        may = may[(sizes[may] >= near * size) & (sizes[may] * near <= size)]
        if len(may) < _DENSE:
            for other in may[may != pivot]:
                its = element[ends[other] - sizes[other] : ends[other]]
                both = len(np.intersect1d(mine, its, assume_unique=True))
                if both * near.denominator >= (size + sizes[other] - both) * near.numerator:
                    label[label == label[other]] = label[pivot]
            continue
        common = np.bincount(held_by(mine), minlength=count)
        union = sizes + size - common
        linked = common * near.denominator >= union * near.numerator
        touched = np.unique(label[linked])
        label[np.isin(label, touched)] = touched[0]
        if linked.sum() < _DENSE:
            continue
        distance = 1 - common / union
        ranked = np.argsort(distance, kind="stable")
        near_first, classes = distance[ranked], label[ranked]
        changes = np.concatenate(([0], np.cumsum(classes[1:] != classes[:-1])))
        low = np.searchsorted(near_first, near_first - reach, "left")
        high = np.searchsorted(near_first, near_first + reach, "right") - 1
        settled[ranked[changes[high] == changes[low]]] = True
    return [(fingerprints[i], fingerprints[order[label[at]]]) for at, i in enumerate(order)]


def _distances(set_: np.ndarray, pivots: list[np.ndarray]) -> np.ndarray:
    common = np.array([len(np.intersect1d(set_, p, assume_unique=True)) for p in pivots])
    return 1 - common / (np.array([len(p) for p in pivots]) + len(set_) - common)


def _split(regions: DataFrame, large: DataFrame, near: Fraction) -> DataFrame:
    """Voronoi cells of the large regions, each set in every cell that may hold one it links to.

    The pivots of a region are the sets with the lowest hash. With ``r`` the join's distance, sets
    nearer than ``1 - r`` to a pivot live in the cell of their nearest pivot, the others in a far
    cell. By the triangle inequality a set can only link to sets of another pivot's cell if it is at most
    ``2 r`` farther from that pivot than from its own and nearer than 1 to it, and to sets of the far
    cell if it is no nearer than ``1 - 2 r`` to any pivot: there it is copied to. A region is dealt
    to tasks by its size, each with all pivots.
    """
    parts = large.withColumn("parts", F.ceil(F.col("entries") / _PART_ENTRIES).cast("long"))
    inside = regions.join(parts, "region").withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("parts"))
    )
    first = Window.partitionBy("region").orderBy(F.xxhash64("fp", "region"), "fp")
    pivots = (
        inside.withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= _PIVOTS)
        .select(
            F.col("region").alias("_region"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("_part"),
            F.col("shingles").alias("pivot"),
            F.col("_rank").alias("rank"),
        )
    )
    apart = float(1 - near) + 1e-9

    def deal(key, rows: pa.Table, centres: pa.Table) -> pa.Table:
        ranks = centres.column("rank").to_pylist()
        seen = dict(zip(ranks, centres.column("pivot").to_pylist()))
        pivot = [np.frombuffer(seen[rank], np.uint64) for rank in sorted(seen)]
        names, taken = [], []
        region = key[0].as_py()
        for row, data in enumerate(rows.column("shingles").to_pylist()):
            far = _distances(np.frombuffer(data, np.uint64), pivot)
            nearest = far.min()
            cells = np.flatnonzero((far <= nearest + 2 * apart) & (far < 1))
            names += [f"{region}/{cell}" for cell in cells]
            if nearest >= 1 - 2 * apart:
                names.append(f"{region}/far")
            taken += [row] * (len(names) - len(taken))
        copies = rows.select(["fp", "shingles"]).take(pa.array(taken, pa.int64()))
        return copies.add_column(0, "region", pa.array(names, pa.string()))

    return (
        inside.select("region", "part", "fp", "shingles")
        .groupBy("region", "part")
        .cogroup(pivots.groupBy("_region", "_part"))
        .applyInArrow(deal, "region string, fp binary, shingles binary")
    )


def _in_blocks(regions: DataFrame, large: DataFrame, entries: int) -> DataFrame:
    """Large regions as pairs of blocks: any two sets of a region meet in one pair."""
    blocks = F.ceil(F.col("entries") / (entries / 2)).cast("long")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pair = F.concat_ws(
        "+",
        F.col("region"),
        F.least("block", "other").cast("string"),
        F.greatest("block", "other").cast("string"),
    )
    return (
        regions.join(large.withColumn("blocks", blocks), "region")
        .withColumn("block", block)
        .withColumn("other", other)
        .select(pair.alias("region"), "fp", "shingles")
    )


def _classes(members: DataFrame, near: Fraction, folder: str, entries: int) -> DataFrame:
    """``fp, label``: the class of every set in ``members`` (``region, fp, shingles``)."""
    spark = members.sparkSession

    def keep(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def sizes(frame: DataFrame) -> DataFrame:
        grouped = frame.groupBy("region").agg(F.sum(F.octet_length("shingles") / 8).alias("entries"))
        return grouped.filter(F.col("entries") > entries)

    def link(rows: pa.Table) -> pa.Table:
        fps = rows.column("fp").to_pylist()
        sets = [np.frombuffer(data, np.uint64) for data in rows.column("shingles").to_pylist()]
        fp, label = zip(*near_classes(fps, sets, near))
        return pa.table({"a": pa.array(fp, pa.binary()), "b": pa.array(label, pa.binary())})

    def joined(frame: DataFrame) -> DataFrame:
        return frame.groupBy("region").applyInArrow(link, "a binary, b binary")

    regions = keep(members, "regions")
    large = sizes(regions)
    if large.isEmpty():
        return joined(regions).select(F.col("a").alias("fp"), F.col("b").alias("label"))
    links = [joined(regions.join(large, "region", "left_anti"))]
    total = large.agg(F.sum("entries")).first()[0]
    for level in range(_SPLITS):
        regions = keep(_split(regions, large, near), f"cells-{level}")
        large = sizes(regions)
        links.append(joined(regions.join(large, "region", "left_anti")))
        before, total = total, large.agg(F.sum("entries")).first()[0] or 0
        if not total:
            break
        if level == _SPLITS - 1 or total > before / 2:  # pivots do not separate what is left
            links.append(joined(_in_blocks(regions, large, entries)))
            break
    edges = links[0]
    for more in links[1:]:
        edges = edges.union(more)
    found = components(keep(edges, "links"), f"{folder}/classes")
    return found.select(F.col("node").alias("fp"), "label")


def _keyed(texts: DataFrame, shingle_words: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, fp`` of rows ``doc_id, text_hash, text``."""

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, fps = [], []
            with np.errstate(over="ignore"):
                for _, found in _sets(batch.column(2), shingle_words):
                    sizes.append(len(found))
                    fps.append(_fingerprint(found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(fps, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "fp"],
            )

    return texts.mapInArrow(fingerprint, "doc_id long, text_hash long, n_shingles long, fp binary")


def _row_key(doc_id, text_hash) -> list:
    """Three columns equal for rows of the same id and text only; without nulls, for joins."""
    return [
        F.coalesce(doc_id, F.lit(0)).alias("_id"),
        doc_id.isNull().cast("int").alias("_no_id"),
        text_hash.alias("_text_hash"),
    ]


_ROW_KEY = ["_id", "_no_id", "_text_hash"]


def _class_table(
    docs: DataFrame, shingle_words: int, near: Fraction, entries: int, folder: str
) -> tuple[DataFrame, DataFrame]:
    """Rows as ``_keyed`` gives them; and the class (``fp, label``) of sets that may link."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text")
    )

    keyed = _keyed(texts, shingle_words)
    keyed.write.parquet(f"{folder}/keyed")
    keyed = spark.read.parquet(f"{folder}/keyed")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures(near)
        for batch in batches:
            fps, keys, needs = [], [], []
            with np.errstate(over="ignore"):
                for _, found in _sets(batch.column(0), shingle_words):
                    if len(found):
                        fps.append(_fingerprint(found))
                        key, need = signatures.signed(found)
                        keys.append(key)
                        needs.append(need)
                    if len(keys) >= 2000:
                        yield _listed(fps, keys, needs)
                        fps, keys, needs = [], [], []
            if keys:
                yield _listed(fps, keys, needs)

    def _listed(fps: list[bytes], keys: list[np.ndarray], needs: list[int]) -> pa.RecordBatch:
        offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)))
        columns = [pa.array(fps, pa.binary()), lists, pa.array(needs, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=["fp", "keys", "needs"])

    # Regions are found over names of the sets, of 58 bits: rows of signatures are many, and names half of
    # each. The other six bits say how many keys of its kind a set needs in common with others.
    name = F.xxhash64("fp").bitwiseAND(F.lit(-64)).alias("name")
    signed = texts.select("text").mapInArrow(sign, "fp binary, keys array<long>, needs int")
    once = signed.groupBy(F.xxhash64("fp").alias("full")).agg(
        F.first(F.struct("keys", "needs")).alias("first")
    )
    need = F.expr("shiftright(needs, CAST(6 * (key & 3) AS INT)) & 63").cast("long")
    rows = (
        once.select("full", "first.needs", F.explode("first.keys").alias("key"))
        .select(F.col("full").bitwiseAND(F.lit(-64)).bitwiseOR(need).alias("set"), "key")
    )
    together = Window.partitionBy("key")

    def several(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_n", F.count("*").over(together)).filter("_n > 1").drop("_n")

    several(rows).write.parquet(f"{folder}/shared-0")
    # A set with fewer keys in common with others than it needs links to none of them; nor do its keys count then.
    for number in range(1, _ROUNDS + 1):
        shared = spark.read.parquet(f"{folder}/shared-{number - 1}")
        kind = Window.partitionBy("set", F.expr("key & 3"))
        enough = shared.withColumn("_n", F.count("*").over(kind)).filter("_n >= (set & 63)").drop("_n")
        several(enough).write.parquet(f"{folder}/shared-{number}")
    shared = spark.read.parquet(f"{folder}/shared-{_ROUNDS}")
    candidates = (
        shared.select(F.col("set").bitwiseAND(F.lit(-64)).alias("name"), "key")
        .withColumn("b", F.min("name").over(together))
        .filter(F.col("name") != F.col("b"))
        .select(F.col("name").alias("a"), "b")
        .distinct()
    )
    candidates.write.parquet(f"{folder}/candidates")
    regions = components(spark.read.parquet(f"{folder}/candidates"), f"{folder}/candidate-rounds")
    regions = regions.select(F.col("node").alias("name"), F.col("label").cast("string").alias("region"))

    # One row's text for each set of a region; rows of one id, or without, are told apart by their texts.
    firsts = keyed.groupBy("fp").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    chosen = firsts.withColumn("name", name).join(regions, "name").select(
        *_row_key(F.col("first.doc_id"), F.col("first.text_hash")), F.col("fp").alias("_fp"), "region"
    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, region = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            rows: list[tuple] = []
            with np.errstate(over="ignore"):
                for i, found in _sets(batch.column(0), shingle_words):
                    if _fingerprint(found) == wanted[i]:
                        rows.append((region[i], wanted[i], found.tobytes()))
            if rows:
                kinds = (pa.string(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    names=["region", "fp", "shingles"],
                )

    members = (
        texts.select("text", *_row_key(F.col("doc_id"), F.col("text_hash")))
        .join(chosen, _ROW_KEY)
        .select("text", "_fp", "region")
        .mapInArrow(fetch, "region string, fp binary, shingles binary")
    )
    classes = _classes(members, near, folder, entries)
    return keyed, classes


def jaccard_join(
    docs: DataFrame,
    shingle_words: int = 5,
    near: Fraction = Fraction(4, 5),
    entries: int = REGION_ENTRIES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: classes of near-duplicate texts.

    A text's set holds its distinct shingles of ``shingle_words`` words (A-Z lowered, cut at ASCII
    white space); a shorter text is one shingle. Two texts link if the Jaccard similarity of
    their sets is ``near`` or more, decided with whole numbers; ``component_id`` is the smallest
    ``doc_id`` that links reach. The result is exact, up to collisions of 64-bit hashes.

    1. Equal sets are one set. 2. Sets that share no shingle have distance 1, of which no triangle
    inequality says anything; so regions are first cut by ``Signatures``: sets that share one, directly or
    over others, are a region. 3. Regions too large for a task are split into the Voronoi cells
    of pivots, border sets being copied by the triangle inequality, recursively; what pivots
    cannot split is joined in pairs of blocks. 4. Each region is joined by ``near_classes``.

    Null texts and texts without words have no set: they link to nothing, ``n_shingles`` is 0. A null
    ``doc_id`` takes part but never names a component unless there is no other. Repeated rows are
    returned as often as they come. Other columns, whatever their names, are not read. An
    empty table gives no rows.
    """
    folder = scratch_folder(docs.sparkSession)
    keyed, classes = _class_table(docs, shingle_words, near, entries, folder)
    named = keyed.join(classes.withColumnRenamed("fp", "_fp"), F.col("fp") == F.col("_fp"), "left")
    named = named.select("doc_id", "n_shingles", F.coalesce("label", "fp").alias("label"))
    least = named.filter(F.col("label").isNotNull()).groupBy("label")
    least = least.agg(F.min("doc_id").alias("_least")).withColumnRenamed("label", "_label")
    return named.join(least, F.col("label") == F.col("_label"), "left").select(
        "doc_id", "n_shingles", F.coalesce("_least", "doc_id").alias("component_id")
    )


def keep_one_of_each(
    docs: DataFrame,
    shingle_words: int = 5,
    near: Fraction = Fraction(4, 5),
    entries: int = REGION_ENTRIES,
) -> DataFrame:
    """One row, all columns unchanged, of each class that ``jaccard_join`` finds.

    The row with the smallest ``doc_id`` stays (null last; of several such rows, any). Rows without words are
    linked to nothing and all stay.
    """
    folder = scratch_folder(docs.sparkSession)
    keyed, classes = _class_table(docs, shingle_words, near, entries, folder)
    firsts = keyed.filter(F.col("fp").isNotNull()).groupBy("fp")
    firsts = firsts.agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"))
    classes = classes.withColumnRenamed("fp", "_fp")
    firsts = firsts.join(classes, F.col("fp") == F.col("_fp"), "left")
    chosen = firsts.groupBy(F.coalesce("label", "fp").alias("label")).agg(F.min("first").alias("best"))
    chosen = chosen.select(*_row_key(F.col("best.doc_id"), F.col("best.text_hash")))

    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.filter(words).select(
        F.struct("*").alias("row"), *_row_key(F.col("doc_id").cast("long"), F.xxhash64("text"))
    )
    # Copies go before rows of one id and text, if there are several, become one.
    stay = rows.join(chosen, _ROW_KEY, "left_semi").groupBy(*_ROW_KEY).agg(F.first("row").alias("row"))
    return stay.select("row.*").union(docs.filter(~words))
