"""Document fingerprints by locally consistent parsing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.plans import scratch_folder

# Phrases of this level and above enter the sketch; a level's phrases are about three times as long
# as those of the level below.
FIRST_LEVEL = 2
SLOTS = 128
_EMPTY = np.uint16(0xFFFF)
_SLICE_CHARS = 1 << 20
_U = np.uint64
# Odd multipliers of the hashes.
_MIX, _RADIX, _RUN = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93), _U(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _MIX
    x ^= x >> _U(29)
    x *= _RUN
    x ^= x >> _U(32)
    return x


def _toss_table(size: int) -> np.ndarray:
    """Per pair (left, own) of labels below ``size``: twice the lowest bit in which own differs
    from left, plus that bit of own."""
    left, own = np.divmod(np.arange(size * size), size)
    differs = left ^ own
    place = np.bitwise_count((differs & -differs) - 1)
    return (2 * place + ((own >> place) & 1)).astype(np.uint8)


_TOSSES = [(size, _toss_table(size)) for size in (128, 14, 8)]


class _Powers:
    """Powers of the radix and of its inverse modulo 2**64, as far as a slice needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def reach(self, count: int) -> None:
        if len(self.up) < count:
            inverse = _U(pow(int(_RADIX), -1, 1 << 64))
            for name, step in (("up", _RADIX), ("down", inverse)):
                factors = np.full(count, step, _U)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))


_POWERS = _Powers()


def _labels(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Deterministic coin tossing: labels below 6 that differ from their left neighbours'.

    Each depends on the name and the four before it, so equal stretches are labelled alike.
    """
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[starts] = 0
    left ^= names
    left &= ~left + _U(1)  # the lowest bit that differs
    place = np.bitwise_count(left - _U(1))
    labels = ((place << 1) | ((names & left) != 0)) & np.uint8(127)
    for size, table in _TOSSES:
        pair = np.empty(len(labels), np.uint16)
        pair[1:] = labels[:-1]
        pair[starts] = labels[starts] ^ 1
        pair *= np.uint16(size)
        pair += labels
        labels = table[pair]
    return labels


def _next_level(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and text starts of the phrases that the names of each text are parsed into.

    Runs of one name become one name first. Phrases then begin at each text's start and where a
    label is above both neighbours', inside the text.
    """
    first = np.empty(len(names), bool)
    first[0] = True
    np.not_equal(names[1:], names[:-1], out=first[1:])
    first[starts] = True
    begins = np.flatnonzero(first)
    if len(begins) < len(names):
        lengths = np.diff(begins, append=len(names))
        starts = np.searchsorted(begins, starts)
        names = names[begins]
        runs = np.flatnonzero(lengths > 1)
        names[runs] = _mixed(names[runs] + lengths[runs].astype(_U) * _RUN)
    labels = _labels(names, starts)
    phrase = np.zeros(len(names), bool)
    phrase[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    phrase[starts[1:] - 1] = False  # the last name of a text has no right neighbour
    phrase[starts] = True
    begins = np.flatnonzero(phrase)
    _POWERS.reach(len(names))
    sums = np.add.reduceat(names * _POWERS.up[: len(names)], begins)
    return _mixed(sums * _POWERS.down[begins]), np.searchsorted(begins, starts)


def parse_levels(texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(numbers, starts, names)`` of each level: the texts still parsed and their phrases' names.

    Level 0 is the code points. A text is parsed until a single name is left, its root.
    Empty texts do not appear.
    """
    sizes = np.array([len(text) for text in texts], np.int64)
    numbers = np.flatnonzero(sizes)
    if not len(numbers):
        return
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    names = _mixed(points.astype(_U) + _U(1))
    starts = np.cumsum(sizes[numbers]) - sizes[numbers]
    while True:
        yield numbers, starts, names
        counts = np.diff(starts, append=len(names))
        if counts.max() == 1:
            return
        if counts.min() == 1:
            names = names[np.repeat(counts > 1, counts)]
            numbers, counts = numbers[counts > 1], counts[counts > 1]
            starts = np.cumsum(counts) - counts
        names, starts = _next_level(names, starts)


def sketch(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The root name of each text and 16 bits for each slot of its sketch.

    A slot keeps the phrase with the least hash of those it is responsible for (one-permutation
    MinHash over the names of ``FIRST_LEVEL`` and above, and the root).
    """
    roots = np.zeros(len(texts), _U)
    least = np.full((len(texts), SLOTS), np.iinfo(_U).max, _U)

    def enter(numbers: np.ndarray, names: np.ndarray) -> None:
        hashed = _mixed(names + _U(1))
        np.minimum.at(least, (numbers, (hashed % _U(SLOTS)).astype(np.int64)), hashed)

    for level, (numbers, starts, names) in enumerate(parse_levels(texts)):
        counts = np.diff(starts, append=len(names))
        done = counts == 1
        roots[numbers[done]] = names[starts[done]]
        if level >= FIRST_LEVEL:
            enter(np.repeat(numbers, counts), names)
        else:
            enter(numbers[done], names[starts[done]])
    filled = least != np.iinfo(_U).max
    values = (_mixed(least) % _U(0xFFFF)).astype(np.uint16)
    return roots, np.where(filled, values, _EMPTY)


def packed(roots: np.ndarray, slots: np.ndarray) -> list[bytes]:
    """Fingerprints as bytes; as texts they are the hex digits of these."""
    rows = zip(roots.astype(">u8"), slots.astype(">u2"))
    return [root.tobytes() + row.tobytes() for root, row in rows]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The estimated share of common phrases of each pair of sketches: 1 for equal texts."""
    either = (a[1] != _EMPTY) | (b[1] != _EMPTY)
    same = (a[1] == b[1]) & either
    shares = same.sum(1) / np.maximum(either.sum(1), 1)
    return np.where(a[0] == b[0], 1.0, shares)


def read_fingerprints(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The sketches that fingerprints hold, for ``likeness``."""
    roots = np.array([int(text[:16], 16) for text in texts], _U)
    slots = np.frombuffer(bytes.fromhex("".join(text[16:] for text in texts)), ">u2")
    return roots, slots.astype(np.uint16).reshape(-1, SLOTS)


def _runs(texts: Sequence[str]) -> Iterator[slice]:
    """Slices of texts of about ``_SLICE_CHARS`` code points, or one longer text."""
    ends = np.cumsum([len(text) for text in texts])
    low = 0
    while low < len(texts):
        reached = (ends[low - 1] if low else 0) + _SLICE_CHARS
        high = max(low + 1, int(np.searchsorted(ends, reached, "right")))
        yield slice(low, high)
        low = high


def fingerprint(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column`` and ``fingerprint`` of every whole text; a null is as an empty text.

    Texts are parsed level by level into phrases whose ends deterministic coin tossing finds from
    the few names around them, so equal substrings fall into equal phrases inside whatever
    surrounds them. A phrase is named by a hash of its names, and a fingerprint is the
    root's name (16 hex digits) and ``SLOTS`` numbers of 4 digits that sketch the set of names.
    Equal texts have equal fingerprints. Memory grows with a slice of texts or the
    longest single text. Repeated rows and null ids stay rows. Other columns are not read.
    """
    kind = dict(docs.select(id_column).dtypes)[id_column]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            for part in _runs(texts):
                prints = [print_.hex() for print_ in packed(*sketch(texts[part]))]
                ids = batch.column(0).slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([ids, pa.array(prints)], names=["id", "fingerprint"])

    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = chosen.mapInArrow(compute, f"id {kind}, fingerprint string")
    return found.withColumnRenamed("id", id_column)


# Digests are bytes until the end: in between they are written once.
_DIGESTS = ("edited_sha256", "fingerprint", "edited_fingerprint")
_RESULT = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary,"
    " edited_fingerprint binary, near_edited double, near_next double"
)
_ROW = f"part int, kind int, {_RESULT}, text string"
_CLOSED, _LAST, _FIRST = 0, 1, 2


def edited(text: str, following: str) -> str:
    """The text with its last quarter (rounded down) replaced by as much of the following one."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _compared(ids: pa.Array, texts: list[str], known=None) -> tuple[list[pa.Array], tuple]:
    """The result columns of all texts but the last, each with the next one; the sketches of all.

    ``known`` is the sketch of the first text where that has been computed before.
    """
    prints = sketch(texts[1:] if known else texts)
    if known:
        prints = tuple(np.concatenate((k, p)) for k, p in zip(known, prints))
    own = tuple(x[:-1] for x in prints)
    after = tuple(x[1:] for x in prints)
    changed = [edited(text, following) for text, following in zip(texts, texts[1:])]
    other = sketch(changed)
    digests = [sha256(text.encode("utf-8", "surrogatepass")).digest() for text in changed]
    columns = [
        ids.slice(0, len(changed)),
        pa.array([len(text) for text in texts[:-1]], pa.int64()),
        pa.array(digests, pa.binary()),
        pa.array(packed(*own), pa.binary()),
        pa.array(packed(*other), pa.binary()),
        pa.array(likeness(own, other), pa.float64()),
        pa.array(likeness(own, after), pa.float64()),
    ]
    return columns, prints


def _rows(part: int, kind: int, columns: list[pa.Array], texts: list[str | None]) -> pa.RecordBatch:
    count = len(columns[0])
    whole = [pa.array([part] * count, pa.int32()), pa.array([kind] * count, pa.int32()), *columns]
    whole.append(pa.array(texts, pa.string()))
    names = [field.split()[0] for field in _ROW.split(", ")]
    return pa.RecordBatch.from_arrays(whole, names=names)


def _edge(part: int, kind: int, doc_id: pa.Array, text: str) -> pa.RecordBatch:
    blank = [pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.binary())] * 3, *[pa.nulls(1, pa.float64())] * 2]
    return _rows(part, kind, [doc_id, *blank], [text])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the rows whose successor is in the partition, and the rows at its two ends."""
    part, last, known = -1, None, None
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text").fill_null("").to_pylist()
        if not texts:
            continue
        part = batch.column("part")[0].as_py()
        for run in _runs(texts):
            chunk, chunk_ids = texts[run], ids.slice(run.start, run.stop - run.start)
            if last is None:
                yield _edge(part, _FIRST, chunk_ids.slice(0, 1), chunk[0])
            else:
                chunk, chunk_ids = [last[1], *chunk], pa.concat_arrays([last[0], chunk_ids])
            columns, prints = _compared(chunk_ids, chunk, known)
            if len(chunk) > 1:
                yield _rows(part, _CLOSED, columns, [None] * (len(chunk) - 1))
            last = chunk_ids.slice(len(chunk) - 1, 1), chunk[-1]
            known = tuple(x[-1:] for x in prints)
    if last is not None:
        yield _edge(part, _LAST, *last)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of rows whose successor is in another partition."""
    names = [field.split()[0] for field in _RESULT.split(", ")]
    for batch in batches:
        for at in range(batch.num_rows):
            texts = [batch.column(name)[at].as_py() for name in ("text", "next_text")]
            columns, _ = _compared(batch.column("doc_id").slice(at, 1), texts)
            yield pa.RecordBatch.from_arrays(columns, names=names)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint beside those of its edited form and of the next document.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. ``n_chars`` counts the code points of the text. The edited text is the text
    whose last ``n_chars // 4`` code points are replaced by the first as many (or all) of the next
    document's; documents follow each other by ascending ``doc_id``, the first one after the last.

    Texts are shuffled once, into range partitions in which they stand in order. A row's
    successor is the next row; only the two rows at the ends of each partition, two per
    partition whatever its size, meet in a join of neighbouring partitions afterwards.

    A null or empty text is empty (equal empty texts are alike by 1). Null ids come first; equal
    ids follow each other by a hash of the text, and equal rows in any order, which
    changes no result, so a hot id is spread over partitions. A single document
    follows itself. An empty table gives no rows. Other columns are not read.
    """
    spark, folder = docs.sparkSession, scratch_folder(docs.sparkSession)
    order = ["doc_id", "_hash", "_row"]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text"),
        F.xxhash64("text").alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
    )
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    placed.mapInArrow(_in_order, _ROW).write.parquet(f"{folder}/ordered")
    done = spark.read.schema(_ROW).parquet(f"{folder}/ordered")
    firsts = done.filter(F.col("kind") == _FIRST).select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text")
    )
    # A number per partition that holds rows.
    parts = sorted(row.next_part for row in firsts.select("next_part").collect())
    follows = spark.createDataFrame(
        list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int"
    )
    ends = done.filter(F.col("kind") == _LAST).select("part", "doc_id", "text")
    met = ends.join(follows, "part").join(firsts, "next_part")
    joined = met.select("doc_id", "text", "next_text").mapInArrow(_across, _RESULT)
    closed = done.filter(F.col("kind") == _CLOSED)
    results = closed.select(*joined.columns).unionByName(joined)
    return results.withColumns({name: F.lower(F.hex(name)) for name in _DIGESTS})
