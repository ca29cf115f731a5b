"""Harmonic packing of token sequences."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.tokens import encoder

_PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("deal", T.LongType()),
    ]
)


def cut_sizes(tokens: int, capacity: int, max_waste: float) -> list[int]:
    """Sizes of the pieces of a document: full sequences, then reciprocal parts of one.

    A rest that nearly fills its class (``capacity // rest`` of it leave at most
    ``max_waste`` of a sequence empty) stays whole; of any other the largest share
    ``capacity // k`` that fits is cut off and the rest is looked at again. Rests below
    1/64 of a sequence are not cut.
    """
    sizes = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        bins = capacity // rest
        fits = bins * rest >= (1 - max_waste) * capacity or rest * 64 < capacity
        sizes.append(rest if fits else capacity // (bins + 1))
        rest -= sizes[-1]
    return sizes


def cut_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    max_waste: float = 0.01,
) -> DataFrame:
    """Pieces of every document: ``doc_id, start, length, doc_tokens, ids, deal``.

    A document is the ids of its whole text and ``end_id``; a null or empty text is the end
    id alone. ``ids`` holds unsigned 32-bit integers, little-endian. Every id lies in exactly one
    piece. ``deal`` is a hash of the piece and of how many equal ones its task has met before, so
    it spreads pieces of null and repeated ids, copies too, and doesn't depend on the order of rows.
    Null and repeated ``doc_id`` are kept: each row is a document. Other columns, whatever
    their names, are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, met = encoder(tokenizer), Counter()
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for low, ids, offsets in encode.documents(texts, end_id):
                values = np.ascontiguousarray(ids, "<u4")
                data = memoryview(values).cast("B") if len(values) else b""
                rows: list[tuple] = []
                for i, at in enumerate(offsets[:-1].tolist()):
                    size, start = int(offsets[i + 1]) - at, 0
                    key = keys[low + i].as_py()
                    for length in cut_sizes(size, capacity, max_waste):
                        first = 4 * (at + start)
                        seed = xxhash.xxh3_64_intdigest(b"%d,%d" % (key or 0, start))
                        name = xxhash.xxh3_64_intdigest(data[first : first + 4 * length], seed)
                        deal = xxhash.xxh3_64_intdigest(b"%d,%d" % (name, met[name])) >> 1
                        met[name] += 1
                        rows.append((key, start, length, size, deal))
                        start += length
                if rows:
                    columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
                    # Pieces lie one after the other in the ids of the slice: no copies of them.
                    ends = np.cumsum([0, *(row[2] for row in rows)], dtype=np.int64)
                    buffers = [None, pa.py_buffer(4 * (int(offsets[0]) + ends)), pa.py_buffer(values)]
                    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), buffers)
                    columns.insert(4, pieces.cast(pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=_PIECES.names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, _PIECES)


def _first_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each length, largest first."""
    room: list[int] = []
    bins = np.empty(len(lengths), dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        at = next((b for b, left in enumerate(room) if left >= length), len(room))
        if at == len(room):
            room.append(capacity)
        room[at] -= length
        bins[i] = at
    return bins


def _fill(group: pa.Table, capacity: int) -> pa.Table:
    """Sequences and offsets of one worker's pieces."""
    length = group.column("length").to_numpy()
    by_size = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")]
    order = pc.sort_indices(group, by_size).to_numpy()
    length = length[order]
    per_bin = capacity // length
    classes, first, size = np.unique(per_bin, return_index=True, return_counts=True)
    full = size // classes
    bin_of = (np.arange(len(length)) - np.repeat(first, size)) // per_bin
    sequence = bin_of + np.repeat(np.cumsum(full) - full, size)
    left = np.flatnonzero(bin_of >= np.repeat(full, size))
    sequence[left] = full.sum() + _first_fit(length[left], capacity)
    in_bins = np.argsort(sequence, kind="stable")
    order, sequence, length = order[in_bins], sequence[in_bins], length[in_bins]
    begins = np.cumsum(length) - length
    heads = np.flatnonzero(np.diff(sequence, prepend=-1))
    offset = begins - np.repeat(begins[heads], np.diff([*heads, len(length)]))
    worker = group.column("_worker")[0].as_py()
    placed = group.drop_columns(["_worker"]).take(pa.array(order))
    placed = placed.append_column("sequence_id", pa.array((worker << 32) + sequence))
    return placed.append_column("offset", pa.array(offset))


def fill_bins(
    pieces: DataFrame, workers: int, capacity: int = 4096, deal: Column | None = None
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``doc_id``, ``start``, ``length``.

    Pieces are dealt to ``workers`` by the number ``deal``, a hash of ``doc_id`` and ``start`` if
    none is given. Each worker packs on its own: the pieces of which ``k`` fit into a sequence,
    but not ``k + 1``, form class ``k``, and ``k`` of them fill a bin. Bins that stay incomplete
    are emptied and packed together, largest piece first. Lengths lie between 1 and
    ``capacity``; all columns are kept, whatever they hold.
    """
    by = F.xxhash64("doc_id", "start") if deal is None else deal
    dealt = pieces.withColumn("_worker", F.pmod(by, F.lit(workers).cast("long")))
    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def fill(group: pa.Table) -> pa.Table:
        return _fill(group, capacity)

    return dealt.groupBy("_worker").applyInArrow(fill, schema)


def packing_workers(docs: DataFrame, bytes_per_worker: int = 32 << 20) -> int:
    """Workers for ``docs``, from the size of all texts: each gets about as much."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // bytes_per_worker))


def harmonic_pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    max_waste: float = 0.01,
) -> DataFrame:
    """Pieces of all documents with their ids, each placed in a sequence of ``capacity`` ids.

    See ``cut_documents`` and ``fill_bins``. The rows of a ``sequence_id`` in the order of
    ``offset`` make the sequence; offsets are gapless from 0. An empty table gives no rows.
    """
    pieces = cut_documents(docs, tokenizer, capacity, end_id, max_waste)
    return fill_bins(pieces, packing_workers(docs), capacity, F.col("deal")).drop("deal")
