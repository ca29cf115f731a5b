"""Token files: documents compressed one by one under a shared zstandard dictionary."""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.tokens import encoder
from starmart.sources import qualified

# A file: magic and dictionary hash; one frame per document; the index, a row per document
# (key, whether it is null, tokens, width of an id in bytes, end of the frame); the tail.
MAGIC = b"SMTOK1\0\0"
HASH_BYTES = 32
INDEX = np.dtype(
    [("doc_id", "<i8"), ("null", "u1"), ("tokens", "<i8"), ("width", "u1"), ("end", "<i8")]
)
TAIL = struct.Struct("<qq8s")

_MANIFEST = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("number", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("documents", T.LongType()),
        T.StructField("tokens", T.LongType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
    ]
)
_DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
_BATCH_BYTES = 16 << 20
# Frames of a file that are read together.
_READ_BYTES = 4 << 20


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        scheme, _, rest = folder.partition(":")
        uri = f"file:///{rest.lstrip('/')}" if scheme == "file" else folder
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), folder


def _pack(ids: np.ndarray) -> tuple[int, bytes]:
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return width, ids.astype(f"<u{width}").tobytes()


def train_dictionary(
    docs: DataFrame,
    rows: int,
    tokenizer: str,
    end_id: int = 2,
    size: int = 64 << 10,
    sample: int = 1000,
    longest: int = 16_384,
) -> bytes:
    """A dictionary from the id arrays of a bounded sample; empty if the sample is too small.

    The sample: of the texts of 1 to ``longest`` characters, the ``sample`` rows whose key has the
    lowest hash. Short documents are the ones a dictionary helps. Of ``rows`` rows in all
    only a share of about eight samples is looked at, so that what tasks send on stays bounded.
    """
    import zstandard

    share = min(1.0, 8 * sample / max(1, rows)) * (1 << 30)
    drawn = (
        docs.filter(F.length("text").between(1, longest))
        .select("text", F.xxhash64("doc_id", "text").alias("_draw"))
        .filter(F.pmod("_draw", F.lit(1 << 30)) <= share)
        .orderBy("_draw")
        .limit(sample)
        .select("text")
    )

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids, offsets in encoder(tokenizer).documents(batch.column(0), end_id):
                packed = [_pack(ids[a:b])[1] for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["ids"])

    samples = [bytes(row[0]) for row in drawn.mapInArrow(serialize, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


class _Writer:
    """One file under a temporary name, moved into place when complete."""

    def __init__(self, folder: str, name: str, digest: bytes):
        self._fs, base = _place(folder)
        self.name, self._target = name, f"{base}/{name}"
        self._temporary = f"{base}/_{uuid4().hex}-{name}"
        self._out = self._fs.open_output_stream(self._temporary)
        self._out.write(MAGIC + digest)
        self._index: list[tuple] = []
        self._end = len(MAGIC) + HASH_BYTES

    def add(self, key: int | None, tokens: int, width: int, frame: bytes) -> None:
        self._out.write(frame)
        self._end += len(frame)
        self._index.append((key or 0, key is None, tokens, width, self._end))

    def full(self, limit: int) -> bool:
        return self._end + len(self._index) * INDEX.itemsize >= limit

    def close(self, part: int, number: int) -> tuple:
        index = np.array(self._index, dtype=INDEX)
        self._out.write(index.tobytes())
        self._out.write(TAIL.pack(self._end, len(index), MAGIC))
        self._out.close()
        self._fs.move(self._temporary, self._target)
        known = index["doc_id"][index["null"] == 0]
        ends = (int(known.min()), int(known.max())) if len(known) else (None, None)
        return (part, number, self.name, len(index), int(index["tokens"].sum()), *ends)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 2,
    level: int = 3,
    bytes_per_part: int = 32 << 20,
    bytes_per_file: int = 64 << 20,
) -> str:
    """Write the ids of every document below ``folder``, a place all executors share.

    Rows are ordered by ``doc_id`` (null first, equal ones by a hash of their text) over parts
    of about ``bytes_per_part`` of text; each part writes its files alone, under names that a
    repeated task writes again. Null and empty texts hold only the end id. ``dictionary.bin`` is the
    dictionary, ``manifest`` lists the files. An empty table writes no files. Other columns,
    whatever their names, are not read.
    """
    import zstandard

    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    total, rows = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = max(1, -(-(total or 0) // bytes_per_part))
    shared = train_dictionary(docs, rows, tokenizer, end_id)
    digest = hashlib.sha256(shared).digest()
    folder = qualified(spark, folder)
    place, base = _place(folder)
    place.create_dir(base, recursive=True)
    with place.open_output_stream(f"{base}/dictionary.bin") as out:
        out.write(shared)
    with place.open_output_stream(f"{base}/format.json") as out:
        out.write(json.dumps({"end_id": end_id, "dictionary": digest.hex()}).encode())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        known = zstandard.ZstdCompressionDict(shared) if shared else None
        compress = zstandard.ZstdCompressor(level=level, dict_data=known).compress
        writer, rows = None, []
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for low, ids, offsets in encoder(tokenizer).documents(batch.column(1), end_id):
                # Ids of a slice are narrowed at once, unless some need four bytes.
                narrow = memoryview(_pack(ids)[1]) if not len(ids) or ids.max() < 1 << 16 else None
                bounds = offsets.tolist()
                for key, a, b in zip(keys[low:], bounds, bounds[1:]):
                    if writer is None:
                        name = f"tokens-{part:06d}-{len(rows):04d}.bin"
                        writer = _Writer(folder, name, digest)
                    width, data = (2, narrow[2 * a : 2 * b]) if narrow is not None else _pack(ids[a:b])
                    writer.add(key, b - a, width, compress(data))
                    if writer.full(bytes_per_file):
                        rows.append(writer.close(part, len(rows)))
                        writer = None
        if writer is not None:
            rows.append(writer.close(part, len(rows)))
        if rows:
            fields = [f.dataType.simpleString() for f in _MANIFEST]
            kinds = {"int": pa.int32(), "string": pa.string(), "bigint": pa.int64()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds[kind]) for c, kind in zip(zip(*rows), fields)],
                names=_MANIFEST.names,
            )

    order = ["doc_id", F.xxhash64("text")]
    (
        docs.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(write, _MANIFEST)
        .write.parquet(f"{folder}/manifest")
    )
    spark.catalog.refreshByPath(f"{folder}/manifest")
    return folder


@lru_cache(maxsize=4)
def _dictionary(folder: str, digest: bytes):
    """The shared dictionary, checked against the hash a file names."""
    import zstandard

    place, base = _place(folder)
    with place.open_input_stream(f"{base}/dictionary.bin") as file:
        shared = file.read()
    if hashlib.sha256(shared).digest() != digest:
        raise ValueError(f"{folder}: the dictionary is not the one its files were written with")
    return zstandard.ZstdCompressionDict(shared) if shared else None


def _read_file(
    folder: str, name: str, start: int, wanted: set[int] | None
) -> Iterator[tuple[int | None, int, int, bytes]]:
    import zstandard

    place, base = _place(folder)
    with place.open_input_file(f"{base}/{name}") as file:
        size = file.size()
        file.seek(size - TAIL.size)
        at, count, magic = TAIL.unpack(file.read(TAIL.size))
        file.seek(0)
        head = file.read(len(MAGIC) + HASH_BYTES)
        if magic != MAGIC or head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{name} is no token file")
        file.seek(at)
        index = np.frombuffer(file.read(count * INDEX.itemsize), dtype=INDEX)
        known = _dictionary(folder, head[len(MAGIC) :])
        decompress = zstandard.ZstdDecompressor(dict_data=known).decompress
        begins = np.concatenate(([len(head)], index["end"][:-1])) if count else []
        starts = start + np.cumsum(index["tokens"]) - index["tokens"]
        rows = slice(None)
        if wanted is not None:
            rows = np.flatnonzero(
                (index["null"] == 0) & np.isin(index["doc_id"], np.array(list(wanted), "i8"))
            )
        chosen = index[rows] if wanted is not None else index
        columns = [chosen[name].tolist() for name in ("doc_id", "null", "tokens", "width", "end")]
        places = zip(np.asarray(begins)[rows].tolist(), starts[rows].tolist()) if count else ()
        buffer, at = b"", 0
        for (begin, before), (key, null, tokens, width, end) in zip(places, zip(*columns)):
            if not at <= begin <= end <= at + len(buffer):
                ahead = max(end - begin, min(_READ_BYTES, int(index["end"][-1]) - begin) if wanted is None else 0)
                file.seek(begin)
                buffer, at = file.read(ahead), begin
            data = decompress(memoryview(buffer)[begin - at : end - at])
            ids = np.frombuffer(data, dtype=f"<u{width}").astype("<u4").tobytes()
            yield None if null else key, before, tokens, ids


def read_token_files(
    spark: SparkSession, folder: str, doc_ids: list[int] | None = None
) -> DataFrame:
    """Documents from the files: ``doc_id, start, n_tokens, ids`` (unsigned 32-bit, little-endian).

    ``start`` counts the ids of all documents before it. With ``doc_ids`` only files that can
    hold them are opened, and of those only the index and the frames asked for.
    """
    folder = qualified(spark, folder)
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        spark.read.schema(_MANIFEST)
        .parquet(f"{folder}/manifest")
        .withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    )
    wanted = None
    if doc_ids is not None:
        wanted = set(doc_ids)
        hits = [F.lit(key).between(F.col("low"), F.col("high")) for key in wanted]
        files = files.filter(F.array_contains(F.array(F.lit(False), *hits), True))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=_DOCUMENTS.names)

        for files in batches:
            for name, start in zip(*(files.column(i).to_pylist() for i in (0, 1))):
                rows, size = [], 0
                for row in _read_file(folder, name, start, wanted):
                    rows.append(row)
                    size += len(row[3])
                    if size >= _BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    tasks = spark.sparkContext.defaultParallelism
    dealt = files.select("name", "start").repartition(4 * tasks, "name")
    return dealt.mapInArrow(read, _DOCUMENTS)
