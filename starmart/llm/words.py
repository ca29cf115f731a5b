"""Words of whole texts as numbers, for work on Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

_SLICE_BYTES = 4 << 20


def remainder(divisor: int, key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo ``divisor``; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % divisor


_KEPT: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]):
    """What ``make`` gives, made once per worker process and kept between tasks.

    Only the last object asked for is kept: workers serve one operator after the other, and what
    each remembers of its words would add up.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def forget_kept() -> None:
    """Give back what an earlier operator's tasks left in this worker process."""
    if not _KEPT:
        return
    _KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(texts: pa.Array, size: int = _SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """The texts in runs of about ``size`` bytes, or one longer text; a null becomes empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    runs = (np.cumsum(sizes) - sizes) // size
    edges = np.flatnonzero(np.diff(runs, prepend=-1))
    for low, high in zip(edges, [*edges[1:], len(texts)]):
        yield int(low), texts.slice(low, high - low)


def split_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words (between ASCII white space), the word of each place, where texts begin.

    There is one more beginning than texts.
    """
    lists = pc.ascii_split_whitespace(texts)
    bounds = np.asarray(lists.offsets, dtype=np.int64)
    encoded = lists.flatten().dictionary_encode()
    places = np.asarray(encoded.indices).astype(np.int64)
    distinct = encoded.dictionary.to_pylist()
    bounds = bounds - bounds[0]
    if "" in distinct:
        filled = places != distinct.index("")
        bounds = np.concatenate(([0], np.cumsum(filled)))[bounds]
        places = places[filled]
    return distinct, places, bounds


def per_text(values: np.ndarray, bounds: np.ndarray, join: np.ufunc, empty: float) -> np.ndarray:
    """``join`` of each text's values, ``empty`` for a text without any."""
    found = np.full((len(bounds) - 1, *values.shape[1:]), empty, dtype=np.float64)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        found[some] = join.reduceat(values, bounds[some])
    return found


class Memo:
    """Numbers computed once per distinct word; forgotten when there are too many words."""

    def __init__(self, compute: Callable[[str], object], width: int, capacity: int = 1_000_000):
        self._compute, self._width, self._capacity = compute, width, capacity
        self._rows: dict[str, object] = {}

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self._rows) > self._capacity:
            self._rows.clear()
        known, compute = self._rows, self._compute
        for word in words:
            if word not in known:
                known[word] = compute(word)
        found = np.array([known[word] for word in words], dtype=np.float64)
        return found.reshape(len(words), self._width)
