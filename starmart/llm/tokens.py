"""Token ids of whole texts, each distinct piece of a text being encoded once per worker."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from starmart.llm.words import kept

# White space before a blank: there the ids of a piece can depend on its neighbour.
_RUN = r"[\s\x{0B}\x{85}\x{1C}-\x{1F}\p{Z}] "
_SLICE_BYTES = 8 << 20


def tokenizer_file(name: str) -> str:
    """Path of a vocabulary file that is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file."""
    return kept(("encoder", path), lambda: Encoder(path))


class Encoder:
    """Encodes arrays of texts without special tokens; strings that look like one are text.

    Texts are cut at blanks. A tokenizer that keeps blanks sees each piece with the blank
    before it, which is how it would split the whole text; texts in which white space
    meets a blank are encoded as a whole instead. At most about ``capacity`` pieces are kept.
    """

    def __init__(self, path: str, capacity: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._blank = " " if self._plain("a b") != self._plain("a  b") else ""
        self._capacity = capacity
        self._forget()

    def _forget(self) -> None:
        self._codes: dict[str, int] = {}
        self._flat = np.empty(1 << 20, dtype=np.int32)
        self._starts = np.empty(1 << 18, dtype=np.int64)
        self._sizes = np.empty(1 << 18, dtype=np.int64)
        self._used = 0

    def _plain(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, pieces: list[str]) -> None:
        for at in range(0, len(pieces), 4096):
            some = pieces[at : at + 4096]
            encoded = self._tokenizer.encode_batch_fast(some, add_special_tokens=False)
            lists = [found.ids for found in encoded]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            total, code = int(sizes.sum()), len(self._codes)
            if self._used + total > len(self._flat):
                self._flat = np.resize(self._flat, 2 * (self._used + total))
            if code + len(some) > len(self._starts):
                self._starts = np.resize(self._starts, 2 * (code + len(some)))
                self._sizes = np.resize(self._sizes, 2 * (code + len(some)))
            ids = np.fromiter(chain.from_iterable(lists), np.int32, total)
            self._flat[self._used : self._used + total] = ids
            self._sizes[code : code + len(some)] = sizes
            self._starts[code : code + len(some)] = self._used + np.cumsum(sizes) - sizes
            self._used += total
            self._codes.update(zip(some, range(code, code + len(some))))

    def _lookup(self, pieces: list[str]) -> np.ndarray:
        codes = np.fromiter(map(self._codes.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            unknown = [pieces[i] for i in missing]
            self._learn(list(dict.fromkeys(unknown)))
            codes[missing] = [self._codes[piece] for piece in unknown]
        return codes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text begins in it (one more entry).

        A null is an empty text.
        """
        if len(self._codes) > self._capacity:
            self._forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = np.zeros(len(texts), dtype=bool)
        if self._blank:
            whole = pc.match_substring_regex(texts, _RUN).to_numpy(zero_copy_only=False)
        cut = pc.if_else(pa.array(whole), "", texts) if whole.any() else texts
        pieces = pc.split_pattern(cut, " ")
        bounds = np.asarray(pieces.offsets, dtype=np.int64)
        bounds = bounds - bounds[0]
        words = pieces.flatten().dictionary_encode()
        distinct = words.dictionary
        if self._blank:
            before, none = (pa.scalar(x, distinct.type) for x in (self._blank, ""))
            distinct = pc.binary_join_element_wise(before, distinct, none)
        codes = self._lookup(distinct.to_pylist())
        codes = codes[np.asarray(words.indices)]
        if self._blank and len(texts):
            first = bounds[:-1]
            codes[first] = self._lookup(
                words.dictionary.take(words.indices.take(pa.array(first))).to_pylist()
            )
        sizes = self._sizes[codes]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = self._flat[
            np.repeat(self._starts[codes] - ends[:-1], sizes) + np.arange(ends[-1])
        ]
        offsets = ends[bounds]
        if not whole.any():
            return ids, offsets
        parts = [
            np.array(self._plain(texts[i].as_py()), dtype=np.int32)
            if whole[i]
            else ids[offsets[i] : offsets[i + 1]]
            for i in range(len(texts))
        ]
        sizes = np.array([len(part) for part in parts])
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes)))

    def documents(
        self, texts: pa.Array, end_id: int | None = None
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Slices of the texts: the first row, ids (each text closed by ``end_id``), offsets.

        A slice holds some megabytes of text, or one longer text.
        """
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        slices = (np.cumsum(sizes) - sizes) // _SLICE_BYTES
        edges = np.flatnonzero(np.diff(slices, prepend=-1))
        for low, high in zip(edges, [*edges[1:], len(texts)]):
            ids, offsets = self.encode(texts.slice(low, high - low))
            if end_id is not None:
                ids = np.insert(ids, offsets[1:], end_id)
                offsets = offsets + np.arange(len(offsets))
            yield int(low), ids, offsets
