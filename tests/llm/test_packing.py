import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from starmart.llm import packing
from starmart.llm.tokens import tokenizer_file
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"


def expected_ids(text):
    tokenizer = Tokenizer.from_file(tokenizer_file(VOCABULARY))
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@given(st.integers(0, 50_000), st.sampled_from([64, 100, 4096]))
def test_cuts_cover_the_document(tokens, capacity):
    sizes = packing.cut_sizes(tokens, capacity, 0.01)
    assert sum(sizes) == tokens and all(0 < size <= capacity for size in sizes)


def sequences(rows):
    found = {}
    for row in rows:
        found.setdefault(row.sequence_id, []).append((row.offset, row.length))
    return found


def check_sequences(rows, capacity):
    for pieces in sequences(rows).values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity


def test_every_id_in_one_piece(spark, documents):
    texts = [None, "", "a", "word " * 700, "b c " * 3000, "x" * 20000, "a", "don't stop " * 40]
    docs = documents([(i, text) for i, text in enumerate(texts)] + [(None, "null key"), (2, "a")])
    rows = packing.harmonic_pack(docs, tokenizer_file(VOCABULARY), capacity=256).collect()
    check_sequences(rows, 256)
    for i in (0, 1, 3, 4, 5, 7):
        ids = expected_ids(texts[i])
        pieces = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        joined = b"".join(bytes(r.ids) for r in pieces)
        assert np.frombuffer(joined, "<u4").tolist() == ids
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces])[:-1])
        assert {r.doc_tokens for r in pieces} == {len(ids)}
    assert sum(r.doc_id == 2 for r in rows) == 2
    assert sum(r.doc_id is None for r in rows) == 1


def test_null_and_repeated_ids_are_spread_over_workers(documents, monkeypatch):
    """Documents of one id, a third of them copies: every worker gets its share."""
    rows = [(None, f"text {i}") for i in range(600)] + [(None, "copy")] * 300 + [(7, "copy")] * 300
    monkeypatch.setattr(packing, "packing_workers", lambda docs: 8)
    found = packing.harmonic_pack(documents(rows), tokenizer_file(VOCABULARY)).collect()
    workers = np.bincount([r.sequence_id >> 32 for r in found], minlength=8)
    assert workers.sum() == 1200 and workers.min() > 80 and workers.max() < 250
    check_sequences(found, 4096)


def test_empty_table(documents):
    docs = documents([])
    assert packing.harmonic_pack(docs, tokenizer_file(VOCABULARY)).count() == 0


def test_classes_are_filled_with_a_fixed_number(spark):
    """40 thirds and 21 halves of a sequence: no bin mixes them but the left-over one."""
    pieces = spark.range(61).select(
        F.col("id").alias("doc_id"),
        F.lit(0).cast("long").alias("start"),
        F.expr("IF(id < 40, 33L, 50L)").alias("length"),
    )
    rows = packing.fill_bins(pieces, workers=1, capacity=100).collect()
    check_sequences(rows, 100)
    kinds = [tuple(sorted(n for _, n in p)) for p in sequences(rows).values()]
    assert kinds.count((33, 33, 33)) == 13 and kinds.count((50, 50)) == 10
    assert len(kinds) == 24


def test_little_padding(spark):
    """Sizes of all kinds, a third of them alike: under 2 % of the sequences is empty."""
    sizes = F.expr("IF(id % 3 = 0, 700, CAST(pmod(xxhash64(id), 3000) + 1 AS INT))")
    draws = [r[0] for r in spark.range(3000).select(sizes).collect()]
    cut = [
        (i, start, size)
        for i, tokens in enumerate(draws)
        for start, size in enumerate(packing.cut_sizes(tokens, 4096, 0.01))
    ]
    pieces = spark.createDataFrame(cut, "doc_id long, start long, length long")
    rows = packing.fill_bins(pieces, workers=3).collect()
    check_sequences(rows, 4096)
    padded = 4096 * len(sequences(rows))
    assert padded < 1.02 * sum(draws)


def test_query_digests(spark):
    from starmart.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op1_harmonic_packing"](spark, folder).collect()
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    check_sequences(rows, 4096)
    assert {r.doc_id for r in rows} == set(texts)
    encoded = {key: np.array(expected_ids(text), "<u4") for key, text in texts.items()}
    assert sum(row.length for row in rows) == sum(map(len, encoded.values()))
    for row in rows:
        ids = encoded[row.doc_id]
        assert row.doc_tokens == len(ids)
        part = ids[row.start : row.start + row.length]
        assert row.ids_crc32 == zlib.crc32(part.tobytes())


pytestmark = pytest.mark.filterwarnings("ignore::UserWarning")
