import zlib
from pathlib import Path

import numpy as np
import pytest
from starmart.llm import token_files
from starmart.llm.tokens import tokenizer_file
from starmart.plans import scratch_folder
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def ids_of():
    tokenizer = Tokenizer.from_file(tokenizer_file(VOCABULARY))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def write(docs, **options):
    folder = scratch_folder(docs.sparkSession)
    return token_files.write_token_files(docs, folder, tokenizer_file(VOCABULARY), **options)


def test_round_trip(spark, documents, ids_of):
    texts = {i: f"text number {i} " * (i % 50) for i in range(300)} | {7: None, 8: "", 9: "ß " * 9000}
    docs = documents(sorted(texts.items(), reverse=True) + [(None, "no key")])
    folder = write(docs, bytes_per_part=20_000, bytes_per_file=4_000)
    rows = token_files.read_token_files(spark, folder).collect()
    by_key = {r.doc_id: r for r in rows}
    assert len(rows) == 301 and by_key[None].start == 0
    start = by_key[None].n_tokens
    for key, text in sorted(texts.items()):
        row = by_key[key]
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == ids_of(text)
        assert (row.start, row.n_tokens) == (start, len(ids_of(text)))
        start += row.n_tokens


def test_files_name_the_dictionary(spark, documents, ids_of):
    folder = write(documents([(i, f"the cat number {i} sat on mat {i % 7}") for i in range(2000)]))
    path = Path(folder.removeprefix("file:"))
    (file, *_) = path.glob("tokens-*.bin")
    assert (path / "dictionary.bin").stat().st_size > 0
    rows = token_files.read_token_files(spark, folder, doc_ids=[5, 1234, 99999]).collect()
    assert sorted(r.doc_id for r in rows) == [5, 1234]
    (path / "dictionary.bin").write_bytes(b"another")
    token_files._dictionary.cache_clear()
    with pytest.raises(ValueError, match="dictionary"):
        list(token_files._read_file(folder, file.name, 0, None))


def test_repeated_rows_and_one_hot_key(spark, documents):
    folder = write(documents([(1, f"text {i % 5}") for i in range(50)]), bytes_per_part=50)
    rows = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    ends = np.cumsum([r.n_tokens for r in rows])
    assert [r.start for r in rows] == [0, *ends[:-1]] and len(rows) == 50


def test_empty_table(spark, documents):
    assert token_files.read_token_files(spark, write(documents([]))).count() == 0


def test_query(spark, ids_of):
    from starmart.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in QUERIES["op4_token_files"](spark, folder).collect()}
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    start = 0
    for key, text in sorted(texts):
        ids = np.array(ids_of(text), "<u4")
        row = rows.pop(key)
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(ids.tobytes())
        start += len(ids)
    assert not rows
