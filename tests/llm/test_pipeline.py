"""Stages on a small folder, each compared with what brute force keeps."""

import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import corpus_pipeline as pipeline
import pytest
from test_jaccard import expected as brute_force

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for number, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs[-1], FOLDER).write.parquet(f"{folder}/{number}")
        docs.append(spark.read.parquet(f"{folder}/{number}"))
    return docs


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_return_the_columns_of_documents(tables):
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "language", "near_copies", "mixing", "packing"]
    assert all(df.dtypes == tables[0].dtypes for df in tables[:5])


def test_filters_keep_whole_rows(spark, tables):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = ({r.doc_id: r for r in df.collect()} for df in tables[:2])
    assert all(before[key] == row for key, row in after.items())
    clean = [key for key in before if labels.get(key) == 0]
    assert sum(key in after for key in clean) >= 0.9 * len(clean)
    lettered = [row for row in rows(tables[1]) if any(c.isalpha() for c in row[1] or "")]
    assert sorted(rows(tables[2])) == sorted(lettered)


def test_one_document_of_each_group(tables):
    before = rows(tables[2])
    group = {int(key): component for key, _, component in brute_force(before, 5, Fraction(4, 5))}
    kept = [key for key, _ in rows(tables[3])]
    assert Counter(group[key] for key in kept) == Counter(set(group.values()))
    assert all(str(key) == group[key] for key in kept)


def test_mix_reaches_its_targets(tables):
    from starmart.llm.mixing import source_targets, word_count
    from pyspark.sql import functions as F

    sizes = tables[3].groupBy("source").agg(F.sum(word_count()).alias("source_size"))
    targets = {r.source: r.target for r in source_targets(sizes).collect()}
    taken, largest = defaultdict(int), 0
    for r in tables[4].withColumn("n", word_count()).collect():
        taken[r.source] += r.n
        largest = max(largest, r.n)
    assert all(abs(taken[s] - targets[s]) <= largest for s in targets)
    assert max(Counter(key for key, _ in rows(tables[4])).values()) <= 3


def test_packing_holds_every_document(tables):
    pieces = tables[5].collect()
    assert {r.doc_id for r in pieces} == {key for key, _ in rows(tables[4])}
    used = defaultdict(int)
    for r in pieces:
        used[r.sequence_id] += r.length
        assert len(r.ids) == 4 * r.length and r.ids_crc32 == zlib.crc32(r.ids)
    assert max(used.values()) <= 4096


def test_empty_documents(spark, documents):
    docs = documents([]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
