import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from starmart.llm import jaccard
from starmart.llm.graph import components
from starmart.plans import scratch_folder


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def expected(rows, size, near):
    """All pairs by brute force: the size of each set and the least id it reaches."""
    sets = [shingles(row[1], size) for row in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and len(a & b) * near.denominator >= near.numerator * len(a | b):
                label[find(i)] = find(j)
    least = defaultdict(list)
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)].append(row[0])
    return sorted(
        (repr(row[0]), len(sets[i]), repr(min(least[find(i)], default=None)))
        for i, row in enumerate(rows)
    )


def found(docs, size, near, **options):
    rows = jaccard.jaccard_join(docs, size, near, **options).collect()
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in rows)


def near_copies(count, seed, words=40, families=12):
    random.seed(seed)
    bases = [[f"w{random.randrange(60)}" for _ in range(random.randrange(1, words))] for _ in range(families)]
    rows = []
    for i in range(count):
        text = list(random.choice(bases))
        for _ in range(random.choice([0, 0, 1, 1, 2, 4])):
            text[random.randrange(len(text))] = f"w{random.randrange(60)}"
        if random.random() < 0.3:
            text += [f"w{random.randrange(60)}"]
        rows.append((i * 7 % count, " ".join(text)))
    return rows


@pytest.mark.parametrize("size, near", [(4, Fraction(85, 100)), (1, Fraction(1, 2))])
def test_brute_force(documents, size, near):
    rows = near_copies(300, seed=size)
    rows += [(None, None), (900, ""), (901, " \t\n"), (902, "A b"), (903, "a B"), (None, "a b")]
    rows += [(904, "one " * 50), (905, "one"), (7, "w1 w2 w3 other"), (7, "w1 w2 w3 other")]
    assert found(documents(rows), size, near) == expected(rows, size, near)


def test_regions_too_large_for_a_task(documents):
    """Voronoi cells, and pairs of blocks where pivots cannot split, lose no link."""
    rows = near_copies(250, seed=5, words=60, families=3)
    near = Fraction(3, 5)
    assert found(documents(rows), 2, near, entries=400) == expected(rows, 2, near)


def test_null_ids_only_and_empty_table(documents):
    rows = [(None, "a b c"), (None, "a b c"), (None, None)]
    assert found(documents(rows), 4, Fraction(4, 5)) == expected(rows, 4, Fraction(4, 5))
    assert found(documents([]), 4, Fraction(4, 5)) == []


def test_many_texts_of_one_id(documents):
    """Rows without an id, and rows of one id, are told apart by their texts: the work stays in proportion."""
    texts = [text for _, text in near_copies(1200, seed=9, families=400)]
    rows = [(None if i % 2 else 5, text) for i, text in enumerate(texts)]
    near = Fraction(4, 5)
    assert found(documents(rows), 3, near) == expected(rows, 3, near)
    labels = {row[2] for row in expected(list(enumerate(texts)), 3, near)}
    kept = jaccard.keep_one_of_each(documents(rows), 3, near).collect()
    assert len(kept) == len(labels) and {(r.doc_id, r.text) for r in kept} <= set(rows)


def test_the_smallest_id_of_each_class_stays(documents):
    rows = [(row[0], row[1], row[0]) for row in near_copies(400, seed=11, families=60)]
    rows += [(None, text, 1000) for _, text, _ in rows[:40]] + [(None, "no one else says so", 1001)]
    near = Fraction(4, 5)
    kept = jaccard.keep_one_of_each(documents([row[:2] for row in rows]), 3, near).collect()
    least = {row[2] for row in expected([row[:2] for row in rows], 3, near)}
    assert {repr(r.doc_id) for r in kept} == least and len(kept) == len(least)


@given(st.integers(1, 400), st.randoms(use_true_random=False), st.sampled_from([Fraction(4, 5), Fraction(17, 20)]))
@settings(max_examples=300, deadline=None)
def test_linked_sets_share_a_signature(size, draw, near):
    signatures = jaccard.Signatures(near)
    a = {draw.getrandbits(64) for _ in range(size)}
    b = set(a)
    for x in draw.sample(sorted(a), k=draw.randrange(0, max(1, size // 5))):
        if draw.random() < 0.7:
            b.discard(x)
        if draw.random() < 0.7:
            b.add(draw.getrandbits(64))
    if b and len(a & b) >= near * len(a | b):
        keys = [set(signatures.of(np.array(sorted(s), np.uint64)).tolist()) for s in (a, b)]
        assert keys[0] & keys[1]


def test_one_row_of_each_class_stays(documents):
    rows = [(5, "a b c d e f g h"), (3, "a b c d e f g h"), (3, "a b c d e f g h"), (9, "x y z")]
    rows += [(1, None), (2, ""), (2, "")]
    kept = jaccard.keep_one_of_each(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted((r.doc_id, r.score) for r in kept.collect()) == [(1, 1), (2, 1), (2, 1), (3, 1), (9, 1)]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(200, 260)] + [(300, 300)]
    frame = spark.createDataFrame(links, "a long, b long")
    label = {r.node: r.label for r in components(frame, scratch_folder(spark)).collect()}
    assert {label[i] for i in range(1, 61)} == {1}
    assert {label[i] for i in [100, *range(200, 260)]} == {100}


@given(st.integers(1, 400), st.randoms(use_true_random=False), st.sampled_from([Fraction(4, 5), Fraction(17, 20)]))
@settings(max_examples=300, deadline=None)
def test_linked_sets_share_as_many_signatures_as_they_need(size, draw, near):
    signatures = jaccard.Signatures(near)
    a = {draw.getrandbits(64) for _ in range(size)}
    b = set(a)
    for x in draw.sample(sorted(a), k=draw.randrange(0, max(1, size // 5))):
        if draw.random() < 0.7:
            b.discard(x)
        if draw.random() < 0.7:
            b.add(draw.getrandbits(64))
    if b and len(a & b) >= near * len(a | b):
        (keys, need), (others, other_need) = (signatures.signed(np.array(sorted(s), np.uint64)) for s in (a, b))
        shared = set(keys.tolist()) & set(others.tolist())
        for needs in (need, other_need):
            assert any(sum(k & 3 == i for k in shared) >= needs >> 6 * i & 63 for i in range(4))


def test_texts_that_share_a_passage_are_no_region(documents, tmp_path, monkeypatch):
    """Some buckets hold nothing but the passage; a link needs more of them."""
    monkeypatch.setattr(jaccard, "scratch_folder", lambda spark: str(tmp_path))
    random.seed(3)
    passage = " ".join(f"p{k}" for k in range(15))
    rows = [(i, " ".join([passage, *(f"w{random.randrange(10**6)}" for _ in range(85))])) for i in range(200)]
    rows += [(300 + i, rows[i][1] + " and more") for i in range(10)]
    docs = documents(rows)
    assert found(docs, 4, Fraction(4, 5)) == expected(rows, 4, Fraction(4, 5))
    read = docs.sparkSession.read.parquet
    some = read(f"{tmp_path}/shared-0").selectExpr("set & -64 AS name").distinct().count()
    left = read(f"{tmp_path}/candidates").selectExpr("explode(array(a, b)) AS name").distinct().count()
    assert 20 <= left < some / 2
