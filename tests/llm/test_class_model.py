import math
import zlib
from collections import Counter

import numpy as np
import pytest
from starmart.llm import class_model
from starmart.llm.words import remainder

FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def check_base(rows, docs):
    held = [zlib.crc32(str("" if k is None else k).encode()) % 7 == 2 for k, _ in docs]
    count = Counter(t for (_, text), out in zip(docs, held) if not out for t in tokens(text))
    total, distinct = sum(count.values()), len(count)
    expected = []
    for (key, text), out in zip(docs, held):
        base = sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in tokens(text))
        known = sum(count[t] > 0 for t in tokens(text))
        expected.append((repr(key), out, len(tokens(text)), known, total, round(base, 6)))
    got = [
        (repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in rows
    ]
    assert sorted(got) == sorted(expected)


def test_base_scores_by_brute_force(documents):
    texts = [None, "", "The cat", "the cat sat", " the\tCAT \n", "Ünïcode É é", "x " * 9000, "cat"]
    docs = [(i, text) for i, text in enumerate(texts * 3)] + [(None, "the end"), (2, "The cat")]
    rows = class_model.score_texts(documents(docs), remainder(7) == 2, 5, 3, 3).collect()
    check_base(rows, docs)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_no_learning_text_and_empty_table(documents):
    from pyspark.sql import functions as F

    rows = class_model.score_texts(documents([(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in rows) == [(1, 0, 0), (3, 0, 0)]
    assert all(math.isfinite(r.score) for r in rows)
    assert class_model.score_texts(documents([]), F.lit(False)).count() == 0


def test_exchange_puts_words_of_like_neighbours_together():
    """Two articles before three nouns, two verbs after them: the classes are these."""
    pairs = np.zeros((8, 8))
    pairs[np.ix_([0, 1], [2, 3, 4])] = 50
    pairs[np.ix_([2, 3, 4], [5, 6])] = 50
    pairs[np.ix_([5, 6], [7])] = 150
    pairs[np.ix_([7], [0, 1])] = 150
    of = class_model.exchange(pairs, 3)
    assert len({of[0], of[1]}) == len({of[2], of[3], of[4]}) == len({of[5], of[6]}) == 1
    assert len({of[0], of[2], of[5], of[7]}) == 4


def test_emissions_and_transitions_are_distributions(documents):
    model = class_model.ClassModel(
        ("a",), np.array([0, 0, 1]), np.log10([[0.4, 0.6], [0.5, 0.5]]),
        np.array([10.0, 0.0]), np.array([3.0, 0.0]), 10, 3, 2,
    )
    counts = np.array([6, 3, 1, 0])
    assert math.isclose(sum(10 ** model.emit(np.zeros(4, dtype=int), counts)), 1)


@pytest.mark.parametrize("folder", [FOLDER])
def test_query_beats_the_base(spark, folder):
    from starmart.llm.queries import QUERIES

    rows = QUERIES["op9_brown_class_scores"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    check_base(rows, [tuple(d) for d in docs])
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)


def brute_force_scores(docs, words, endings, classes, least):
    """The model of ``score_texts`` by loops over all tokens; clustering of types is shared with it."""
    texts = [(tokens(text)[:-1], zlib.crc32(str(k).encode()) % 7 == 2) for k, text in docs]
    texts = [([w.decode() for w in ws], out) for ws, out in texts]
    learned = [ws for ws, out in texts if not out]
    count = Counter(w for ws in learned for w in ws)
    frequent = sorted(count, key=lambda w: (-count[w], w))[:words]
    sums = Counter()
    for w, n in count.items():
        sums["*" + w[-3:]] += n
    types = frequent + sorted(sums, key=lambda e: (-sums[e], e))[:endings]

    def kind(w):
        return types.index(w) if w in frequent else types.index("*" + w[-3:]) if "*" + w[-3:] in types else len(types)

    end = len(types) + 1
    pairs = np.zeros((end + 1, end + 1))
    for ws in learned:
        row = [end, *map(kind, ws), end]
        for a, b in zip(row, row[1:]):
            pairs[a, b] += 1
    of = class_model.exchange(pairs, classes)
    last = of[-1]
    seed = np.zeros((last + 1, last + 1))
    for a, b in np.ndindex(*pairs.shape):
        seed[of[a], of[b]] += pairs[a, b]
    seed += 0.5
    gain = np.log(seed / seed.sum(1, keepdims=True) / seed.sum(0, keepdims=True))
    scores = {w: np.zeros(last) for w in count}
    for ws in learned:
        row = [last, *(of[kind(w)] for w in ws), last]
        for i, w in enumerate(ws):
            scores[w] += gain[row[i], :last] + gain[:last, row[i + 2]]

    def of_word(w):
        return of[kind(w)] if w in frequent or count[w] < least else int(scores[w].argmax())

    table = np.zeros((last + 1, last + 1))
    for ws in learned:
        row = [last, *map(of_word, ws), last]
        for a, b in zip(row, row[1:]):
            table[a, b] += 1
    share = (table.sum(0) + 1) / (table.sum() + last + 1)
    follow = (table + 20 * share) / (table.sum(1, keepdims=True) + 20)
    size, variety = Counter(), Counter()
    for w, n in count.items():
        size[of_word(w)] += n
        variety[of_word(w)] += 1
    found = []
    for (key, _), (ws, _) in zip(docs, texts):
        score, before = 0.0, last
        for w in ws:
            c = of_word(w)
            kept = count[w] - 0.5 if count[w] else 0.5 * variety[c] + 1
            score += math.log10(follow[before, c]) + math.log10(kept / (size[c] + 1))
            before = c
        found.append((key, score + math.log10(follow[before, last])))
    return found


@pytest.mark.parametrize("split", [False, True])
def test_scores_by_brute_force(documents, monkeypatch, split):
    if split:  # several runs a file, words merged in parts, many tasks
        monkeypatch.setattr(class_model, "_RUN_BYTES", 200)
        monkeypatch.setattr(class_model, "_MERGE_ROWS", 40)
        monkeypatch.setattr(class_model, "_MERGE_RUNS", 2)
    random = np.random.default_rng(3)
    parts = [[f"{x}{i}{e}" for i in range(12) for e in ("ing", "ed")] for x in ("adj", "noun", "verb")]
    docs = [
        (k, " ".join(parts[i % 3][int(len(parts[0]) * random.random() ** 2)] for i in range(random.integers(0, 25))))
        for k in range(120)
    ] + [(120, None), (121, "New words only"), (122, "adj0ing " * 50), (123, "often " * 700)]
    rows = class_model.score_texts(documents(docs), remainder(7) == 2, 12, 4, 5, 2).collect()
    got = {r.doc_id: r.score for r in rows}
    assert len(rows) == len(docs)
    for key, score in brute_force_scores(docs, 12, 4, 5, 2):
        assert math.isclose(got[key], score, rel_tol=1e-9, abs_tol=1e-9)


def test_affinity_is_the_slope_of_mutual_information():
    random = np.random.default_rng(0)
    table = random.integers(100, 1000, (4, 4)).astype(float)

    def information(t):
        t = t + 0.5
        return (t * np.log(t / t.sum(1, keepdims=True) / t.sum(0, keepdims=True))).sum()

    slope = class_model.affinity(table)
    for before, c in np.ndindex(4, 4):
        step = np.zeros((4, 4))
        step[before, c] = 1e-3
        change = (information(table + step) - information(table - step)) / 2e-3
        # The same -1 for every class.
        assert math.isclose(change, slope[before, c] - 1, abs_tol=1e-4)
        assert slope[4 + c, before] == slope[before, c]


def test_frequent_words_are_added_up_by_names(spark):
    """No word goes through the shuffle of all words, and what comes out are the words' sums."""
    rows = [(f"w{i % 50}ing" if i % 3 else f"v{i % 40}ed", i % 7 + 1) for i in range(600)]
    frequent, types = class_model._types(spark.createDataFrame(rows, "word string, n long"), 20, 3)
    sums = {}
    for word, n in rows:
        sums[word] = sums.get(word, 0) + n
    assert len(frequent) == 20 and all(sums[word] == n for word, n in frequent.items())
    assert sorted(frequent.values()) == sorted(sums.values())[-20:] and {"*ing", "*ed"} & set(types) == {"*ing"}
    assert types[:20] == tuple(sorted(frequent, key=lambda word: (-sums[word], word)))
