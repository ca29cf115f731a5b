"""Hard negatives against all anchors compared with all rows."""

from __future__ import annotations

from math import floor, isfinite

import numpy as np
import pyarrow as pa

from starmart.llm import hard_negatives
from starmart.llm.hard_negatives import mine_hard_negatives, products, walk_list


def _vectors(spark, rows):
    # Names that the operator uses inside.
    schema = "vec_id long, embedding array<double>, label int, row string, cluster int, norm double"
    return spark.createDataFrame([(*row, "x", 1, 0.5) for row in rows], schema)


def _brute(rows):
    kept = []
    for vec_id, vector, label in rows:
        if label is None or not vector or any(x is None or not isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [floor(256 * x) for x in vector], label))
    last = lambda hit: (-hit[0], hit[1] is None, hit[1] or 0)
    found = []
    for at, (anchor_id, a, label) in enumerate(kept):
        if anchor_id is None or anchor_id % 100:
            continue
        scored = [
            (max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), other, same == label)
            for i, (other, b, same) in enumerate(kept)
            if i != at
        ]
        for best, positive_id, _ in sorted((s for s in scored if s[2]), key=last)[:5]:
            fits = [s for s in scored if not s[2] and 30 * best <= 100 * s[0] <= 90 * best]
            for rank, (score, vec_id, _) in enumerate(sorted(fits, key=last)[:10], 1):
                found.append((anchor_id, positive_id, rank, vec_id, best, score))
    return sorted(found, key=repr)


def _found(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_equals_all_comparisons(spark):
    draw = np.random.default_rng(3)
    rows = [(i, list(map(float, draw.normal(size=6))), i % 4) for i in range(350)]
    rows += [
        (100, [1.0] * 6, 2), (100, [1.0] * 6, 2),  # repeated rows, also of an anchor
        (200, [0.0] * 6, 1),  # a zero vector ties with everything
        (None, [0.9] * 6, 2), (None, [0.8] * 6, 1), (401, [0.5] * 3, 1),  # null ids, short vectors
        (400, None, 1), (500, [], 1), (600, [1.0, None], 1), (700, [float("nan")] * 6, 1),
        (800, [float("inf")] * 6, 1), (900, [1.0] * 6, None),
        *[(1000 + i, [0.25, 0.5, 0.0, 0.0, 0.0, 0.0], i % 3) for i in range(60)],  # one hot vector
        (-100, [-1.0] * 6, 0), (7, [2.0] * 6, 9),
    ]
    assert _found(mine_hard_negatives(_vectors(spark, rows))) == _brute(rows)


def test_many_parts_lots_and_stops_give_the_same(spark, monkeypatch):
    """Clustered vectors, where lists end early, and pieces so small that all of them are split."""
    monkeypatch.setattr(hard_negatives, "_PART_VALUES", 64 * 8)
    monkeypatch.setattr(hard_negatives, "_LOT", 3)
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(6, 8))
    rows = []
    for i in range(700):
        vector = centres[i % 6] * (1 + i % 3) + draw.normal(size=8) / 20
        rows.append((i * 10, list(map(float, vector)), int(i // 6 % 5)))
    vectors = _vectors(spark, rows)
    assert _found(mine_hard_negatives(vectors)) == _brute(rows)


def test_empty_table(spark):
    empty = mine_hard_negatives(_vectors(spark, []))
    assert empty.collect() == []
    assert empty.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    ]


def test_products_stay_whole():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, 1.0], [2.0**40, 0.0]])
    assert products(a, b).tolist() == [[2**60 + 3, 2**63 - 1]]
    assert products(a[:, :0], b[:, :0]).tolist() == [[0, 0]]


def test_a_walk_stops_where_nothing_better_can_follow(monkeypatch):
    monkeypatch.setattr(hard_negatives, "_CHUNK", 8)
    seen = []
    monkeypatch.setattr(
        hard_negatives, "products", lambda a, b: seen.append(len(b)) or products(a, b)
    )
    draw = np.random.default_rng(1)
    x = np.concatenate((draw.integers(90, 110, (8, 4)), draw.integers(-9, 9, (200, 4)))).astype(float)
    listed = pa.table(
        {
            "row": pa.array(range(1, 209)), "vec_id": pa.array(range(1, 209)),
            "label": pa.array([1] * 208), "v": pa.array([v.tobytes() for v in x]),
            "key": pa.array(np.linalg.norm(x, axis=1)),
        }
    )
    anchor = np.full(4, 100.0)
    asked = pa.table(
        {
            "row": [0], "demand": pa.array([0], pa.int32()), "label": [1], "v": [anchor.tobytes()],
            "norm": [np.linalg.norm(anchor)], "least": [-(2**62)], "most": [2**62],
            "need": [-(2**62)],
        }
    )
    found = walk_list(asked, listed, np.dtype(np.float64), 4, 5, True)
    assert sum(seen) == 8
    assert found.column("score").to_pylist() == sorted((x @ anchor).astype(int), reverse=True)[:5]
