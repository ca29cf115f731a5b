import math

import compare
import pytest
from starmart.llm import mixing
from starmart.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def shares(sizes, weights=(5, 2, 1), ceiling=3):
    """Targets by repeated sharing: hold whoever is above, share the rest again."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes))}
    held, total = {}, sum(sizes.values())
    while True:
        rest = total - sum(held.values())
        free = [s for s in sizes if s not in held]
        level = rest / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] >= ceiling * sizes[s]]
        if not over:
            return held | {s: level * weight[s] for s in free}
        held |= {s: float(ceiling * sizes[s]) for s in over}


@pytest.mark.parametrize(
    "sizes", [[7], [0, 0], [100, 1, 1], [10, 1000, 3, 50, 50, 9000], [0, 5, 80, 5, 0, 5, 5, 5, 4]]
)
def test_targets_are_water_filled(spark, sizes):
    named = {f"s{i}": size for i, size in enumerate(sizes)}
    frame = spark.createDataFrame(list(named.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    expected = shares(named)
    assert all(math.isclose(found[s], expected[s], abs_tol=1e-6) for s in named)
    assert math.isclose(sum(found.values()), sum(sizes), abs_tol=1e-6)


def test_matches_sql(spark):
    columns, found = compare.spark_rows(QUERIES["op10_capped_mixing"](spark, FOLDER))
    sql = compare.sql_rows(compare.connect(FOLDER), ORACLES["op10_capped_mixing"])
    assert (columns, found) == sql and found


def test_takes_come_near_the_targets(spark, documents):
    rows = [(i, "w " * (i % 17 + 1), None, ["a", "b", "c", None][i % 4 % (1 + i % 3)]) for i in range(900)]
    mixed = mixing.mix(documents(rows)).collect()
    taken, target, largest = {}, {}, 0
    for row in mixed:
        taken[row.row.source] = taken.get(row.row.source, 0) + row.taken
        target[row.row.source] = row.target
        assert 0 <= row.taken <= 3 * row.size
        largest = max(largest, row.size)
    assert len(mixed) == 900
    assert all(abs(taken[s] - target[s]) <= largest / 2 for s in target)


def test_reruns_agree_and_seeds_differ(spark, documents):
    docs = documents([(i, f"text {i}", None, f"s{i % 3}") for i in range(300)])

    def takes(rows, seed):
        return sorted((r.doc_id, r.taken) for r in mixing.mix(rows, seed=seed).collect())

    assert takes(docs, 1) == takes(docs.repartition(5), 1)
    assert takes(docs, 1) != takes(docs, 2)


def test_nulls_empty_texts_and_repeated_rows(spark, documents):
    rows = [(None, None), (1, ""), (1, ""), (2, "a b", None, "s"), (2, "a b", None, "s"), (None, "c")]
    mixed = mixing.mix(documents(rows)).collect()
    assert len(mixed) == 6
    assert sorted(r.size for r in mixed) == [0, 0, 0, 1, 2, 2]
    assert {r.row.score for r in mixed} == {1}
    twice = [r.taken for r in mixed if r.doc_id == 2]
    assert twice[0] == twice[1]


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_nothing_to_share(documents, rows):
    mixed = mixing.mix(documents(rows)).collect()
    assert [(r.target, r.taken) for r in mixed] == [(0.0, 0)] * len(rows)


def test_main_path_is_native(documents):
    plan = mixing.mix(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
