import numpy as np
import pytest
from starmart.llm import lattice, pivot_index

NAN, INF = float("nan"), float("inf")


@pytest.fixture
def vectors(spark):
    def make(rows):
        full = [(key, None if v is None else [None if x is None else float(x) for x in v], 0, "x") for key, v in rows]
        return spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, n_links string")

    return make


def clustered(count, width=24, seed=0):
    """A third of the rows around one centre, the others in small families or alone."""
    random = np.random.default_rng(seed)
    centres = random.normal(size=(count // 6, width))
    rows = []
    for i in range(count):
        centre = centres[0] if i % 3 == 0 else centres[random.integers(len(centres))]
        rows.append((i, np.float32(centre + random.normal(size=width) * random.choice([0.02, 0.2, 0.8]))))
    return rows


def test_e8_is_the_nearest_point():
    random = np.random.default_rng(1)
    points = random.normal(size=(200, 8)) * 2
    near = lattice.nearest_e8(points)
    assert len(lattice.SHORTEST) == 240 and np.allclose((lattice.SHORTEST**2).sum(1), 2)
    around = near[:, None, :] + lattice.SHORTEST
    best = ((points[:, None, :] - around) ** 2).sum(2).min(1)
    assert (((points - near) ** 2).sum(1) <= best + 1e-9).all()
    assert np.allclose(near.sum(1) % 2, 0)


def test_links_match_brute_force(vectors):
    rows = clustered(600) + [(900, None), (901, [0.0] * 24), (902, [NAN] + [1.0] * 23), (903, [INF] + [1.0] * 23)]
    rows += [(904, [None] + [1.0] * 23), (905, []), (906, rows_of_one(24)), (907, rows_of_one(24)), (907, rows_of_one(24))]
    rows += [(908, [1.0])]
    x = np.zeros((len(rows), 24))
    good = np.zeros(len(rows), bool)
    for i, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(a is not None and np.isfinite(a) for a in v) and any(v):
            x[i, : len(v)] = v
            good[i] = True
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
    link = (unit @ unit.T >= 0.9) & good[:, None] & good[None, :]
    np.fill_diagonal(link, False)
    label = np.array([key for key, _ in rows])
    for _ in range(len(rows)):
        least = np.minimum(label, np.where(link, label[None, :], 10**9).min(1))
        if (least == label).all():
            break
        label = least
    expected = sorted((k, int(n), int(c)) for (k, _), n, c in zip(rows, link.sum(1), label))
    got = lattice.near_vectors(vectors(rows)).collect()
    found = sum(r.n_links for r in got) / max(1, link.sum())
    assert 0.98 <= found <= 1
    same = sum(a == b for a, b in zip(sorted((r.vec_id, r.n_links, r.component_id) for r in got), expected))
    assert same >= 0.98 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    for r in got:
        if r.vec_id in (900, 901, 902, 903, 904, 905):
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)


@pytest.mark.parametrize("width", [16, 64])
def test_pairs_at_the_threshold_are_found_in_large_tables(width):
    random = np.random.default_rng(5)
    x, other = (unit(random.normal(size=(2000, width))) for _ in range(2))
    y = 0.9 * x + np.sqrt(1 - 0.9**2) * unit(other - (x * other).sum(1, keepdims=True) * x)
    for count in (50_000, 200_000, 5_000_000):
        tables = lattice.LatticeTables(width, count, tables=6, probes=8, seed=0)
        found = np.zeros(len(x), bool)
        for (own, around), (home, near) in zip(tables.keys(x), tables.keys(y)):
            found |= (own == home) | (around == home[:, None]).any(1) | (near == own[:, None]).any(1)
        assert found.mean() >= 0.985


def test_found_pairs_do_not_depend_on_the_number_of_vectors():
    x = unit(np.random.default_rng(4).normal(size=(500, 24)))
    few, many = (lattice.LatticeTables(24, count, tables=6, probes=8, seed=0) for count in (500, 5_000_000))
    for (own, around), (home, near) in zip(few.keys(x), many.keys(x)):
        assert (own == home).all() and (around == near).all()


def unit(rows):
    return rows / np.linalg.norm(rows, axis=-1, keepdims=True)


def rows_of_one(width):
    return [1.0] * width


def check_search(rows, got):
    """Brute force over rows, each a candidate of all others."""
    good = [(k, v) for k, v in rows if v is not None and len(v) and np.isfinite(v).all()]
    keys = np.array([np.iinfo(np.int64).max if k is None else k for k, _ in good])
    x = np.zeros((len(good), 24))
    for i, (_, v) in enumerate(good):
        x[i, : len(v)] = np.floor(256 * np.array(np.float32(v), dtype=np.float64))
    expected = []
    for i in [i for i, (k, _) in enumerate(good) if k is not None and k % 50 == 0]:
        score = x @ x[i]
        order = [j for j in np.lexsort((keys, -score)) if j != i][:5]
        expected += [(keys[i], n, good[j][0], score[j]) for n, j in enumerate(order, 1)]
    found = [(r.query_id, r["rank"], r.vec_id, r.score) for r in got]
    assert sorted(found, key=repr) == sorted([(int(a), b, c, int(d)) for a, b, c, d in expected], key=repr)


def test_search_matches_brute_force(vectors):
    rows = clustered(500) + [(1000, None), (1050, [NAN] * 24), (1100, [0.0] * 24), (None, [1.0] * 24), (1101, [])]
    rows += [(1001, rows_of_one(24)), (1150, rows_of_one(24)), (1002, rows_of_one(24)), (1003, [0.5])]
    check_search(rows, pivot_index.top_k_products(vectors(rows)).collect())


def test_search_takes_repeated_rows_and_ids_as_rows(vectors):
    """A third of the rows is one vector; queries have copies, and other vectors under their id."""
    rows = clustered(120, seed=2)
    rows += [(1200, rows_of_one(24))] * 60 + [(1250, [2.0] * 24)] * 2 + [(1250, [3.0] * 24)]
    rows += [(None, [2.0] * 24)] * 3 + [(1201, [2.0] * 24)] * 2
    check_search(rows, pivot_index.top_k_products(vectors(rows)).collect())


def test_search_stops_before_most_rings_of_clusters(vectors):
    """Rows of one length in distant families: bounds separate them."""
    random = np.random.default_rng(4)
    centres = random.normal(size=(40, 24))
    rows = [(i, np.float32(unit(centres[i % 40] + 0.05 * random.normal(size=24)))) for i in range(2000)]
    found, share = pivot_index.search(vectors(rows))
    check_search(rows, found.collect())
    assert share < 0.5


def test_few_rows_and_empty_tables(vectors):
    got = pivot_index.top_k_products(vectors([(0, [1.0, 0.0]), (3, [0.5, 0.5])])).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 3, 256 * 128)]
    assert pivot_index.top_k_products(vectors([(50, [1.0])])).count() == 0
    assert pivot_index.top_k_products(vectors([])).count() == 0
    assert lattice.near_vectors(vectors([])).count() == 0


def test_large_rings_and_many_queries_are_split(vectors, monkeypatch):
    rows = clustered(400, seed=3)
    whole = pivot_index.top_k_products(vectors(rows), query="vec_id % 10 = 0").collect()
    monkeypatch.setattr(pivot_index, "_RING_ROWS", 20)
    monkeypatch.setattr(pivot_index, "_QUERY_ROWS", 15)
    split = pivot_index.top_k_products(vectors(rows), query="vec_id % 10 = 0").collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, split)) and len(whole) == 200
