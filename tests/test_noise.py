from datetime import date, timedelta

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from starmart.functions import DRAW_RANGE, row_draw
from starmart.operators import inject_noise
from starmart.sources import TABLES

TODAY = date(2025, 1, 1)
N = 4000


def make(spark, table, n=N):
    ids = spark.range(1, n + 1, 1, 4)
    columns = {
        "users": ["id user_id", "'Ann' name", "id || '@x.org' email", "'UK' country",
                  "'High St' address", "DATE '2024-01-01' signup_date"],
        "products": ["id product_id", "'Lamp' name", "'Home' category", "'A lamp' description",
                     "9.5D price"],
        "transactions": ["id transaction_id", "id + 5 user_id", "id + 9 product_id", "3 quantity",
                         "DATE '2024-01-01' transaction_date"],
    }
    return ids.selectExpr(*columns[table])


def damaged(clean, noisy):
    """Changed cells as (column, new value)."""
    before = {repr(row[1:]) + str(i): row for i, row in enumerate(clean)}
    assert len(before) == len(noisy)
    return [
        (i, new)
        for old_row, new_row in zip(clean, noisy)
        for i, (old, new) in enumerate(zip(old_row, new_row))
        if old != new
    ]


@pytest.mark.parametrize("table", TABLES)
def test_one_cell_per_damaged_row_and_every_kind(spark, table):
    df = make(spark, table)
    noisy = inject_noise(df, df.columns[0], level=0.5, today=TODAY)
    assert noisy.schema.simpleString() == df.schema.simpleString()
    before, after = rows(df), rows(noisy)
    changed = [sum(a != b for a, b in zip(x, y)) for x, y in zip(before, after)]
    assert set(changed) == {0, 1}
    assert 0.45 < sum(changed) / N < 0.55

    kinds = {}
    for i, value in damaged(before, after):
        kinds.setdefault(df.columns[i], []).append(value)
    assert set(kinds) == set(df.columns)
    for name, values in kinds.items():
        nulls = sum(v is None for v in values) / len(values)
        assert 0.4 < nulls < 0.6
        wrong = [v for v in values if v is not None]
        if name == "email":
            assert all("_at_" in v and "@" not in v for v in wrong)
        elif name.endswith("date"):
            oldest, latest = TODAY - timedelta(days=182500), TODAY - timedelta(days=36500)
            assert all(oldest <= v <= latest for v in wrong)
            assert len(set(wrong)) > len(wrong) / 2
        elif name.endswith("_id") or name in ("price", "quantity"):
            assert set(wrong) == {-1, -99, 0}
        else:
            assert set(wrong) == {""}


def test_shares(spark):
    df = make(spark, "products")
    only_null = rows(inject_noise(df, "product_id", level=0.3, null_share=1.0))
    assert {v for _, v in damaged(rows(df), only_null)} == {None}
    no_null = rows(inject_noise(df, "product_id", level=0.3, null_share=0.0))
    assert None not in {v for _, v in damaged(rows(df), no_null)}
    assert rows(inject_noise(df, "product_id", level=0.0)) == rows(df)


def test_draws_depend_on_key_and_seed_only(spark):
    df = make(spark, "users")
    one = sorted(map(repr, rows(inject_noise(df, "user_id", 0.2, today=TODAY))))
    two = sorted(map(repr, rows(inject_noise(df.repartition(7), "user_id", 0.2, today=TODAY))))
    other = sorted(map(repr, rows(inject_noise(df, "user_id", 0.2, seed=1, today=TODAY))))
    assert one == two != other


@pytest.mark.parametrize("level", [0.0, 0.0003, 0.03, 0.5, 1.0])
def test_exact_number_of_rows(spark, level):
    # One text column besides the key, and NULL as the only damage: every pick shows.
    df = spark.range(1, N + 1, 1, 4).selectExpr("id", "'x' a", "'y' b")
    noisy = inject_noise(df, "id", level=level, null_share=1.0, exact=True)
    hit = noisy.where(" OR ".join(f"{c} IS NULL" for c in df.columns))
    assert hit.count() == int(N * level) and noisy.count() == N


def test_exact_number_among_equal_draws(spark):
    # Rows with the same key share their draw; the cut may fall among them.
    df = spark.range(0, 900).selectExpr("id % 3 AS id", "id AS n")
    noisy = inject_noise(df, "id", level=0.5, null_share=1.0, exact=True)
    assert noisy.where("id IS NULL OR n IS NULL").count() == 450


def test_default_needs_no_shuffle(spark):
    plan = inject_noise(make(spark, "users"), "user_id")._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_other_columns(spark):
    df = spark.range(1, 2000).select(
        F.col("id"), F.lit(5).alias("score"), F.lit(True).alias("active")
    )
    noisy = inject_noise(df, "id", level=1.0, null_share=0.0)
    assert {r.score for r in noisy.collect()} == {5, -1, -99, 0}
    assert {r.active for r in noisy.collect()} == {True, None}


def test_neighbouring_keys_and_seeds_are_drawn_apart(spark):
    """Neither rows (t, p) and (t + 1, p - 31) nor seeds 0 and 1 are damaged alike."""
    df = spark.range(1, 4001).selectExpr("id AS t", "id * 31 + 100 AS p")
    ids = F.col("t"), F.col("p")

    def hit(frame, seed):
        draw = F.expr(row_draw(["t", "p"], seed)) < F.lit(DRAW_RANGE // 2)
        return [r[0] for r in frame.orderBy("t").select(draw).collect()]

    zero, one = hit(df, 0), hit(df, 1)
    moved = hit(df.select((ids[0] + 1).alias("t"), (ids[1] - 31).alias("p")), 0)
    for other in (one, moved, one[31:] + one[:31], one[1:] + one[:1]):
        assert 0.4 < sum(a == b for a, b in zip(zero, other)) / len(zero) < 0.6


def test_null_keys_are_drawn_one_by_one(spark):
    df = spark.range(0, 2000).selectExpr("CAST(NULL AS BIGINT) AS id", "id AS n", "'x' AS a")
    noisy = inject_noise(df, "id", level=0.25, null_share=1.0, exact=True)
    # A third of the damage falls on the key, which is NULL already.
    assert 200 < noisy.where("n IS NULL OR a IS NULL").count() < 450
