"""Mixing sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# First digits of a draw: rows are summed per bucket before any of them is ranked.
_BUCKET_DIGITS = 3


def word_count(text: str = "text") -> Column:
    """Words between ASCII white space; 0 for a null."""
    words = F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def _draw(seed: int) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text")]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3
) -> DataFrame:
    """A row per source with its target; ``sizes`` has ``source`` and ``source_size``.

    Sources in code point order, null last, weigh ``weights``, repeating. Targets share the
    total by weight. One above ``max_epochs`` times its source's size is held there and
    what it leaves is shared again among the others, until none is above: sources are taken
    in the order in which they reach that ceiling, so the first source that stays below
    fixes the level for all behind it. Empty sources get 0. The windows see a row per source.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    total = Window.partitionBy()
    filling = Window.orderBy(F.col("_ceiling") / F.col("weight"), F.col("_place"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("_total") - F.coalesce(F.sum("_ceiling").over(before), F.lit(0))
    open_weight = F.sum("weight").over(total) - F.coalesce(
        F.sum("weight").over(before), F.lit(0)
    )
    placed = sizes.select(
        "source",
        "source_size",
        F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("_place"),
        (F.col("source_size") * max_epochs).alias("_ceiling"),
    ).withColumn(
        "weight",
        F.element_at(cycle, ((F.col("_place") - 1) % len(weights) + 1).cast("int")).cast("long"),
    )
    levels = (
        placed.withColumn("_total", F.sum("source_size").over(total))
        .withColumn("_rest", rest)
        .withColumn("_open", open_weight)
        .withColumn("_held", F.col("_rest") * F.col("weight") >= F.col("_ceiling") * F.col("_open"))
    )
    # Once a source stays below its ceiling, those behind it do too and share the same rest.
    first_open = F.when(~F.col("_held"), F.struct("_rest", "_open"))
    whole = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = levels.withColumn("_level", F.first(first_open, ignorenulls=True).over(whole))
    return shared.select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("_held"), F.col("_ceiling").cast("double"))
        .otherwise((F.col("_level._rest") * F.col("weight")) / F.col("_level._open"))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    max_epochs: int = 3,
    seed: int = 0,
) -> DataFrame:
    """How often each row is taken so that every source comes near its target.

    Returns ``row`` (the whole input row), ``doc_id``, ``size``, ``source_size``, ``target``,
    ``copies`` and ``taken`` = ``copies * size``. Every row is taken as many whole times as the
    target holds its source; then rows are taken once more in the order of a seeded draw
    of doc_id and text, until half of the next row would overshoot. The draw depends on the row
    alone, so reruns agree. A source's rows are summed by the first digits of their draws and
    ranked only within the digits where its target ends, so a hot source is not
    gathered in one task.

    Null texts and texts without words have size 0 and are taken as often as the whole
    repetitions say. A null source is a source. Repeated rows have one draw: they are taken
    or left together. An empty table gives an empty result. Other columns, whatever their
    names, are only carried inside ``row``.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id"),
        F.col("source"),
        word_count().alias("size"),
        _draw(seed).alias("_draw"),
    ).withColumn("_bucket", F.substring("_draw", 1, _BUCKET_DIGITS))
    sums = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    sizes = sums.groupBy("source").agg(F.sum("_sum").cast("long").alias("source_size"))
    goals = (
        source_targets(sizes, weights, max_epochs)
        .withColumn(
            "_whole",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(F.lit(1))
            .cast("long"),
        )
        .withColumn("_quota", F.col("target") - F.col("_whole") * F.col("source_size"))
        .withColumnRenamed("source", "_source")
    )
    same = _same("source", "_source")
    running = Window.partitionBy("source").orderBy("_bucket")
    edges = (
        sums.withColumn("_upto", F.sum("_sum").over(running))
        .join(goals.select("_source", "_quota"), same)
        .filter(
            (F.col("_upto") > F.col("_quota"))
            & (F.col("_upto") - F.col("_sum") <= F.col("_quota"))
        )
        .groupBy("_source")
        .agg(
            F.min("_bucket").alias("_edge"),
            F.min_by(F.col("_upto") - F.col("_sum"), "_bucket").alias("_base"),
            F.first("_quota").alias("_quota"),
        )
    )
    within = Window.partitionBy("_source").orderBy("_draw")
    upto = F.col("_base") + F.sum("_sum").over(within)
    cuts = (
        rows.select("source", "_bucket", "_draw", "size")
        .join(edges, same & (F.col("_bucket") == F.col("_edge")))
        .groupBy("_source", "_draw")
        .agg(
            F.sum("size").alias("_sum"),
            F.first("_base").alias("_base"),
            F.first("_quota").alias("_quota"),
        )
        .withColumn("_middle", upto - F.col("_sum") / 2)
        .groupBy("_source")
        .agg(F.max(F.when(F.col("_middle") <= F.col("_quota"), F.col("_draw"))).alias("_last"))
    )
    plan = (
        goals.join(edges.select(F.col("_source").alias("_s"), "_edge"), _same("_source", "_s"), "left")
        .drop("_s")
        .join(cuts.withColumnRenamed("_source", "_s"), _same("_source", "_s"), "left")
        .withColumn("_part", F.explode(F.array(*[F.lit(digit) for digit in "0123456789abcdef"])))
    )
    once_more = (
        F.when(F.col("_edge").isNull(), F.col("_quota") > 0)
        .when(F.col("_bucket") != F.col("_edge"), F.col("_bucket") < F.col("_edge"))
        .otherwise(F.coalesce(F.col("_draw") <= F.col("_last"), F.lit(False)))
    )
    return (
        rows.join(plan, same & (F.col("_part") == F.substring("_draw", 1, 1)))
        .withColumn("copies", F.col("_whole") + once_more.cast("long"))
        .select(
            "row",
            "doc_id",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )
