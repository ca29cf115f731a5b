"""Merkle manifests: a hash tree over the rows of each group, and one over the groups' roots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.plans import scratch_folder

ARITY = 8
_KEYS = ("tree", "place")
# Bits that monotonically_increasing_id() leaves to the row within its partition.
_ROW_BITS = 33


def field_digest(columns: Sequence[Column]) -> Column:
    """sha256 in hex over all columns, each as ``-`` if null, else ``bytes:value``."""

    def coded(column: Column) -> Column:
        text = column.cast("string")
        counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(counted, F.lit("-"))

    return F.sha2(F.concat(*map(coded, columns)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and the siblings of ``path`` give."""
    return F.aggregate(
        path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256)
    )


def proof_digest(path: Column) -> Column:
    """sha256 over the siblings of a path, level by level, left to right."""
    siblings = F.transform(path, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(siblings, ""), 256)


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _placed(rows: DataFrame, order: Sequence[str], folder: str) -> DataFrame:
    """``rows`` (``tree``, ``node``, ...) with ``place`` in its tree by ``order``, and ``nodes``.

    Range partitions hold the rows in order, so a place is the rows of the tree in earlier
    partitions plus those before it in its own; a large tree is spread over many partitions.
    """
    keys = ["tree", *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    sorted_rows = _written(
        ranged.withColumn("_at", F.monotonically_increasing_id()), f"{folder}/sorted"
    )
    part = F.shiftright("_at", _ROW_BITS)
    pieces = sorted_rows.groupBy("tree", part.alias("_part")).agg(
        F.count("*").alias("_rows"), F.min("_at").alias("_from")
    )
    # A row per tree and range partition.
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        F.col("tree").alias("_tree"),
        "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_from")).alias("_shift"),
        F.sum("_rows").over(tree).alias("nodes"),
    )
    here = (F.col("tree") == F.col("_tree")) & (part == F.col("_part"))
    return (
        sorted_rows.join(offsets, here)
        .withColumn("place", F.col("_at") + F.col("_shift"))
        .drop("_tree", "_part", "_shift", "_at")
    )


def _with_siblings(level: DataFrame, arity: int) -> DataFrame:
    """The nodes of a level with the digests to their left and right in their run.

    Every node asks for the places of its siblings and an equijoin on tree and place answers.
    """
    slot = F.col("place") % arity
    if arity == 2:
        asked = F.array(F.col("place").bitwiseXOR(F.lit(1)))
    else:
        shifts = F.array(*[F.lit(shift).cast("long") for shift in range(1, arity)])
        first = F.col("place") - slot
        asked = F.transform(shifts, lambda shift: first + (slot + shift) % arity)
    requests = (
        level.select(*_KEYS, "nodes", F.explode(asked).alias("_sibling"))
        .filter(F.col("_sibling") < F.col("nodes"))
        .drop("nodes")
    )
    answers = level.select(
        F.col("tree").alias("_tree"), F.col("place").alias("_place"), F.col("node").alias("_node")
    )
    met = requests.join(
        answers, (F.col("tree") == F.col("_tree")) & (F.col("_sibling") == F.col("_place"))
    )
    gathered = met.groupBy(*_KEYS).agg(
        F.sort_array(F.collect_list(F.struct("_sibling", "_node"))).alias("_siblings")
    )

    def side(is_before: bool) -> Column:
        chosen = F.filter(
            "_siblings",
            lambda s: (s["_sibling"] < F.col("place")) == F.lit(is_before),
        )
        digests = F.array_join(F.transform(chosen, lambda s: s["_node"]), "")
        return F.coalesce(digests, F.lit(""))

    return (
        level.join(gathered, list(_KEYS), "left")
        .withColumn("left", side(True))
        .withColumn("right", side(False))
        .drop("_siblings")
    )


def _levels(leaves: DataFrame, arity: int, folder: str) -> list[DataFrame]:
    """All levels of all trees from the leaves up, each written; a tree's last node is its root."""
    most = leaves.agg(F.max("nodes")).first()[0] or 0
    levels = []
    while True:
        leaves = _written(_with_siblings(leaves, arity), f"{folder}/level-{len(levels)}")
        levels.append(leaves)
        if most <= 1:
            return levels
        most = -(-most // arity)
        slot_zero = (F.col("place") % arity == 0) & (F.col("nodes") > 1)
        leaves = leaves.filter(slot_zero).select(
            "tree",
            F.expr(f"place div {arity}").alias("place"),
            F.expr(f"(nodes + {arity - 1}) div {arity}").alias("nodes"),
            F.sha2(F.concat("node", "right"), 256).alias("node"),
        )


def _roots(levels: Sequence[DataFrame]) -> DataFrame:
    single = [level.filter("nodes = 1").select("tree", "node") for level in levels]
    return reduce(DataFrame.union, single)


def _paths(levels: Sequence[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """The leaves of ``levels`` with their ``path`` and the other columns of ``above``.

    ``above`` has a row per tree: what lies over its root. Paths are handed down a level at a time
    by tree and place, so no tree is a hot key.
    """
    carried = [name for name in above.columns if name not in ("tree", "path")]
    over = above.select("tree", F.lit(-1).cast("long").alias("place"), *carried, "path")
    upper = over
    for number in reversed(range(len(levels))):
        level = levels[number]
        up = F.when(F.col("nodes") > 1, F.expr(f"place div {arity}")).otherwise(F.lit(-1))
        handed = upper.select(
            F.col("tree").alias("_tree"), F.col("place").alias("_up"), *carried,
            F.col("path").alias("_path"),
        )
        joined = level.join(handed, (F.col("tree") == F.col("_tree")) & (up == F.col("_up")))
        step = F.array(F.struct("left", "right"))
        path = F.when(F.col("nodes") > 1, F.concat(step, "_path")).otherwise(F.col("_path"))
        found = joined.withColumn("path", path).drop("_tree", "_up", "_path")
        if number == 0:
            return found
        upper = found.select(*_KEYS, *carried, "path").unionByName(over)


def build_manifest(
    rows: DataFrame, leaf: str, tree: str, order: Sequence[str], arity: int = ARITY
) -> DataFrame:
    """``row``, ``leaf``, ``subroot``, ``root`` and ``path`` of every row.

    ``row`` is the input row, so pass only what is wanted back; ``leaf`` names its column of
    digests in hex, ``tree`` the group (a string) that has a tree of its own. Leaves ascend by
    ``order`` and then by digest; while a tree has several nodes, every ``arity`` consecutive ones
    (the last run may be shorter, even one) become the sha256 of their concatenated digests. What
    remains is the group's ``subroot``; the subroots ordered by ``tree``, null first, bytewise,
    give ``root`` likewise. ``path`` lists the siblings (``left`` and ``right`` of
    the node, concatenated) from the leaf up to the root: ``fold(leaf, path)`` is the root.

    Every level joins the nodes with the places of their siblings and writes the result; slot zero
    of each run emits the parent, so levels are resumed from files after a lost executor and
    shrink by ``arity``. Places come from range partitions, never from a sort in one task.

    A null tree is a group of its own, before the empty text. Null order values come first. Equal
    rows are leaves of their own, in any order, which changes no digest. An empty table has
    no rows and no root. Columns may have any names: they are only read inside ``row``.
    """
    folder = scratch_folder(rows.sparkSession)
    ordered = [F.col(name).alias(f"_order_{i}") for i, name in enumerate(order)]
    taken = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(tree)), F.lit("")).alias("tree"),
        F.col(leaf).alias("node"),
        *ordered,
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*[F.col(f"`{name}`") for name in rows.columns]).alias("row"),
    )
    leaves = _written(taken, f"{folder}/leaves")
    keys = [f"_order_{i}" for i in range(len(ordered))] + ["node", "_row"]
    placed = _placed(leaves, keys, folder).select(*_KEYS, "nodes", "node", "row")
    levels = _levels(placed, arity, folder)

    tops = _roots(levels).select(F.lit("").alias("tree"), "node", F.col("tree").alias("group"))
    groups = _placed(tops, ["group"], f"{folder}/groups").select(*_KEYS, "nodes", "node", "group")
    top_levels = _levels(groups, arity, f"{folder}/groups")
    none = F.array().cast("array<struct<left:string,right:string>>")
    root = _roots(top_levels).select("tree", F.col("node").alias("root"), none.alias("path"))
    over = _paths(top_levels, root, arity).select(
        F.col("group").alias("tree"), F.col("node").alias("subroot"), "root", "path"
    )
    found = _paths(levels, _written(over, f"{folder}/over"), arity)
    return found.select("row", F.col("node").alias("leaf"), "subroot", "root", "path")


def document_leaves(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``leaf`` and ``tampered_leaf`` of documents.

    Where 3 divides the crc32 of the decimal id (of an empty text if it is null), the tampered
    leaf is of the text with A-Z in lower case; elsewhere it is the leaf.
    """
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    leaf = field_digest([*fields, F.col("text")])
    tampered = F.when(F.crc32(id_text) % 3 == 0, field_digest([*fields, lowered])).otherwise(leaf)
    return docs.select("doc_id", "lang", leaf.alias("leaf"), tampered.alias("tampered_leaf"))


def document_manifest(docs: DataFrame) -> DataFrame:
    """A manifest of documents by language, and what tampering with a third of them does to it."""
    found = build_manifest(document_leaves(docs), "leaf", "lang", ["doc_id"])
    folded = fold(F.col("row.tampered_leaf"), F.col("path"))
    return found.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )
