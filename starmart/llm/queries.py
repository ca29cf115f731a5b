"""One query per operator of this subpackage: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    class_model,
    fingerprints,
    hard_negatives,
    jaccard,
    language,
    lattice,
    merkle,
    mixing,
    packing,
    pages,
    pivot_index,
    token_files,
    toxicity,
)
from starmart.llm.tokens import tokenizer_file
from starmart.llm.words import remainder
from starmart.plans import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_harmonic_packing(spark, folder):
    docs = _table(spark, folder, "documents")
    packed = packing.harmonic_pack(docs, tokenizer_file("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op2_jaccard_metric_join(spark, folder):
    return jaccard.jaccard_join(_table(spark, folder, "documents"), 4, Fraction(85, 100))


@query
def op3_host_suffix_array(spark, folder):
    return pages.extract_main_text(_table(spark, folder, "pages"))


@query
def op4_token_files(spark, folder):
    docs = _table(spark, folder, "documents")
    written = token_files.write_token_files(
        docs, scratch_folder(spark), tokenizer_file("byte_bpe_50k.json")
    )
    documents = token_files.read_token_files(spark, written)
    return documents.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op5_lattice_near_vectors(spark, folder):
    return lattice.near_vectors(_table(spark, folder, "embeddings"))


@query
def op6_kneser_ney_toxicity(spark, folder):
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.learn(docs, labels, remainder(5) != 0)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")


@query
def op7_pivot_distance_search(spark, folder):
    return pivot_index.top_k_products(_table(spark, folder, "embeddings"))


@query
def op8_cross_parsing_language(spark, folder):
    docs = _table(spark, folder, "documents")
    found = language.identify(docs, language.learn(docs, remainder(4) != 2))
    return found.withColumn("held_out", remainder(4) == 2)


@query
def op9_brown_class_scores(spark, folder):
    return class_model.score_texts(_table(spark, folder, "documents"), remainder(7) == 2)


@query
def op10_capped_mixing(spark, folder):
    mixed = mixing.mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


# md5 over the same text gives the same draws; sums of whole numbers are exact in both.
ORACLES["op10_capped_mixing"] = r"""
WITH docs AS (
    SELECT doc_id, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5('0|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS draw
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM docs GROUP BY source
), weighed AS (
    SELECT *, 3 * source_size AS ceiling, CAST([5, 2, 1][(place - 1) % 3 + 1] AS BIGINT) AS weight
    FROM sources
), filling AS (
    SELECT *,
        CAST(sum(source_size) OVER () - coalesce(sum(ceiling) OVER earlier, 0) AS BIGINT) AS rest,
        CAST(sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS BIGINT) AS open
    FROM weighed
    WINDOW earlier AS (ORDER BY ceiling / weight, place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT rest, open FROM filling WHERE rest * weight < ceiling * open
    ORDER BY ceiling / weight, place LIMIT 1
), targets AS (
    SELECT source, source_size,
        CASE WHEN f.rest * weight >= ceiling * f.open THEN CAST(ceiling AS DOUBLE)
            ELSE CAST(l.rest * weight AS DOUBLE) / CAST(l.open AS DOUBLE) END AS target
    FROM filling f LEFT JOIN level l ON TRUE
), quotas AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 1
        END AS whole
    FROM targets
), ties AS (
    SELECT source, draw, CAST(sum(size) AS BIGINT) AS size FROM docs GROUP BY source, draw
), ranked AS (
    SELECT source, draw, sum(size) OVER (PARTITION BY source ORDER BY draw) - size / 2 AS middle
    FROM ties
)
SELECT d.doc_id, d.size, q.source_size, q.target,
    CAST((q.whole + CASE WHEN q.source_size > 0
        AND r.middle <= q.target - q.whole * q.source_size THEN 1 ELSE 0 END) * d.size AS BIGINT)
        AS taken
FROM docs d
JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source
JOIN ranked r ON d.source IS NOT DISTINCT FROM r.source AND d.draw = r.draw
"""


@query
def op11_merkle_manifest(spark, folder):
    return merkle.document_manifest(_table(spark, folder, "documents"))


# crc32 is the usual reflected one (polynomial 0xEDB88320 = 3988292384) over the id's digits.
ORACLES["op11_merkle_manifest"] = r"""
WITH RECURSIVE bits AS (
    SELECT range AS byte, 0 AS step, range AS crc FROM range(256)
    UNION ALL
    SELECT byte, step + 1, CASE WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END
    FROM bits WHERE step < 8
), bytes AS (
    SELECT byte, crc FROM bits WHERE step = 8
), digits AS (
    SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS id, 1 AS pos, 4294967295 AS crc
    FROM (SELECT DISTINCT doc_id FROM documents)
    UNION ALL
    SELECT doc_id, id, pos + 1, xor(d.crc // 256, b.crc)
    FROM digits d JOIN bytes b ON b.byte = xor(d.crc % 256, ascii(substr(id, pos, 1)))
    WHERE pos <= length(id)
), crcs AS (
    SELECT doc_id, xor(crc, 4294967295) AS crc FROM digits WHERE pos = length(id) + 1
), fields AS (
    SELECT d.*, coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-')
        || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-')
        || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
        CASE WHEN c.crc % 3 = 0
            THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
            ELSE text END AS tampered_text
    FROM documents d JOIN crcs c ON d.doc_id IS NOT DISTINCT FROM c.doc_id
), hashed AS (
    SELECT row_number() OVER () AS k, doc_id, coalesce('=' || lang, '') AS tree,
        sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(strlen(tampered_text) || ':' || tampered_text, '-')) AS tampered
    FROM fields
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, k) - 1 AS place
    FROM hashed
), nodes AS (
    SELECT tree, 0 AS level, place, count(*) OVER (PARTITION BY tree) AS nodes, leaf AS node
    FROM leaves
    UNION ALL
    SELECT tree, level + 1, place // 8, (nodes + 7) // 8, sha256(string_agg(node, '' ORDER BY place))
    FROM nodes WHERE nodes > 1 GROUP BY tree, level, place // 8, nodes
), subroots AS (
    SELECT tree, node, row_number() OVER (ORDER BY encode(tree)) - 1 AS place,
        count(*) OVER () AS nodes
    FROM nodes WHERE nodes = 1
), tops AS (
    SELECT 0 AS level, place, nodes, node FROM subroots
    UNION ALL
    SELECT level + 1, place // 8, (nodes + 7) // 8, sha256(string_agg(node, '' ORDER BY place))
    FROM tops WHERE nodes > 1 GROUP BY level, place // 8, nodes
), steps AS (
    SELECT a.tree, 0 AS stage, a.level, a.place,
        coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l,
        coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r
    FROM nodes a JOIN nodes b
        ON a.tree = b.tree AND a.level = b.level AND a.place // 8 = b.place // 8
    WHERE a.nodes > 1 GROUP BY ALL
    UNION ALL
    SELECT NULL, 1, a.level, a.place,
        coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place < a.place), ''),
        coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place > a.place), '')
    FROM tops a JOIN tops b ON a.level = b.level AND a.place // 8 = b.place // 8
    WHERE a.nodes > 1 GROUP BY ALL
), paths AS (
    SELECT l.k, s.stage, s.level, s.l, s.r
    FROM leaves l JOIN steps s ON s.stage = 0 AND s.tree = l.tree
        AND s.place = l.place // CAST(pow(8, s.level) AS BIGINT)
    UNION ALL
    SELECT l.k, s.stage, s.level, s.l, s.r
    FROM leaves l JOIN subroots t ON t.tree = l.tree
        JOIN steps s ON s.stage = 1 AND s.place = t.place // CAST(pow(8, s.level) AS BIGINT)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY stage, level) AS n FROM paths
), proofs AS (
    SELECT k, string_agg(l || r, '' ORDER BY n) AS proof FROM numbered GROUP BY k
), folding AS (
    SELECT k, 1 AS n, tampered AS node FROM leaves
    UNION ALL
    SELECT f.k, f.n + 1, sha256(p.l || f.node || p.r)
    FROM folding f JOIN numbered p ON p.k = f.k AND p.n = f.n
), folded AS (
    SELECT k, max_by(node, n) AS node FROM folding GROUP BY k
)
SELECT l.doc_id, l.leaf, t.node AS subroot, r.node AS root,
    sha256(coalesce(p.proof, '')) AS proof_sha256, f.node AS folded_root,
    f.node = r.node AS verified
FROM leaves l JOIN subroots t USING (tree) JOIN folded f USING (k) LEFT JOIN proofs p USING (k)
    CROSS JOIN (SELECT node FROM tops WHERE nodes = 1) r
"""


@query
def op13_shared_list_negatives(spark, folder):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    vectors = _table(spark, folder, "embeddings")
    vectors = vectors.withColumn("label", F.coalesce(moved, F.col("label")))
    return hard_negatives.mine_hard_negatives(vectors)


# All anchors against all rows, with scores as whole numbers.
ORACLES["op13_shared_list_negatives"] = """
WITH vectors AS (
    SELECT row_number() OVER () AS k, vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.k, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
        CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.k <> b.k
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE alike QUALIFY place <= 5
), negatives AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
        p.score AS positive_score, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.k, p.place ORDER BY n.score DESC, n.vec_id) AS rank
    FROM positives p JOIN scored n ON p.k = n.k AND NOT n.alike
    WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT * FROM negatives WHERE rank <= 10
"""


@query
def op12_parsed_fingerprints(spark, folder):
    return fingerprints.compare_with_next(_table(spark, folder, "documents"))
