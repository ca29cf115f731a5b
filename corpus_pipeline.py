"""A training corpus from raw documents: five stages, each written and read again.

Toxic documents go, documents without a language go, one document of each group of near copies
stays, sources are mixed to their target weights, and the rest is packed into sequences.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import jaccard, language, mixing, packing, toxicity
from starmart.llm.tokens import tokenizer_file
from starmart.llm.words import remainder
from starmart.plans import scratch_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5, learned from the labelled ones among them.

    The fifth of the labels that the operator's query holds out is held out here too. Null and empty
    texts stay.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.learn(docs, labels, remainder(5) != 0)
    return toxicity.keep_ordinary(docs, model)


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: null texts and those without a letter go."""
    return language.keep_identified(docs, language.learn(docs, remainder(4) != 2))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that shingles of five words link at 0.8."""
    return jaccard.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; rows without words are not taken.

    Null and repeated ids are rows of their own; a null source is a source.
    """
    mixed = mixing.mix(docs).filter(F.col("copies") > 0)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")
    return mixed.select("row", each).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids, placed in sequences of at most 4,096 tokens.

    Every row is a document, null and repeated ids too; null and empty texts are one end id.
    """
    packed = packing.harmonic_pack(docs, tokenizer_file("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unidentified),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Models, exact set similarity over words and tokenizers have no SQL; the tests compare the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    folder = scratch_folder(spark)

    def stage(docs: DataFrame, numbered) -> DataFrame:
        number, (name, function) = numbered
        path = f"{folder}/{number}-{name}"
        function(spark, docs, sf_dir).write.parquet(path)
        return spark.read.parquet(path)

    documents = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return reduce(stage, enumerate(STAGES, 1), documents)
