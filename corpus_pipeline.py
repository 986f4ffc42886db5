"""From raw documents to token ids and the text decoded from them in five stages, each by one operator of shoalmark.llm.

Each stage takes (spark, docs, sf_dir) and gives the rows that the next one works on, written as Parquet in between.
Nulls: a document with a null text is rejected by the language stage; one with a null id stays unless its fingerprint's
component has an id.  Empty tables pass through all stages.  Repeated rows and ties: of equal texts, and of texts within the
bits, the row with the smallest id stays, and of several rows with that id the first by a hash of its content.  Other columns
of documents stay as they are up to the last stage, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalmark.llm import bpe, language_id, mixing, quality_cnn, simhash_dedup
from shoalmark.llm.common import crc_mod, filtered, table, training_rows, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents to which the byte network, learned from the labels outside the held-out fold, gives 0.3 or more."""
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    train = training_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), labels, quality_cnn.Fit.rows)
    network = quality_cnn.learn(train.select("text", "label", "weight"))
    return filtered(docs, "text", lambda texts: network.score(texts) >= 0.3)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a clear language; those go that have no letter, are mixed, or are unlike the rows of all languages."""
    known = table(spark, sf_dir, "documents").where(crc_mod("doc_id", 4) != 2).select("text", "lang")
    model = language_id.learn(known, language_id.Fit(opens=True))  # a text that quotes at length is clear, too
    shared = spark.sparkContext.broadcast(model)

    def mask(texts):
        if not shared.value.languages:
            return [False] * len(texts)
        return language_id.clear(texts, shared.value)

    return filtered(docs, "text", mask)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_dedup.dedup(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture of languages has them."""
    return mixing.mixed(docs, mixing.labelled_domains(spark, sf_dir), weights=mixing.TARGETS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, the text decoded from them, and n_tokens of each document: BPE encoding and decoding in one pass."""
    import public_tokenizers

    coded = bpe.encode_rows(docs, public_tokenizers.path("word_bpe_49k.json"), ("doc_id", "source"))
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("mixing", mixture),
    ("BPE encoding", tokens),
]

#: The stages' models and components can't be expressed in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
