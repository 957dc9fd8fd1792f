"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet into the cluster's shared folder and rereads it as the next
stage's documents.  All stages but the last return the columns of documents.

Defined results: null texts are empty for every decision; rows with a null
doc_id pass through both deduplications; empty tables give empty tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.llm import byte_cnn, lsh_forest, packing, pii, sentence_dedup
from tracewise.llm.common import table
from tracewise.session import ensure_checkpoint_dir, prepare

MIN_SCORE = 0.5


def _recount(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level network, fitted on the labels; rejected documents go."""
    model = byte_cnn.fit_quality(docs, table(spark, sf_dir, "labels"))
    return byte_cnn.with_score(docs, model, score_col="__tw_score").where(
        F.col("__tw_score") >= MIN_SCORE).drop("__tw_score")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (five words, 0.8)."""
    return lsh_forest.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences that repeat an earlier span go; so do documents that consist
    of nothing else."""
    rows = sentence_dedup.without_repeats(docs, removed_col="__tw_removed")
    return _recount(rows.where("__tw_removed = 0 OR text RLIKE '[^\\\\s]'").drop("__tw_removed"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the kind in brackets."""
    return _recount(pii.redact(docs, pii.fit_selector(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of all that is left; each row has its piece's text, so
    the sequences can be rebuilt from the rows alone."""
    return packing.with_texts(packing.pack(docs), docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("minhash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("pii", redact_personal_data),
    ("best-fit packing", pack_sequences),
]

# The network, the trees and the greedy packing are beyond SQL; tests/llm holds
# every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    prepare(spark)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
