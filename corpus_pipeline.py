"""A corpus pipeline of five stages: toxicity, exact and near de-duplication, decontamination, BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, decontamination, exact_dedup, near_dedup, queries, toxicity
from barloom.llm._shared import new_path, scratch
from barloom.llm._ship import ship


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; lexicon and weights are learned from the labelled documents outside the held-out fifth.

    Each row is judged by its own text: null and empty texts stay, rows that repeat stay or go together, ids and further columns play no part."""
    ship(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.gentle(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts the one with the smallest id; ties, nulls and repeated rows as exact_dedup.keep_first says."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id; ties, nulls and repeated rows as near_dedup.keep_one says."""
    ship(spark)
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item; each row is judged by its own text, and null and empty texts stay."""
    ship(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and the SHA-256 of what they decode to; one row per row, null texts as empty ones."""
    ship(spark)
    got = bpe.encode(docs.select("doc_id", "text"), bpe.read_vocabulary(queries.vocabulary_path()), decoded=True)
    own = F.sha2(F.encode("decoded", "UTF-8"), 256)
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", own.alias("decoded_sha256"))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]

#: SQL expresses neither the learned score nor the merges of BPE; tests/llm/test_pipeline.py holds each stage of a run on 200 documents
#: against plain Python (the toxicity score itself comes from the model).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name.replace(" ", "-"))
        with scratch(spark):  # what a stage has written on its way goes when its rows are there
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
