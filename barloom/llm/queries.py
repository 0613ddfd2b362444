"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, chat, decontamination, divergence, exact_dedup, extraction, near_dedup, negatives, quality, sharding, suffix_dedup, toxicity, warc
from barloom.llm._ship import ship


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive(_read(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_read(spark, sf_dir, "conversations"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(_read(spark, sf_dir, "documents")).drop("fraction")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = bpe.encode(_read(spark, sf_dir, "documents"), bpe.read_vocabulary(vocabulary_path()), decoded=True)
    listed = F.expr("trim(BOTH '[]' FROM to_json(ids))")
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").where("label is not null and embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    label = F.expr("case when vec_id % 7 = 0 then (bigint(label) + 1) % 10 else label end")
    rows = rows.select("vec_id", label.alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"))
    return negatives.hard_negatives(rows, "vec_id % 100 = 0")


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extract(pages, extraction.fit(pages)).select("page_id", "url", "text", "n_chars")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_near_dedup, op2_warc, op3_exact_dedup, op4_chat_format, op5_sharding, op6_quality, op7_toxicity, op8_bpe, op9_suffix_dedup, op10_decontamination, op11_source_divergence, op12_hard_negatives, op13_html_extraction)}
