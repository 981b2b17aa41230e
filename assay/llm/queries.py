"""One query per operator, with production parameters over the whole intended table."""

from __future__ import annotations

from typing import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.bpe import bpe_encode, read_tokenizer
from assay.llm.common import scratch, ship
from assay.llm.context_mixing import score_documents
from assay.llm.hash_ring import shard_documents
from assay.llm.kd_topk import scaled_vectors, top_k, top_k_sql
from assay.llm.line_dedup import line_dedup, line_dedup_sql
from assay.llm.lz_fingerprint import compare_with_edits
from assay.llm.packing import pack_documents
from assay.llm.pii import KINDS, find_spans, train
from assay.llm.simhash import simhash_groups
from assay.llm.spelling import corpus_words, variant_groups
from assay.llm.toxicity import fit, score
from assay.llm.warc import archive_sql, read_archive, write_archive
from assay.llm.whitening import whiten_embeddings


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    decoded = bpe_encode(_table(spark, sf_dir, "documents"), tokenizer, decoded=True)
    return decoded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids_sha256",
                          F.sha2("text", 256).alias("decoded_sha256"))


def op2_kd_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaled_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    found = top_k(vectors, vectors.where("id % 50 = 0"), k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op4_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(_table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = find_spans(docs, train(docs))
    base = F.filter("spans", lambda s: s["rule"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("id").alias("doc_id"), *map(count, KINDS), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_archive(_table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path, payloads=False).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), "severity", "grade", "p_toxic", (F.col("p_toxic") > 0.5).alias("toxic"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer, length=1024, end_id=0).drop("ids")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op11_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"), shards=16)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = corpus_words(_table(spark, sf_dir, "documents"), "doc_id", "text", min_chars=7, min_count=2, slip_every=31)
    return variant_groups(words, ratio=10)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", components=16).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_kd_topk": op2_kd_topk,
    "op3_simhash": op3_simhash,
    "op4_lz_fingerprint": op4_lz_fingerprint,
    "op5_pii": op5_pii,
    "op6_context_mixing": op6_context_mixing,
    "op7_warc": op7_warc,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_hash_ring": op11_hash_ring,
    "op12_spelling": op12_spelling,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op2_kd_topk": top_k_sql(),
    "op7_warc": archive_sql(),
    "op10_line_dedup": line_dedup_sql(),
}
