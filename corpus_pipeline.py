"""A training-data pipeline over ``documents``: the stages, in order, each on all that its predecessor kept.

Every stage but the last returns the columns of ``documents``; texts that a stage changes get a new
``n_chars``.  Each stage's rows are written to the shared folder and read again by the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import line_dedup as lines
from assay.llm import packing, pii, simhash
from assay.llm import toxicity as toxic
from assay.llm.bpe import read_tokenizer
from assay.llm.common import materialize, ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _sized(docs: DataFrame) -> DataFrame:
    return _columns(docs.withColumn("n_chars", F.char_length("text").cast("long")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier toxic than not go.  A null text counts as empty; null ids, repeated ids and
    repeated rows are decided each by its own text; a tie (one half) stays; an empty table gives an empty
    table; columns beside those of documents are dropped."""
    ship(spark)
    model = toxic.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxic.reject(_columns(docs), model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines go, but for one copy (in the document with the smallest id); every document,
    null text, null id and repeated row stays.  An empty table gives an empty table; columns beside those of
    documents are dropped."""
    return _sized(lines.line_dedup(_columns(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with linked SimHash fingerprints, one row with the smallest id stays (of rows
    that share it, one).  Null texts count as texts without words, and link like them; an empty table gives
    an empty table; columns beside those of documents are dropped."""
    ship(spark)
    return _columns(simhash.keep_one(_columns(docs), shingle=3, max_bits=2))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document, null text, null id and repeated row stays.  An
    empty table gives an empty table; columns beside those of documents are dropped."""
    ship(spark)
    docs = _columns(docs)
    return _sized(pii.redact(docs, pii.train(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept texts as token sequences of 1024, in pieces.  A null text counts as empty (one token, the end);
    null and repeated ids are documents each; an empty table gives no pieces."""
    ship(spark)
    tokenizer = read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(docs, tokenizer, length=1024, end_id=0)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("private_data", private_data), ("packing", pack)]

#: SQL cannot express the stages (a classifier, 64-bit hashes, a tokenizer): they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
