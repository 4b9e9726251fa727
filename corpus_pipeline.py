"""Corpus pipeline: raw documents to packed batches, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows the stage before kept, and
returns a DataFrame that is written as Parquet and read again by the next one. All but
the last return the columns of ``documents``, extra ones included.

1. ``language_id`` drops documents without a language (null text, no letter) and gives those without
   ``lang`` the predicted one. Where no document has a label to learn from, those with a letter stay as they are.
2. ``simhash_dedup`` keeps the document with the smallest id of each group of near
   duplicates.
3. ``decontaminate`` drops documents that hold at least half of a benchmark item.
4. ``secret_scan`` masks secrets in the text and sets ``n_chars`` anew where it did.
5. ``packing`` returns bucket, batch and slot of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewline.llm import langid, packing, secrets, simhash, tiling
from renewline.llm.common import free_name, materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = langid.train(docs)
    return langid.keep_identified(docs, net)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    blocks = tiling.item_blocks(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return tiling.drop_leaked(docs, blocks)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = free_name(docs, "secret_spans")
    spans = F.col(name)
    masked = secrets.find_secrets(docs, name=name).withColumn("text", secrets.redact(F.col("text"), spans))
    n_chars = F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).drop(name)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Training, fingerprints and tiling are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
