"""Corpus pipeline: documents to packed training sequences. Every stage gets what its predecessor kept.

1. toxicity: a text whose worst window scores 0.5 or more goes.
2. line_dedup: lines on more than a twentieth of their source's texts are taken out of them.
3. near_dedup: of texts that five-word shingles link at 0.8 or more the one with the smallest id stays (one without an id only
   where no other has one). Different texts under one id are different documents; rows that repeat id and text are one.
4. pii: found spans become [KIND].
5. packing: pieces in sequences of 2048 tokens.

The first four return the columns of documents, n_chars being the length of the text as it is then (null for a null text).
Null and empty texts pass; an empty table stays empty; other columns pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from foresight.llm import line_dedup, near_dedup, packing, pii, toxicity
from foresight.session import materialize


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.learn_from(docs, labels)
    return toxicity.reject(docs, model, 0.5)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(line_dedup.drop_lines(docs, percent=5, min_pages=5).select(*docs.columns))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # a text under an id is a node of its own, so texts that share an id are not taken for one
    keyed = docs.withColumn("_node", F.xxhash64("doc_id", "text"))
    groups = near_dedup.near_duplicates(keyed.select("_node", "text"), key="_node", size=5, percent=80).select("_node", "component_id")
    nodes = keyed.select("_node", "doc_id").join(groups.distinct(), "_node")
    first = nodes.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_node")).alias("first"))
    kept = materialize(first.select("first._node"), "kept-nodes")
    return keyed.join(kept, "_node", "left_semi").dropDuplicates(["_node"]).select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(pii.redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity_stage), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup_stage), ("pii", pii_stage), ("packing", packing_stage)]
ORACLE_SQL = None  # a trained network decides the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
