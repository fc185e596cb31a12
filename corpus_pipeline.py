"""Corpus preparation: documents in, token ids out, in stages that are written and read again.

1. language: documents whose language is undetermined or ambiguous go.
2. near_duplicates: of documents linked by five-word shingles at 0.8 the smallest id stays.
3. decontaminate: documents that hold half or more of a benchmark item go.
4. secrets: secret spans in the text are masked; documents stay.
5. tokens: ids and decoded check of what is left.

Rows without ``doc_id`` have no place in a group and stay. A row repeated under one id stays as
often as it is given. Null and empty texts go with stage 1. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, langid, near, secrets, tiling
from tidemark.llm.common import shared_dir
from tidemark.llm.queries import vocabulary_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = near.near_duplicates(docs, 5, 80)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tiling.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask(docs, secrets.fit(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(docs, vocabulary_path())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", mask_secrets),
    ("tokens", tokens),
]

# Trained, sketched and tokenised stages have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = shared_dir(spark)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
