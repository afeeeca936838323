"""A corpus pipeline of five of the operators: bad documents, copies and leaks go, personal data is replaced, the rest is encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley.llm import decontaminate, minhash, pii, quality, tokens
from parley.llm.common import saved


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.EXAMPLE_KEY)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.encode_digests(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pseudonyms),
    ("sentencepiece", encoding),
]

#: SQL can express neither the model nor the signatures; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents, each stage's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
