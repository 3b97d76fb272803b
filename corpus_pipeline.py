"""Five stages that turn ``documents`` into a clean, tokenised corpus.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and returns their columns;
the last one adds the token columns. ``run`` writes each stage's rows to the cluster's shared folder, so a lost
executor never recomputes an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import op1_secrets, op4_ngram_jaccard, op5_language, op7_decontaminate, op9_sentencepiece
from ledgerflow.sources.shared import store


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or unlike every language that was learnt, go."""
    return op5_language.keep_known(docs, docs.where(~op5_language.held_out()))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five-word shingles, similarity 0.8 or more) stays."""
    return op4_ngram_jaccard.one_per_class(docs, size=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return op7_decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return op1_secrets.redact(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests beside the documents."""
    return op9_sentencepiece.token_digests(docs)


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("sentencepiece", tokenised),
]

#: Language profiles, shingle classes and merges are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
