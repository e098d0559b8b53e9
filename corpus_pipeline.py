"""A training corpus from ``documents``: language, exact copies, near copies, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import exact_dedup, lang_id, ngram_join, packing, secrets
from tabwright.llm.queries import tokenizer_path
from tabwright.session import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models recognise."""
    return lang_id.accepted(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.distinct_rows(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares five-word shingles to 0.8 or more."""
    return ngram_join.representatives(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced and n_chars counted anew."""
    models = secrets.train(secrets.labelled_samples(docs))
    return secrets.redact(docs, models)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: No SQL states trained models and retrieval; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
