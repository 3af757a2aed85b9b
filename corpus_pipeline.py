"""The corpus pipeline: toxic documents go, one of each class of near copies stays,
benchmark passages take their documents with them, sources are mixed to their weights, and
what is left is packed into shards.

Each stage takes (spark, docs, sf_dir) and is written as Parquet before the next reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkwright.llm import benchmark, jaccard, mixing, sharding, toxicity
from sparkwright.session import load, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit_on(docs, load(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs.select(*COLUMNS), model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs).select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return benchmark.without(docs, load(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs).select(*COLUMNS)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shards(docs, 24)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

# The kernel machine and the fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
