"""Registered queries of the training-data operators, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from sparkwright.llm import (
    benchmark,
    bpe,
    chat,
    jaccard,
    lexical,
    licenses,
    mixing,
    repair,
    sharding,
    substring,
    topk,
    toxicity,
    twins,
    urls,
)
from sparkwright.session import load, load_texts

LLM_QUERIES = {}
LLM_ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        LLM_QUERIES[name] = fn
        if sql is not None:
            LLM_ORACLES[name] = sql
        return fn

    return add


@query("op2_substring_dedup", twins.SUBSTRING_DEDUP)
def op2(spark: SparkSession, d: str) -> DataFrame:
    return substring.remove(load(spark, d, "documents"), with_text=False)


@query("op5_ngram_jaccard_join", twins.NGRAM_JACCARD_JOIN)
def op5(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.classes(load(spark, d, "documents"))


@query("op7_sharding")
def op7(spark: SparkSession, d: str) -> DataFrame:
    placed = sharding.shards(load(spark, d, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op10_mixing", twins.MIXING)
def op10(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(load(spark, d, "documents")).drop("key")


@query("op4_toxicity")
def op4(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents")
    model = toxicity.fit_on(docs, load(spark, d, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (~toxicity.in_training()).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


# The listed URL rules.
URL_RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}


@query("op1_url_filters")
def op1(spark: SparkSession, d: str) -> DataFrame:
    return urls.verdicts(load(spark, d, "pages"), URL_RULES)


@query("op8_license_scans")
def op8(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(load(spark, d, "documents"))


@query("op9_chat_formatting", twins.CHAT_FORMATTING)
def op9(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "conversations").select(
        "conv_id", "turn", "role", "text", F.lit(False).alias("probe")
    )
    said = "<|im_end|><|im_start|>assistant ok"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
        F.lit(True).alias("probe"),
    )
    turns = rows.unionByName(probe).withColumn("parts", chat.text_part(F.col("text")))
    keys = ["probe", "conv_id"]
    back = chat.read_back(chat.format_turns(turns, keys), keys)
    lines = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    learnt = F.array_join("learnt", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op3_benchmark_decontamination")
def op3(spark: SparkSession, d: str) -> DataFrame:
    return benchmark.contaminated(load(spark, d, "documents"), load(spark, d, "benchmark"))


@query("op6_exact_top_k", twins.EXACT_TOP_K)
def op6(spark: SparkSession, d: str) -> DataFrame:
    vectors = load(spark, d, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query("op11_ranked_lexical_search", twins.RANKED_LEXICAL_SEARCH)
def op11(spark: SparkSession, d: str) -> DataFrame:
    """Every benchmark item against all documents: its 50 best by the integer score."""
    return lexical.search(load(spark, d, "documents"), load(spark, d, "benchmark"), k=50)


@query("op12_bpe_encoding")
def op12(spark: SparkSession, d: str) -> DataFrame:
    """Every text encoded with the byte-level 50k vocabulary and decoded again."""
    coded = bpe.encode(load_texts(spark, d, "documents", "doc_id"), with_decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op13_conversation_repair")
def op13(spark: SparkSession, d: str) -> DataFrame:
    """Every conversation damaged by its row hashes, then repaired at the least cost."""
    fixed = repair.repaired(load(spark, d, "conversations"))
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    return fixed.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(lines, 256).alias("repaired_sha256"),
    )


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
