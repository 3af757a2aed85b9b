"""Sorts, limits, top-k and keep-first over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import ranking as R
from sparkwright.plans.registry import query
from sparkwright.session import load


def _suppliers(spark, d):
    return load(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")


@query("sort_results", "SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey")
def sort_results(spark, d):
    return R.sort_results(_suppliers(spark, d), "s_acctbal", "s_suppkey")


@query(
    "head_n",
    "SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 30",
)
def head_n(spark, d):
    return R.head_n(_suppliers(spark, d), [F.desc("s_acctbal"), F.col("s_suppkey")], 30)


@query(
    "top_bottom_n",
    """
    (SELECT s_suppkey, s_name, s_acctbal, 'top' AS side FROM supplier
     ORDER BY s_acctbal DESC, s_suppkey LIMIT 25)
    UNION ALL
    (SELECT s_suppkey, s_name, s_acctbal, 'bottom' AS side FROM supplier
     ORDER BY s_acctbal, s_suppkey LIMIT 25)
    """,
)
def top_bottom_n(spark, d):
    return R.top_bottom_n(_suppliers(spark, d), "s_acctbal", "s_suppkey", 25)


@query(
    "top_abs_n",
    """
    SELECT s_suppkey, s_name, s_acctbal FROM supplier
    ORDER BY abs(s_acctbal) DESC, s_suppkey LIMIT 25
    """,
)
def top_abs_n(spark, d):
    return R.top_abs_n(_suppliers(spark, d), "s_acctbal", "s_suppkey", 25)


@query(
    "dedupe_keep_first",
    """
    SELECT doc_id, md5(text) AS text_md5 FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
    """,
)
def dedupe_keep_first(spark, d):
    # Digests stand for the texts, so no text is shuffled.
    docs = load(spark, d, "documents").select(
        "doc_id",
        F.sha2("text", 256).alias("content"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
    )
    return R.dedupe_keep_first(docs, "content", "doc_id").drop("content")


@query("distinct_sorted", "SELECT DISTINCT p_retailprice FROM part ORDER BY p_retailprice")
def distinct_sorted(spark, d):
    return R.distinct_sorted(load(spark, d, "part"), "p_retailprice")
