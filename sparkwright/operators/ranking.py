"""Sorts, limits, top-k and keep-first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sort_results(df: DataFrame, metric: str, tie: str, ascending: bool = True) -> DataFrame:
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    return df.orderBy(order, tie)


def head_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_bottom_n(df: DataFrame, value: str, tie: str, n: int, name: str = "side") -> DataFrame:
    """The n largest and n smallest rows; two top-n passes instead of a full sort."""
    top = df.orderBy(F.desc(value), tie).limit(n).withColumn(name, F.lit("top"))
    bottom = df.orderBy(F.asc(value), tie).limit(n).withColumn(name, F.lit("bottom"))
    return top.unionByName(bottom)


def top_abs_n(df: DataFrame, value: str, tie: str, n: int) -> DataFrame:
    return df.orderBy(F.abs(value).desc(), tie).limit(n)


def top_n_per(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows of each group. Spark limits each group before the shuffle, so a
    big group sends n rows per task."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def dedupe_keep_first(df: DataFrame, content: str, key: str) -> DataFrame:
    """One row per content, the one with the smallest key; NULL is a content as well.

    Only (digest, key) pairs are grouped and only the surviving keys are joined
    back: a text that fills a third of the table is one row per task, and no text
    travels to be compared.
    """
    keep = (
        df.select(F.sha2(F.col(content), 256).alias("_digest"), key)
        .groupBy("_digest")
        .agg(F.min(key).alias(key))
        .select(key)
    )
    return df.join(keep, key, "left_semi")


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)
