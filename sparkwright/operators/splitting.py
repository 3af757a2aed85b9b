"""Deterministic train/test splits and folds from seeded row hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.functions.hashing import hash32, hash_below
from sparkwright.operators.ordered import hash_rank


def random_split(df: DataFrame, key: str | list[str], test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Unstratified split as a 0/1 column: a hash threshold, no shuffle."""
    keys = [key] if isinstance(key, str) else key
    return df.withColumn("is_test", hash_below(seed, test_size, *keys).cast("int"))


def kfold_assign(df: DataFrame, key: str | list[str], k: int = 5, seed: int = 42) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return df.withColumn("fold", F.pmod(hash32(seed, *keys), F.lit(k)).cast("int"))


def test_quotas(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """(label, quota): ceil(test_size * n) rows shared out by largest remainder."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_c"))
    all_rows = Window.partitionBy(F.lit(0))  # one row per class
    n = F.sum("n_c").over(all_rows)
    counts = counts.withColumn("n", n).withColumn(
        "n_test", F.ceil(F.lit(test_size) * F.col("n")).cast("bigint")
    )
    exact = F.col("n_c") * F.col("n_test") / F.col("n")
    counts = counts.withColumn("base", F.floor(exact).cast("bigint")).withColumn(
        "frac", exact - F.floor(exact)
    )
    left = F.col("n_test") - F.sum("base").over(all_rows)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("frac"), label))
    return counts.select(
        label, (F.col("base") + (place <= left).cast("bigint")).alias("quota")
    )


def stratified_split(
    df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Split with exact per-class quotas as a 0/1 column ``is_test``: the rows of a
    class that come first in hash order are the test rows."""
    quotas = test_quotas(df, label, test_size)
    ranked = hash_rank(df, hash32(seed, key), key, group=[label], per_group=quotas)
    return ranked.withColumn("is_test", (F.col("rn") <= F.col("quota")).cast("int")).drop(
        "rn", "quota"
    )


def stratified_kfold(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Folds dealt round-robin in hash order within each class."""
    ranked = hash_rank(df, hash32(seed, key), key, group=[label])
    return ranked.withColumn("fold", F.pmod(F.col("rn") - 1, F.lit(k)).cast("int")).drop("rn")
