"""Joins between tokens, vocabularies, coefficients and word vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.functions.hashing import SPAN, hash32


def token_coef_join(tokens: DataFrame, coef: DataFrame, word: str = "word") -> DataFrame:
    """Tokens with their coefficient; ``coef`` comes from a bounded vocabulary."""
    return tokens.join(F.broadcast(coef), word)


def in_vocab_semi(tokens: DataFrame, vocab: DataFrame, word: str = "word") -> DataFrame:
    return tokens.join(vocab.select(word), word, "left_semi")


def stopword_anti(tokens: DataFrame, stop_words: Sequence[str], word: str = "word") -> DataFrame:
    """Drop listed words; the list is a literal, so it is a broadcast of known size."""
    spark = tokens.sparkSession
    listed = spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in stop_words])).alias(word))
    return tokens.join(F.broadcast(listed), word, "left_anti")


def normal_draws(word: Column | str, dim: int, scale: float = 0.6, seed: int = 42) -> Column:
    """Repeatable N(0, scale^2) vector for a word (Box-Muller on two row hashes)."""

    def draw(i: Column) -> Column:
        u = (hash32(f"{seed}:a", word, i) + 1) / F.lit(float(SPAN))
        v = hash32(f"{seed}:b", word, i) / F.lit(float(SPAN))
        return F.lit(scale) * F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(2.0) * F.pi() * v)

    return F.transform(F.sequence(F.lit(1), F.lit(dim)), draw)


def vector_left_join(
    words: DataFrame,
    vectors: DataFrame,
    word: str,
    dim: int,
    fill: str = "random",
    seed: int = 42,
) -> DataFrame:
    """Attach a vector to each word; words without one get seeded noise or zeros."""
    if fill == "random":
        missing = normal_draws(word, dim, seed=seed)
    else:
        missing = F.array_repeat(F.lit(0.0), dim)
    known = F.col("vector").cast("array<double>")
    return words.join(vectors, word, "left").withColumn("vector", F.coalesce(known, missing))


def full_outer_counts(left: DataFrame, right: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Full outer join of two ranked lists, a missing count is 0."""
    return left.join(right, key, "full_outer").select(
        key, *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in (a, b)]
    )


def union_model_rows(rows: Sequence[DataFrame]) -> DataFrame:
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def word_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()
