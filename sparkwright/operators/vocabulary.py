"""Vocabularies, bags of words, TF-IDF and id sequences in long form.

Rows are (document, term, count); a term that occurs in every document is
combined per task before each shuffle. A vocabulary is bounded by ``max_features``
(20,000), which is the proof of size behind each broadcast here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.operators.ranking import top_n_per
from sparkwright.session import ship_package

MAX_FEATURES = 20000
MAX_LEN = 200


def explode_tokens(df: DataFrame, tokens: Column | str, keep: Sequence[str], name: str = "word"):
    return df.select(*keep, F.explode(tokens).alias(name))


def top_words(tokens: DataFrame, label: str, word: str, n: int) -> DataFrame:
    """The n most common words of each class (ties: alphabetical)."""
    counts = tokens.groupBy(label, word).agg(F.count("*").alias("n"))
    return top_n_per(counts, [label], [F.desc("n"), F.col(word)], n)


def vocab_size(tokens: DataFrame, label: str, word: str) -> DataFrame:
    """Distinct words per class and, with a NULL class, over all."""
    pairs = tokens.select(label, word).distinct()
    per_class = pairs.groupBy(label).agg(F.count("*").alias("words"))
    overall = pairs.select(word).distinct().agg(F.count("*").alias("words"))
    return per_class.unionByName(
        overall.withColumn(label, F.lit(None).cast(tokens.schema[label].dataType))
    )


def bow_pivot(df: DataFrame, key: str, tokens: Column, words: Sequence[str]) -> DataFrame:
    """Dense document x word counts for a given word list; no shuffle, and documents
    without any of the words keep a row of zeros."""
    base = df.select(key, tokens.alias("_t"))

    def count_of(word: str) -> Column:
        return F.size(F.filter("_t", lambda t: t == F.lit(word))).cast("bigint").alias(word)

    return base.select(key, *[count_of(w) for w in words])


def with_bigrams(tokens: Column | str) -> Column:
    """Unigrams followed by the pairs of neighbours."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    n = F.greatest(F.size(t) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(t, F.lit(1), n), F.slice(t, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b)
    )
    return F.concat(t, pairs)


def term_counts(df: DataFrame, terms: Column | str, keep: Sequence[str]) -> DataFrame:
    """(keep..., term, tf)."""
    return (
        df.select(*keep, F.explode(terms).alias("term"))
        .groupBy(*keep, "term")
        .agg(F.count("*").alias("tf"))
    )


def df_prune(
    counts: DataFrame,
    n_docs: Column,
    min_df: int = 2,
    max_df: float = 0.98,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """(term, df, total): document-frequency band, then the most frequent terms."""
    return (
        counts.groupBy("term")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
        .where(F.col("df") >= min_df)
        .where(F.col("df") <= F.lit(max_df) * n_docs)
        .orderBy(F.desc("total"), "term")
        .limit(max_features)
    )


def bow_counts(
    counts: DataFrame, min_df: int = 2, max_features: int = MAX_FEATURES
) -> DataFrame:
    """Sparse counts of the most frequent terms found in ``min_df`` documents or more."""
    vocab = df_prune(counts, F.lit(1), min_df, float("inf"), max_features)
    return counts.join(F.broadcast(vocab.select("term")), "term")


def tfidf_fit(
    train_counts: DataFrame,
    train_docs: DataFrame,
    min_df: int = 2,
    max_df: float = 0.98,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """(term, df, idf) with idf = ln((1 + n) / (1 + df)) + 1, from training rows only."""
    n = train_docs.agg(F.count("*")).scalar()
    vocab = df_prune(train_counts, n, min_df, max_df, max_features)
    return vocab.withColumn(
        "idf", F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    ).select("term", "df", "idf")


def tfidf_transform(counts: DataFrame, fit: DataFrame, key: str) -> DataFrame:
    """(1 + ln tf) * idf, scaled to unit length per document; unseen terms are dropped."""
    raw = counts.join(F.broadcast(fit.select("term", "idf")), "term").withColumn(
        "w", (F.lit(1.0) + F.log("tf")) * F.col("idf")
    )
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.withColumn("w", F.col("w") / norm).drop("idf", "tf")


def vocab_rank(tokens: DataFrame, word: str, max_vocab: int = MAX_FEATURES) -> DataFrame:
    """(word, n, id): ids from 2 by falling count (ties: alphabetical); 1 is reserved
    for unknown words and 0 for padding. Numbering runs over ``max_vocab`` rows at most."""
    top = (
        tokens.groupBy(word)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), word)
        .limit(max_vocab - 2)
    )
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), word))
    return top.select(word, "n", (place + 1).alias("id"))


def texts_to_ids(df: DataFrame, key: str, tokens: Column, vocab: DataFrame, word: str = "word"):
    """Token arrays -> id arrays in text order, unknown words = 1.

    The vocabulary is bounded, so it travels to the tokens; ids of one document are
    gathered with their positions and sorted inside the row.
    """
    pos = df.select(key, F.posexplode_outer(tokens).alias("pos", word))
    ids = pos.join(F.broadcast(vocab.select(word, "id")), word, "left")
    entry = F.when(F.col(word).isNotNull(), F.struct("pos", F.coalesce("id", F.lit(1)).alias("id")))
    return ids.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_e")).select(
        key, F.transform("_e", lambda e: e["id"]).alias("ids")
    )


def pad_ids(ids: Column | str, n: int = MAX_LEN) -> Column:
    """Cut or fill with 0 on the right to exactly n ids."""
    c = F.col(ids) if isinstance(ids, str) else ids
    return F.slice(F.concat(c, F.array_repeat(F.lit(0), n)), 1, n)


def oov_ids(tokens: DataFrame, vocab: DataFrame, word: str = "word") -> DataFrame:
    return tokens.join(F.broadcast(vocab.select(word, "id")), word, "left").withColumn(
        "id", F.coalesce("id", F.lit(1))
    )


def to_sparse_vector(
    weights: DataFrame, key: str, vocab: DataFrame, size: int, keys: DataFrame | None = None
) -> DataFrame:
    """Long form -> one sparse vector per document. ``vocab`` holds (term, idx); the
    entries of a row are bounded by the vocabulary. Documents without terms are absent,
    unless ``keys`` (one column ``key``) is given: each of its keys then has a vector, an
    empty one where no term of the vocabulary occurs."""
    from pyspark.ml.linalg import Vectors, VectorUDT

    ship_package(weights.sparkSession)

    @F.udf(VectorUDT())
    def build(idx, w):
        return Vectors.sparse(size, idx, w)

    entry = F.struct("idx", "w")
    entries = (
        weights.join(F.broadcast(vocab), "term")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    )
    if keys is not None:
        none = F.array().cast(entries.schema["entries"].dataType)
        entries = keys.select(key).join(entries, key, "left").select(key, F.coalesce("entries", none).alias("entries"))
    return entries.select(key, build("entries.idx", "entries.w").alias("features"))


def index_terms(fit: DataFrame) -> DataFrame:
    """Number the fitted terms 0..V-1 alphabetically (at most ``max_features`` rows)."""
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("term")) - 1
    return fit.withColumn("idx", place)


def mean_embedding(ids: DataFrame, vectors: DataFrame, key: str, dim: int) -> DataFrame:
    """Mean vector of the token ids of each document; an id without a vector, such as that
    of unknown words, counts as zeros.

    ``ids`` holds one row per (document, id, n). Sums run per component inside the
    hash aggregate, so no (document, component) rows are built.
    """
    joined = ids.join(vectors, "id", "left")
    n = F.sum("n")
    parts = [
        F.coalesce(F.sum(F.col("n") * F.col("vector")[i]), F.lit(0.0)) / n for i in range(dim)
    ]
    return joined.groupBy(key).agg(F.array(*parts).alias("mean"))
