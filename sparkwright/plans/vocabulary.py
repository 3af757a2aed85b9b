"""Vocabulary, bag-of-words, TF-IDF and sequence queries over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import text as T
from sparkwright.operators import joining as J
from sparkwright.operators import splitting as P
from sparkwright.operators import vocabulary as V
from sparkwright.plans import sqlparts as Q
from sparkwright.plans.registry import query
from sparkwright.plans.shaping import labelled_docs
from sparkwright.session import load, load_texts, load_texts_by_key, materialize

PIVOT_WORDS = ["that", "with", "this", "avec", "dans", "nicht", "para", "como"]


def labelled_tokens(spark, d):
    """(doc_id, label, word) of the cleaned labelled documents."""
    return V.explode_tokens(labelled_docs(spark, d), T.clean_tokens("text"), ["doc_id", "label"])


def all_words(spark, d, read=load_texts):
    return V.explode_tokens(read(spark, d, "documents", "doc_id"), T.word_tokens("text"), ["doc_id"])


def clean_counts(spark, d, bigrams=True):
    """(doc_id, term, tf) over all documents."""
    docs = load_texts_by_key(spark, d, "documents", "doc_id")
    docs = docs.select("doc_id", T.clean_tokens("text").alias("toks"))
    return V.term_counts(docs, V.with_bigrams("toks") if bigrams else F.col("toks"), ["doc_id"])


def split_counts(spark, d):
    """Term counts of the labelled documents with the train/test flag, written once
    because the vocabulary, the weights and every model read them again."""
    docs = P.random_split(labelled_docs(spark, d, by_key=True), "doc_id")
    keep = ["doc_id", "label", "is_test"]
    toks = docs.select(*keep, T.clean_tokens("text").alias("toks"))
    return materialize(V.term_counts(toks, V.with_bigrams("toks"), keep), "term-counts")


def split_docs(spark, d):
    docs = P.random_split(labelled_docs(spark, d), "doc_id")
    return docs.select("doc_id", "label", "is_test")


def fitted_tfidf(spark, d):
    """(fit, weights): fitted on training rows, applied to all labelled documents."""
    counts = split_counts(spark, d)
    train = split_docs(spark, d).where("is_test = 0")
    fit = V.tfidf_fit(counts.where("is_test = 0"), train)
    fit = materialize(fit, "tfidf-fit")
    return fit, V.tfidf_transform(counts, fit, "doc_id")


@query(
    "top_words",
    f"""
    WITH {Q.LABELLED}
    SELECT label, word, count(*) AS n, CAST(row_number() OVER
           (PARTITION BY label ORDER BY count(*) DESC, word) AS INTEGER) AS rank
    FROM tok GROUP BY label, word QUALIFY rank <= 30
    """,
)
def top_words(spark, d):
    return V.top_words(labelled_tokens(spark, d), "label", "word", 30)


@query(
    "vocab_size",
    f"""
    WITH {Q.LABELLED}
    SELECT label, count(DISTINCT word) AS words FROM tok GROUP BY GROUPING SETS ((label), ())
    """,
)
def vocab_size(spark, d):
    return V.vocab_size(labelled_tokens(spark, d), "label", "word")


@query(
    "bow_pivot",
    "SELECT doc_id, "
    + ", ".join(f"CAST(len(list_filter(t, lambda w: w = '{w}')) AS BIGINT) AS \"{w}\"" for w in PIVOT_WORDS)
    + f" FROM (SELECT doc_id, regexp_extract_all(lower(text), {Q.q(T.WORDS)}) AS t FROM documents)",
)
def bow_pivot(spark, d):
    return V.bow_pivot(load_texts(spark, d, "documents", "doc_id"), "doc_id", T.word_tokens("text"), PIVOT_WORDS)


@query(
    "bow_counts",
    f"""
    WITH {Q.CLEAN_ALL}, {Q.terms(bigrams=False)},
    tf AS (SELECT doc_id, term, count(*) AS tf FROM term GROUP BY ALL),
    vocab AS (SELECT term FROM tf GROUP BY term HAVING count(*) >= 2
              ORDER BY sum(tf) DESC, term LIMIT 20000)
    SELECT tf.doc_id, tf.term, tf.tf FROM tf JOIN vocab ON tf.term = vocab.term
    """,
)
def bow_counts(spark, d):
    counts = materialize(clean_counts(spark, d, bigrams=False), "bow")
    return V.bow_counts(counts).select("doc_id", "term", "tf")


@query(
    "ngrams_1_2",
    f"WITH {Q.CLEAN_ALL}, {Q.terms()} SELECT term, count(*) AS n FROM term GROUP BY term",
)
def ngrams_1_2(spark, d):
    docs = load_texts(spark, d, "documents", "doc_id").select(T.clean_tokens("text").alias("toks"))
    grams = docs.select(F.explode(V.with_bigrams("toks")).alias("term"))
    return grams.groupBy("term").agg(F.count("*").alias("n"))


@query(
    "df_prune",
    f"""
    WITH {Q.CLEAN_ALL}, {Q.terms()},
    tf AS (SELECT doc_id, term, count(*) AS tf FROM term GROUP BY ALL)
    SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM tf GROUP BY term
    HAVING count(*) >= 2 AND count(*) <= 0.98 * (SELECT count(*) FROM documents)
    ORDER BY sum(tf) DESC, term LIMIT 20000
    """,
)
def df_prune(spark, d):
    n = load(spark, d, "documents").agg(F.count("*")).scalar()
    return V.df_prune(clean_counts(spark, d), n)


@query(
    "tfidf_fit",
    f"WITH {Q.TFIDF} SELECT term, df, round(idf, 9) AS idf FROM vocab",
)
def tfidf_fit(spark, d):
    counts = split_counts(spark, d)
    fit = V.tfidf_fit(counts.where("is_test = 0"), split_docs(spark, d).where("is_test = 0"))
    return fit.withColumn("idf", F.round("idf", 9))


@query(
    "tfidf_transform",
    f"WITH {Q.TFIDF} SELECT doc_id, is_test, term, round(w, 8) AS w FROM tfidf",
)
def tfidf_transform(spark, d):
    _, weights = fitted_tfidf(spark, d)
    return weights.select("doc_id", "is_test", "term", F.round("w", 8).alias("w"))


@query(
    "to_sparse_vector",
    f"""
    WITH {Q.TFIDF}, ix AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM vocab)
    SELECT doc_id, CAST(count(*) AS BIGINT) AS filled, round(sum(w), 6) AS weight_sum,
           round(sum(w * idx), 3) AS index_sum
    FROM tfidf t JOIN ix ON t.term = ix.term GROUP BY doc_id
    """,
)
def to_sparse_vector(spark, d):
    fit, weights = fitted_tfidf(spark, d)
    vocab = V.index_terms(fit).select("term", "idx")
    vectors = V.to_sparse_vector(weights, "doc_id", vocab, V.MAX_FEATURES)
    # The filled slots only: as a dense array a document would have MAX_FEATURES of them.
    slots = vectors.withColumn("x", F.unwrap_udt("features"))
    total = F.lit(0.0)
    placed = F.zip_with("x.values", "x.indices", lambda v, i: v * i)
    return slots.select(
        "doc_id",
        F.size(F.filter("x.values", lambda v: v != 0)).cast("bigint").alias("filled"),
        F.round(F.aggregate("x.values", total, lambda a, v: a + v), 6).alias("weight_sum"),
        F.round(F.aggregate(placed, total, lambda a, v: a + v), 3).alias("index_sum"),
    )


@query(
    "vocab_rank",
    f"""
    WITH w AS (SELECT unnest(regexp_extract_all(lower(text), {Q.q(T.WORDS)})) AS word FROM documents)
    SELECT word, count(*) AS n,
           CAST(row_number() OVER (ORDER BY count(*) DESC, word) + 1 AS INTEGER) AS id
    FROM w GROUP BY word ORDER BY n DESC, word LIMIT 19998
    """,
)
def vocab_rank(spark, d):
    return V.vocab_rank(all_words(spark, d), "word")


# Token ids of every document; the vocabulary is built from the same documents.
IDS = f"""
    t AS (SELECT doc_id, regexp_extract_all(lower(text), {Q.q(T.WORDS)}) AS toks FROM documents),
    w AS (SELECT doc_id, unnest(toks) AS word, unnest(range(len(toks))) AS pos FROM t),
    vocab AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) + 1 AS id
              FROM w GROUP BY word ORDER BY count(*) DESC, word LIMIT 19998),
    seq AS (SELECT w.doc_id, list(CAST(coalesce(v.id, 1) AS INTEGER) ORDER BY w.pos) AS ids
            FROM w LEFT JOIN vocab v ON w.word = v.word GROUP BY w.doc_id)
"""


def _ids(spark, d):
    vocab = materialize(V.vocab_rank(all_words(spark, d), "word"), "vocab")
    docs = load_texts_by_key(spark, d, "documents", "doc_id")
    return V.texts_to_ids(docs, "doc_id", T.word_tokens("text"), vocab)


@query(
    "texts_to_ids",
    f"""
    WITH {IDS} SELECT doc_id, CAST(len(ids) AS BIGINT) AS n,
         md5(array_to_string(ids, ' ')) AS ids_md5 FROM seq
    """,
)
def texts_to_ids(spark, d):
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return _ids(spark, d).select(
        "doc_id", F.size("ids").cast("bigint").alias("n"), F.md5(joined.cast("binary")).alias("ids_md5")
    )


@query(
    "pad_ids",
    f"""
    WITH {IDS}, p AS (SELECT doc_id, list_concat(ids, list_transform(range(200),
                             lambda i: 0::INTEGER))[1:200] AS ids FROM seq)
    SELECT doc_id, CAST(len(ids) AS BIGINT) AS n, md5(array_to_string(ids, ' ')) AS ids_md5 FROM p
    """,
)
def pad_ids(spark, d):
    padded = _ids(spark, d).withColumn("ids", V.pad_ids("ids"))
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return padded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n"), F.md5(joined.cast("binary")).alias("ids_md5")
    )


@query(
    "oov_left_join",
    f"""
    WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {Q.q(T.WORDS)})) AS word
               FROM documents),
    vocab AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) + 1 AS id
              FROM w GROUP BY word ORDER BY count(*) DESC, word LIMIT 19998)
    SELECT w.doc_id, count(*) AS words, count(*) FILTER (WHERE coalesce(v.id, 1) = 1) AS unknown,
           CAST(sum(coalesce(v.id, 1)) AS BIGINT) AS id_sum
    FROM w LEFT JOIN vocab v ON w.word = v.word GROUP BY w.doc_id
    """,
)
def oov_left_join(spark, d):
    words = all_words(spark, d)
    ids = V.oov_ids(words, V.vocab_rank(words, "word"))
    return ids.groupBy("doc_id").agg(
        F.count("*").alias("words"),
        F.count_if(F.col("id") == 1).alias("unknown"),
        F.sum("id").alias("id_sum"),
    )


_WORD_IDS = f"""
    w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {Q.q(T.WORDS)})) AS word
          FROM documents),
    vocab AS (SELECT word, CAST(row_number() OVER (ORDER BY count(*) DESC, word) + 1 AS INTEGER) AS id
              FROM w GROUP BY word ORDER BY count(*) DESC, word LIMIT 19998)
"""


def _id_vectors(spark, d, fill):
    """Vocabulary ids with the vector of the same number, where there is one."""
    vocab = V.vocab_rank(all_words(spark, d), "word")
    vectors = load(spark, d, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("vector")
    )
    return J.vector_left_join(vocab, vectors, "id", 64, fill)


@query(
    "vector_left_join",
    f"""
    WITH {_WORD_IDS},
    z AS (SELECT v.word, v.id, CAST(e.embedding AS DOUBLE[]) AS known, list_transform(range(1, 65),
             lambda i: 0.6::DOUBLE * sqrt(-2 * ln(
               (('0x' || substr(md5('42:a:' || v.id || ':' || i), 1, 8))::BIGINT + 1)
                 / 4294967296.0::DOUBLE))
               * cos(2 * pi() * (('0x' || substr(md5('42:b:' || v.id || ':' || i), 1, 8))::BIGINT
                 / 4294967296.0::DOUBLE))) AS noise
          FROM vocab v LEFT JOIN embeddings e ON v.id = e.vec_id)
    SELECT word, id, list_transform(coalesce(known, noise), lambda x: round(x, 6)) AS vector FROM z
    """,
)
def vector_left_join(spark, d):
    out = _id_vectors(spark, d, "random")
    return out.select("word", "id", F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))


@query(
    "mean_embedding",
    f"""
    WITH {_WORD_IDS},
    z AS (SELECT v.word, CAST(e.embedding AS DOUBLE[]) AS vector
          FROM vocab v JOIN embeddings e ON v.id = e.vec_id),
    c AS (SELECT doc_id, word, count(*) AS n FROM w GROUP BY ALL),
    t AS (SELECT doc_id, sum(n) AS n FROM c GROUP BY doc_id),
    u AS (SELECT c.doc_id, c.n, unnest(z.vector) AS x, unnest(range(64)) AS i
          FROM c JOIN z ON c.word = z.word),
    m AS (SELECT u.doc_id, i, sum(u.n * x) AS x FROM u GROUP BY ALL),
    k AS (SELECT m.doc_id, list(round(x / t.n, 6) ORDER BY i) AS mean
          FROM m JOIN t ON m.doc_id = t.doc_id GROUP BY m.doc_id)
    SELECT d.doc_id, coalesce(k.mean, list_transform(range(64), lambda i: 0::DOUBLE)) AS mean
    FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
    """,
)
def mean_embedding(spark, d):
    words = all_words(spark, d, load_texts_by_key).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    vectors = materialize(_id_vectors(spark, d, "zeros"), "id-vectors")
    ids = V.oov_ids(words, vectors)
    found = V.mean_embedding(ids, F.broadcast(vectors.select("id", "vector")), "doc_id", 64)
    zeros = F.array_repeat(F.lit(0.0), 64)
    return (
        load(spark, d, "documents")
        .select("doc_id")
        .join(found, "doc_id", "left")
        .select("doc_id", F.transform(F.coalesce("mean", zeros), lambda x: F.round(x, 6)).alias("mean"))
    )
