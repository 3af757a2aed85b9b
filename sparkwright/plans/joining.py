"""Joins and set operations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import text as T
from sparkwright.functions.stopwords import default_stop_words
from sparkwright.operators import joining as J
from sparkwright.operators import vocabulary as V
from sparkwright.plans import sqlparts as Q
from sparkwright.plans.registry import query
from sparkwright.plans.vocabulary import all_words, labelled_tokens
from sparkwright.session import load

WORDS_SQL = f"""
    w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {Q.q(T.WORDS)})) AS word
          FROM documents)
"""


@query(
    "in_vocab_semi",
    f"""
    WITH {WORDS_SQL},
    vocab AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), {Q.q(T.WORDS)})) AS word
              FROM benchmark)
    SELECT doc_id, word, count(*) AS n FROM w WHERE word IN (SELECT word FROM vocab)
    GROUP BY doc_id, word
    """,
)
def in_vocab_semi(spark, d):
    vocab = V.explode_tokens(load(spark, d, "benchmark"), T.word_tokens("text"), []).distinct()
    counts = all_words(spark, d).groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    return J.in_vocab_semi(counts, vocab).select("doc_id", "word", "n")


@query(
    "stopword_anti",
    f"""
    WITH {WORDS_SQL}
    SELECT doc_id, word, count(*) AS n FROM w
    WHERE word NOT IN ({', '.join(Q.q(x) for x in default_stop_words())})
    GROUP BY doc_id, word
    """,
)
def stopword_anti(spark, d):
    kept = J.stopword_anti(all_words(spark, d), default_stop_words())
    return kept.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


TOP_SQL = f"""
    {Q.LABELLED},
    r AS (SELECT label, word, count(*) AS n FROM tok GROUP BY label, word
          QUALIFY row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, word) <= 30)
"""


def _top_lists(spark, d):
    top = V.top_words(labelled_tokens(spark, d), "label", "word", 30)
    return top.where("label = 0"), top.where("label = 1")


@query(
    "top_words_full_outer",
    f"""
    WITH {TOP_SQL}
    SELECT word, CAST(coalesce(max(CASE WHEN label = 0 THEN n END), 0) AS BIGINT) AS n0,
           CAST(coalesce(max(CASE WHEN label = 1 THEN n END), 0) AS BIGINT) AS n1
    FROM r GROUP BY word
    """,
)
def top_words_full_outer(spark, d):
    a, b = _top_lists(spark, d)
    return J.full_outer_counts(
        a.select("word", F.col("n").alias("n0")), b.select("word", F.col("n").alias("n1")),
        "word", "n0", "n1",
    )


@query("word_union", f"WITH {TOP_SQL} SELECT DISTINCT word FROM r")
def word_union(spark, d):
    a, b = _top_lists(spark, d)
    return J.word_union(a.select("word"), b.select("word"))


def _model_row_sql(name, where):
    return (
        f"SELECT '{name}' AS model, count(*) AS n, round(avg(l_extendedprice), 6) AS mean_price, "
        f"max(l_quantity) AS max_quantity FROM lineitem WHERE {where}"
    )


@query(
    "union_model_rows",
    " UNION ALL ".join(_model_row_sql(f, f"l_returnflag = '{f}'") for f in "ANR"),
)
def union_model_rows(spark, d):
    li = load(spark, d, "lineitem")
    rows = [
        li.where(F.col("l_returnflag") == f).agg(
            F.lit(f).alias("model"),
            F.count("*").alias("n"),
            F.round(F.avg("l_extendedprice"), 6).alias("mean_price"),
            F.max("l_quantity").alias("max_quantity"),
        )
        for f in "ANR"
    ]
    return J.union_model_rows(rows)


@query(
    "token_coef_join",
    f"""
    WITH {Q.nb()}
    SELECT t.doc_id, t.word, count(*) AS n, round(sum(c.coef), 6) AS coef_sum
    FROM tok t JOIN coef c ON t.word = c.term GROUP BY t.doc_id, t.word
    """,
)
def token_coef_join(spark, d):
    from sparkwright.plans.bayes import fitted_bayes

    model = fitted_bayes(spark, d)
    coef = model.coefficients.withColumnRenamed("term", "word")
    joined = J.token_coef_join(labelled_tokens(spark, d), coef)
    return joined.groupBy("doc_id", "word").agg(
        F.count("*").alias("n"), F.round(F.sum("coef"), 6).alias("coef_sum")
    )
