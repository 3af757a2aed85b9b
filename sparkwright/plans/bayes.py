"""Naive Bayes over the TF-IDF weights of the labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import bayes as B
from sparkwright.plans import sqlparts as Q
from sparkwright.plans.registry import query
from sparkwright.plans.vocabulary import fitted_tfidf, split_docs
from sparkwright.session import materialize

ALPHA = 0.1


def fit_with_weights(spark, d):
    fit, weights = fitted_tfidf(spark, d)
    weights = materialize(weights, "weights")
    train = split_docs(spark, d).where("is_test = 0")
    log_prob = B.term_log_prob(weights.where("is_test = 0"), fit, ALPHA)
    return B.BayesModel(materialize(log_prob, "nb"), B.class_priors(train)), weights


def fitted_bayes(spark, d):
    return fit_with_weights(spark, d)[0]


def scored_docs(spark, d):
    model, weights = fit_with_weights(spark, d)
    return B.score(model, split_docs(spark, d), weights)


@query(
    "nb_term_log_prob",
    f"WITH {Q.nb(ALPHA)} SELECT term, label, round(logp, 7) AS logp FROM logp",
)
def nb_term_log_prob(spark, d):
    wide = fitted_bayes(spark, d).log_prob
    rows = [
        wide.select("term", F.lit(c).alias("label"), F.round(f"logp{c}", 7).alias("logp"))
        for c in (0, 1)
    ]
    return rows[0].unionByName(rows[1])


@query(
    "nb_predict",
    f"""
    WITH {Q.nb_scored(ALPHA)}
    SELECT doc_id, label, is_test, round(p1, 6) AS p1, CAST(p1 > 0.5 AS INTEGER) AS prediction
    FROM scored
    """,
)
def nb_predict(spark, d):
    return scored_docs(spark, d).select(
        "doc_id", "label", "is_test", F.round("p1", 6).alias("p1"), "prediction"
    )
