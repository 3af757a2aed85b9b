"""Multinomial naive Bayes for two classes on long-form term weights.

Fitting is one aggregate over (term, class); scoring is one join with a
vocabulary of bounded size and one aggregate per document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class BayesModel:
    log_prob: DataFrame  # term, logp0, logp1 - bounded by the vocabulary
    priors: DataFrame  # one row: prior0, prior1

    @property
    def coefficients(self) -> DataFrame:
        """Log odds of class 1 per term."""
        return self.log_prob.select("term", (F.col("logp1") - F.col("logp0")).alias("coef"))


def class_priors(train_docs: DataFrame, label: str = "label") -> DataFrame:
    """ln(n_c / n), unsmoothed, one row."""
    n = F.count("*")
    return train_docs.agg(
        F.log(F.count_if(F.col(label) == 0) / n).alias("prior0"),
        F.log(F.count_if(F.col(label) == 1) / n).alias("prior1"),
    )


def term_log_prob(
    train_weights: DataFrame, vocab: DataFrame, alpha: float = 0.1, label: str = "label"
) -> DataFrame:
    """ln((N_ci + alpha) / (N_c + alpha V)) per vocabulary term and class."""
    sums = train_weights.groupBy("term").agg(
        *[
            F.sum(F.when(F.col(label) == c, F.col("w")).otherwise(0.0)).alias(f"n{c}")
            for c in (0, 1)
        ]
    )
    full = vocab.select("term").join(sums, "term", "left").na.fill(0.0, ["n0", "n1"])
    totals = full.agg(
        F.struct(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"), F.count("*").alias("v"))
    ).scalar()
    out = full.withColumn("_t", totals)
    return out.select(
        "term",
        *[
            F.log((F.col(f"n{c}") + alpha) / (F.col(f"_t.t{c}") + alpha * F.col("_t.v"))).alias(
                f"logp{c}"
            )
            for c in (0, 1)
        ],
    )


def score(model: BayesModel, docs: DataFrame, weights: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add s0, s1, p1 and the predicted class (ties: 0) to every document; one without
    known terms keeps the priors."""
    sums = (
        weights.select(key, "term", "w")
        .join(F.broadcast(model.log_prob), "term")
        .groupBy(key)
        .agg(*[F.sum(F.col("w") * F.col(f"logp{c}")).alias(f"d{c}") for c in (0, 1)])
    )
    priors = model.priors.select(F.struct("prior0", "prior1")).scalar()
    out = docs.join(sums, key, "left").withColumn("_p", priors)
    for c in (0, 1):
        out = out.withColumn(
            f"s{c}", F.col(f"_p.prior{c}") + F.coalesce(F.col(f"d{c}"), F.lit(0.0))
        )
    return (
        out.withColumn("p1", F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("s0") - F.col("s1"))))
        .withColumn("prediction", (F.col("s1") > F.col("s0")).cast("int"))
        .drop("_p", "d0", "d1")
    )
