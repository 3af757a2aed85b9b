"""MLlib estimators set up to minimise the same objectives as the usual
single-machine ones, plus a regularisation path from one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.operators import binned

SEED = 42
PART_ROWS = 100_000


def _n_and_std(train: DataFrame, label: str) -> tuple[int, float]:
    r = train.agg(F.count("*").alias("n"), F.stddev_pop(label).alias("s")).first()
    return r["n"], r["s"] or 1.0


def _bounded_parts(train: DataFrame) -> DataFrame:
    """Every round of a fit reads the cached rows once more, a partition a task: where the
    files give partitions of more than ``PART_ROWS`` rows on average, they are dealt anew."""
    n = -(-train.count() // PART_ROWS)
    return train.repartition(n) if n > train.rdd.getNumPartitions() else train


def linear_regression(train: DataFrame, label: str, features: str = "features"):
    return LinearRegression(
        featuresCol=features, labelCol=label, regParam=0.0, solver="normal"
    ).fit(train)


def ridge(train: DataFrame, label: str, alpha: float = 1.0, features: str = "features"):
    """||y - Xw||^2 + alpha ||w||^2. MLlib divides by n and scales the L2 part by the
    deviation of the label, hence the factor."""
    n, std = _n_and_std(train, label)
    return LinearRegression(
        featuresCol=features, labelCol=label, regParam=alpha / n * std, elasticNetParam=0.0,
        standardization=False, solver="normal",
    ).fit(train)


def lasso(train: DataFrame, label: str, alpha: float = 1.0, features: str = "features"):
    """1/(2n) ||y - Xw||^2 + alpha |w|."""
    return LinearRegression(
        featuresCol=features, labelCol=label, regParam=alpha, elasticNetParam=1.0,
        standardization=False, maxIter=20000, tol=1e-12,
    ).fit(train)


def elastic_net(
    train: DataFrame, label: str, alpha: float = 1.0, l1_ratio: float = 0.5,
    features: str = "features",
):
    """1/(2n) ||y - Xw||^2 + alpha (r |w| + (1 - r)/2 ||w||^2)."""
    _, std = _n_and_std(train, label)
    reg = alpha * l1_ratio + alpha * (1 - l1_ratio) * std
    return LinearRegression(
        featuresCol=features, labelCol=label, regParam=reg,
        elasticNetParam=alpha * l1_ratio / reg, standardization=False, maxIter=20000, tol=1e-12,
    ).fit(train)


def tree_regressor(
    train: DataFrame, label: str, features: str = "features", max_depth: int = 30,
    max_bins: int = 128, seed: int = SEED,
):
    return DecisionTreeRegressor(
        featuresCol=features, labelCol=label, maxDepth=max_depth, maxBins=max_bins, seed=seed,
        maxMemoryInMB=1024,
    ).fit(train)


def forest_regressor(
    train: DataFrame, label: str, features: str = "features", trees: int = 100,
    max_depth: int = 30, max_bins: int = 128, seed: int = SEED,
):
    return binned.fit(train, label, features, trees, max_depth, max_bins, "all", classify=False, seed=seed)


def gbt_regressor(
    train: DataFrame, label: str, features: str = "features", rounds: int = 100,
    rate: float = 0.1, max_depth: int = 3, max_bins: int = 128, seed: int = SEED,
):
    return GBTRegressor(
        featuresCol=features, labelCol=label, maxIter=rounds, stepSize=rate, maxDepth=max_depth,
        maxBins=max_bins, seed=seed, maxMemoryInMB=1024,
    ).fit(_bounded_parts(train))


def tree_classifier(
    train: DataFrame, label: str, features: str = "features", max_depth: int = 30,
    min_leaf: int = 1, max_bins: int = 128, weight: str | None = None, seed: int = SEED,
):
    est = DecisionTreeClassifier(
        featuresCol=features, labelCol=label, impurity="gini", maxDepth=max_depth,
        minInstancesPerNode=min_leaf, maxBins=max_bins, seed=seed, maxMemoryInMB=1024,
    )
    return (est.setWeightCol(weight) if weight else est).fit(train)


def forest_classifier(
    train: DataFrame, label: str, features: str = "features", trees: int = 300,
    max_depth: int = 30, max_bins: int = 128, weight: str | None = None, seed: int = SEED,
):
    return binned.fit(
        train, label, features, trees, max_depth, max_bins, "sqrt", classify=True, weight=weight, seed=seed
    )


def logistic(
    train: DataFrame, label: str, features: str = "features", c: float = 1.0,
    weight: str | None = None, max_iter: int = 5000, tol: float = 1e-6,
):
    """L2 logistic regression: C * sum(w_i loss_i) + ||w||^2 / 2, intercept free. MLlib
    averages the loss over the weights, so the penalty is 1 / (C * sum of weights)."""
    mass = F.sum(weight) if weight else F.count("*")
    total = float(train.agg(mass.alias("m")).first()["m"])
    est = LogisticRegression(
        featuresCol=features, labelCol=label, regParam=1.0 / (c * total), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=tol,
    )
    return (est.setWeightCol(weight) if weight else est).fit(train)


def with_probability(scored: DataFrame, name: str = "p") -> DataFrame:
    """Probability of class 1 as a plain column."""
    return scored.withColumn(name, vector_to_array("probability")[1])


def ridge_grid(
    df: DataFrame, columns: Sequence[str], label: str, alphas: Sequence[float], k: int = 5,
    fold: str = "fold",
) -> list[dict]:
    """Cross-validated RMSE of every alpha from one aggregation.

    The centred moments of each fold are a (p+1) x (p+1) table. A training set is the
    sum of the other folds, a validation error a quadratic form in its own fold, so
    k x len(alphas) fits cost one pass over the rows instead of one each.
    """
    cols = [*columns, label]
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    z = [F.col(c).cast("double") - F.lit(float(means[c])) for c in cols]
    aggs = [F.count("*").alias("n")]
    aggs += [F.sum(z[i]).alias(f"s{i}") for i in range(len(cols))]
    aggs += [
        F.sum(z[i] * z[j]).alias(f"q{i}_{j}") for i in range(len(cols)) for j in range(i, len(cols))
    ]
    rows = {r[fold]: r for r in df.groupBy(fold).agg(*aggs).collect()}
    p = len(columns)

    def moments(r):
        n, s = r["n"], np.array([r[f"s{i}"] for i in range(p + 1)])
        g = np.zeros((p + 1, p + 1))
        for i in range(p + 1):
            for j in range(i, p + 1):
                g[i, j] = g[j, i] = r[f"q{i}_{j}"]
        return n, s, g

    parts = {f: moments(r) for f, r in rows.items()}
    out = []
    for alpha in alphas:
        errors = []
        for f, (n_v, s_v, g_v) in parts.items():
            n = sum(m[0] for h, m in parts.items() if h != f)
            s = sum(m[1] for h, m in parts.items() if h != f)
            g = sum(m[2] for h, m in parts.items() if h != f)
            c = g - np.outer(s, s) / n
            w = np.linalg.solve(c[:p, :p] + alpha * np.eye(p), c[:p, p])
            b = (s[p] - w @ s[:p]) / n
            v = np.append(-w, 1.0)  # residual = v.z - b
            sse = v @ g_v @ v - 2 * b * (v @ s_v) + n_v * b * b
            errors.append(float(np.sqrt(max(sse, 0.0) / n_v)))
        out.append(
            {
                "alpha": float(alpha),
                "rmse_mean": float(np.mean(errors)),
                "rmse_std": float(np.std(errors)),
            }
        )
    return out
