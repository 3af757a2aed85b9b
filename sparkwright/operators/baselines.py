"""Baselines and the one-feature line: closed-form aggregates, no iteration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_baseline(train: DataFrame, rows: DataFrame, label: str) -> DataFrame:
    """Predict the training mean for every row."""
    return rows.withColumn("prediction", train.agg(F.avg(label)).scalar())


def prior_baseline(train: DataFrame, rows: DataFrame, label: str) -> DataFrame:
    """Probability = share of the positive class; class = the more frequent one
    (ties: 0)."""
    share = train.agg(F.avg(label)).scalar()
    return rows.withColumn("probability", share).withColumn(
        "prediction", (F.col("probability") > 0.5).cast("int")
    )


def slr_fit(train: DataFrame, feature: str, label: str) -> DataFrame:
    """Slope and intercept of the least-squares line, one row."""
    return train.agg(
        F.regr_slope(label, feature).alias("slope"),
        F.regr_intercept(label, feature).alias("intercept"),
    )


def slr_predict(rows: DataFrame, fit: DataFrame, feature: str) -> DataFrame:
    line = fit.select(F.struct("slope", "intercept")).scalar()
    return (
        rows.withColumn("_line", line)
        .withColumn("prediction", F.col("_line.intercept") + F.col("_line.slope") * F.col(feature))
        .drop("_line")
    )
