"""Interpretation, error analysis and follow-up rules on scored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.functions.hashing import hash32
from sparkwright.operators import metrics as M
from sparkwright.operators.joining import token_coef_join
from sparkwright.operators.ordered import hash_rank
from sparkwright.operators.ranking import top_bottom_n, top_n_per


def coef_table(coef: DataFrame, n: int = 25) -> DataFrame:
    """The n largest and n smallest coefficients with their terms."""
    return top_bottom_n(coef, "coef", "term", n)


def misclassified(scored: DataFrame, label: str, prediction: str, p1: str) -> DataFrame:
    """Wrong rows with both class probabilities."""
    wrong = scored.where(F.col(label) != F.col(prediction))
    return wrong.withColumns({"proba_0": 1.0 - F.col(p1), "proba_1": F.col(p1)})


def doc_contributions(
    tokens: DataFrame, coef: DataFrame, key: str, word: str = "word", n: int = 25
) -> DataFrame:
    """Per document: the n token occurrences with the largest absolute coefficient,
    summed per token, with the sign class (1 = pushes towards class 1).

    Occurrences of one token share their coefficient, so they are ranked as a group
    with a running count instead of one row each.
    """
    counts = tokens.groupBy(key, word).agg(F.count("*").alias("n"))
    joined = token_coef_join(counts, coef, word)
    order = Window.partitionBy(key).orderBy(F.abs("coef").desc(), word)
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    used = joined.withColumn("used", F.least(F.col("n"), F.lit(n) - before)).where("used > 0")
    return used.select(
        key,
        word,
        F.col("used").cast("bigint").alias("occurrences"),
        (F.col("coef") * F.col("used")).alias("coef"),
        (F.col("coef") >= 0).cast("int").alias("class"),
    )


def permutation_importance(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    label: str,
    score: Callable[[DataFrame], DataFrame],
    seed: int = 42,
) -> DataFrame:
    """Drop in ROC-AUC when one column is shuffled between rows.

    A shuffle is a join of two rank orders: row r in one hash order takes the value of
    row r in another. ``score`` adds a probability column ``p``.
    """
    base = M.ranking_metrics(score(df), label, "p").select(F.col("roc_auc").alias("base_auc"))
    targets = hash_rank(df, hash32(f"{seed}:to", key), key, name="_rn")
    rows = None
    for c in columns:
        donors = hash_rank(df.select(key, c), hash32(f"{seed}:from:{c}", key), key, name="_rn")
        moved = targets.drop(c).join(donors.select("_rn", c), "_rn").drop("_rn")
        auc = M.ranking_metrics(score(moved), label, "p")
        row = auc.select(F.lit(c).alias("feature"), F.col("roc_auc").alias("shuffled_auc"))
        rows = row if rows is None else rows.unionByName(row)
    return rows.withColumn("base_auc", base.scalar()).withColumn(
        "importance", F.col("base_auc") - F.col("shuffled_auc")
    )


def permutation_importance_stacked(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    label: str,
    score: Callable[[DataFrame], DataFrame],
    seed: int = 42,
) -> DataFrame:
    """Drop in ROC-AUC of a fitted model when each column in turn is shuffled; all columns
    in one plan, with the same shuffles as ``permutation_importance``.

    One donor table serves every column: the columns are unpivoted to (key, feature,
    value) and ranked within each feature by that feature's hash order. Targets are ranked
    by one more order; one join on the rank gives every row, for every feature, the value
    of its donor. The stack holds each row unchanged (feature "") and once per feature
    with only that column replaced, so ``score`` - a fitted model's transform adding a
    probability ``p`` - runs over it once, and one aggregation grouped by feature gives
    all ROC-AUCs. Null cells are shuffled like values. (feature, shuffled_auc, base_auc,
    importance) per column, in the order given.
    """
    targets = hash_rank(df, hash32(f"{seed}:to", key), key, name="_rn")
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("_value")) for c in columns])
    long = df.select(key, F.explode(cells).alias("_e")).select(key, "_e.*")
    donors = hash_rank(long, hash32(f"{seed}:from", "feature", key), key, group=["feature"], name="_rn")
    moved = targets.join(donors.select("feature", "_rn", "_value"), "_rn")
    for c in columns:
        moved = moved.withColumn(c, F.when(F.col("feature") == c, F.col("_value")).otherwise(F.col(c).cast("double")))
    base = targets.select(*[F.col(c).cast("double").alias(c) if c in columns else F.col(c) for c in targets.columns])
    stack = base.withColumn("feature", F.lit("")).unionByName(moved.drop("_value"))
    auc = M.ranking_metrics(score(stack.drop("_rn")), label, "p", group=["feature"])
    auc = auc.collect()
    by = {r["feature"]: r["roc_auc"] for r in auc}
    rows = [(c, by.get(c), by.get("")) for c in columns]
    out = df.sparkSession.createDataFrame(rows, "feature string, shuffled_auc double, base_auc double")
    return out.withColumn("importance", F.col("base_auc") - F.col("shuffled_auc"))


def subgroup_metrics(
    df: DataFrame, bucket: Column, label: str, probability: str, threshold: float = 0.5
) -> DataFrame:
    """Size, positive share, sensitivity, specificity and precision per bucket."""
    rows = df.withColumn("bucket", bucket)
    cm = M.rates(M.confusion(rows, label, probability, threshold, group=["bucket"]))
    n = F.col("TN") + F.col("FP") + F.col("FN") + F.col("TP")
    return cm.select(
        "bucket",
        n.alias("n"),
        ((F.col("TP") + F.col("FN")) / n).alias("positive_share"),
        "sensitivity",
        "specificity",
        F.col("precision_ppv").alias("precision"),
    )


def route_by_confidence(df: DataFrame, probability: str, floor: float = 0.75) -> DataFrame:
    """Unsure rows go to review, clear positives are suppressed, the rest passes."""
    p = F.col(probability)
    return df.withColumn(
        "route",
        F.when(F.greatest(p, 1.0 - p) < floor, "review").when(p >= 0.5, "suppress").otherwise("pass"),
    )


def tree_shape(model) -> dict:
    return {"depth": int(model.depth), "leaves": int((model.numNodes + 1) // 2)}


def tree_rules(model) -> list[str]:
    return [line for line in model.toDebugString.splitlines() if line.strip()]
