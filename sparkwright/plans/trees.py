"""Exact (unbinned) CART on the 13 text counts: the tree, its test predictions, its
cost-complexity path and its impurity importances."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import text as T
from sparkwright.operators import cart
from sparkwright.operators import pruning as C
from sparkwright.plans.explaining import _rows, tabular_parts
from sparkwright.plans.registry import query

COLUMNS = list(T.TEXT_MEASURES)


def exact_tree(spark, d):
    """(the node table of the training rows' tree, all rows)."""
    feats, _ = tabular_parts(spark, d)
    feats = feats.select("doc_id", "label", "is_test", *COLUMNS)
    return cart.fit_table(feats.where("is_test = 0"), "label", COLUMNS), feats


@query("cart_exact_tree")
def cart_exact_tree(spark, d):
    table, _ = exact_tree(spark, d)
    names = F.array(*[F.lit(c) for c in COLUMNS])
    n = F.col("n0") + F.col("n1")
    a, b = F.col("n0") / n, F.col("n1") / n
    # Heap numbers of 31 levels are ints.
    return table.select(
        F.col("id").cast("int").alias("node"), "depth",
        F.when(F.col("column").isNull(), "").otherwise(F.element_at(names, F.col("column") + 1)).alias("feature"),
        F.coalesce("threshold", F.lit(0.0)).alias("threshold"), F.col("column").isNull().alias("leaf"),
        F.col("n0").cast("int").alias("n0"), F.col("n1").cast("int").alias("n1"),
        F.round(1.0 - a * a - b * b, 9).alias("impurity"),
    )


@query("cart_exact_predict")
def cart_exact_predict(spark, d):
    table, feats = exact_tree(spark, d)
    out = cart.predict(feats.where("is_test = 1"), cart.as_list(table, COLUMNS), COLUMNS)
    return out.select("doc_id", "label", "leaf", F.round("p", 6).alias("p"), (F.col("p") > 0.5).cast("int").alias("prediction"))


@query("cart_exact_prune_path")
def cart_exact_prune_path(spark, d):
    table, _ = exact_tree(spark, d)
    steps = C.Nodes.of(cart.as_rows(cart.as_list(table, COLUMNS))).path()
    return _rows(spark, [
        {"step": i, "alpha": round(s["alpha"], 9), "leaves": s["leaves"], "impurity": round(s["impurity"], 9)}
        for i, s in enumerate(steps)
    ])


@query("cart_exact_importance")
def cart_exact_importance(spark, d):
    table, _ = exact_tree(spark, d)
    nodes = cart.as_list(table, COLUMNS)
    return _rows(spark, [{"feature": c, "importance": round(v, 9)} for c, v in cart.importance(nodes, COLUMNS).items()])


@query("forest_hashed_predict")
def forest_hashed_predict(spark, d):
    """300 exact trees, bootstrap weights and feature draws by hashes, on the training
    rows; the test rows' mean leaf share."""
    from sparkwright.operators import forest

    feats, _ = tabular_parts(spark, d)
    feats = feats.select("doc_id", "label", "is_test", *COLUMNS)
    nodes = forest.fit_table(feats.where("is_test = 0"), "label", COLUMNS, "doc_id", trees=300)
    test = feats.where("is_test = 1")
    out = forest.predict(test, nodes, COLUMNS, "doc_id").join(test.select("doc_id", "label"), "doc_id")
    return out.select("doc_id", "label", F.round("p", 6).alias("p"), (F.col("p") > 0.5).cast("int").alias("prediction"))
