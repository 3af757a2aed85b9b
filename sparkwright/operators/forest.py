"""Random forests of exact CART trees whose random choices are row and node hashes.

Bagging: tree t weighs row r by a Poisson(1) draw whose uniform is the seeded hash of
(t, r's key), so the same rows get the same weights on 1 or 1,000 partitions and after a
lost task. Rows of weight 0 leave the tree. Feature draws: an open node (t, i) may split on
the ``features`` columns with the smallest seeded hashes of (t, i, column); a node whose
drawn columns hold no valid split is a leaf. All trees grow together with the grower of
``cart`` keyed by (tree, node): large nodes level by level, small subtrees each in a task,
so the number of Spark jobs does not depend on the number of trees. Rows are repeated once
per tree (bagging reads each row once a tree by nature). The nodes stay a table: 300 deep
trees are millions of them. A forest's probability is the mean of its trees' leaf shares.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.functions.hashing import SPAN, hash32
from sparkwright.operators import cart
from sparkwright.session import ship_package

# Poisson(1) up to 12; the rest of the mass (below 1e-9) counts as 13.
POISSON_CDF = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(13)]


# Rows of one (tree, rows) group of the scoring, beside that tree's nodes.
SCORED_ROWS = 100_000


def bootstrap_weight(seed: int, tree: str, key: str) -> Column:
    def weight(u: Column) -> Column:
        out = F.lit(len(POISSON_CDF))
        for k in range(len(POISSON_CDF) - 1, -1, -1):
            out = F.when(u < F.lit(POISSON_CDF[k]), F.lit(k)).otherwise(out)
        return out.cast("long")

    # In a lambda the hash is computed once, not once a step.
    u = hash32(f"{seed}:boot", tree, key) / F.lit(float(SPAN))
    return F.transform(F.array(u), weight)[0]


def drawn_columns(seed: int, tree: int, node: int, columns: int, m: int) -> list[int]:
    """The ``m`` columns with the smallest hashes, as ``draw`` in ``fit_table`` orders them."""

    def h(j: int) -> str:
        return hashlib.md5(f"{seed}:feature:{tree}:{node}:{j}".encode()).hexdigest()[:8]

    return sorted(range(columns), key=lambda j: (h(j), j))[:m]


def fit(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    key: str,
    trees: int = 100,
    max_depth: int = 30,
    min_leaf: int = 1,
    features: int | None = None,
    seed: int = 42,
    local_rows: int = cart.LOCAL_ROWS,
) -> list[dict]:
    """Nodes of all trees (tree, id, depth, n0, n1, impurity, and for inner nodes column,
    feature, threshold) on the driver, for small forests."""
    return cart.as_list(fit_table(df, label, columns, key, trees, max_depth, min_leaf, features, seed, local_rows), columns)


def fit_table(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    key: str,
    trees: int = 100,
    max_depth: int = 30,
    min_leaf: int = 1,
    features: int | None = None,
    seed: int = 42,
    local_rows: int = cart.LOCAL_ROWS,
) -> DataFrame:
    """The node table (``cart.NODES``) of all trees; counts are bootstrap weights.
    ``features`` defaults to floor(sqrt(number of columns)), at least 1. Rows with a null
    label or key are left out."""
    m = features or max(1, int(math.isqrt(len(columns))))
    rows = (
        df.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .select(F.col(key), F.col(label), *[F.col(c) for c in columns])
        .withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("w", bootstrap_weight(seed, "tree", key))
        .where(F.col("w") > 0)
    )

    def draw(pairs: DataFrame) -> DataFrame:
        options = pairs.withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(len(columns) - 1))))
        order = Window.partitionBy("tree", "node").orderBy(hash32(f"{seed}:feature", "tree", "node", "column"), "column")
        return options.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= m).drop("_k")

    n_columns = len(columns)

    def pick(tree: int, node: int) -> list[int]:
        return drawn_columns(seed, tree, node, n_columns, m)

    return cart.grow(rows, label, columns, max_depth, min_leaf, draw, pick, local_rows)


def predict(
    df: DataFrame, nodes: DataFrame | list[dict], columns: Sequence[str], key: str, name: str = "p",
    scored_rows: int = SCORED_ROWS,
) -> DataFrame:
    """(key, name): the mean over trees of the class-1 share of the leaf each row reaches.
    Rows and nodes meet by (tree, slice of the rows): a task holds one tree at a time."""
    spark = df.sparkSession
    ship_package(spark)
    if isinstance(nodes, list):
        fields = ("tree", "id", "depth", "n0", "n1", "column", "threshold")
        nodes = spark.createDataFrame([tuple(v.get(f) for f in fields) for v in nodes], cart.NODES)
    trees = [r["tree"] for r in nodes.select("tree").distinct().collect()]
    slices = max(1, -(-df.count() // scored_rows))
    names = list(columns)
    rows = (
        df.select(F.col(key).alias("_key"), *[cart._value(c).alias(c) for c in columns])
        .withColumn("_slice", F.pmod(F.xxhash64("_key", *columns), F.lit(slices)).cast("int"))
        .withColumn("tree", F.explode(F.array(*[F.lit(t) for t in trees]).cast("array<int>")))
    )
    model = nodes.select(
        "tree", "id", "n0", "n1", "column", "threshold", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice")
    )

    def score(rows: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        tree = tree.sort_values("id")
        ids = tree["id"].to_numpy(np.int64)
        column = tree["column"].fillna(-1).to_numpy(np.int64)
        at = cart.walk(ids, column, tree["threshold"].to_numpy(np.float64), rows[names].to_numpy(np.float64))
        share = (tree["n1"] / (tree["n0"] + tree["n1"])).to_numpy()
        return pd.DataFrame({"_key": rows["_key"], "_share": share[at]})

    kind = df.schema[key].dataType.simpleString()
    scored = rows.groupBy("tree", "_slice").cogroup(model.groupBy("tree", "_slice")).applyInPandas(
        score, f"_key {kind}, _share double"
    )
    return scored.groupBy(F.col("_key").alias(key)).agg(F.avg("_share").alias(name))
