"""Exact (unbinned) CART for two classes, grown on Spark.

Every distinct value of every column is a candidate threshold, as in a single-machine
CART, so the tree does not depend on a binning. Nodes of more than ``local_rows`` rows are
split level by level, each level a handful of grouped aggregations over their rows:

1. the feature columns are unpivoted into (node, column, value) cells whose label counts
   are merged before the shuffle, so a value that fills a third of the rows is one row;
2. the counts on each side of every threshold are prefix sums over the values of each
   (node, column), taken in ranges (``ordered.prefix_sums``), so a root with a hundred
   million distinct values is not one task;
3. the best split of every node is one aggregate (``max`` of a struct of the score, the
   negated column index and the negated value), so ties go to the first column and then
   to the smallest value, and no node is ever a window partition of its own;
4. the threshold is the midpoint to the next distinct value, found by a join of the
   chosen splits with the cells; the rows then move to their children by a join with the
   splits of the level, which has one row per node.

A node of ``local_rows`` rows or fewer is one group of a shuffle by (tree, node): its task
finishes the subtree below it by the same rules. So the number of Spark jobs grows with the
levels of the large nodes, not with the depth, and no task holds more than that many rows.

A node is split when it holds both classes and some column has two distinct values that
leave at least ``min_leaf`` rows on each side; a split that lowers the impurity by zero is
still made (as a plain CART does). Growth stops at ``max_depth``. The score compared is
(l0^2 + l1^2) / L + (r0^2 + r1^2) / R, rounded to 9 digits so that equal splits tie
exactly; maximising it is maximising the Gini decrease.

Nulls and NaN in a feature are +infinity (they go right); rows with a null label are left
out. The model is the node table, as large as the tree: node ids are heap numbers (children
2i and 2i + 1), so the depth is at most 62.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.operators.ordered import prefix_sums
from sparkwright.session import materialize, ship_package

MAX_DEPTH = 62
# Rows of a subtree that one task grows: some 100 MB with its sort orders at 13 columns.
LOCAL_ROWS = 250_000
NODES = "tree int, id long, depth int, n0 long, n1 long, column int, threshold double"


def _value(c: str) -> Column:
    inf = F.lit(float("inf"))
    return F.nanvl(F.coalesce(F.col(c).cast("double"), inf), inf)


def _cells(rows: DataFrame, columns: Sequence[str], drawn: DataFrame | None) -> DataFrame:
    """Label counts per (tree, node, column, value); ``drawn`` names each node's columns."""
    if drawn is None:
        entries = F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).alias("value")) for i, c in enumerate(columns)])
    else:
        names = drawn.groupBy("tree", "node").agg(F.collect_list("column").alias("_drawn"))
        rows = rows.join(names, ["tree", "node"])
        values = F.array(*[F.col(c) for c in columns])
        entries = F.transform("_drawn", lambda i: F.struct(i.alias("column"), F.element_at(values, i + 1).alias("value")))
    return (
        rows.select("tree", "node", "label", "w", F.explode(entries).alias("e"))
        .select("tree", "node", "e.column", "e.value", "label", "w")
        .groupBy("tree", "node", "column", "value")
        .agg(
            F.sum(F.when(F.col("label") == 0, F.col("w")).otherwise(0)).alias("n0"),
            F.sum(F.when(F.col("label") == 1, F.col("w")).otherwise(0)).alias("n1"),
        )
    )


def _best_splits(x, w0, w1, seg, tot0, tot1, allowed, min_leaf):
    """Best (column, value, next value) of every node of a level; column -1: none. ``seg`` is
    the node of each row, ``allowed[node, column]`` whether a node may use a column."""
    k = len(tot0)
    score, column = np.full(k, -np.inf), np.full(k, -1)
    value, following = np.zeros(k), np.zeros(k)
    for j in range(x.shape[1]):
        at = np.flatnonzero(allowed[seg, j])
        at = at[np.lexsort((x[at, j], seg[at]))]
        s, v = seg[at], x[at, j]
        ends = np.flatnonzero((s[:-1] == s[1:]) & (v[:-1] < v[1:]))
        if not len(ends):
            continue
        heads = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        c0, c1 = np.r_[0, np.cumsum(w0[at])], np.r_[0, np.cumsum(w1[at])]
        base0, base1 = np.zeros(k, np.int64), np.zeros(k, np.int64)
        base0[s[heads]], base1[s[heads]] = c0[heads], c1[heads]
        e = s[ends]
        l0, l1 = c0[ends + 1] - base0[e], c1[ends + 1] - base1[e]
        r0, r1 = tot0[e] - l0, tot1[e] - l1
        left, right = l0 + l1, r0 + r1
        ok = (left >= min_leaf) & (right >= min_leaf)
        ends, e, l0, l1, r0, r1, left, right = (a[ok] for a in (ends, e, l0, l1, r0, r1, left, right))
        got = np.round((l0 * l0 + l1 * l1) / left + (r0 * r0 + r1 * r1) / right, 9)
        top = score.copy()
        np.maximum.at(top, e, got)
        better = np.flatnonzero((got == top[e]) & (got > score[e]))
        nodes, first = np.unique(e[better], return_index=True)
        i = better[first]
        score[nodes], column[nodes] = got[i], j
        value[nodes], following[nodes] = v[ends[i]], v[ends[i] + 1]
    return column, value, following


def _subtree(tree, node, depth, x, y, w, max_depth, min_leaf, pick) -> pd.DataFrame:
    """All nodes from ``node`` down, a level at a time."""
    at = np.full(len(y), node, np.int64)
    w0, w1 = np.where(y == 0, w, 0), np.where(y == 1, w, 0)
    out = []
    while len(at):
        ids, seg = np.unique(at, return_inverse=True)
        n0, n1 = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        np.add.at(n0, seg, w0)
        np.add.at(n1, seg, w1)
        level = pd.DataFrame({"tree": tree, "id": ids, "depth": depth, "n0": n0, "n1": n1, "column": -1, "threshold": np.nan})
        out.append(level)
        mixed = (n0 > 0) & (n1 > 0)
        if depth == max_depth or not mixed.any():
            break
        allowed = np.repeat(mixed[:, None], x.shape[1], axis=1)
        if pick is not None:
            for i in np.flatnonzero(mixed):
                allowed[i] = False
                allowed[i, pick(tree, int(ids[i]))] = True
        column, value, following = _best_splits(x, w0, w1, seg, n0, n1, allowed, min_leaf)
        inner = column >= 0
        threshold = np.where(np.isinf(following), value, (value + following) / 2)
        level["column"], level["threshold"] = column, np.where(inner, threshold, np.nan)
        go = inner[seg]
        x, w0, w1, at, seg = x[go], w0[go], w1[go], at[go], seg[go]
        at = at * 2 + (x[np.arange(len(at)), column[seg]] > threshold[seg])
        depth += 1
    nodes = pd.concat(out)
    leaf = nodes["column"] < 0
    return nodes.astype({"column": "Int32"}).assign(
        column=lambda v: v["column"].mask(leaf), threshold=nodes["threshold"].astype("Float64").mask(leaf)
    )


def fit(
    df: DataFrame, label: str, columns: Sequence[str], max_depth: int = 30, min_leaf: int = 1, local_rows: int = LOCAL_ROWS
) -> list[dict]:
    """Grow the tree; returns its nodes: id, depth, n0, n1, impurity (Gini), and for
    inner nodes column (index), feature (name) and threshold (x <= threshold goes left)."""
    table = fit_table(df, label, columns, max_depth, min_leaf, local_rows)
    return [{k: v for k, v in n.items() if k != "tree"} for n in as_list(table, columns)]


def fit_table(
    df: DataFrame, label: str, columns: Sequence[str], max_depth: int = 30, min_leaf: int = 1, local_rows: int = LOCAL_ROWS
) -> DataFrame:
    """The nodes of the tree as a table (``NODES``; a leaf has no column and threshold)."""
    rows = df.where(F.col(label).isNotNull()).select(
        F.lit(0).alias("tree"), F.lit(1).cast("long").alias("w"), F.col(label), *[F.col(c) for c in columns]
    )
    return grow(rows, label, columns, max_depth, min_leaf, local_rows=local_rows)


def as_list(table: DataFrame, columns: Sequence[str]) -> list[dict]:
    """The node table as dictionaries, by tree and id."""
    out = []
    for r in table.collect():
        n = r["n0"] + r["n1"]
        v = {k: r[k] for k in ("tree", "id", "depth", "n0", "n1")}
        v["impurity"] = 1.0 - (r["n0"] / n) ** 2 - (r["n1"] / n) ** 2
        if r["column"] is not None:
            v.update(column=r["column"], feature=columns[r["column"]], threshold=r["threshold"])
        out.append(v)
    return sorted(out, key=lambda v: (v["tree"], v["id"]))


def grow(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    max_depth: int = 30,
    min_leaf: int = 1,
    draw: Callable[[DataFrame], DataFrame] | None = None,
    pick: Callable[[int, int], list[int]] | None = None,
    local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """The written node table (``NODES``) of all trees of ``df`` (columns ``tree``, ``w`` (a
    row's weight, > 0), label and features), grown together. ``draw(pairs)``, if given,
    takes open (tree, node) pairs and returns the (tree, node, column) that each may split
    on; ``pick(tree, node)`` gives the same columns of one node inside a task."""
    if max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth is at most {MAX_DEPTH}")
    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(
        F.col("tree").cast("int").alias("tree"),
        F.lit(1).cast("long").alias("node"),
        F.col(label).cast("int").alias("label"),
        F.col("w").cast("long").alias("w"),
        *[_value(c).alias(c) for c in columns],
    )
    names = list(columns)

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf[names].to_numpy(np.float64)
        node = int(pdf["node"].iat[0])
        return _subtree(
            int(pdf["tree"].iat[0]), node, node.bit_length() - 1, x, pdf["label"].to_numpy(),
            pdf["w"].to_numpy(np.int64), max_depth, min_leaf, pick,
        )

    large: list[tuple] = []
    parts: list[DataFrame] = []
    for depth in range(max_depth + 1):
        counts = rows.groupBy("tree", "node").agg(
            F.sum(F.when(F.col("label") == 0, F.col("w")).otherwise(0)).alias("n0"),
            F.sum(F.when(F.col("label") == 1, F.col("w")).otherwise(0)).alias("n1"),
            F.count("*").alias("n"),
        )
        if depth:
            # All but the nodes below a large one were finished before.
            counts = materialize(counts, "cart-counts")
        big = {(r["tree"], r["node"]): r for r in counts.where(F.col("n") > local_rows).collect()}
        if not big:
            parts.append(materialize(rows.groupBy("tree", "node").applyInPandas(finish, NODES), "cart-subtrees"))
            break
        pairs = materialize(spark.createDataFrame(list(big), "tree int, node long"), "cart-large")
        if not depth:
            rows = materialize(rows, "cart-rows")
        small = rows.join(pairs, ["tree", "node"], "left_anti").groupBy("tree", "node").applyInPandas(finish, NODES)
        parts.append(materialize(small, "cart-subtrees"))
        open_nodes = [key for key, r in big.items() if r["n0"] and r["n1"]] if depth < max_depth else []
        chosen = {}
        if open_nodes:
            wanted = materialize(spark.createDataFrame(open_nodes, "tree int, node long"), "cart-open")
            splits = _level_splits(rows.join(wanted, ["tree", "node"], "left_semi"), columns, min_leaf, draw and draw(wanted))
            chosen = {(r["tree"], r["node"]): r for r in splits.collect()}
        for (tree, node), r in big.items():
            split = chosen.get((tree, node))
            large.append((tree, node, depth, r["n0"], r["n1"], split and split["column"], split and split["threshold"]))
        if not chosen:
            break
        x = F.element_at(F.array(*[F.col(c) for c in columns]), F.col("column") + 1)
        moved = rows.join(splits, ["tree", "node"]).select(
            "tree", (F.col("node") * 2 + (x > F.col("threshold")).cast("long")).alias("node"), "label", "w", *columns
        )
        rows = materialize(moved, "cart-rows")
    out = spark.createDataFrame(large, NODES)
    for part in parts:
        out = out.unionByName(part)
    return materialize(out, "cart-nodes") if large else parts[0]


def _level_splits(rows: DataFrame, columns: Sequence[str], min_leaf: int, drawn: DataFrame | None) -> DataFrame:
    """(tree, node, column, threshold): the best split of every node that has one."""
    cells = materialize(_cells(rows, columns, drawn), "cart-cells")
    group = ["tree", "node", "column"]
    sums = prefix_sums(cells, "value", {"n0": "c0", "n1": "c1"}, group=group)
    l0 = F.col("c0_before") + F.col("n0")
    l1 = F.col("c1_before") + F.col("n1")
    r0, r1 = F.col("c0_total") - l0, F.col("c1_total") - l1
    left, right = l0 + l1, r0 + r1
    score = F.round((l0 * l0 + l1 * l1) / left + (r0 * r0 + r1 * r1) / right, 9)
    candidates = sums.where((left >= min_leaf) & (right >= min_leaf) & (right > 0)).select(
        "tree", "node", F.struct(score.alias("score"), (-F.col("column")).alias("neg_column"), (-F.col("value")).alias("neg_value")).alias("s")
    )
    best = candidates.groupBy("tree", "node").agg(F.max("s").alias("s")).select(
        "tree", "node", (-F.col("s.neg_column")).alias("column"), (-F.col("s.neg_value")).alias("value")
    )
    after = (
        best.join(cells.select(*group, F.col("value").alias("next")), group)
        .where(F.col("next") > F.col("value"))
        .groupBy(*group, "value")
        .agg(F.min("next").alias("next"))
    )
    splits = after.select(
        "tree", "node", "column",
        F.when(F.col("next") == float("inf"), F.col("value"))
        .otherwise((F.col("value") + F.col("next")) / 2).alias("threshold"),
    )
    return materialize(splits, "cart-splits")


def walk(ids: np.ndarray, column: np.ndarray, threshold: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Position in the sorted ``ids`` of the leaf that each row of ``x`` reaches; column -1
    marks a leaf."""
    at = np.full(len(x), np.searchsorted(ids, 1))
    moving = np.arange(len(x))
    while len(moving):
        moving = moving[column[at[moving]] >= 0]
        i = at[moving]
        right = x[moving, column[i]] > threshold[i]
        at[moving] = np.searchsorted(ids, ids[i] * 2 + right)
    return at


def predict(df: DataFrame, nodes: list[dict], columns: Sequence[str], name: str = "p") -> DataFrame:
    """Adds the leaf (heap id) and ``name`` (share of class 1 in the leaf) to every row; the
    node arrays, as large as the tree, travel to the tasks. A row with a null feature goes
    right, as in training. Without nodes (no training rows) there are no rows."""
    if not nodes:
        return df.withColumns({"leaf": F.lit(None).cast("long"), name: F.lit(None).cast("double")}).where(F.lit(False))
    ship_package(df.sparkSession)
    nodes = sorted(nodes, key=lambda v: v["id"])
    ids = np.array([v["id"] for v in nodes], np.int64)
    column = np.array([v.get("column", -1) for v in nodes])
    threshold = np.array([v.get("threshold", 0.0) for v in nodes])
    share = np.array([v["n1"] / (v["n0"] + v["n1"]) for v in nodes])

    @F.pandas_udf("leaf long, p double")
    def reached(*x: pd.Series) -> pd.DataFrame:
        at = walk(ids, column, threshold, np.column_stack([v.to_numpy(np.float64) for v in x]))
        return pd.DataFrame({"leaf": ids[at], "p": share[at]})

    out = df.withColumn("_reached", reached(*[_value(c) for c in columns]))
    return out.withColumns({"leaf": F.col("_reached.leaf"), name: F.col("_reached.p")}).drop("_reached")


def as_rows(nodes: list[dict]) -> list[dict]:
    """The node table in pre-order with MLlib's fields (id, impurity, impurityStats,
    leftChild, rightChild), for pruning and reports."""
    by = {v["id"]: v for v in nodes}
    order, stack = [], [1]
    while stack:
        i = stack.pop()
        order.append(i)
        if "threshold" in by[i]:
            stack += [2 * i + 1, 2 * i]
    number = {i: k for k, i in enumerate(order)}
    out = []
    for i in order:
        v = by[i]
        inner = "threshold" in v
        out.append({
            "id": number[i], "impurity": v["impurity"], "impurityStats": [float(v["n0"]), float(v["n1"])],
            "leftChild": number[2 * i] if inner else -1, "rightChild": number[2 * i + 1] if inner else -1,
        })
    return out


def importance(nodes: list[dict], columns: Sequence[str]) -> dict[str, float]:
    """Mean decrease in impurity per column, weighted by node size, normalised to 1."""
    by = {v["id"]: v for v in nodes}
    total = {c: 0.0 for c in columns}
    for v in nodes:
        if "threshold" in v:
            n = lambda u: u["n0"] + u["n1"]
            a, b = by[2 * v["id"]], by[2 * v["id"] + 1]
            total[v["feature"]] += n(v) * v["impurity"] - n(a) * a["impurity"] - n(b) * b["impurity"]
    s = sum(total.values())
    return {c: (t / s if s else 0.0) for c, t in total.items()}
