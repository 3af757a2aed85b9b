"""Forests on binned columns: the same on any partitioning and any size of a task's nodes,
equal to a brute-force tree, MLlib's quality."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor

from sparkwright.operators import binned
from sparkwright.operators import models as L


def table(spark, n=400, seed=3):
    r = np.random.default_rng(seed)
    rows = [
        (i, int(r.random() < 0.2 + 0.6 * (a > 0) * hot), float(a), float(b), float(hot), float(10 * a + 3 * hot + r.normal()))
        for i, (a, b, hot) in enumerate(zip(r.normal(size=n), r.integers(0, 9, n), r.integers(0, 2, n)))
    ]
    df = spark.createDataFrame(rows, "id long, label int, a double, b double, hot double, y double")
    return VectorAssembler(inputCols=["a", "b", "hot"], outputCol="features").transform(df)


def scores(model, df, column):
    return {r["id"]: r[column] for r in model.transform(df).collect()}


def test_forest_does_not_depend_on_the_partitions(spark):
    df = table(spark)
    one = scores(L.forest_classifier(df.repartition(1), "label", trees=7), df, "probability")
    many = scores(L.forest_classifier(df.repartition(9), "label", trees=7), df.repartition(5), "probability")
    assert one.keys() == many.keys() and len(one) == 400
    assert all(np.allclose(one[i].toArray(), many[i].toArray(), atol=1e-12) for i in one)


@pytest.mark.parametrize("label, classify, draw", [("label", True, "sqrt"), ("y", False, "all")])
def test_large_nodes_grow_the_same_trees(spark, monkeypatch, label, classify, draw):
    df = table(spark)
    monkeypatch.setattr(binned, "PART_ROWS", 90)
    args = (df, label, "features", 5, 30, 16, draw, classify)
    small, large = binned.fit(*args), binned.fit(*args, local_rows=40)
    a, b = ({(r["tree"], r["id"]): (r["code"], r["value"]) for r in m.nodes.collect()} for m in (small, large))
    assert a.keys() == b.keys() and all(a[k][0] == b[k][0] for k in a)
    assert all(np.allclose(a[k][1], b[k][1]) for k in a)


def test_depth_limit_holds_on_both_paths(spark):
    df = table(spark)
    for local_rows in (10, 1000):
        nodes = binned.fit(df, "label", "features", 3, 2, 16, "all", True, local_rows=local_rows).nodes
        ids = [r["id"] for r in nodes.collect()]
        assert max(ids) < 8 and len(ids) > 3


def brute(x, y, w, edges, node, out, classes):
    """{node: (column, bin) of the best split}, by trying all thresholds."""

    def loss(at):
        if not classes:
            return (w[at] * (y[at] - np.average(y[at], weights=w[at])) ** 2).sum()
        s = np.array([w[at][y[at] == c].sum() for c in range(classes)])
        return s.sum() - (s**2).sum() / s.sum()

    every = np.ones(len(y), bool)
    best = (1e-12, None)
    for j, cuts in enumerate(edges):
        for b, cut in enumerate(cuts):
            left = x[:, j] <= cut
            if left.any() and not left.all() and loss(every) > 0:
                gain = round((loss(every) - loss(left) - loss(~left)) / loss(every), 12)
                if gain > best[0]:
                    best = (gain, (j, b))
    out[node] = best[1]
    if best[1]:
        left = x[:, best[1][0]] <= edges[best[1][0]][best[1][1]]
        for child, at in ((2 * node, left), (2 * node + 1, ~left)):
            brute(x[at], y[at], w[at], edges, child, out, classes)


@pytest.mark.parametrize("classes", [0, 2, 3])
def test_a_tree_equals_brute_force(classes):
    r = np.random.default_rng(classes)
    n = 120
    x = np.stack([r.integers(0, 6, n), r.integers(0, 2, n), r.integers(0, 4, n), np.ones(n)], 1).astype(float)
    y = r.integers(0, classes, n).astype(float) if classes else np.round(3 * x[:, 0] + 5 * x[:, 1] + r.normal(size=n), 2)
    w = r.integers(1, 4, n).astype(float)
    edges = [np.unique(c)[:-1] + 0.5 for c in x.T]
    spec = binned.Spec(edges, classes, 30, 4, 1)
    bins = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], 1)
    listed = ~spec.one[None, :] & (~spec.two[None, :] | (bins == 1))
    ids, split, value = binned.grow(spec, 0, 1, y, w, np.nonzero(listed)[0], (spec.start[:-1] + bins)[listed])
    want = {}
    brute(x, y, w, edges, 1, want, classes)
    got = {
        int(i): None if s < 0 else (int(spec.column[s]), int(s - spec.start[spec.column[s]])) for i, s in zip(ids, split)
    }
    assert got == want and len(got) > 20
    at = binned._leaves(spec, ids, split, bins)
    assert set(split[at]) == {-1}


def test_draws_are_poisson_and_by_row():
    key = np.arange(40_000, dtype=np.int64) * 7919
    for m in (1, 6):
        k = binned.draws(key, np.full(len(key), m), 42, 3)
        assert abs(k.mean() - m) < 0.05 * m and abs(k.var() - m) < 0.05 * m
    mixed = binned.draws(key, np.where(key % 2, 1, 6), 42, 3)
    assert (mixed[key % 2 == 0] == k[key % 2 == 0]).all()
    assert (binned.draws(key, np.full(len(key), 6), 42, 4) != k).any()


def test_copies_count_as_rows(spark):
    """A thousand copies of one row outweigh one other row of the same features."""
    df = spark.createDataFrame([(1, 0.0, 1)] + [(0, 0.0, 1)] * 1000 + [(1, 1.0, 1)] * 5, "label int, a double, k int")
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    got = {r["a"]: r["probability"][1] for r in L.forest_classifier(df, "label", trees=20).transform(df).collect()}
    assert got[0.0] < 0.01 and got[1.0] > 0.9


def test_weights_and_bad_labels(spark):
    df = table(spark).selectExpr("*", "IF(label = 1, 0D, 1D) AS only0", "IF(id = 3, NULL, label) AS holed")
    model = L.forest_classifier(df, "label", trees=3, weight="only0")
    assert {r["prediction"] for r in model.transform(df).collect()} == {0.0}
    with pytest.raises(Exception, match="labels"):
        L.forest_classifier(df, "holed", trees=3)


def test_many_values_get_max_bins_and_quality_is_mllibs(spark):
    df = table(spark, 3000)
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    model = binned.fit(train, "y", "features", 30, 30, 32, "all", classify=False)
    assert [len(e) for e in model.spec.edges] == [31, 8, 1]
    theirs = RandomForestRegressor(
        labelCol="y", numTrees=30, maxDepth=12, maxBins=32, featureSubsetStrategy="all", seed=1
    ).fit(train)
    errors = [
        m.transform(test).selectExpr("sqrt(avg(pow(prediction - y, 2))) e").first()["e"] for m in (model, theirs)
    ]
    assert errors[0] < 1.05 * errors[1]


def test_no_histogram_of_small_nodes_leaves_a_task(spark):
    """One task finishes a tree of few rows: nothing but its nodes comes out."""
    plan = L.forest_classifier(table(spark), "label", trees=50).nodes
    assert plan.columns == ["tree", "id", "code", "value"] and plan.select("tree").distinct().count() == 50
