import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from sparkwright.operators import models as L
from sparkwright.operators import preparing as E
from sparkwright.operators import splitting as P


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(240, 3)) * [1, 3, 0.5] + [0, 5, 1]
    y = x @ [2.0, -1.0, 0.5] + 4 + rng.normal(size=240)
    df = spark.createDataFrame(
        [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
        "id long, a double, b double, c double, y double",
    )
    return x, y, VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def _centred(x, y):
    return x - x.mean(0), y - y.mean()


def test_ridge_closed_form(data):
    x, y, df = data
    xc, yc = _centred(x, y)
    w = np.linalg.solve(xc.T @ xc + 3.0 * np.eye(3), xc.T @ yc)
    assert L.ridge(df, "y", 3.0).coefficients.toArray() == pytest.approx(w, abs=1e-8)


@pytest.mark.parametrize("ratio", [1.0, 0.5])
def test_l1_models_satisfy_optimality(data, ratio):
    x, y, df = data
    m = L.lasso(df, "y", 0.3) if ratio == 1 else L.elastic_net(df, "y", 0.3, ratio)
    w, (xc, yc) = m.coefficients.toArray(), _centred(x, y)
    grad = -xc.T @ (yc - xc @ w) / len(y) + 0.3 * (1 - ratio) * w
    for g, v in zip(grad, w):
        if abs(v) > 1e-9:
            assert g == pytest.approx(-0.3 * ratio * np.sign(v), abs=1e-5)
        else:
            assert abs(g) <= 0.3 * ratio + 1e-5


def test_ridge_grid_equals_separate_fits(data):
    x, y, df = data
    folded = P.kfold_assign(df, "id")
    fold = np.array([r["fold"] for r in folded.orderBy("id").collect()])
    got = L.ridge_grid(folded, ["a", "b", "c"], "y", [0.1, 10.0])
    for row in got:
        errors = []
        for f in range(5):
            xt, yt, xv, yv = x[fold != f], y[fold != f], x[fold == f], y[fold == f]
            xc, yc = _centred(xt, yt)
            w = np.linalg.solve(xc.T @ xc + row["alpha"] * np.eye(3), xc.T @ yc)
            errors.append(np.sqrt(np.mean((yv - yt.mean() - (xv - xt.mean(0)) @ w) ** 2)))
        assert row["rmse_mean"] == pytest.approx(np.mean(errors))
        assert row["rmse_std"] == pytest.approx(np.std(errors))


def test_logistic_has_zero_gradient(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] + rng.normal(size=300) > 0.8).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "a double, b double, label int")
    df = E.class_weight(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df), "label")
    m = L.logistic(df, "label", c=0.5, weight="weight", tol=1e-12)
    w = m.coefficients.toArray()
    s = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    p = 1 / (1 + np.exp(-(x @ w + m.intercept)))
    assert 0.5 * x.T @ (s * (p - y)) + w == pytest.approx(np.zeros(2), abs=1e-3)
    assert (s * (p - y)).sum() == pytest.approx(0, abs=1e-3)


def test_column_transformer_unseen_and_missing(spark):
    train = spark.createDataFrame(
        [(1.0, "a"), (3.0, "b"), (None, "a"), (5.0, None)], "x double, k string"
    )
    model = E.column_transformer(train, ["x"], ["k"])
    test = spark.createDataFrame([(None, "zzz"), (3.0, None)], "x double, k string")
    got = [r["features"].toArray() for r in model.transform(test).collect()]
    assert got[0] == pytest.approx([0, 0, 0]) and got[1] == pytest.approx([0, 1, 0])


def test_mode_ties_use_the_columns_own_order(spark):
    df = spark.createDataFrame([(10, "b"), (9, "a"), (10, "b"), (9, "a"), (None, None)], "n int, s string")
    got = {r["column"]: r["fill"] for r in E.mode_fit(df, ["n", "s"]).collect()}
    assert got == {"n": "9", "s": "a"}


def test_tree_beats_the_mean(spark, sf):
    from sparkwright.operators.metrics import regression_metrics
    from sparkwright.plans.models import _part_split

    train, test, _ = _part_split(spark, sf)
    fit = L.tree_regressor(train, "label", max_depth=8)
    assert regression_metrics(fit.transform(test), "label", "prediction").first()["r2"] > 0.5


@pytest.mark.parametrize(
    "name, operator",
    [("tree_classifier", "tree_classifier"), ("forest_classifier", "forest_classifier"),
     ("tree_shape", "tree_classifier"), ("tree_regressor", "tree_regressor"),
     ("forest_regressor", "forest_regressor"), ("gbt_regressor", "gbt_regressor"),
     ("logistic_text", "logistic"), ("score_stream", "logistic"), ("embedding_classifier", "logistic")],
)
def test_queries_fit_with_the_defaults_of_their_operator(spark, sf, monkeypatch, name, operator):
    from sparkwright.operators import models
    from sparkwright.plans.registry import QUERIES, load_all

    class Seen(Exception):
        pass

    def fit(*args, **options):
        raise Seen(sorted(options))

    load_all()
    monkeypatch.setattr(models, operator, fit)
    with pytest.raises(Seen) as seen:
        QUERIES[name](spark, sf)
    assert not {"max_depth", "trees", "rounds", "max_iter"} & set(seen.value.args[0])
