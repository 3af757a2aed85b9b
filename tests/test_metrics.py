import math

import numpy as np
import pytest

from sparkwright.operators import metrics as M


def _df(spark, rows):
    return spark.createDataFrame([(int(y), float(p)) for y, p in rows], "y int, p double")


def test_auc_with_ties_by_pairs(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    p = np.round(rng.random(400) * 0.7 + y * 0.1, 2)
    r = M.ranking_metrics(_df(spark, zip(y, p)), "y", "p").first()
    pos, neg = p[y == 1], p[y == 0]
    pairs = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert r["roc_auc"] == pytest.approx(pairs / (len(pos) * len(neg)))
    ap, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        rec, prec = (y[hit] == 1).sum() / len(pos), (y[hit] == 1).mean()
        ap, last = ap + (rec - last) * prec, rec
    assert r["pr_auc"] == pytest.approx(ap)


def test_report_undefined_cells(spark):
    r = M.binary_report(_df(spark, [(0, 0.1), (0, 0.2), (1, 0.3)]), "y", "p", 0.5).first()
    assert (r["TN"], r["FP"], r["FN"], r["TP"]) == (2, 0, 1, 0)
    assert r["precision_ppv"] is None and r["f1"] == 0 and r["mcc"] == 0
    assert r["sensitivity"] == 0 and r["specificity"] == 1 and r["roc_auc"] == 1


def test_report_one_class(spark):
    r = M.binary_report(_df(spark, [(1, 0.9), (1, 0.2)]), "y", "p", 0.5).first()
    assert r["specificity"] is None and r["roc_auc"] is None and r["npv"] == 0


def test_mcc_by_hand(spark):
    rows = [(1, 0.9)] * 6 + [(1, 0.1)] * 2 + [(0, 0.8)] * 1 + [(0, 0.2)] * 3
    r = M.binary_report(_df(spark, rows), "y", "p", 0.5).first()
    assert r["mcc"] == pytest.approx((6 * 3 - 1 * 2) / math.sqrt(7 * 8 * 4 * 5))


def test_threshold_grid_against_loop(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 500)
    grid = np.linspace(0.05, 0.95, 181)
    p = np.concatenate([grid, rng.random(316), [0.0, 1.0, 0.95]])
    got = sorted(M.threshold_grid(_df(spark, zip(y, p)), "y", "p").collect())
    for r, t in zip(got, grid):
        assert r["threshold"] == pytest.approx(t)
        pred = p >= r["threshold"]
        assert (r["TP"], r["FP"]) == ((pred & (y == 1)).sum(), (pred & (y == 0)).sum())
        assert (r["FN"], r["TN"]) == ((~pred & (y == 1)).sum(), (~pred & (y == 0)).sum())


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "y double, p double")
    r = M.regression_metrics(df, "y", "p").first()
    assert r["mae"] == pytest.approx(1) and r["rmse"] == pytest.approx(math.sqrt(5 / 3))
    assert r["r2"] == pytest.approx(1 - 5 / 8)


def test_slr_cv_against_loop(spark):
    rng = np.random.default_rng(0)
    x, f = rng.random(200), np.arange(200) % 5
    y = 3 * x + rng.normal(size=200)
    df = spark.createDataFrame(
        [(float(a), float(b), int(c)) for a, b, c in zip(x, y, f)], "x double, y double, fold int"
    )
    got = {r["metric"]: r for r in M.slr_cv_scores(df, "x", "y").collect()}
    rmse = []
    for k in range(5):
        b, a = np.polyfit(x[f != k], y[f != k], 1)
        rmse.append(np.sqrt(np.mean((y[f == k] - a - b * x[f == k]) ** 2)))
    assert got["rmse"]["mean"] == pytest.approx(np.mean(rmse))
    assert got["rmse"]["std"] == pytest.approx(np.std(rmse))
