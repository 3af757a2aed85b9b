"""Grid search with refit and stacked permutation importance against plain loops."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from sparkwright.functions.hashing import hash32
from sparkwright.operators import explain as X
from sparkwright.operators import selection as S


def auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    if not pos or not neg:
        return None
    won = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return won / (len(pos) * len(neg))


def macro_f1(rows):
    out = []
    for c in (1, 0):
        tp = sum(1 for y, p in rows if y == c and (p > 0.5) == (c == 1))
        wrong = sum(1 for y, p in rows if (p > 0.5) != (y == 1))
        out.append(2 * tp / (2 * tp + wrong) if 2 * tp + wrong else 0.0)
    return sum(out) / 2


def test_grid_refit_equals_loop(spark):
    rng = random.Random(3)
    base = [(i, rng.randrange(2), i % 5, rng.random()) for i in range(300)]
    shifts = [0.0, 0.1, 0.25, -0.2]

    def grid_oof(train):
        rows = [(s, f, i, y, min(1.0, max(0.0, x + s * y))) for s in shifts for i, y, f, x in base]
        return spark.createDataFrame(rows, "shift double, fold int, doc_id long, label int, p double")

    called = {}

    def refit(train, test, best):
        called.update(best)
        return test.withColumn("shift", F.lit(best["shift"]))

    train = spark.createDataFrame([(i, y, f) for i, y, f, _ in base], "doc_id long, label int, fold int")
    summary, best, held = S.grid_search_refit(train, train.limit(3), grid_oof, refit, ["shift"], "roc_auc")
    got = {r["shift"]: r for r in summary.collect()}
    loop = {}
    for s in shifts:
        per = []
        for f in range(5):
            rows = [(y, min(1.0, max(0.0, x + s * y))) for i, y, ff, x in base if ff == f]
            per.append((auc(rows), macro_f1(rows)))
        loop[s] = per
        assert got[s]["mean_roc_auc"] == pytest.approx(statistics.mean(a for a, _ in per))
        assert got[s]["std_roc_auc"] == pytest.approx(statistics.pstdev(a for a, _ in per))
        assert got[s]["mean_macro_f1"] == pytest.approx(statistics.mean(m for _, m in per))
    want = sorted(shifts, key=lambda s: (-round(statistics.mean(a for a, _ in loop[s]), 12), s))
    assert [got[s]["rank"] for s in want] == [1, 2, 3, 4]
    assert best == {"shift": want[0]} == called
    assert held.count() == 3


def test_stacked_permutation_equals_column_loop_and_hand_shuffle(spark):
    rng = random.Random(9)
    rows = [(i, rng.randrange(2), float(rng.randrange(50)), float(rng.randrange(7)), None if i % 11 == 0 else float(i % 4)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, label int, a double, b double, c double")

    def score(t):
        return t.withColumn("p", (F.col("a") + 3 * F.col("b") + F.coalesce(F.col("c"), F.lit(0.0))) / 80.0)

    cols = ["a", "b", "c"]
    stacked = {r.feature: r for r in X.permutation_importance_stacked(df, cols, "doc_id", "label", score).collect()}
    loop = {r.feature: r for r in X.permutation_importance(df, cols, "doc_id", "label", score).collect()}
    for c in cols:
        assert stacked[c].shuffled_auc == pytest.approx(loop[c].shuffled_auc)
        assert stacked[c].base_auc == pytest.approx(loop[c].base_auc)
    # By hand: row r of the target order takes the value of row r of the column's order.
    h = {r.doc_id: (r.t, {c: r[c] for c in cols}) for r in df.select(
        "doc_id", hash32("42:to", "doc_id").alias("t"), *[hash32(f"42:from:{c}", "doc_id").alias(c) for c in cols]).collect()}
    by_id = {r[0]: r for r in rows}
    targets = sorted(by_id, key=lambda i: (h[i][0], i))
    for j, c in enumerate(cols):
        donors = sorted(by_id, key=lambda i: (h[i][1][c], i))
        moved = []
        for t, s in zip(targets, donors):
            r = list(by_id[t])
            r[2 + j] = by_id[s][2 + j]
            p = (r[2] + 3 * r[3] + (r[4] or 0.0)) / 80.0
            moved.append((r[1], p))
        assert stacked[c].shuffled_auc == pytest.approx(auc(moved))


def test_bayes_grid_agrees_with_grid_search(spark, sf):
    from sparkwright.plans.registry import QUERIES, load_all

    load_all()
    old = {r.alpha: r for r in QUERIES["grid_search"](spark, sf).collect()}
    new = {r.alpha: r for r in QUERIES["grid_search_nb"](spark, sf).collect()}
    assert set(old) == set(new)
    for a in old:
        assert new[a].mean_macro_f1 == pytest.approx(old[a].mean, abs=1e-7)
    refit = QUERIES["grid_search_nb_refit"](spark, sf).collect()
    best = min(new.values(), key=lambda r: r["rank"]).alpha
    assert refit and {r.alpha for r in refit} == {best}


def test_tree_grid_and_permutation_queries(spark, sf):
    from sparkwright.plans.registry import QUERIES, load_all

    load_all()
    grid = QUERIES["grid_search_tree"](spark, sf).collect()
    assert sorted(r["rank"] for r in grid) == list(range(1, len(grid) + 1))
    best = next(r.alpha for r in grid if r["rank"] == 1)
    refit = QUERIES["grid_search_tree_refit"](spark, sf).collect()
    assert refit and {r.alpha for r in refit} == {best}
    perm = QUERIES["permutation_importance_tree"](spark, sf).collect()
    assert len(perm) == 13 and all(r.base_auc is not None for r in perm)


def test_folds_do_not_repeat_the_rows_of_the_naive_bayes_weights(spark):
    rng = random.Random(6)
    rows = [(i, i % 2, i % 5, f"t{t}", rng.randrange(1, 4)) for i in range(60) for t in rng.sample(range(12), 4 + 2 * (i % 2))]
    counts = spark.createDataFrame(rows, "doc_id long, label int, fold int, term string, tf long")
    docs = counts.select("doc_id", "label", "fold").distinct()
    out = S.nb_oof(counts, docs, [0.5])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # Only the vocabulary, not the counts, is unfolded by fold.
    windows = [line for line in plan.splitlines() if "Window" in line and "doc_id" in line]
    assert windows and not any(" f#" in line for line in windows)
    got = {r.doc_id: r.p1 for r in out.collect()}
    assert len(got) == 60
    import math
    for f in range(5):
        train = {i for i, _, g, _, _ in rows if g != f}
        df = {}
        for i, _, _, t, _ in rows:
            if i in train:
                df[t] = df.get(t, 0) + 1
        idf = {t: math.log((1 + len(train)) / (1 + n)) + 1 for t, n in df.items() if 2 <= n <= 0.98 * len(train)}
        w = {}
        for i, y, g, t, c in rows:
            if t in idf:
                w.setdefault((i, y, g), {})[t] = (1 + math.log(c)) * idf[t]
        for v in w.values():
            norm = math.sqrt(sum(x * x for x in v.values()))
            for t in v:
                v[t] /= norm
        mass = {(t, c): sum(v.get(t, 0.0) for (i, y, g), v in w.items() if y == c and g != f) for t in idf for c in (0, 1)}
        total = {c: sum(mass[t, c] for t in idf) + 0.5 * len(idf) for c in (0, 1)}
        prior = {c: math.log(len({i for i, y, g, _, _ in rows if g != f and y == c}) / len(train)) for c in (0, 1)}
        for (i, y, g), v in w.items():
            if g == f:
                s = [prior[c] + sum(x * math.log((mass[t, c] + 0.5) / total[c]) for t, x in v.items()) for c in (0, 1)]
                assert got[i] == pytest.approx(1 / (1 + math.exp(s[0] - s[1])))
