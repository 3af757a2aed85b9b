"""Hash-seeded forests: the same on any partitioning, equal to a brute-force forest."""

import hashlib
import math
import random

import pytest

from sparkwright.operators import forest


def h32(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def weight(seed, tree, key):
    u = h32(f"{seed}:boot", tree, key) / 2**32
    return next((k for k, c in enumerate(forest.POISSON_CDF) if u < c), len(forest.POISSON_CDF))


def brute(rows, columns, trees, m, seed, depth_limit=30):
    out = []
    for t in range(trees):
        part = [(weight(seed, t, r[0]), r) for r in rows]
        part = [(w, r) for w, r in part if w > 0]

        def grow(node, part, depth):
            n0 = sum(w for w, r in part if r[1] == 0)
            n1 = sum(w for w, r in part if r[1] == 1)
            v = {"tree": t, "id": node, "n0": n0, "n1": n1}
            out.append(v)
            if depth == depth_limit or not n0 or not n1:
                return
            drawn = sorted(range(len(columns)), key=lambda j: (h32(f"{seed}:feature", t, node, j), j))[:m]
            best = None
            for j in drawn:
                values = sorted({r[2 + j] for _, r in part})
                for a, b in zip(values, values[1:]):
                    left = [(w, r) for w, r in part if r[2 + j] <= a]
                    right = [(w, r) for w, r in part if r[2 + j] > a]
                    l1 = sum(w for w, r in left if r[1] == 1)
                    r1 = sum(w for w, r in right if r[1] == 1)
                    l0, r0 = sum(w for w, _ in left) - l1, sum(w for w, _ in right) - r1
                    score = round((l0 * l0 + l1 * l1) / (l0 + l1) + (r0 * r0 + r1 * r1) / (r0 + r1), 9)
                    if best is None or (score, -j, -a) > best[0]:
                        best = ((score, -j, -a), j, (a + b) / 2, left, right)
            if best is None:
                return
            _, j, threshold, left, right = best
            v.update(column=j, threshold=threshold)
            grow(2 * node, left, depth + 1)
            grow(2 * node + 1, right, depth + 1)

        grow(1, part, 0)
    return sorted(out, key=lambda v: (v["tree"], v["id"]))


def test_same_on_any_partitioning_and_equal_to_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, int(rng.random() < 0.4 + 0.04 * (i % 7)), float(i % 7), float(rng.randrange(5)), float(i % 3)) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c double")
    cols = ["a", "b", "c"]
    one = forest.fit(df.repartition(1), "y", cols, "id", trees=4, seed=7)
    many = forest.fit(df.repartition(32), "y", cols, "id", trees=4, seed=7)
    shape = lambda nodes: [(v["tree"], v["id"], v["n0"], v["n1"], v.get("column"), v.get("threshold")) for v in nodes]
    assert shape(one) == shape(many)
    assert shape(one) == shape(brute(rows, cols, 4, 1, 7))
    got = {r.id: r.p for r in forest.predict(df, one, cols, "id").collect()}
    by = {(v["tree"], v["id"]): v for v in one}
    for r in rows:
        shares = []
        for t in range(4):
            node = 1
            while "threshold" in by[(t, node)]:
                v = by[(t, node)]
                node = 2 * node + (r[2 + v["column"]] > v["threshold"])
            leaf = by[(t, node)]
            shares.append(leaf["n1"] / (leaf["n0"] + leaf["n1"]))
        assert got[r[0]] == pytest.approx(sum(shares) / 4)


def test_poisson_weights_have_mean_one(spark):
    df = spark.range(20000).withColumn("w", forest.bootstrap_weight(1, "id", "id"))
    mean = df.agg({"w": "avg"}).first()[0]
    assert abs(mean - 1.0) < 0.03 and math.isclose(forest.POISSON_CDF[0], math.exp(-1))


def test_levels_on_spark_grow_the_same_forest_and_slices_score_alike(spark):
    rng = random.Random(5)
    rows = [(i, int(rng.random() < 0.5), float(i % 7), float(rng.randrange(5)), float(i % 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c double")
    cols = ["a", "b", "c"]
    local = forest.fit(df, "y", cols, "id", trees=3, features=2, seed=1)
    assert forest.fit(df, "y", cols, "id", trees=3, features=2, seed=1, local_rows=40) == local
    table = forest.fit_table(df, "y", cols, "id", trees=3, features=2, seed=1)
    one = {r.id: r.p for r in forest.predict(df, table, cols, "id").collect()}
    many = {r.id: r.p for r in forest.predict(df, local, cols, "id", scored_rows=10).collect()}
    assert one == pytest.approx(many) and len(one) == 120
