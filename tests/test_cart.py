"""Exact CART against a brute-force CART with the same tie rules."""

import random

import pytest

from sparkwright.operators import cart
from sparkwright.operators import pruning as C


def brute(rows, columns, max_depth=30, min_leaf=1):
    """rows: (label, values...). Every threshold of every column tried at every node."""
    out = []

    def grow(node, part, depth):
        n0 = sum(1 for r in part if r[0] == 0)
        n1 = len(part) - n0
        n = len(part)
        v = {"id": node, "depth": depth, "n0": n0, "n1": n1, "impurity": 1 - (n0 / n) ** 2 - (n1 / n) ** 2}
        out.append(v)
        if depth == max_depth or not n0 or not n1:
            return
        best = None
        for j in range(len(columns)):
            values = sorted({r[1 + j] for r in part})
            for a, b in zip(values, values[1:]):
                left = [r for r in part if r[1 + j] <= a]
                right = [r for r in part if r[1 + j] > a]
                if len(left) < min_leaf or len(right) < min_leaf:
                    continue
                l1 = sum(r[0] for r in left)
                r1 = sum(r[0] for r in right)
                l0, r0 = len(left) - l1, len(right) - r1
                score = round((l0 * l0 + l1 * l1) / len(left) + (r0 * r0 + r1 * r1) / len(right), 9)
                key = (score, -j, -a)
                if best is None or key > best[0]:
                    best = (key, j, a, b, left, right)
        if best is None:
            return
        _, j, a, b, left, right = best
        v.update(column=j, feature=columns[j], threshold=(a + b) / 2)
        grow(2 * node, left, depth + 1)
        grow(2 * node + 1, right, depth + 1)

    grow(1, rows, 0)
    return sorted(out, key=lambda v: v["id"])


def table(rng, n):
    rows = []
    for _ in range(n):
        a, b, c = rng.randrange(12), rng.random() < 0.3, rng.choice([1.5, 2.5, 2.5, 7.0])
        y = int((a > 6) ^ (rng.random() < 0.15) or (b and c > 2))
        rows.append((y, float(a), float(b), c))
    return rows


@pytest.mark.parametrize("depth,min_leaf", [(30, 1), (3, 5)])
def test_equals_brute_force(spark, depth, min_leaf):
    rows = table(random.Random(depth), 500)
    cols = ["a", "b", "c"]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, y int, a double, b double, c double")
    got = cart.fit(df, "y", cols, max_depth=depth, min_leaf=min_leaf)
    want = brute(rows, cols, depth, min_leaf)
    assert [(v["id"], v["n0"], v["n1"], v.get("column"), v.get("threshold")) for v in got] == [
        (v["id"], v["n0"], v["n1"], v.get("column"), v.get("threshold")) for v in want
    ]
    scored = {r.id: r.p for r in cart.predict(df, got, cols).collect()}
    by = {v["id"]: v for v in want}
    for i, r in enumerate(rows):
        node = 1
        while "threshold" in by[node]:
            node = 2 * node + (r[1 + by[node]["column"]] > by[node]["threshold"])
        assert scored[i] == pytest.approx(by[node]["n1"] / (by[node]["n0"] + by[node]["n1"]))
    nodes = C.Nodes.of(cart.as_rows(got))
    assert len(nodes.leaves) == sum("threshold" not in v for v in got)
    assert nodes.path()[-1]["leaves"] == 1
    imp = cart.importance(got, cols)
    assert sum(imp.values()) == pytest.approx(1.0)


def test_pure_empty_and_null_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 3.0)], "y int, a double")
    assert [(v["n0"], v["n1"]) for v in cart.fit(df, "y", ["a"])] == [(0, 2)]
    assert cart.fit(df.limit(0), "y", ["a"]) == []
    df = spark.createDataFrame([(0, None), (1, 2.0), (0, 1.0)], "y int, a double")
    got = cart.fit(df, "y", ["a"])
    # 1 | 2, null: equal scores, the smaller value wins; then 2 | null, null going right.
    assert got[0]["threshold"] == 1.5 and got[2]["threshold"] == 2.0
    assert [(v["id"], v["n0"], v["n1"]) for v in got[1:]] == [(2, 1, 0), (3, 1, 1), (6, 0, 1), (7, 1, 0)]


def test_subtrees_in_tasks_equal_levels_on_spark(spark):
    rows = table(random.Random(8), 400)
    rows += [(i % 2, None, float("nan") if i % 3 else 0.0, 7.0) for i in range(20)]
    cols = ["a", "b", "c"]
    df = spark.createDataFrame(rows, "y int, a double, b double, c double")
    local = cart.fit(df, "y", cols)
    assert cart.fit(df, "y", cols, max_depth=2, local_rows=0) == cart.fit(df, "y", cols, max_depth=2)
    assert cart.fit(df, "y", cols, local_rows=60) == local
    assert sum(v["n0"] + v["n1"] for v in local if "threshold" not in v) == 420


def test_many_nodes_are_one_quick_table(spark):
    from sparkwright.plans.explaining import _rows

    out = _rows(spark, [{"i": i, "big": 2**31 + i, "x": i / 2, "leaf": i % 2 == 0, "s": "t"} for i in range(20000)])
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "bigint", "double", "boolean", "string"]
    assert out.count() == 20000 and len(out._jdf.queryExecution().logical().toString()) < 10000
