import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.functions.hashing import hash32
from sparkwright.operators.ordered import exact_quantiles, hash_rank, prefix_sums


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(1)
    x = np.round(rng.lognormal(size=3000), 2)
    x[:1200] = 3.25  # one value holds more than a third of the rows
    return x


def test_quantiles_match_numpy_under_skew(spark, skewed):
    df = spark.createDataFrame([(float(v), float(-v)) for v in skewed], "a double, b double")
    probs = {"q10": 0.1, "q25": 0.25, "q50": 0.5, "q99": 0.99}
    for ranges in (8, 256):
        got = {r["column"]: r for r in exact_quantiles(df, ["a", "b"], probs, ranges=ranges).collect()}
        for name, p in probs.items():
            assert got["a"][name] == pytest.approx(np.quantile(skewed, p))
            assert got["b"][name] == pytest.approx(np.quantile(-skewed, p))


def test_quantiles_skip_nulls_and_group(spark):
    df = spark.createDataFrame(
        [("x", 1.0), ("x", None), ("x", 4.0), ("y", 7.0)], "g string, v double"
    )
    got = {r["g"]: r["m"] for r in exact_quantiles(df, ["v"], {"m": 0.5}, group=["g"]).collect()}
    assert got == {"x": 2.5, "y": 7.0}


@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sums(spark, descending):
    rows = [(g, k, k % 5 + 1) for g in "ab" for k in range(300 if g == "a" else 7)]
    df = spark.createDataFrame(rows, "g string, k long, n long")
    got = prefix_sums(df, "k", {"n": "n"}, group=["g"], descending=descending, ranges=16).collect()
    assert len(got) == len(rows)
    for r in got:
        side = [n for g, k, n in rows if g == r["g"] and (k > r["k"] if descending else k < r["k"])]
        assert r["n_before"] == sum(side)
        assert r["n_total"] == sum(n for g, _, n in rows if g == r["g"])


def test_hash_rank_is_a_row_number(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") < 4000, 0).otherwise(1))
    ranked = hash_rank(df, hash32(42, "id"), "id", group=["g"], ranges=64)
    check = ranked.withColumn("h", hash32(42, "id")).collect()
    for g in (0, 1):
        order = sorted((r["h"], r["id"], r["rn"]) for r in check if r["g"] == g)
        assert [x[2] for x in order] == list(range(1, len(order) + 1))
