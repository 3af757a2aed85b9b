from pyspark.sql import functions as F

from sparkwright.operators import splitting as P


def _labels(spark, zeros, ones):
    return spark.range(zeros + ones).withColumn("label", (F.col("id") >= zeros).cast("int"))


def test_stratified_quotas(spark):
    for zeros, ones, want in ((357, 212, (72, 42)), (4052, 1499, (811, 300))):
        split = P.stratified_split(_labels(spark, zeros, ones), "label", "id", 0.2)
        got = {r["label"]: r["t"] for r in split.groupBy("label").agg(F.sum("is_test").alias("t")).collect()}
        assert (got[0], got[1]) == want


def test_split_is_stable_across_partitioning(spark):
    df = _labels(spark, 300, 60)
    a = {tuple(r) for r in P.stratified_kfold(df.repartition(1), "label", "id").collect()}
    b = {tuple(r) for r in P.stratified_kfold(df.repartition(13), "label", "id").collect()}
    assert a == b


def test_folds_are_balanced(spark):
    folds = P.stratified_kfold(_labels(spark, 500, 53), "label", "id")
    sizes = [r["n"] for r in folds.groupBy("label", "fold").agg(F.count("*").alias("n")).collect()]
    assert sorted(sizes) == [10, 10, 11, 11, 11, 100, 100, 100, 100, 100]


def test_random_split_share(spark):
    share = P.random_split(spark.range(20000), "id").agg(F.avg("is_test")).first()[0]
    assert abs(share - 0.2) < 0.02
