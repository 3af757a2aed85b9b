"""Properties of the physical plans that matter at scale."""

from sparkwright.plans.registry import QUERIES, load_all
from sparkwright.session import load

load_all()

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_is_used(spark, sf):
    plan = _plan(QUERIES["grouped_sum"](spark, sf))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "l_returnflag", "l_quantity", "l_extendedprice"
    }


def test_filters_reach_the_scan(spark, sf):
    plan = _plan(QUERIES["class_subset"](spark, sf))
    assert "EqualTo(toxic,1)" in plan


def test_splits_do_not_shuffle(spark, sf):
    for name in ("random_split", "kfold_assign", "text_features", "bow_pivot"):
        plan = _plan(QUERIES[name](spark, sf))
        assert "Exchange SinglePartition" not in plan
    assert "Exchange" not in _plan(QUERIES["random_split"](spark, sf))


def test_results_do_not_depend_on_partitions(spark, sf):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(
                [
                    sorted(map(tuple, QUERIES[q](spark, sf).collect()))
                    for q in ("top_words", "stratified_split", "roc_points", "vocab_rank")
                ]
            )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1]


def test_stream_continues_after_its_checkpoint(spark, sf, tmp_path):
    from sparkwright.plans.shaping import labelled_docs
    from sparkwright.streaming.scoring import score_stream, text_pipeline

    model = text_pipeline(labelled_docs(spark, sf).select("text", "label"))
    docs = load(spark, sf, "documents").select("doc_id", "text")
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in (docs.where("doc_id < 100"), docs.where("doc_id >= 100")):
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(docs.schema).parquet(src)
        score_stream(stream, model, ["doc_id"], out, state).awaitTermination()
    scored = spark.read.parquet(out)
    assert scored.count() == docs.count() == scored.select("doc_id").distinct().count()


def test_stream_scores_each_message_once_across_restarts(spark, sf, tmp_path):
    from pyspark.sql import functions as F

    from sparkwright.plans.shaping import labelled_docs
    from sparkwright.streaming.scoring import batch_writer, score_stream_once, text_pipeline

    docs = labelled_docs(spark, sf).select("doc_id", "text", "label")
    model = text_pipeline(docs)
    rows = docs.select("doc_id", "text", F.timestamp_seconds(F.col("doc_id") + 1_700_000_000).alias("sent_at"))
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    ids = sorted(r.doc_id for r in rows.select("doc_id").collect())
    half = ids[len(ids) // 2]

    def run():
        stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(str(src))
        score_stream_once(stream, model, ["doc_id"], "doc_id", "sent_at", out, state, watermark="100000 days").awaitTermination()

    rows.where(F.col("doc_id") <= half).write.parquet(str(src / "a"))
    run()
    # A restart on the same checkpoint: old messages again, new ones, repeats among them.
    rows.write.parquet(str(src / "b"))
    rows.where(F.col("doc_id") > half).write.parquet(str(src / "c"))
    run()
    got = [r.doc_id for r in spark.read.parquet(out).select("doc_id").collect()]
    assert sorted(got) == ids
    # A batch run again overwrites only itself.
    write = batch_writer(out)
    first = spark.read.parquet(f"{out}/batch=0")
    write(spark.createDataFrame(first.collect(), first.schema), 0)
    assert sorted(r.doc_id for r in spark.read.parquet(out).select("doc_id").collect()) == ids
