"""Score messages as they arrive: a stateless Structured Streaming job."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.functions import text as T
from sparkwright.operators import models as L
from sparkwright.operators import preparing as E
from sparkwright.operators import vocabulary as V
from sparkwright.session import materialize


def _words(text: str) -> Column:
    """Clean tokens; a null text has none."""
    return F.coalesce(T.clean_tokens(text), F.array().cast("array<string>"))


def text_pipeline(train: DataFrame, text: str = "text", label: str = "label") -> PipelineModel:
    """Word counts -> balanced logistic regression (C = 0.1), fitted on a batch of labelled
    texts. The model reads the tokens from ``_words``; a text without a known word has no
    counts and scores by the intercept."""
    rows = train.select(
        F.monotonically_increasing_id().alias("_row"), label, _words(text).alias("_words")
    )
    rows = materialize(rows, "text-rows")
    vocab = V.df_prune(V.term_counts(rows, "_words", ["_row"]), F.lit(1), 2, float("inf"))
    terms = [r.term for r in vocab.select("term").collect()]
    counter = CountVectorizerModel.from_vocabulary(
        sorted(terms), inputCol="_words", outputCol="features"
    )
    counted = materialize(counter.transform(E.class_weight(rows, label)), "text-counts")
    return PipelineModel(stages=[counter, L.logistic(counted, label, c=0.1, weight="weight")])


def score_stream(
    stream: DataFrame, model: PipelineModel, keep: list[str], out: str, checkpoint: str,
    text: str = "text",
):
    """Start a query that scores what is there and then stops (``availableNow``). The
    checkpoint makes a restart continue after the last committed batch."""
    scored = model.transform(stream.withColumn("_words", _words(text))).select(
        *keep,
        vector_to_array("probability")[1].alias("p1"),
        F.col("prediction").cast("int").alias("prediction"),
    )
    return (
        scored.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def batch_writer(out: str):
    """A ``foreachBatch`` sink that writes batch b to ``out/batch=b``, overwriting: a batch
    that is run again after a failure replaces its own files and nothing else, so every
    committed batch is in the output exactly once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write


def score_stream_once(
    stream: DataFrame, model: PipelineModel, keep: list[str], key: str, event_time: str,
    out: str, checkpoint: str, text: str = "text", watermark: str = "1 hour",
):
    """Score each message once: repeats of a key within ``watermark`` of event time are
    dropped by streaming state (``dropDuplicatesWithinWatermark``), and batches go through
    an idempotent ``foreachBatch`` sink, so a killed and restarted query - same checkpoint -
    neither loses nor repeats a message. Messages later than the watermark are dropped as
    late. Runs what is there and stops (``availableNow``)."""
    once = stream.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([key])
    scored = model.transform(once.withColumn("_words", _words(text))).select(
        *keep,
        vector_to_array("probability")[1].alias("p1"),
        F.col("prediction").cast("int").alias("prediction"),
    )
    return (
        scored.writeStream.foreachBatch(batch_writer(out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
