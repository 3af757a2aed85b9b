"""Mixing sources to target weights by hash-random order and exact budgets.

Every document gets a hash-random key. Within its source it stands at the prefix sum of
the sizes of all smaller keys; the sum is taken in key ranges - totals of ranges first,
then inside each range - so a source that holds a third of all rows is many small windows.
A budget of whole passes plus a rest is then cut at its exact word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkwright.session import materialize

RANGE_ROWS = 2_000
WORD = r"[^\x20\x09-\x0D]+"


def targets(
    totals: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0
) -> DataFrame:
    """Adds ``target`` to (source, size): all sizes shared by weight, no source above
    ``most`` times its size, the excess reshared until none is.

    The sources in code point order, null last, take the weights in turn. Resharing ends
    at one common level: a source gets the smaller of its ceiling and level x weight.
    Sources with the lowest ratio of ceiling to weight meet their ceilings first, so the
    level follows from prefix sums over the sources in that order. One row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(
        F.array(*(F.lit(float(x)) for x in weights)),
        (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    by_ratio = Window.partitionBy(F.lit(0)).orderBy("ratio", "source")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    return (
        totals.withColumn("weight", w)
        .withColumn("ceiling", F.lit(float(most)) * F.col("size"))
        .withColumn("ratio", F.col("ceiling") / F.col("weight"))
        .withColumn(
            "level",
            (
                F.sum("size").over(everything)
                - F.coalesce(F.sum("ceiling").over(earlier), F.lit(0.0))
            )
            / F.sum("weight").over(later),
        )
        .withColumn(
            "level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
        )
        .select(
            "source", "size", "n",
            F.coalesce(F.least("ceiling", F.col("level") * F.col("weight")), F.col("ceiling")).alias("target"),
        )
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    most: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 0,
) -> DataFrame:
    """(id, key, size, source_size, target, taken) for every row; taken counts words.

    size: runs of anything but ASCII white space in the text; null has none. A source
    takes every document floor(target / size of the source) times, and of the next pass
    the documents up to the rest of its budget; the document at the cut is taken in part.
    Null is a source of its own. Rows are ordered by a hash of seed, id and text, then id
    and text hash; equal rows share every key, and which of them is cut does not matter.
    The result does not depend on partitions. ``key`` is the hash of the text.
    """
    n_words = F.when(F.col(text_col).isNull(), 0).otherwise(
        F.regexp_count(F.col(text_col), F.lit(WORD))
    )
    draw = F.md5(
        F.concat_ws(
            "|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("-")),
            F.coalesce(F.md5(text_col), F.lit("-")),
        )
    )
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        n_words.cast("long").alias("size"),
        F.xxhash64(text_col).alias("key"),
        F.conv(F.substring(draw, 1, 15), 16, 10).cast("long").alias("draw"),
    )
    rows = materialize(rows, "sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    goal = materialize(
        targets(totals, weights, most).select(
            F.col("source").alias("s"),
            F.col("size").alias("source_size"),
            "target",
            F.ceil(F.col("n") / RANGE_ROWS).alias("ranges"),
        ),
        "targets",
    )
    # A range of the draws, in order: the draw, of 60 bits, as a fraction times the ranges.
    fraction = F.col("draw") / F.lit(float(2**60))
    placed = rows.join(goal, F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "range", F.floor(fraction * F.col("ranges"))
    )
    sums = placed.groupBy("s", "range").agg(F.sum("size").alias("sum"))
    starts = sums.select(
        F.col("s").alias("s2"),
        F.col("range").alias("range2"),
        F.coalesce(
            F.sum("sum").over(
                Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("start"),
    )
    inside = (
        Window.partitionBy("s", "range")
        .orderBy("draw", "id", "key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    passes = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    rest = F.floor(F.col("target") - F.col("passes") * F.col("source_size"))
    return (
        placed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, F.col("s").eqNullSafe(F.col("s2")) & (F.col("range") == F.col("range2")))
        .withColumn("before", F.col("before") + F.col("start"))
        .withColumn("passes", passes)
        .withColumn("rest", rest)
        .select(
            F.col("id").alias(id_col),
            "key",
            "size",
            "source_size",
            "target",
            (
                F.col("passes") * F.col("size")
                + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
            ).cast("long").alias("taken"),
        )
    )


def mixed_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    most: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 0,
) -> DataFrame:
    """``docs`` as the mix takes them, each row once per pass; the document at the cut is
    kept whole. Documents without words go. Columns are unchanged."""
    found = mix(docs, weights, most, id_col, text_col, source_col, seed)
    copies = (
        found.where("size > 0 AND taken > 0")
        .select(
            F.col(id_col).alias("id__"), F.col("key").alias("key__"),
            F.ceil(F.col("taken") / F.col("size")).cast("int").alias("copies__"),
        )
        .groupBy("id__", "key__")
        .agg(F.max("copies__").alias("copies__"))
    )
    on = F.col(id_col).eqNullSafe(F.col("id__")) & (F.xxhash64(text_col) == F.col("key__"))
    return (
        docs.join(copies, on)
        .withColumn("copy__", F.explode(F.sequence(F.lit(1), F.col("copies__"))))
        .select(*docs.columns)
    )
