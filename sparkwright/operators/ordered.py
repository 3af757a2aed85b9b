"""Exact ranks, prefix sums and quantiles that never put a whole order in one task.

A global (or big-group) ordering is cut into ranges; each range is one window
partition and an offset per range - a table of at most ``ranges`` rows per
group - is added back. Equal keys always fall in one range, and callers
aggregate equal keys first, so a value that holds a third of all rows is one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.functions.hashing import SPAN
from sparkwright.session import materialize

RANGES = 256


def _range_offsets(df: DataFrame, group: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Per (group, range): the sums over all earlier ranges of the group."""
    totals = df.groupBy(*group, "_range").agg(*[F.sum(c).alias(c) for c in sums])
    before = (
        Window.partitionBy(*group)
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.select(
        *group,
        "_range",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in sums],
    )


def _locate(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """Add ``_range``: how many of the ``ranges - 1`` sorted bounds lie below the key.
    A binary search written as one cheap projection per step, all inside codegen."""
    if ranges & (ranges - 1):
        raise ValueError("ranges must be a power of two")
    out = df.withColumn("_range", F.lit(0))
    step = ranges // 2
    while step:
        pivot = F.col("_bounds")[F.col("_range") + (step - 1)]
        out = out.withColumn(
            "_range",
            F.when(pivot < F.col(key), F.col("_range") + step).otherwise(F.col("_range")),
        )
        step //= 2
    return out.drop("_bounds")


def _schema_bound(group: Sequence[str]) -> bool:
    """True where the schema bounds the number of groups: one per unpivoted column."""
    return set(group) <= {"column"}


def prefix_sums(
    df: DataFrame,
    key: str,
    sums: dict[str, str],
    group: Sequence[str] = (),
    descending: bool = False,
    ranges: int = RANGES,
) -> DataFrame:
    """Add, for each ``column -> name``, ``name_before`` (sum over rows ordered
    strictly before) and ``name_total`` (sum over the group).

    ``df`` must hold one row per (group, key).
    """
    g = list(group)
    cuts = ", ".join(f"{i / ranges!r}D" for i in range(1, ranges))
    # The totals ride along, which also keeps this plan's input identical to the
    # main one, so Spark reuses its exchange instead of scanning again.
    summary = [
        F.expr(f"percentile_approx(`{key}`, array({cuts}), 10000)").alias("_bounds"),
        *[F.sum(c).alias(f"{name}_total") for c, name in sums.items()],
    ]
    if g and _schema_bound(g):
        ranged = df.join(F.broadcast(df.groupBy(*g).agg(*summary)), g)
    elif g:
        # The number of groups is open. Written tables have a known size: Spark
        # broadcasts the summaries if they are small and joins by key if not.
        df = materialize(df, "ordered-counts")
        ranged = df.join(materialize(df.groupBy(*g).agg(*summary), "ordered-bounds"), g)
    else:
        one = df.agg(F.struct(*summary)).scalar()
        ranged = df.withColumn("_one", one).select(*df.columns, "_one.*")
    ranged = _locate(ranged, key, ranges)
    if descending:
        ranged = ranged.withColumn("_range", -F.col("_range"))
    order = F.col(key).desc() if descending else F.col(key).asc()
    before = (
        Window.partitionBy(*g, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = _range_offsets(ranged, g, list(sums))
    if _schema_bound(g):
        offsets = F.broadcast(offsets)
    out = ranged.join(offsets, [*g, "_range"])
    for c, name in sums.items():
        inner = F.coalesce(F.sum(c).over(before), F.lit(0))
        out = out.withColumn(f"{name}_before", F.col(f"_off_{c}") + inner)
    return out.drop("_range", *[f"_off_{c}" for c in sums])


def hash_rank(
    df: DataFrame,
    hashed: Column,
    tie: str,
    group: Sequence[str] = (),
    name: str = "rn",
    ranges: int = 4096,
    per_group: DataFrame | None = None,
) -> DataFrame:
    """1-based row number over a 32-bit hash order within each group.

    ``per_group`` columns join the small offsets table, not the rows, so a group that
    holds most rows is never a join key of its own.

    The hash is uniform, so equal slices of its span are balanced ranges and a
    class with most of the rows is spread over ``ranges`` window partitions.
    """
    g = list(group)
    ranged = df.withColumn("_hash", hashed).withColumn(
        "_range", F.floor(F.col("_hash") * F.lit(ranges) / F.lit(SPAN)).cast("int")
    )
    counted = ranged.select(*g, "_range").withColumn("_n", F.lit(1).cast("bigint"))
    offsets = _range_offsets(counted, g, ["_n"])
    if per_group is not None:
        offsets = offsets.join(per_group, g)
    inner = F.row_number().over(Window.partitionBy(*g, "_range").orderBy("_hash", tie))
    out = ranged.withColumn("_inner", inner).join(offsets, [*g, "_range"])
    return out.withColumn(name, (F.col("_off__n") + F.col("_inner")).cast("bigint")).drop(
        "_hash", "_range", "_inner", "_off__n"
    )


def value_counts_long(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """(group, column, value, n) over non-null numeric cells; the shuffle moves
    map-side combined counts only."""
    # A one-argument unpivot of many columns is one scan whatever their number.
    long = df.select(*group, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(group), list(columns), "column", "value"
    )
    return (
        long.where(F.col("value").isNotNull())
        .groupBy(*group, "column", "value")
        .agg(F.count("*").alias("n"))
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: dict[str, float],
    group: Sequence[str] = (),
    ranges: int = RANGES,
) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per (group, column)."""
    keys = [*group, "column"]
    counts = value_counts_long(df, columns, group)
    ordered = prefix_sums(counts, "value", {"n": "n"}, group=keys, ranges=ranges)
    upto = F.col("n_before") + F.col("n")
    aggs = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("n_total") - 1)
        for end, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            holds = (F.col("n_before") <= rank) & (rank < upto)
            aggs.append(F.max(F.when(holds, F.col("value"))).alias(f"_{name}_{end}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_{name}_frac"))
    found = ordered.groupBy(*keys).agg(*aggs)
    outs = [
        (
            F.col(f"_{name}_lo")
            + (F.col(f"_{name}_hi") - F.col(f"_{name}_lo")) * F.col(f"_{name}_frac")
        ).alias(name)
        for name in probs
    ]
    return found.select(*keys, *outs)
