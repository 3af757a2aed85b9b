"""Audits and descriptive aggregates. Each is one or two aggregations whose
partial results are combined before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.functions.hashing import hash32
from sparkwright.operators.ordered import exact_quantiles
from sparkwright.operators.shape import numeric_columns
from sparkwright.session import materialize

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _rows_from(one_row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn the columns of a one-row aggregate into one row per struct."""
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        for name, f in (
            ("count", F.count),
            ("mean", F.avg),
            ("std", F.stddev_samp),
            ("min", F.min),
            ("max", F.max),
        ):
            aggs.append(f(x).alias(f"{c}__{name}"))
    structs = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{c}__{m}").alias(m) for m in ("count", "mean", "std", "min", "max")],
        )
        for c in columns
    ]
    return _rows_from(df.agg(*aggs), structs)


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max per numeric column."""
    cols = list(columns or numeric_columns(df))
    quart = exact_quantiles(df, cols, QUARTILES)
    return (
        _moments(df, cols)
        .join(quart, "column", "left")
        .select("column", "count", "mean", "std", "min", *QUARTILES, "max")
    )


def _text_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: non-null count, distinct count, most frequent value (ties: smallest)
    and its frequency."""
    return (
        _text_counts(df, columns)
        .groupBy("column")
        .agg(
            F.sum("n").alias("count"),
            F.count("*").alias("unique"),
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
            F.max("n").alias("freq"),
        )
    )


def describe_all(
    df: DataFrame, numeric: Sequence[str], text: Sequence[str]
) -> DataFrame:
    """``describe_numeric`` plus unique / top / freq rows for text columns."""
    return describe_numeric(df, numeric).unionByName(modes(df, text), allowMissingColumns=True)


def column_audit(df: DataFrame, top: int = 30) -> DataFrame:
    """Type, missing, missing share, distinct values and range per column; the
    ``top`` columns by missing share.

    Distinct values are counted on map-side combined (column, value) pairs, so a
    frequent value is one row per task.
    """
    cols = df.columns
    aggs = [F.count("*").alias("_rows")]
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__missing"))
        aggs.append(F.min(c).alias(f"{c}__min"))
        aggs.append(F.max(c).alias(f"{c}__max"))
    one = df.agg(*aggs)
    text_row = one.select(
        "_rows",
        *[F.col(f"{c}__missing") for c in cols],
        *[
            _range_text(df.schema[c].dataType, F.col(f"{c}__{e}")).alias(f"{c}__{e}")
            for c in cols
            for e in ("min", "max")
        ],
    )
    rows = _rows_from(
        text_row,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                F.col(f"{c}__missing").alias("missing"),
                (F.col(f"{c}__missing") * 100.0 / F.col("_rows")).alias("missing_pct"),
                F.col(f"{c}__min").alias("min_value"),
                F.col(f"{c}__max").alias("max_value"),
            )
            for c in cols
        ],
    )
    unique = _text_counts(df, cols).groupBy("column").agg(F.count("*").alias("n_unique"))
    return (
        rows.join(unique, "column", "left")
        .withColumn("n_unique", F.coalesce("n_unique", F.lit(0).cast("bigint")))
        .select("column", "dtype", "missing", "missing_pct", "n_unique", "min_value", "max_value")
        .orderBy(F.desc("missing_pct"), "column")
        .limit(top)
    )


def _range_text(kind: T.DataType, c: Column) -> Column:
    if isinstance(kind, T.NumericType):
        return c.cast("decimal(38,6)").cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return c.cast("string")


def missing_counts(df: DataFrame) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _rows_from(
        one, [F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns]
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows; NULL equals NULL."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)


def class_share(df: DataFrame, label: str) -> DataFrame:
    """Share per class, rounded to three places, in percent."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("t")).scalar()
    return counts.select(label, (F.round(F.col("n") / total, 3) * 100).alias("share_pct"))


def prevalence(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(label).alias("prevalence"))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair in long form, pairwise-complete rows, one pass."""
    cols = list(columns)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
            for a, b in pairs
        ]
    )
    both = pairs + [(b, a) for a, b in pairs if a != b]
    known = set(pairs)
    return _rows_from(
        one,
        [
            F.struct(
                F.lit(a).alias("a"),
                F.lit(b).alias("b"),
                F.col(f"{a}__{b}" if (a, b) in known else f"{b}__{a}").alias("corr"),
            )
            for a, b in both
        ],
    )


def histogram(
    df: DataFrame, value: Column, bins: int = 20, group: Sequence[str] = ()
) -> DataFrame:
    """Equal-width bins over the range of each group, the last bin closed on the
    right; count and density per non-empty bin."""
    rows = df.select(*group, value.cast("double").alias("x")).where("x is not null")
    span = [F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n_all")]
    if group:
        # Written, so its size is known and Spark decides on a broadcast before the join.
        rows = rows.join(materialize(rows.groupBy(*group).agg(*span), "spans"), list(group))
    else:
        s = rows.agg(F.struct(*span).alias("s")).scalar()
        rows = rows.withColumn("s", s).select("x", "s.*")
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))
    )
    return (
        rows.select(*group, index.cast("int").alias("bin"), "lo", "n_all", width.alias("width"))
        .groupBy(*group, "bin", "lo", "width", "n_all")
        .agg(F.count("*").alias("n"))
        .select(
            *group,
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"),
            "n",
            F.when(F.col("width") > 0, F.col("n") / (F.col("n_all") * F.col("width"))).alias(
                "density"
            ),
        )
    )


def kde_grid(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid over the range, Scott bandwidth.

    Equal values are merged first and every merged value adds to ``points`` sums
    inside the partial aggregate, so the shuffle moves ``points`` rows per task.
    """
    x = df.select(F.col(column).cast("double").alias("x")).where("x is not null")
    stats = x.agg(
        F.struct(
            F.count("*").alias("n"),
            F.stddev_samp("x").alias("sd"),
            F.min("x").alias("lo"),
            F.max("x").alias("hi"),
        ).alias("s")
    ).scalar()
    merged = x.groupBy("x").agg(F.count("*").alias("w"))
    bw = F.col("s.sd") * F.pow(F.col("s.n").cast("double"), F.lit(-0.2))
    at = F.col("s.lo") + F.col("point") * (F.col("s.hi") - F.col("s.lo")) / F.lit(points - 1.0)
    norm = F.sqrt(F.lit(2.0) * F.pi())
    return (
        merged.withColumn("s", stats)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .select(
            "point",
            at.alias("x"),
            (
                F.col("w")
                * F.exp(F.lit(-0.5) * F.pow((at - F.col("x")) / bw, F.lit(2)))
                / (F.col("s.n") * bw * norm)
            ).alias("k"),
        )
        .groupBy("point", "x")
        .agg(F.sum("k").alias("density"))
    )


def box_summary(df: DataFrame, category: str, column: str) -> DataFrame:
    """Per category: quartiles, whiskers (furthest points within 1.5 IQR) and outliers."""
    quart = exact_quantiles(df, [column], QUARTILES, group=[category]).drop("column")
    quart = materialize(quart, "quartiles")  # known size: broadcast if small
    x = F.col(column).cast("double")
    iqr = F.col("q75") - F.col("q25")
    low, high = F.col("q25") - 1.5 * iqr, F.col("q75") + 1.5 * iqr
    inside = x.between(low, high)
    return (
        df.select(category, column)
        .where(F.col(column).isNotNull())
        .join(quart, category)
        .groupBy(category, *QUARTILES)
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def xy_sample(
    df: DataFrame, key: str, columns: Sequence[str], n: int = 500, seed: int = 42
) -> DataFrame:
    """Exactly ``n`` rows (or all), chosen by seeded hash order: a top-n, not a sort."""
    return (
        df.select(key, *columns)
        .orderBy(hash32(seed, key), key)
        .limit(n)
    )


def grouped_sum(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.sum(c).alias(c) for c in columns])
