"""Preprocessing fitted on training rows only. A fit is a small table or a
PipelineModel; applying it is a projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.operators.ordered import exact_quantiles
from sparkwright.session import materialize


def median_fit(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, fill): exact medians, the mean of the middle two on even counts."""
    return exact_quantiles(train, columns, {"fill": 0.5})


def mode_fit(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, fill): most frequent value as text; ties go to the smallest value in the
    column's own order."""
    numeric = [c for c in columns if isinstance(train.schema[c].dataType, T.NumericType)]
    # Numbers keep a sortable key next to their text, so 9 comes before 10.
    structs = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(c).cast("string").alias("fill"),
            (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("num"),
        )
        for c in columns
    ]
    return (
        train.select(F.explode(F.array(*structs)).alias("s"))
        .select("s.*")
        .where(F.col("fill").isNotNull())
        .groupBy("column", "fill", "num")
        .agg(F.count("*").alias("n"))
        .groupBy("column")
        .agg(F.min_by("fill", F.struct(-F.col("n"), F.col("num"), F.col("fill"))).alias("fill"))
    )


def _wide(fit: DataFrame, columns: Sequence[str], value: str) -> Column:
    """One struct with a field per column, from the long fit table."""
    return fit.agg(
        F.struct(*[F.max(F.when(F.col("column") == c, F.col(value))).alias(c) for c in columns])
    ).scalar()


def impute(df: DataFrame, fit: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULL by the fitted value of each column."""
    out = df.withColumn("_fill", _wide(fit, columns, "fill"))
    fixed = {
        c: F.coalesce(F.col(c), F.col(f"_fill.{c}").cast(df.schema[c].dataType)) for c in columns
    }
    return out.withColumns(fixed).drop("_fill")


def standardize_fit(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of means and population deviations."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std")]
    return train.agg(F.struct(*aggs).alias("s"))


def standardize(df: DataFrame, fit: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / std; a constant column keeps scale 1."""
    out = df.withColumn("_s", fit.scalar())
    scaled = {}
    for c in columns:
        std = F.col(f"_s.{c}__std")
        scale = F.when(std == 0, F.lit(1.0)).otherwise(std)
        scaled[c] = (F.col(c) - F.col(f"_s.{c}__mean")) / scale
    return out.withColumns(scaled).drop("_s")


def categories(train: DataFrame, column: str) -> list[str]:
    """Sorted training categories; they become columns, so they must fit a schema."""
    rows = train.select(F.col(column).cast("string").alias("v")).where("v is not null").distinct()
    return [r["v"] for r in rows.orderBy("v").collect()]


def one_hot(df: DataFrame, column: str, values: Sequence[str], drop: bool = False) -> DataFrame:
    """One 0/1 column per category; a value unseen in training gives zeros everywhere."""
    hot = {
        f"{column}_{v}": F.coalesce(F.col(column).cast("string") == F.lit(v), F.lit(False)).cast("int")
        for v in values
    }
    out = df.withColumns(hot)
    return out.drop(column) if drop else out


def poly_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Squares and pairwise products next to the inputs, no bias column."""
    extra = {}
    for i, a in enumerate(columns):
        for b in columns[i:]:
            extra[f"{a}__x__{b}"] = F.col(a).cast("double") * F.col(b).cast("double")
    return df.withColumns(extra)


def class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """n / (K n_k) for the class of each row; the joined side has one row per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    total = df.agg(
        F.struct(F.count("*").alias("n"), F.count_distinct(label).alias("k"))
    ).scalar()
    weights = (
        counts.withColumn("_t", total)
        .select(label, (F.col("_t.n") / (F.col("_t.k") * F.col("_n"))).alias(name))
    )
    # Written, so Spark knows how few classes there are before it plans the join.
    return df.join(materialize(weights, "class-weights"), label)


def _number(x: float | None) -> str:
    return f"{float(0.0 if x is None else x)!r}D"


def _text(x: str | None) -> str:
    return "CAST(NULL AS STRING)" if x is None else "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_transformer(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    output: str = "features",
    scale: bool = True,
    poly: bool = False,
) -> PipelineModel:
    """Numeric branch (median, optional degree-2 terms, scale) beside a categorical
    branch (mode, one-hot), assembled into one vector.

    The fitted numbers are a few per column; they become literals of a
    ``SQLTransformer`` so that the result is a plain, saveable PipelineModel.
    """
    fills = {r["column"]: r["fill"] for r in median_fit(train, numeric).collect()}
    filled = {c: f"coalesce(CAST(`{c}` AS DOUBLE), {_number(fills.get(c))})" for c in numeric}
    terms = dict(filled)
    if poly:
        cols = list(numeric)
        for i, a in enumerate(cols):
            for b in cols[i:]:
                terms[f"{a}__x__{b}"] = f"({filled[a]}) * ({filled[b]})"
    shown = dict(terms)
    if scale:
        aggs = []
        for name, sql in terms.items():
            aggs += [
                F.avg(F.expr(sql)).alias(f"{name}__m"),
                F.stddev_pop(F.expr(sql)).alias(f"{name}__s"),
            ]
        stats = train.agg(*aggs).first()
        for name, sql in terms.items():
            std = stats[f"{name}__s"] or 1.0
            shown[name] = f"(({sql}) - {_number(stats[f'{name}__m'])}) / {_number(std)}"
    parts = [f"{sql} AS `_num_{name}`" for name, sql in shown.items()]
    if categorical:
        modes = {r["column"]: r["fill"] for r in mode_fit(train, categorical).collect()}
        parts += [
            f"coalesce(CAST(`{c}` AS STRING), {_text(modes.get(c))}) AS `_cat_{c}`"
            for c in categorical
        ]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")]
    inputs = [f"_num_{name}" for name in shown]
    if categorical:
        cats = [f"_cat_{c}" for c in categorical]
        indexer = StringIndexer(
            inputCols=cats, outputCols=[f"{c}_i" for c in cats], handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ).fit(stages[0].transform(train))
        indexed = indexer.transform(stages[0].transform(train))
        encoder = OneHotEncoder(
            inputCols=[f"{c}_i" for c in cats], outputCols=[f"{c}_v" for c in cats], dropLast=True
        ).fit(indexed)
        stages += [indexer, encoder]
        inputs += [f"{c}_v" for c in cats]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
    return PipelineModel(stages=stages)
