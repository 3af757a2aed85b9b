"""Projections, filters and reshaping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def binary_label(df: DataFrame, condition: Column, name: str = "label") -> DataFrame:
    """Predicate as a 0/1 column; an unknown outcome counts as 0."""
    return df.withColumn(name, F.coalesce(condition, F.lit(False)).cast("int"))


def yes_no_encode(df: DataFrame, exclude: Iterable[str] = (), yes: object = "Yes") -> DataFrame:
    """Every column outside ``exclude`` becomes ``value == yes`` as 0/1; NULL gives 0."""
    skip = set(exclude)
    return df.select(
        *[
            F.col(c)
            if c in skip
            else F.coalesce(F.col(c) == F.lit(yes), F.lit(False)).cast("int").alias(c)
            for c in df.columns
        ]
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def other_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]


def select_by_dtype(df: DataFrame, numeric: bool = True) -> DataFrame:
    return df.select(*(numeric_columns(df) if numeric else other_columns(df)))


def class_subset(df: DataFrame, label: str, value: object) -> DataFrame:
    return df.where(F.col(label) == F.lit(value))


def drop_blank_rows(df: DataFrame, text: str) -> DataFrame:
    """Empty and one-space texts count as missing; rows with any missing value go."""
    missing = F.col(text).isin("", " ")
    return df.withColumn(text, F.when(~missing, F.col(text))).na.drop()


def leak_guard(features: Sequence[str], *targets: str) -> None:
    leaked = sorted(set(features) & set(targets))
    if leaked:
        raise ValueError(f"target among the features: {', '.join(leaked)}")


def attach_features(left: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Column-wise concatenation: rows are matched by key, never by position."""
    return left.join(features, key)


def transpose_metrics(
    df: DataFrame, name: str, metrics: Sequence[str], rows: Sequence[str]
) -> DataFrame:
    """One row per ``name`` -> one row per metric with a column per name. ``rows``
    lists the names, so the pivot needs no extra job."""
    wide = [F.col(m).cast("double").alias(m) for m in metrics]
    long = df.select(name, *wide).unpivot([name], list(metrics), "metric", "value")
    return long.groupBy("metric").pivot(name, list(rows)).agg(F.first("value"))


def residuals(df: DataFrame, label: str, prediction: str, name: str = "residual") -> DataFrame:
    return df.withColumn(name, F.col(label) - F.col(prediction))
