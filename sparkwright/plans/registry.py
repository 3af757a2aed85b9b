"""Registry of runnable queries and, where SQL can express them, their twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    from sparkwright.plans import (  # noqa: F401
        audits,
        bayes,
        evaluation,
        explaining,
        files,
        joining,
        models,
        neighbours,
        preparing,
        ranking,
        shaping,
        splitting,
        text,
        trees,
        tuning,
        vocabulary,
    )
