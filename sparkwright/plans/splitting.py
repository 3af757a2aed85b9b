"""Splits and folds over the given tables."""

from __future__ import annotations

from sparkwright.operators import splitting as P
from sparkwright.plans.registry import query
from sparkwright.plans.shaping import labelled_docs
from sparkwright.plans.sqlparts import hash32
from sparkwright.session import load

LINE = hash32("l_orderkey || ':' || l_linenumber")

RANKED = f"""
    r AS (SELECT d.doc_id, l.toxic AS label, row_number() OVER
                 (PARTITION BY l.toxic ORDER BY {hash32('d.doc_id')}, d.doc_id) AS rn
          FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
"""


@query(
    "stratified_split",
    f"""
    WITH {RANKED},
    c AS (SELECT label, count(*) AS n_c, sum(count(*)) OVER () AS n,
                 CAST(ceil(0.2::DOUBLE * sum(count(*)) OVER ()) AS BIGINT) AS n_test
          FROM r GROUP BY label),
    e AS (SELECT label, n_test, n_c * n_test / n::DOUBLE AS x FROM c),
    f AS (SELECT label, floor(x) AS base, n_test - sum(floor(x)) OVER () AS rest,
                 row_number() OVER (ORDER BY x - floor(x) DESC, label) AS place FROM e),
    qt AS (SELECT label, base + CASE WHEN place <= rest THEN 1 ELSE 0 END AS quota FROM f)
    SELECT r.doc_id, r.label, CAST(r.rn <= qt.quota AS INTEGER) AS is_test
    FROM r JOIN qt ON r.label = qt.label
    """,
)
def stratified_split(spark, d):
    docs = labelled_docs(spark, d).select("doc_id", "label")
    return P.stratified_split(docs, "label", "doc_id").select("doc_id", "label", "is_test")


@query(
    "random_split",
    f"""
    SELECT l_orderkey, l_linenumber, CAST({LINE} < 858993459 AS INTEGER) AS is_test
    FROM lineitem
    """,
)
def random_split(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return P.random_split(li, ["l_orderkey", "l_linenumber"])


@query(
    "kfold_assign",
    f"SELECT l_orderkey, l_linenumber, CAST({LINE} % 5 AS INTEGER) AS fold FROM lineitem",
)
def kfold_assign(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return P.kfold_assign(li, ["l_orderkey", "l_linenumber"])


@query(
    "stratified_kfold",
    f"WITH {RANKED} SELECT doc_id, label, CAST((rn - 1) % 5 AS INTEGER) AS fold FROM r",
)
def stratified_kfold(spark, d):
    docs = labelled_docs(spark, d).select("doc_id", "label")
    return P.stratified_kfold(docs, "label", "doc_id").select("doc_id", "label", "fold")
