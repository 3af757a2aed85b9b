"""Queries that SQL can express give the rows DuckDB gives, in whole tables."""

import duckdb
import pytest

from sparkwright.llm.queries import LLM_ORACLES, LLM_QUERIES
from tools.check import TABLES, kind, rows_of


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_twin(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = LLM_QUERIES[name](spark, sf)
    cur = con.execute(LLM_ORACLES[name])
    types = {c[0]: kind(c[1]) for c in cur.description}
    assert {f.name: f.dataType.simpleString() for f in found.schema.fields} == types
    want, names = rows_of([c[0] for c in cur.description], cur.fetchall())
    have, columns = rows_of(found.columns, [tuple(r) for r in found.collect()])
    assert columns == names
    assert have == want
