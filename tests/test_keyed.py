"""Words are grouped by document where their text is: only texts cross the network."""

import re

import pytest

from sparkwright.plans import vocabulary
from sparkwright.plans.registry import QUERIES, load_all
from sparkwright.session import TEXT_PARTITIONS

load_all()


@pytest.fixture()
def as_on_a_cluster(spark):
    """No number of text partitions is set, as where the submitter sets the session."""
    parts = spark.conf.get(TEXT_PARTITIONS)
    spark.conf.unset(TEXT_PARTITIONS)
    yield
    spark.conf.set(TEXT_PARTITIONS, parts)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["texts_to_ids", "pad_ids"])
def test_words_are_put_together_where_their_text_is(spark, sf, as_on_a_cluster, name):
    assert "ENSURE_REQUIREMENTS" not in _plan(QUERIES[name](spark, sf))


def test_mean_embedding_shuffles_no_words(spark, sf, as_on_a_cluster):
    assert not re.search(r"hashpartitioning\([^)]*word", _plan(QUERIES["mean_embedding"](spark, sf)))


@pytest.mark.parametrize("bigrams", [True, False])
def test_terms_are_counted_where_their_text_is(spark, sf, as_on_a_cluster, bigrams):
    assert "ENSURE_REQUIREMENTS" not in _plan(vocabulary.clean_counts(spark, sf, bigrams))


def test_repeated_and_null_keys_are_one_group(spark, tmp_path):
    rows = [(1, "alpha beta"), (None, "gamma"), (1, "gamma"), (None, "alpha"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["n"] for r in QUERIES["texts_to_ids"](spark, str(tmp_path)).collect()}
    assert got == {1: 3, None: 2, 2: 0, 3: 0}
    counts = vocabulary.clean_counts(spark, str(tmp_path), bigrams=False).collect()
    assert sorted((r["doc_id"] or 0, r["term"], r["tf"]) for r in counts) == [
        (0, "alpha", 1), (0, "gamma", 1), (1, "alpha", 1), (1, "beta", 1), (1, "gamma", 1)
    ]
