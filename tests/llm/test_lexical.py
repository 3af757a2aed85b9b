"""Ranked lexical search against a brute-force scorer, on both of its paths."""

import math
import random
import re
from collections import Counter

import pytest

from sparkwright.llm import lexical
from tests.llm.data import documents

TERM = re.compile(lexical.TERM)


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans(lexical.UPPER, lexical.LOWER)))


def brute(docs, items, k=50):
    rows = [(d, terms(t)) for d, t in docs]
    rows = [(d, ts) for d, ts in rows if ts]
    n_docs, total = len(rows), sum(len(ts) for _, ts in rows)
    df = Counter(t for _, ts in rows for t in set(ts))
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
    queries = {}
    for item, text in items:
        if item is not None:
            queries.setdefault(item, set()).update(terms(text))
    out = []
    for item, q in queries.items():
        scored = []
        for d, ts in rows:
            if d is None:
                continue
            tf, m = Counter(ts), 50 + (50 * len(ts) * n_docs) // total
            s = sum(w[t] * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in q if t in tf)
            if s > 0:
                scored.append((-s, d))
        for r, (s, d) in enumerate(sorted(scored)[:k]):
            out.append((item, r + 1, d, -s))
    return sorted(out)


def corpus(seed, n=60):
    rng = random.Random(seed)
    common = ["The", "of", "and"]
    docs = []
    for i in range(n):
        ws = [rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 30))]
        docs.append((i, " ".join(ws)))
    docs += [(n, None), (n + 1, ""), (n + 2, "...!!"), (None, "w1 w2 w3"), docs[3], (n + 3, "W1" * 1 + " " + "w2 " * 5000)]
    items = [(j, " ".join(rng.choice(common + [f"w{x}" for x in range(45)]) for _ in range(rng.randrange(1, 8)))) for j in range(12)]
    items += [(12, None), (13, "zzz unknown"), (None, "w1"), (14, "the THE of"), items[0]]
    return docs, items


@pytest.mark.parametrize("share", [1, 3, 64])
@pytest.mark.parametrize("k", [3, 50])
def test_equals_brute_force(spark, share, k):
    docs, items = corpus(5)
    found = lexical.search(
        documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), k=k, frequent_share=share
    )
    assert sorted(tuple(r) for r in found.collect()) == brute(docs, items, k)


def test_empty_tables_and_clashing_columns(spark):
    empty = documents(spark, [])
    items = spark.createDataFrame([(1, "a b", "x")], "item_id long, text string, row string")
    assert lexical.search(empty, items).collect() == []
    docs = documents(spark, [(1, "a b c"), (2, "a")]).withColumnRenamed("lang", "c")
    assert [tuple(r) for r in lexical.search(docs, items.limit(0)).collect()] == []
    got = sorted(tuple(r) for r in lexical.search(docs, items).collect())
    assert got == brute([(1, "a b c"), (2, "a")], [(1, "a b")])


def test_vocabulary_filtered_by_join_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(lexical, "VOCABULARY_BROADCAST", 0)
    monkeypatch.setattr(lexical, "QUERY_BROADCAST", 0)
    docs, items = corpus(11)
    found = lexical.search(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), k=5)
    assert sorted(tuple(r) for r in found.collect()) == brute(docs, items, 5)


def zipf_corpus(seed, n=1500):
    """Texts of frequent terms by falling weight, every sixth with a rare one."""
    rng = random.Random(seed)
    vocab = [f"f{x}" for x in range(40)]
    weights = [1 / (x + 2) for x in range(40)]
    docs = []
    for i in range(n):
        ws = rng.choices(vocab, weights, k=rng.randrange(5, 60))
        docs.append((i, " ".join(ws + [f"r{rng.randrange(60)}"] * (i % 6 == 0))))
    items = [(j, " ".join(set(rng.choices(vocab, k=18)) | {f"r{rng.randrange(60)}" for _ in range(9)})) for j in range(8)]
    return docs, items


@pytest.mark.parametrize("slack", [0.6, 0.99])
def test_few_documents_are_completed(spark, monkeypatch, slack):
    docs, items = zipf_corpus(3)
    seen, complete = [], lexical._complete

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return complete(pairs, *rest)

    monkeypatch.setattr(lexical, "_complete", counted)
    share = {} if slack == 0.6 else {"slack_share": slack}
    found = lexical.search(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), k=5, **share)
    assert sorted(tuple(r) for r in found.collect()) == brute(docs, items, 5)
    if not share:
        # Nearly every text holds a frequent term of every query; few can be among its best.
        assert sum(seen) < len(docs) * len(items) / 8
