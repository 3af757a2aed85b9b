"""Substring dedup and the Jaccard join against brute force, with their edge cases."""

import hashlib

import pytest

from sparkwright.llm import graph, jaccard, sharding, substring
from tests.llm.data import SCHEMA, copies, documents


def shingle_sets(rows):
    out = []
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        n = max(1, min(5, len(w)))
        out.append((doc, frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))))
    return out


def brute_classes(rows):
    sets = shingle_sets(rows)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(sets):
        if doc is not None:
            r = find(i)
            least[r] = min(doc, least.get(r, doc))
    return sorted(
        ((doc, len(s), least.get(find(i)) if s else doc) for i, (doc, s) in enumerate(sets)), key=str
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_are_those_of_brute_force(spark, seed):
    rows = copies(seed)
    got = jaccard.classes(documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_classes(rows)


def test_one_of_each_class_stays(spark):
    rows = [(3, "a b c d e f"), (1, "A b c d e f"), (2, "other words are here now"), (9, None), (8, "")]
    kept = jaccard.keep_one(documents(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 8, 9]
    assert kept.columns == documents(spark, rows).columns


def test_large_near_copy_class_without_pairs(spark):
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(200):
        w = list(base)
        w[i % 110] = f"edit{i}"
        rows.append((i, " ".join(w)))
    got = jaccard.classes(documents(spark, rows)).collect()
    assert {r.component_id for r in got} == {0}


def test_components(spark):
    links = spark.createDataFrame(
        [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a long, b long"
    )
    got = {r.node: r.root for r in graph.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert graph.components(links.limit(0)).collect() == []


def brute_kept(rows, size):
    earliest = {}
    split = [(doc, (text or "").encode().split()) for doc, text in rows]
    for doc, w in split:
        if doc is not None:
            for i in range(len(w) - size + 1):
                x = tuple(w[i : i + size])
                earliest[x] = min(doc, earliest.get(x, doc))
    out = []
    for doc, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if doc is not None and earliest[tuple(w[i : i + size])] < doc:
                gone[i : i + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        digest = hashlib.sha256(b" ".join(kept)).hexdigest()
        out.append((doc, len(w), len(w) - len(kept), digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [50, 8])
def test_repeated_passages_are_those_of_brute_force(spark, size):
    rows = copies(5)
    # Equal words at the borders, a repeat inside one text, and one id with two texts.
    p = " ".join(f"p{i}" for i in range(60))
    rows += [(900, f"x {p} y"), (901, f"z {p} y"), (902, f"{p} {p}"), (903, p), (903, f"q {p}")]
    got = substring.remove(documents(spark, rows), min_words=size).drop("kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_kept(rows, size)


def test_kept_text(spark):
    p = " ".join(f"p{i}" for i in range(50))
    got = substring.remove(documents(spark, [(1, p), (2, f"a {p} b")])).collect()
    assert {r.doc_id: r.kept for r in got} == {1: p, 2: "a b"}


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert jaccard.classes(none).collect() == []
    assert substring.remove(none).collect() == []
    assert sharding.shards(none).collect() == []
    rows = [(1, "a b c d e f"), (2, "a b c d e f")]
    odd = documents(spark, rows)
    for c in ("doc", "sid", "rk", "n", "token", "size", "shard", "item", "digest", "key"):
        odd = odd.withColumn(c, odd.source)
    assert {r.component_id for r in jaccard.classes(odd).collect()} == {1}
    assert len(substring.remove(odd).collect()) == 2
    assert len(sharding.shards(odd).collect()) == 2
