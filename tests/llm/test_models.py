"""Toxicity, decontamination and exact top-k against brute force or held-out rows."""

import random
import re
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkwright.llm import benchmark, topk, toxicity
from tests.llm.data import SCHEMA, documents, words


def brute_top(rows, queries, k):
    out = []
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = [int(np.floor(256 * x)) for x in v]
    for q in queries:
        if q in whole:
            scores = sorted(
                (-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q
            )
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["normal", "clustered", "ties", "odd"])
def test_top_k_is_that_of_brute_force(spark, kind):
    rng = random.Random(kind)
    rows = []
    for i in range(250):
        if kind == "normal":
            v = [rng.gauss(0, 0.3) for _ in range(12)]
        elif kind == "clustered":
            v = [rng.choice([-1, 1]) * (d == i % 6) + rng.gauss(0, 0.02) for d in range(12)]
        elif kind == "ties":
            v = [rng.choice([0.0, 0.5]) for _ in range(4)]
        else:
            v = rng.choice([None, [], [float("nan"), 1.0], [None, 1.0], [float("inf")], [0.0] * 3,
                            [1e4, -1e4], [rng.random()] * 5])
        rows.append((i, v))
    table = spark.createDataFrame(
        [(i, v, 1) for i, v in rows] + [(None, [1.0], 1)],
        "vec_id long, embedding array<double>, score int",
    )
    asked = table.where("vec_id % 10 = 0")
    got = topk.top_k(table.repartition(3), asked, 5).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows, range(0, 250, 10), 5)


def test_top_k_query_blocks_repeats_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rows = [(i, [float(i), 1.0]) for i in range(20)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(table, table.unionByName(table.limit(1)), 2).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows, range(20), 2)
    assert topk.top_k(table, table.limit(0)).collect() == []
    assert topk.top_k(table.limit(0), table).collect() == []


def test_index_stops_only_on_proof():
    rng = np.random.default_rng(1)
    v = rng.integers(-200, 200, (600, 16))
    q = rng.integers(-200, 200, (30, 16))
    ids = np.arange(600)
    query, row, score = topk.Index(v).best(q, np.full(30, -1), ids, 5)
    exact = v @ q.T
    for j in range(30):
        want = np.sort(exact[:, j])[-5:]
        assert sorted(score[query == j])[-5:] == want.tolist()


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())


def brute_leaks(rows, items, threshold=0.75):
    sh = lambda w: Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
    its = [(i, split(t)) for i, t in items if i is not None and t is not None]
    df = Counter(s for _, w in its for s in sh(w))
    weigh = lambda s: 1 + log(len(its) / df[s]) if s in df else 1 + log(len(its))
    out = set()
    for doc, text in rows:
        w = split(text)
        for item, iw in its:
            n = min(len(iw), len(w))
            if not n or n < threshold * len(iw):
                continue
            b = sh(iw)
            for at in range(len(w) - n + 1):
                a = sh(w[at : at + n])
                if not a.keys() & b.keys():
                    continue
                low = sum(min(a[s], b[s]) * weigh(s) for s in a.keys() & b.keys())
                high = sum(c * weigh(s) for s, c in a.items()) + sum(c * weigh(s) for s, c in b.items())
                if low / (high - low) >= threshold:
                    out.add((doc, item))
                    break
    return out


def test_leaks_are_those_of_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, rng.randrange(14, 50), 5000))) for i in range(30)]
    items += [(30, "a b"), (31, ""), (32, None), (None, "x y z"), (33, items[0][1]), (34, items[1][1] + " end")]
    rows = []
    for i in range(80):
        w = words(rng, rng.randrange(20, 120), 5000)
        if i % 2:
            p = split(rng.choice(items[:30])[1])
            for _ in range(i % 5):
                p[rng.randrange(len(p))] = "changed"
            if i % 7 == 0:
                p.insert(3, "more")
            at = rng.randrange(len(w))
            w[at:at] = [x.upper() for x in p]
        rows.append((i, rng.choice([" ", ", ", ".\n"]).join(w)))
    rows += [(100, None), (101, ""), (102, items[2][1]), (103, " ".join(split(items[2][1])[1:])), (104, "x a b y")]
    docs = documents(spark, rows + [rows[1]]).withColumn("item_id", F.lit(5))
    table = spark.createDataFrame(items, "item_id long, text string")
    found = benchmark.contaminated(docs, table)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    want = brute_leaks(rows, items)
    assert got <= want
    # The fingerprints' radius is four deviations wide at the threshold.
    assert len(want - got) <= 0.01 * len(want)
    kept = {r.doc_id for r in benchmark.without(docs, table).collect()}
    assert kept == {i for i, _ in rows} - {d for d, _ in got}
    assert benchmark.contaminated(docs.limit(0), table).collect() == []
    assert benchmark.contaminated(docs, table.limit(0)).collect() == []


@pytest.fixture(scope="module")
def taught(spark):
    rng = random.Random(9)
    bad = ["idiot", "moron", "scum", "pathetic"]
    rows, labels = [], []
    for i in range(360):
        w = ["".join(rng.choice(["an", "the", "er", "ti", "on", "st", "ou"]) for _ in range(rng.randrange(1, 5)))
             for _ in range(rng.randrange(10, 60))]
        toxic = i % 3 == 0
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        for at in range(9, len(w), 10):
            w[at] += "."
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    docs = documents(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, marks, toxicity.fit_on(docs, marks)


def test_held_out_labels(spark, taught):
    docs, marks, model = taught
    scored = toxicity.score(docs, model).join(marks, "doc_id").join(docs.select("doc_id", "text"), "doc_id")
    held = scored.where(~toxicity.in_training()).collect()
    assert len(held) > 60
    wrong = [(r.toxic, r.score, r.text) for r in held if (r.score >= 0.7) != (r.toxic == 1)]
    print(model.words, wrong)
    right = len(held) - len(wrong)
    assert right >= 0.97 * len(held)


def test_gapped_insults_and_odd_texts(spark, taught):
    _, _, model = taught
    texts = ["the ou erst idiot", "the ou i d i o t erst", "i.d.i.o.t", "the m-o-r-o-n", "an idxiot there",
             "THE IDIOT", "pathetically", None, "", "the ou erst", "an " * 20000, "x" * 100_000, "an " * 20000 + " idiot"]
    got = {r.doc_id: r.score for r in toxicity.score(documents(spark, list(enumerate(texts)) + [(0, texts[0])]), model).collect()}
    print([(texts[i] and texts[i][:20], round(s, 3)) for i, s in got.items()])
    for i in (0, 1, 2, 3, 4, 5, 6, 12):
        assert got[i] >= 0.5, texts[i]
    for i in (7, 8, 9, 10, 11):
        assert got[i] < 0.5
    assert all(0 <= s <= 1 for s in got.values())
    kept = toxicity.without_toxic(documents(spark, list(enumerate(texts))), model)
    assert {7, 8, 9, 10, 11} <= {r.doc_id for r in kept.collect()} and kept.columns == documents(spark, []).columns


def test_without_both_labels_nothing_is_toxic(spark, taught):
    docs, marks, _ = taught
    assert toxicity.fit_on(docs, marks.where("toxic = 0")) is None
    assert toxicity.fit_on(docs, marks.limit(0)) is None
    none = spark.createDataFrame([], SCHEMA)
    assert toxicity.fit_on(none, marks) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(none, taught[2]).collect() == []


def test_kernel_is_that_of_all_subsequences():
    from itertools import combinations

    def plain(a: bytes, b: bytes):
        def feats(x):
            out = Counter()
            for at in combinations(range(len(x)), 4):
                if at[-1] - at[0] < toxicity.SPAN:
                    out[bytes(x[i] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] + 1)
            return out
        fa, fb = feats(a), feats(b)
        return sum(v * fb[u] for u, v in fa.items()) / sum(v * v for v in fb.values())

    marks = toxicity.Landmarks([" idiot ", " path"])
    units = [b" idiot ", b" idxiot ", b" pathetic ", b" onoror ", b" id "]
    got = marks.kernel(*toxicity._padded(units))
    want = [[min(plain(u, w), 1.5) for w in marks.words] for u in units]
    assert got == pytest.approx(np.array(want), abs=1e-5)


def test_units():
    texts = pa.array(["One, two. I.D.", None, "a b c dd", "é" * 40])
    letters, length, unit, row, where = toxicity.units_of(texts)
    names = [bytes(x[:n]).decode("utf-8", "ignore") for x, n in zip(letters, length)]
    per = [[names[u] for u in unit[row == i]] for i in range(4)]
    assert per[0] == [" one ", " two ", " id "] and per[1] == []
    assert " abc " in per[2] and " dd " in per[2]
    assert len(per[3]) > 1 and where[0] == where[1] and where[2] > where[1]


def test_runs_of_single_letters_end_with_their_text():
    def names(texts):
        letters, length, unit, row, _ = toxicity.units_of(pa.array(texts, pa.string()))
        spelt = [bytes(x[:n]).decode() for x, n in zip(letters, length)]
        return [sorted(spelt[u] for u in unit[row == i]) for i in range(len(texts))]

    texts = ["take vitamin c", "i d i o t you", "a b c", "d e f", None, "x", "y", "z", "", "m o r o n", "a b"]
    together = names(texts)
    assert together == [names([t])[0] for t in texts]
    assert " idiot " in together[1] and " def " in together[3] and " moron " in together[9]
    assert names([]) == [] and names([None, ""]) == [[], []]


def test_a_text_scores_alike_beside_others(spark, taught):
    _, _, model = taught
    texts = ["the ou vitamin c", "i d i o t", "a b c", "m o r o n"]
    together = toxicity.score(documents(spark, list(enumerate(texts))).coalesce(1), model).collect()
    for i, text in enumerate(texts):
        alone = toxicity.score(documents(spark, [(i, text)]), model).first()
        assert [r.score for r in together if r.doc_id == i] == pytest.approx([alone.score])


def test_leaks_do_not_depend_on_the_blocks_of_items(spark, monkeypatch):
    rng = random.Random(8)
    plates = [words(rng, 12, 50) for _ in range(4)]
    items, rows = [], []
    for i in range(48):
        w = words(rng, 26, 5000)
        if i % 2:
            w[20:] = plates[i % 4]
        items.append((i, " ".join(w)))
        # The words at one end become boilerplate of other items.
        for cut in (4, 5, 6):
            p = plates[(i + 1) % 4][:cut + 2] if i % 3 else plates[(i + 2) % 4][:cut]
            rows.append((3 * i + cut - 4, " ".join(words(rng, 9, 5000) + p + w[cut:] + words(rng, 9, 5000))))
    items += [(48, "a b"), (49, "a b"), (50, "c d"), (51, items[1][1])]
    rows += [(500, None), (501, ""), (502, "x a b y c d"), (503, rows[0][1]), (None, rows[1][1])]
    docs, table = documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")

    def found():
        got = benchmark.contaminated(docs, table).collect()
        return sorted(((r.doc_id, r.item_id, r.first_word, r.n_words, round(r.similarity, 9)) for r in got), key=str)

    whole = found()
    monkeypatch.setattr(benchmark, "ITEM_BLOCK", 5)
    assert found() == whole
    pairs, want = {(r[0], r[1]) for r in whole}, brute_leaks(rows, items)
    assert pairs <= want and len(want - pairs) <= 0.01 * len(want)
