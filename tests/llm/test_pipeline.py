"""The pipeline's stages against their brute-force versions, stage by stage."""

from collections import defaultdict

import corpus_pipeline
from sparkwright.llm import toxicity
from sparkwright.llm.queries import LLM_QUERIES
from sparkwright.session import load, materialize
from tests.llm.test_copies import brute_classes
from tests.llm.test_models import brute_leaks
from tests.llm.test_native import water


def test_every_stage(spark, sf):
    docs = load(spark, sf, "documents")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], sf), name))
    raw, clean, single, pure, mixed, dealt = tables
    for t in tables[1:-1]:
        assert t.schema.simpleString() == raw.select(*corpus_pipeline.COLUMNS).schema.simpleString()
    ids = lambda t: sorted(r.doc_id for r in t.select("doc_id").collect())
    rows = lambda t: [(r.doc_id, r.text) for r in t.select("doc_id", "text").collect()]

    model = toxicity.fit_on(raw, load(spark, sf, "labels"))
    toxic = {r.doc_id for r in toxicity.score(raw, model).collect() if r.score >= 0.7}
    assert ids(clean) == sorted(set(ids(raw)) - toxic)
    assert ids(single) == sorted(d for d, _, c in brute_classes(rows(clean)) if d == c)
    items = [(r.item_id, r.text) for r in load(spark, sf, "benchmark").collect()]
    assert ids(pure) == sorted(set(ids(single)) - {d for d, _ in brute_leaks(rows(single), items)})

    words = lambda t: len((t or "").encode().split())
    sizes, got = defaultdict(int), defaultdict(int)
    for r in pure.collect():
        sizes[r.source] += words(r.text)
    for r in mixed.collect():
        got[r.source] += words(r.text)
    for s, goal in water(sizes).items():
        longest = max(words(t) for _, t in rows(pure))
        assert goal - 1 <= got[s] <= goal + longest
    out = dealt.collect()
    assert sorted(r.doc_id for r in out) == ids(mixed)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_registered(spark, sf):
    names = list(LLM_QUERIES)
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert LLM_QUERIES["pipeline"] is corpus_pipeline.run
