"""BPE encoding and decoding against the tokenizers library itself."""

import hashlib

import pytest

from sparkwright.llm import bpe
from tests.llm.data import documents

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

HOSTILE = [
    None, "", " ", "a", "<|endoftext|>", "x<|endoftext|>y <|endoftext|>", "<|endoft", "\r\n\t  \n",
    "😀🎉 café naïve Ærø", "don't we'll I'M", "12345 3.14", "a" * 30000, "ab " * 3000 + "ab",
    " ".join(["w"] * 200), "中文字符 テスト", "\x00\x01 control",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(bpe.compile_tables(P.path("byte_bpe_50k.json")), P.PATTERN)


def test_encoder_equals_library(own, library):
    for text in HOSTILE:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)
    assert own.decode(None) is None


def test_spark_round_trip(spark, library):
    rows = [(i, t) for i, t in enumerate(HOSTILE)] + [(0, HOSTILE[4]), (None, "b")]
    docs = documents(spark, rows).withColumnRenamed("lang", "ids")
    got = {(r.doc_id, tuple(r.ids), r.decoded) for r in bpe.decode(bpe.encode(docs)).collect()}
    want = set()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((i, tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert got == want
    assert bpe.encode(documents(spark, [])).collect() == []


def test_query_digests(spark, sf, library):
    import duckdb

    from sparkwright.llm.queries import LLM_QUERIES

    found = {r.doc_id: r for r in LLM_QUERIES["op12_bpe_encoding"](spark, sf).collect()}
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    assert len(found) == len(texts)
    for doc, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = found[doc]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_one_pass_round_trip_and_slices(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_BYTES", 64)
    rows = [(i, t) for i, t in enumerate(HOSTILE)]
    got = {(r.doc_id, tuple(r.ids), r.decoded) for r in bpe.encode(documents(spark, rows), with_decoded=True).collect()}
    want = set()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((i, tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert got == want
