"""Repeated passages by relative parsing against indexed reference blocks, exactly.

Every document is cut into blocks at places that its own words decide: a window of
``min_words`` words belongs to the smallest hash (the anchor) among the short word runs in
it, and neighbouring windows with the same anchor form a block. Equal passages are thus
cut alike wherever they stand, and the blocks of all documents are the reference, indexed
by anchor with the first document of each. A document is parsed from left to right into
blocks; a block that the index holds from an earlier document is a copied factor, as a
whole, and neighbouring factors join to longer spans. Where a copied passage begins or
ends, the block at that boundary has an anchor that is known but words that are not; only
there windows are compared one by one.

No document meets another in pairs: an anchor, a block or a window that a third of all
documents share is one row per task after the partial minimum.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm import words as W
from sparkwright.session import materialize, ship_package

ANCHOR_WORDS = 10
BLOCKS = "doc long, rk long, anchor long, block long, pos int, windows int"


def _blocks(hashes: np.ndarray, size: int, short: int):
    """Start, number of windows, anchor and content hash of each block of one text."""
    n = len(hashes) - size + 1
    least = W.sliding_min(W.grams(hashes, short), size - short + 1)
    start = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    count = np.diff(np.r_[start, n])
    up, down = W.powers(W.WORD_BASE_2, len(hashes))
    sums = np.zeros(len(hashes) + 1, dtype=W.U)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    end = start + count + size - 1
    content = W.mix((sums[end] - sums[start]) * down[start] + W.mix(count.astype(W.U)))
    return start, count, least[start], content


def block_batches(batches, size: int, short: int):
    for batch in batches:
        hashes, first = W.words_of(batch.column(2))
        rows, parts = [], []
        for d in np.flatnonzero(np.diff(first) >= size):
            parts.append(_blocks(hashes[first[d] : first[d + 1]], size, short))
            rows.append(d)
        if not rows:
            continue
        row = pa.array(np.repeat(rows, [len(p[0]) for p in parts]))
        start, count, anchor, content = (np.concatenate(x) for x in zip(*parts))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(row),
                batch.column(1).take(row),
                pa.array(W.signed(anchor)),
                pa.array(W.signed(content)),
                pa.array(start.astype(np.int32)),
                pa.array(count.astype(np.int32)),
            ],
            ["doc", "rk", "anchor", "block", "pos", "windows"],
        )


def window_batches(batches, size: int):
    """One row per window of the wanted blocks of each text."""
    for batch in batches:
        hashes, first = W.words_of(batch.column(1))
        wanted = batch.column(2).to_pylist()
        out = [[], [], [], [], []]
        for d, blocks in enumerate(wanted):
            windows = W.grams(hashes[first[d] : first[d + 1]], size)
            doc = batch.column(0)[d].as_py()
            for b in blocks:
                n = b["windows"]
                out[0].append(np.full(n, doc, dtype=np.int64))
                out[1].append(np.full(n, b["anchor"], dtype=np.int64))
                out[2].append(np.full(n, b["block"], dtype=np.int64))
                out[3].append(np.arange(n, dtype=np.int32))
                out[4].append(W.signed(windows[b["pos"] : b["pos"] + n]))
        if out[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in out],
                ["doc", "anchor", "block", "at", "window"],
            )


def _covered(n: int, spans: list, size: int) -> np.ndarray:
    """Which of n words lie in a removed window; spans: first window, number of windows."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for s in spans:
        edge[s["pos"]] += 1
        edge[s["pos"] + s["windows"] + size - 1] -= 1
    return np.cumsum(edge[:-1]) > 0


def kept_batches(batches, size: int, with_text: bool):
    """Words, removed words, digest of the kept words, and, if asked for, the kept text."""
    for batch in batches:
        rows = ([], [], [], [])
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = (text or "").encode().split()
            n = len(words)
            if spans:
                gone = _covered(n, spans, size)
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            kept = b" ".join(words)
            rows[0].append(n)
            rows[1].append(n - len(words))
            rows[2].append(hashlib.sha256(kept).hexdigest())
            rows[3].append(kept.decode() if with_text else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()),
             pa.array(rows[2], pa.string()), pa.array(rows[3], pa.string())],
            ["doc", "n_words", "n_removed", "kept_sha256", "kept"],
        )


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc, text = F.col(id_col).cast("long"), F.col(text_col)
    return docs.select(doc.alias("doc"), F.xxhash64(doc, text).alias("rk"), text.alias("text"))


def factors(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50,
    anchor_words: int = ANCHOR_WORDS,
) -> DataFrame:
    """(rk, pos, windows): runs of windows of ``min_words`` words that also occur in a
    document with a smaller id, by row key (a hash of id and text). Runs may touch.

    Words are runs of anything but ASCII white space. Rows with a null id or text give and
    get no factors; nor do texts shorter than a window. Rows with the same id are not
    earlier than one another.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = _rows(docs, id_col, text_col)
    # The anchor stays well inside a window.
    short = max(1, min(anchor_words, min_words // 2))
    blocks = materialize(
        rows.where(F.col("doc").isNotNull()).mapInArrow(
            functools.partial(block_batches, size=min_words, short=short), BLOCKS
        ),
        "blocks",
    )
    index = (
        blocks.groupBy("anchor")
        .agg(
            F.min("doc").alias("first_doc"),
            F.max("doc").alias("last"),
            (F.min("block") == F.max("block")).alias("alike"),
        )
        .where("first_doc < last")
        .drop("last")
    )
    known = materialize(blocks.join(index, "anchor"), "known-blocks")
    copied = known.where("alike AND doc > first_doc").select("rk", "pos", "windows")

    # Boundaries: the anchor is known, with other words around it.
    edges = known.where("NOT alike").drop("first_doc", "alike")
    first = edges.groupBy("anchor", "block").agg(F.min(F.struct("doc", "rk", "pos", "windows")).alias("f"))
    first = materialize(first, "first-blocks")
    seen = edges.join(first, ["anchor", "block"])
    again = seen.where("doc > f.doc").select("rk", "pos", "windows")
    wanted = first.groupBy("f.rk").agg(
        F.collect_list(
            F.struct("anchor", "block", F.col("f.pos").alias("pos"), F.col("f.windows").alias("windows"))
        ).alias("blocks")
    )
    windows = (
        rows.join(wanted, "rk")
        .select("doc", "text", "blocks")
        .mapInArrow(
            functools.partial(window_batches, size=min_words),
            "doc long, anchor long, block long, at int, window long",
        )
    )
    windows = materialize(windows, "windows")
    earliest = (
        windows.groupBy("anchor", "window")
        .agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last"))
        .where("first_doc < last")
    )
    late = windows.join(earliest, ["anchor", "window"]).where("doc > first_doc")
    late = late.select("anchor", "block", "at")
    own = seen.where("doc = f.doc").select("anchor", "block", "rk", "pos")
    single = own.join(late, ["anchor", "block"]).select(
        "rk", (F.col("pos") + F.col("at")).cast("int").alias("pos"), F.lit(1).alias("windows")
    )
    return copied.unionByName(again).unionByName(single)


def remove(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50,
    with_text: bool = True,
) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept) for every row: the words that no factor
    covers, joined by one space; without the kept text itself if that is not wanted.

    Null and empty texts have no words and the digest of the empty text. Windows are
    judged on the input. Repeated rows (same id and text) are judged alike. An empty table
    gives no rows; other columns are not looked at.
    """
    found = materialize(factors(docs, id_col, text_col, min_words), "factors")
    spans = found.groupBy("rk").agg(F.collect_list(F.struct("pos", "windows")).alias("spans"))
    out = (
        _rows(docs, id_col, text_col)
        .join(spans, "rk", "left")
        .select("doc", "text", "spans")
        .mapInArrow(
            functools.partial(kept_batches, size=min_words, with_text=with_text),
            "doc long, n_words long, n_removed long, kept_sha256 string, kept string",
        )
        .withColumnRenamed("doc", id_col)
    )
    return out if with_text else out.drop("kept")
