"""Benchmark decontamination by SimHash windows with a multi-index Hamming search.

Windows as long as an item, in words, slide over every document. A window and the items of
its length are compared by 64-bit SimHash fingerprints of their weighted word shingles.
The fingerprints are cut into blocks; two within the radius differ by few bits in at least
one block, so an index of each block's values, with all values that near, finds every item
within the radius. The candidates are verified by the exact weighted Jaccard similarity of
the shingles. Only windows that hold at least one shingle of an item of the benchmark are
fingerprinted: without one the similarity is zero.

Items are read in blocks of a bounded number; each block's index goes to all tasks and the
documents stay where they are.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm import words as W
from sparkwright.session import materialize, ship_package

ITEM_BLOCK = 20_000
PARTS, PART_BITS = 8, 8
RADIUS = 23
TABLE_BITS = 22


def _words(texts) -> tuple[np.ndarray, np.ndarray]:
    return W.words_of(pc.utf8_lower(texts), separators=W.NOT_ALNUM)


def _shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    return W.grams(hashes, min(k, len(hashes))) if len(hashes) else hashes


def _simhash(tokens: np.ndarray, weights: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Fingerprints of runs of weighted shingles; ``begin`` holds the start of each run."""
    out = np.zeros(len(begin), dtype=W.U)
    spread = W.mix(tokens ^ W.U(0x2545F4914F6CDD1D))
    for bit in range(64):
        sign = np.where((spread >> W.U(bit)) & W.U(1), weights, -weights)
        out |= (np.add.reduceat(sign, begin) > 0).astype(W.U) << W.U(bit)
    return out


@dataclass
class Items:
    """The index of one block of items."""

    ids: np.ndarray
    sizes: np.ndarray
    shingles: list
    prints: np.ndarray
    token: np.ndarray
    weight: np.ndarray
    other: float
    k: int
    # Shingles of other blocks that a text holds, sorted, and their weights.
    more: tuple[np.ndarray, np.ndarray] | None = None

    def __post_init__(self):
        self.flags = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.flags[(self.token >> W.U(64 - TABLE_BITS)).astype(np.int64)] = True
        self.lengths = np.unique(self.sizes)
        # token -> lengths of the items that have it.
        token = np.searchsorted(self.token, np.concatenate(self.shingles))
        slot = np.searchsorted(self.lengths, np.repeat(self.sizes, [len(s) for s in self.shingles]))
        pairs = np.unique(token * len(self.lengths) + slot)
        self.slot_of = pairs % len(self.lengths)
        self.slot_begin = np.searchsorted(pairs // len(self.lengths), np.arange(len(self.token) + 1))
        # (length, part, value) -> items: all values within the part's share of the radius.
        near = [
            sum(1 << b for b in bits)
            for r in range(RADIUS // PARTS + 1)
            for bits in combinations(range(PART_BITS), r)
        ]
        near = np.array(near, dtype=np.int64)
        parts = self._parts(self.prints)
        values = parts[:, :, None] ^ near[None, None, :]
        slot = np.searchsorted(self.lengths, self.sizes)
        key = (slot[:, None, None] * PARTS + np.arange(PARTS)[None, :, None]) * (1 << PART_BITS) + values
        key = key.reshape(len(self.ids), -1)
        item = np.repeat(np.arange(len(self.ids)), key.shape[1])
        flat = key.ravel()
        order = np.argsort(flat, kind="stable")
        self.items = item[order]
        n_keys = len(self.lengths) * PARTS << PART_BITS
        self.begin = np.searchsorted(flat[order], np.arange(n_keys + 1))

    @staticmethod
    def _parts(prints: np.ndarray) -> np.ndarray:
        shift = (np.arange(PARTS) * PART_BITS).astype(W.U)
        return ((prints[:, None] >> shift[None, :]) & W.U((1 << PART_BITS) - 1)).astype(np.int64)

    def weigh(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weight of each shingle, and whether an item has it."""
        at = np.minimum(np.searchsorted(self.token, tokens), len(self.token) - 1)
        known = self.token[at] == tokens
        weights = np.where(known, self.weight[at], self.other)
        if self.more is not None and len(self.more[0]):
            token, weight = self.more
            at = np.minimum(np.searchsorted(token, tokens), len(token) - 1)
            weights = np.where(~known & (token[at] == tokens), weight[at], weights)
        return weights, known

    def places(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, length number) for every place of a token that items have, once for
        each length of such items."""
        at = np.flatnonzero(self.flags[(tokens >> W.U(64 - TABLE_BITS)).astype(np.int64)])
        which = np.minimum(np.searchsorted(self.token, tokens[at]), len(self.token) - 1)
        same = self.token[which] == tokens[at]
        at, which = at[same], which[same]
        low = self.slot_begin[which]
        count = self.slot_begin[which + 1] - low
        inner = np.arange(count.sum()) + np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count)
        return np.repeat(at, count), self.slot_of[inner]

    def candidates(self, prints: np.ndarray, slot: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs of this length within the radius."""
        key = (slot * PARTS + np.arange(PARTS)[None, :]) * (1 << PART_BITS) + self._parts(prints)
        low, high = self.begin[key.ravel()], self.begin[key.ravel() + 1]
        count = high - low
        window = np.repeat(np.repeat(np.arange(len(prints)), PARTS), count)
        at = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        pair = np.unique(window * len(self.ids) + self.items[at])
        window, item = pair // len(self.ids), pair % len(self.ids)
        bits = np.bitwise_count(prints[window] ^ self.prints[item])
        return window[bits <= RADIUS], item[bits <= RADIUS]


def _similarity(a: np.ndarray, b: np.ndarray, items: Items) -> float:
    """Weighted Jaccard similarity of two multisets of shingles."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    both, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    shared = (np.minimum(ca[ia], cb[ib]) * items.weigh(both)[0]).sum() if len(both) else 0.0
    total = (ca * items.weigh(ua)[0]).sum() + (cb * items.weigh(ub)[0]).sum() - shared
    return float(shared / total) if total > 0 else 0.0


def _index(ids, hashes, first, k: int, n_items: int, df: tuple[np.ndarray, np.ndarray]) -> Items:
    """``df``: sorted shingles that several items have, and the number of these."""
    rows = [i for i in range(len(ids)) if first[i + 1] > first[i]]
    shingles = [_shingles(hashes[first[i] : first[i + 1]], k) for i in rows]
    token = np.unique(np.concatenate(shingles))
    rare = lambda n: 1 + math.log(n_items / n)
    weight = np.full(len(token), rare(1))
    _, at, other = np.intersect1d(token, df[0], assume_unique=True, return_indices=True)
    weight[at] = rare(1) - np.log(df[1][other])
    sizes = np.array([first[i + 1] - first[i] for i in rows])
    items = Items.__new__(Items)
    items.token, items.weight, items.other, items.more = token, weight, rare(1), None  # for weigh()
    begin = np.cumsum([0, *map(len, shingles)])[:-1]
    flat = np.concatenate(shingles)
    prints = _simhash(flat, items.weigh(flat)[0], begin)
    return Items(np.asarray(ids)[rows], sizes, shingles, prints, token, weight, rare(1), k)


def _hits(hashes: np.ndarray, items: Items, threshold: float):
    """(item, start, words, similarity) of the verified windows of one text, best of each
    item."""
    n, k = len(hashes), items.k
    found: dict[int, tuple] = {}
    grams = {min(k, n): W.grams(hashes, min(k, n))} if n else {}
    for short in items.lengths[items.lengths < k]:
        if short <= n:
            grams[int(short)] = W.grams(hashes, int(short))
    marks = []
    for g, x in grams.items():
        at, slots = items.places(x)
        marks += [(s, g, at[slots == s]) for s in np.unique(slots).tolist()]
    for slot, g, hits in marks:
        size = int(items.lengths[slot])
        # A text a little shorter than the item is one window.
        length = min(size, n)
        if length < max(1, threshold * size) or g != min(k, size):
            continue
        last = n - length
        # Starts of windows that hold a shingle of an item of this length.
        edge = np.zeros(last + 2, dtype=np.int64)
        lo = np.clip(hits - (length - g), 0, last)
        hi = np.clip(hits, 0, last)
        np.add.at(edge, lo, 1)
        np.add.at(edge, hi + 1, -1)
        starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        per = length - g + 1
        for i in range(0, len(starts), 4096):
            part = starts[i : i + 4096]
            at = part[:, None] + np.arange(per)[None, :]
            tokens = grams[g][at].ravel()
            weights = items.weigh(tokens)[0]
            prints = _simhash(tokens, weights, np.arange(len(part)) * per)
            window, item = items.candidates(prints, slot)
            for w, j in zip(window.tolist(), item.tolist()):
                s = _similarity(grams[g][at[w]], items.shingles[j], items)
                if s >= threshold and s > found.get(j, (0, 0, 0.0))[2]:
                    found[j] = (int(part[w]), length, s)
    return found


def _weights(shared: list | None, other: float) -> tuple[np.ndarray, np.ndarray] | None:
    if not shared:
        return None
    token = np.array([x["token"] for x in shared], dtype=np.int64).view(W.U)
    order = np.argsort(token)
    return token[order], other - np.log(np.array([x["n"] for x in shared], dtype=float)[order])


def scan_batches(batches, items: Items, threshold: float):
    for batch in batches:
        out = ([], [], [], [], [])
        hashes, first = _words(batch.column(1))
        shared = batch.column(2).to_pylist() if batch.num_columns > 2 else None
        for d in range(batch.num_rows):
            if shared is not None:
                items.more = _weights(shared[d], items.other)
            found = _hits(hashes[first[d] : first[d + 1]], items, threshold)
            for j, (start, length, s) in found.items():
                for column, x in zip(out, (d, int(items.ids[j]), start, length, s)):
                    column.append(x)
        rows = pa.array(out[0], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
             pa.array(out[3], pa.int64()), pa.array(out[4], pa.float64())],
            ["doc", "item_id", "first_word", "n_words", "similarity"],
        )


def item_shingles(batches, k: int):
    for batch in batches:
        hashes, first = _words(batch.column(0))
        for i in range(batch.num_rows):
            s = np.unique(_shingles(hashes[first[i] : first[i + 1]], k))
            yield pa.RecordBatch.from_arrays([pa.array(W.signed(s))], ["token"])


def text_shingles(batches, k: int, flags: np.ndarray):
    """(key, token) for the shingles of each text, of every length up to ``k``, whose
    leading bits are flagged."""
    for batch in batches:
        hashes, first = _words(batch.column(1))
        for i in range(batch.num_rows):
            words = hashes[first[i] : first[i + 1]]
            for g in range(1, k + 1):
                s = np.unique(W.grams(words, g))
                s = s[flags[(s >> W.U(64 - TABLE_BITS)).astype(np.int64)]]
                if len(s):
                    key = batch.column(0).take(pa.array(np.full(len(s), i, dtype=np.int32)))
                    yield pa.RecordBatch.from_arrays([key, pa.array(W.signed(s))], ["key", "token"])


def _with_shared(rows: DataFrame, shared: DataFrame, k: int) -> DataFrame:
    """``rows`` (doc, text) with ``shared``, the (token, n) of the shared shingles that each
    text holds. The shingles are looked up in the partitioned table of ``shared``; only
    those whose leading bits occur there are moved."""
    spark = rows.sparkSession
    slot = F.shiftrightunsigned("token", 64 - TABLE_BITS)
    flags = np.zeros(1 << TABLE_BITS, dtype=bool)
    flags[shared.select(slot.alias("slot")).distinct().toArrow()["slot"].to_numpy()] = True
    hidden = spark.sparkContext.broadcast(flags)
    held = (
        rows.select(F.md5("text").alias("key"), "text")
        .where(F.col("key").isNotNull())
        .mapInArrow(lambda b: text_shingles(b, k, hidden.value), "key string, token long")
        .distinct()
        .join(shared, "token")
        .groupBy("key")
        .agg(F.collect_list(F.struct("token", "n")).alias("shared"))
    )
    return rows.join(
        materialize(held, "text-shingles"), F.md5("text") == F.col("key"), "left"
    ).select("doc", "text", "shared")


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", words: int = 5, threshold: float = 0.75,
) -> DataFrame:
    """(id, item_id, first_word, n_words, similarity): the best window of each document
    for each item it holds with a similarity of ``threshold`` or more.

    Words are runs of ASCII digits, letters, and anything beyond ASCII, in lower case.
    A shingle counts as often as it occurs, times 1 + ln(items / items that have it). Items
    of fewer words than a shingle are one. Null and empty texts and items give nothing;
    equal items are found each; repeated rows give their rows each, with null ids too. An
    empty table on either side gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    ship_package(spark)
    known = items.where(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")
    )
    n = known.count()
    def shingles(part: DataFrame) -> DataFrame:
        return part.select("text").mapInArrow(functools.partial(item_shingles, k=words), "token long")

    shared = materialize(
        shingles(known).groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "shared"
    )
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    blocks = max(1, -(-n // ITEM_BLOCK))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    if blocks > 1:
        # A block knows the weights of its own shingles; a text may hold those of others.
        rows = materialize(_with_shared(rows, shared, words), "weighted")
    found = None
    for b in range(blocks):
        here = known.where(block == b)
        part = here.orderBy("item", "text").collect()
        hashes, first = _words(pa.array([r.text for r in part], pa.string()))
        if not len(hashes):
            continue
        df = shared.join(shingles(here).distinct(), "token", "left_semi").toArrow()
        token = df["token"].to_numpy().view(W.U)
        order = np.argsort(token)
        df = token[order], df["n"].to_numpy()[order]
        index = _index([r.item for r in part], hashes, first, words, n, df)
        kind = docs.schema[id_col].dataType.simpleString()
        hits = rows.mapInArrow(
            functools.partial(scan_batches, items=index, threshold=threshold),
            f"doc {kind}, item_id long, first_word long, n_words long, similarity double",
        )
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = rows.select(
            "doc", *(F.lit(0).cast("long").alias(c) for c in ("item_id", "first_word", "n_words")),
            F.lit(0.0).alias("similarity"),
        ).where(F.lit(False))
    return found.withColumnRenamed("doc", id_col)


def without(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold an item; columns unchanged. Documents with
    a null id stay."""
    # Written, so that Spark knows the size of the list and moves no text if it is small.
    bad = materialize(contaminated(docs, items, id_col, **options).select(id_col).distinct(), "leaks")
    return docs.join(bad, id_col, "left_anti").select(*docs.columns)
