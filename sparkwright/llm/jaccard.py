"""N-gram Jaccard join by grouped prefixes: classes of near copies, exactly.

A document's set holds its distinct word shingles. The order of shingles is: a fixed
fifth-and-more of the hash space first, by document frequency, then the rest. Two sets
with a Jaccard similarity of at least t share one of their first ``n - ceil(t n) + 1``
shingles in that order. Shingles that occur in one set only cannot be shared, so a set
with that many of them in the counted part has no partner and leaves early. For the sets
that stay, all shingles are counted and the prefixes drawn again.

Sets with the same size and the same prefix form one group. Shared prefix shingles
propose pairs of groups; sizes filter them; members are verified by exact intersection.
A class of copies is not expanded into pairs: first each group meets the head it shares
most with, then only pairs that are still in different classes are tried - all of them.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm import words as W
from sparkwright.llm.graph import components
from sparkwright.session import materialize, ship_package

# The share of the hash space whose shingles are counted in every set. It exceeds the
# prefix share (a quarter at 75 %), so few sets need the rest as well.
COUNTED = 5 / 16
VERY_FREQUENT = 1 << 30
TOKENS = "token long, sid long, frequent boolean"
SETS = "sid long, tokens array<long>"
# A shingle in more sets of one Arrow batch than this many, and this share, is frequent.
BATCH_SETS, BATCH_SHARE = 64, 50


def _counted(percent: int) -> np.uint64:
    share = min(1.0, COUNTED * (100 - percent) / 25) if percent > 0 else 1.0
    return np.uint64(min(2**64 - 1, int(share * 2**64)))


def _prefix(n: int, percent: int) -> int:
    return n - math.ceil(percent * n / 100) + 1


def _sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    hashes, first = W.words_of(texts, lower=True)
    for lo, hi in W.spans_of_rows(first):
        part = hashes[first[lo] : first[hi]]
        grams = W.grams(part, words)
        for d in range(lo, hi):
            a, b = first[d] - first[lo], first[d + 1] - first[lo]
            if b - a >= words:
                yield np.unique(grams[a : b - words + 1])
            elif b > a:
                yield W.grams(part[a:b], int(b - a))
            else:
                yield part[:0]


def _set_id(s: np.ndarray) -> np.uint64:
    with np.errstate(over="ignore"):
        return W.mix(W.mix(s ^ W.U(0x5851F42D4C957F2D)).sum(dtype=W.U)[None] + W.U(len(s)))[0]


def _emitted(s: np.ndarray, percent: int) -> tuple[int, np.ndarray]:
    """The number of counted shingles of a set; those, or all if they are fewer than its
    prefix."""
    k = int(np.searchsorted(s, _counted(percent)))
    return k, s[:k] if k >= _prefix(len(s), percent) else s


def describe_batches(batches, words: int, percent: int):
    """Per document: its id, set size, number of counted and emitted shingles, set id."""
    for batch in batches:
        rows = []
        for s in _sets(batch.column(1), words):
            k, emitted = _emitted(s, percent)
            rows.append((len(s), k, len(emitted), _set_id(s)))
        n, k, m, sid = (np.array(x) for x in zip(*rows)) if rows else (np.zeros(0),) * 4
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n.astype(np.int64)),
                pa.array(k.astype(np.int64)),
                pa.array(m.astype(np.int64)),
                pa.array(W.signed(sid.astype(W.U))),
            ],
            ["doc", "n", "k", "m", "sid"],
        )


def _tokens(sids: list, parts: list) -> pa.RecordBatch:
    """(token, sid, frequent) for distinct sets. A token that is frequent among them also
    sends one row without a set."""
    token = np.concatenate(parts)
    sid = np.repeat(np.array(sids, dtype=np.int64), [len(p) for p in parts])
    _, where, count = np.unique(token, return_inverse=True, return_counts=True)
    often = count > max(BATCH_SETS, len(parts) // BATCH_SHARE)
    marks = np.unique(token[often[where]])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([token, marks])),
            pa.array(
                np.concatenate([sid, np.zeros(len(marks), dtype=np.int64)]),
                mask=np.arange(len(token) + len(marks)) >= len(token),
            ),
            pa.array(np.concatenate([often[where], np.zeros(len(marks), dtype=bool)])),
        ],
        ["token", "sid", "frequent"],
    )


def token_batches(batches, words: int, percent: int):
    """The emitted shingles of each distinct set of a batch of texts."""
    for batch in batches:
        seen = {}
        for s in _sets(batch.column(0), words):
            if len(s):
                seen.setdefault(int(W.signed(_set_id(s)[None])[0]), _emitted(s, percent)[1])
        if seen:
            yield _tokens(list(seen), [W.signed(x) for x in seen.values()])


def set_token_batches(batches):
    """All shingles of a batch of distinct sets."""
    for batch in batches:
        if batch.num_rows:
            arrays = batch.column(1)
            flat, cuts = np.asarray(arrays.flatten()), np.cumsum(np.asarray(pc.list_value_length(arrays)))
            yield _tokens(np.asarray(batch.column(0)), np.split(flat, cuts[:-1]))


def shared_batches(batches):
    """From rows sorted by token and set: the rows whose token is in two sets or more,
    with the number of sets. Rows without a set mark a frequent token."""

    def settle(token, sid, has, frequent):
        begins = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        sizes = np.diff(np.r_[begins, len(token)])
        run = np.repeat(np.arange(len(begins)), sizes)
        fresh = np.r_[True, (sid[1:] != sid[:-1]) | (token[1:] != token[:-1])] & has
        count = np.bincount(run[fresh], minlength=len(begins))
        marked = np.bincount(run[~has | frequent], minlength=len(begins)) > 0
        df = np.where(marked, VERY_FREQUENT, count)
        keep = fresh & (df[run] > 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(sid[keep]), pa.array(token[keep]), pa.array(df[run][keep].astype(np.int64))],
            ["sid", "token", "df"],
        )

    held = None
    for batch in batches:
        has = np.asarray(batch.column(1).is_valid())
        rows = (
            np.asarray(batch.column(0)),
            np.asarray(batch.column(1).fill_null(0)),
            has,
            np.asarray(batch.column(2)),
        )
        if not len(has):
            continue
        if held is not None:
            rows = tuple(np.concatenate(x) for x in zip(held, rows))
        cut = int(np.searchsorted(rows[0], rows[0][-1]))
        if cut:
            yield settle(*(x[:cut] for x in rows))
        held = tuple(x[cut:] for x in rows)
    if held is not None:
        yield settle(*held)


def full_batches(batches, words: int):
    for batch in batches:
        rows = list(_sets(batch.column(0), words))
        offsets = np.cumsum([0, *map(len, rows)])
        flat = np.concatenate(rows) if rows else np.zeros(0, dtype=W.U)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(W.signed(np.array([_set_id(s) for s in rows], dtype=W.U))),
                W.lists(W.signed(flat), offsets, pa.int64()),
            ],
            ["sid", "tokens"],
        )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids whose similarity reaches the threshold."""
    a = sets.select(F.col("sid").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("sid").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    union = F.size("ta") + F.size("tb") - both
    return pairs.join(a, "a").join(b, "b").where(100 * both >= percent * union).select("a", "b")


def _shared(tokens: DataFrame) -> DataFrame:
    """(sid, token, df) of the tokens in two sets or more. Rows of a frequent token are
    dealt by their sets, so no task gets them all."""
    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = F.when(F.col("frequent"), F.col("sid")).otherwise(F.col("token"))
    return (
        tokens.repartition(parts, deal)
        .sortWithinPartitions("token", "sid")
        .mapInArrow(shared_batches, "sid long, token long, df long")
    )


def _prefixes(shared: DataFrame, sizes: DataFrame, counted, percent: int) -> DataFrame:
    """The shared shingles in the prefix of each set, with their places in its order; sets
    that can have a partner only. ``sizes``: set size n, its k counted and m emitted
    shingles; ``counted`` tells the counted ones, which come first in the order."""
    place = F.struct((~counted).alias("late"), "df", "token")
    width = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    early = F.array_sort(F.filter("known", lambda t: ~t["late"]))
    late = F.array_sort(F.filter("known", lambda t: t["late"]))

    def first(tokens, places):
        return F.slice(tokens, F.lit(1), F.greatest(places, F.lit(0)).cast("int"))["token"]

    # Before the shared shingles of either part stand the set's own ones of that part.
    late_places = F.when(F.col("m") > F.col("k"), width - F.col("k") - F.col("own_late"))
    return (
        shared.groupBy("sid")
        .agg(F.collect_list(place).alias("known"))
        .join(sizes, "sid")
        .withColumn("own", F.col("k") - F.size(early))
        .where(F.col("own") < width)
        .withColumn("own_late", F.col("m") - F.col("k") - F.size(late))
        .withColumn("early", first(early, width - F.col("own")))
        .withColumn("late", first(late, F.coalesce(late_places, F.lit(0))))
        .withColumn("prefix", F.concat("early", "late"))
        .withColumn(
            "places",
            F.transform(
                "prefix",
                lambda t, i: F.when(i < F.size("early"), F.col("own") + i + 1).otherwise(
                    F.col("k") + F.col("own_late") + i - F.size("early") + 1
                ),
            ),
        )
        .where(F.size("prefix") > 0)
        .select(
            "sid", "n", "prefix", "places",
            (F.col("own") + F.greatest("own_late", F.lit(0))).alias("own"),
            (F.size("prefix") == width).alias("whole"),
        )
    )


def _near_sizes(x, y, percent: int):
    return (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75
) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    component_id is the smallest id that links reach, the row's own included. A text
    without words, or null, has an empty set, no links, and its own id. Rows with a null
    id take part; they get the smallest id of their class, or null if there is none.
    Equal sets (repeated rows too) share a class. Texts of any length are read whole. An
    empty table gives no rows; other columns of ``docs`` are not looked at. Sets are told
    apart by 64-bit ids.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    known = materialize(
        rows.mapInArrow(
            functools.partial(describe_batches, words=words, percent=percent),
            "doc long, n long, k long, m long, sid long",
        ),
        "sets",
    )

    tokens = rows.select("text").mapInArrow(
        functools.partial(token_batches, words=words, percent=percent), TOKENS
    )
    # The counted part of the hash space as unsigned numbers.
    bound = int(_counted(percent))
    counted = F.col("token") >= 0
    if bound < 2**63:
        counted = counted & (F.col("token") < bound)
    else:
        counted = counted | (F.col("token") < bound - 2**64)
    sizes = known.groupBy("sid").agg(*(F.first(c).alias(c) for c in ("n", "k", "m")))
    hopeful = materialize(
        _prefixes(_shared(tokens), sizes, counted, percent).select("sid", "n"), "hopeful"
    )

    # The whole sets of those, each text once.
    wanted = known.join(hopeful.select("sid"), "sid", "left_semi")
    wanted = wanted.groupBy("sid").agg(F.min("doc").alias("doc"))
    full = functools.partial(full_batches, words=words)
    sets = (
        rows.join(wanted.select("doc").distinct(), "doc", "left_semi")
        .select("text")
        .mapInArrow(full, SETS)
        .join(hopeful.select("sid"), "sid", "left_semi")
    )
    orphans = (
        rows.where(F.col("doc").isNull())
        .select("text")
        .mapInArrow(full, SETS)
        .join(wanted.where(F.col("doc").isNull()), "sid", "left_semi")
    )
    sets = sets.unionByName(orphans).groupBy("sid").agg(F.first("tokens").alias("tokens"))
    sets = materialize(sets, "shingles")

    # Partners are among them, so their prefixes follow from counts over them alone - now
    # of all their shingles.
    size = F.size("tokens").cast("long")
    sizes = sets.select("sid", size.alias("n"), size.alias("k"), size.alias("m"))
    prefixes = _prefixes(
        _shared(sets.mapInArrow(set_token_batches, TOKENS)), sizes, F.lit(True), percent
    )
    # A set with a shingle of its own in the prefix shares the prefix with no other set.
    prefixes = materialize(
        prefixes.withColumn(
            "gid",
            F.when(F.col("whole"), F.xxhash64("n", "prefix")).otherwise(
                F.xxhash64("n", "prefix", "sid")
            ),
        ),
        "prefixes",
    )
    groups = prefixes.groupBy("gid").agg(
        F.min_by(F.struct("n", "own", "prefix", "places"), "sid").alias("g"),
        F.min("sid").alias("head"),
    )
    groups = materialize(groups.select("gid", "head", "g.*"), "groups")
    postings = materialize(
        groups.select(
            "gid", "head", "n", "own", F.explode(F.arrays_zip("prefix", "places")).alias("t")
        ).select("gid", "head", "n", "own", F.col("t.prefix").alias("token"), F.col("t.places").alias("place")),
        "postings",
    )

    # First: every group meets the one head it shares most shingles with, every member
    # the head of its group. Heads have the fewest shingles of their own: in a class of
    # copies of one original that is the original, or what is closest to it.
    def stars(posted: DataFrame, eligible) -> DataFrame:
        heads = posted.groupBy("token").agg(
            F.min(F.when(eligible, F.struct("own", "n", "head"))).alias("h")
        )
        return (
            posted.join(heads, "token")
            .where((F.col("head") != F.col("h.head")) & _near_sizes("n", "h.n", percent))
            .groupBy(F.col("head").alias("a"), F.col("h.head").alias("b"))
            .count()
            .groupBy("a")
            .agg(F.max_by("b", F.struct("count", "b")).alias("b"))
        )

    inside = (
        prefixes.select("sid", "gid")
        .join(groups.select("gid", "head"), "gid")
        .where(F.col("sid") != F.col("head"))
        .select(F.col("sid").alias("a"), F.col("head").alias("b"))
    )
    tried = stars(postings, F.lit(True)).unionByName(inside)
    links = materialize(_verified(tried, sets, percent), "links")

    def placed_in_classes():
        """Members with their classes; postings of the shingles of several classes."""
        found = components(links)
        member = (
            prefixes.select("sid", "gid")
            .join(found, F.col("sid") == F.col("node"), "left")
            .select("sid", "gid", F.coalesce("root", "sid").alias("root"))
        )
        member = materialize(member, "members")
        placed = postings.join(member.select("gid", "root").distinct(), "gid")
        mixed = (
            placed.groupBy("token", "root")
            .agg(F.count("*").alias("c"))
            .groupBy("token")
            .agg(F.max_by("root", F.struct("c", "root")).alias("most"), F.count("*").alias("k"))
            .where("k > 1")
            .select("token", "most")
        )
        return member, materialize(placed.join(mixed, "token"), "placed")

    # Once more with the heads of the largest class of each shingle.
    member, placed = placed_in_classes()
    outside = placed.where(F.col("root") != F.col("most"))
    major = placed.where(F.col("root") == F.col("most"))
    tried = stars(
        outside.withColumn("inner", F.lit(False)).unionByName(
            major.withColumn("inner", F.lit(True))
        ),
        F.col("inner"),
    ).join(outside.select(F.col("head").alias("a")).distinct(), "a", "left_semi")
    links = materialize(links.unionByName(_verified(tried, sets, percent)), "links")

    # Then: all pairs of groups in two classes that share a shingle near enough to the
    # front for their sizes. Pairs inside the largest class of a shingle are never formed.
    member, placed = placed_in_classes()
    left = placed.where(F.col("root") != F.col("most")).select(
        "token",
        *(F.col(c).alias(f"{c}_a") for c in ("gid", "n", "place", "root")),
    )
    right = placed.select(
        "token",
        *(F.col(c).alias(f"{c}_b") for c in ("gid", "n", "place", "root")),
        (F.col("root") == F.col("most")).alias("major"),
    )
    needed = F.ceil(F.lit(percent) * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    pairs = (
        left.join(right, "token")
        .where(F.col("major") | (F.col("root_a") < F.col("root_b")))
        .where((F.col("root_a") != F.col("root_b")) & _near_sizes("n_a", "n_b", percent))
        .where(F.col("place_a") <= F.col("n_a") - needed + 1)
        .where(F.col("place_b") <= F.col("n_b") - needed + 1)
        .select("gid_a", "root_a", "gid_b", "root_b")
        .distinct()
    )
    # Behind the whole prefixes only so many shingles are left to share.
    def side(c):
        return groups.select(
            F.col("gid").alias(f"gid_{c}"), F.col("n").alias(f"n_{c}"),
            F.col("prefix").alias(f"prefix_{c}"),
        )

    rest = [F.ceil(F.lit(percent) * F.col(f"n_{c}") / 100) - 1 for c in "ab"]
    pairs = (
        pairs.join(side("a"), "gid_a")
        .join(side("b"), "gid_b")
        .where(F.size(F.array_intersect("prefix_a", "prefix_b")) + F.greatest(*rest) >= needed)
        .select(
            F.col("gid_a").alias("ga"), F.col("root_a").alias("ra"),
            F.col("gid_b").alias("gb"), F.col("root_b").alias("rb"),
        )
    )
    of = lambda s: member.select(
        F.col("sid").alias(s), F.col("gid").alias(f"g{s}"), F.col("root").alias(f"r{s}")
    )
    pairs = pairs.join(of("a"), ["ga", "ra"]).join(of("b"), ["gb", "rb"])
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    more = _verified(pairs, sets, percent)
    both = links.unionByName(more)
    roots = components(both)

    placed_rows = known.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select(
        "doc", "n", F.when(F.col("n") > 0, F.coalesce("root", "sid")).alias("root")
    )
    least = placed_rows.where(F.col("root").isNotNull()).groupBy("root").agg(
        F.min("doc").alias("least")
    )
    return placed_rows.join(least, "root", "left").select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc")).otherwise(F.col("least")).alias("component_id"),
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75
) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id.

    Documents without words, and classes without any id, all stay. Columns and texts are
    unchanged. A row given twice (same id) is one document and stays as often as given.
    """
    found = classes(docs, id_col, text_col, words, percent)
    gone = found.where(F.col("component_id") != F.col(id_col)).select(id_col).distinct()
    # Written, so that Spark knows the size of the list and moves no text if it is small.
    gone = materialize(gone, "copies")
    return docs.join(gone, id_col, "left_anti")
