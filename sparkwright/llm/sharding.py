"""Shards of near equal bytes by best-fit-decreasing bin packing of indivisible groups.

Equal texts are a group and stay together. Groups larger than a small share of a shard are
items of their own; the many small ones are first dealt into bundles by their digest, each
a fixed share of a shard as well. So the number of items has a bound that does not depend
on the data, and only items - a size each - are packed on the driver. Rows never leave
their tasks but as a narrow table of ids, sizes and digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkwright.session import materialize

# Bundles of small groups for each shard; a group of more than half a bundle is an item.
BUNDLES = 64
SLOT_ROWS = 50_000


class Bins:
    """Open bins by remaining capacity in a balanced (AVL) tree; equal ones by number."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _height(t):
        return t[3] if t else 0

    def _node(self, left, key, right):
        tall, low = self._height(left), self._height(right)
        if tall > low + 1:
            ll, lk, lr, _ = left
            if self._height(ll) < self._height(lr):
                rl, rk, rr, _ = lr
                return self._node(self._node(ll, lk, rl), rk, self._node(rr, key, right))
            return self._node(ll, lk, self._node(lr, key, right))
        if low > tall + 1:
            rl, rk, rr, _ = right
            if self._height(rr) < self._height(rl):
                ll, lk, lr, _ = rl
                return self._node(self._node(left, key, ll), lk, self._node(lr, rk, rr))
            return self._node(self._node(left, key, rl), rk, rr)
        return (left, key, right, 1 + max(tall, low))

    def add(self, key):
        self.root = self._add(self.root, key)

    def _add(self, t, key):
        if t is None:
            return (None, key, None, 1)
        left, k, right, _ = t
        if key < k:
            return self._node(self._add(left, key), k, right)
        return self._node(left, k, self._add(right, key))

    def _pop_least(self, t):
        left, k, right, _ = t
        if left is None:
            return k, right
        least, left = self._pop_least(left)
        return least, self._node(left, k, right)

    def _remove(self, t, key):
        left, k, right, _ = t
        if key < k:
            return self._node(self._remove(left, key), k, right)
        if key > k:
            return self._node(left, k, self._remove(right, key))
        if right is None:
            return left
        least, right = self._pop_least(right)
        return self._node(left, least, right)

    def take_tightest(self, size: int):
        """Remove and return the bin with the least remaining capacity of ``size`` or more."""
        t, best = self.root, None
        while t:
            left, k, right, _ = t
            if k[0] >= size:
                best, t = k, left
            else:
                t = right
        if best is not None:
            self.root = self._remove(self.root, best)
        return best


def best_fit(items: list[tuple[int, object]], capacity: int) -> dict[object, int]:
    """Bin number of each (size, name), largest first, ties by name. A new bin opens only
    if no open one has room; an item beyond the capacity gets a bin of its own."""
    bins, out, opened = Bins(), {}, 0
    for size, name in sorted(items, key=lambda x: (-x[0], str(x[1]))):
        found = bins.take_tightest(size)
        if found is None:
            found = (max(capacity, size), opened)
            opened += 1
        bins.add((found[0] - size, found[1]))
        out[name] = found[1]
    return out


def pack_into(items: list[tuple[int, object]], bins: int) -> dict[object, int]:
    """The packing of the least capacity, to the byte, that needs at most ``bins`` bins."""
    total, most = sum(s for s, _ in items), max((s for s, _ in items), default=0)
    low, high = max(most, -(-total // bins)), max(most, 2 * -(-total // bins) + most)
    used = lambda packed: len(set(packed.values()))
    best = best_fit(items, high)
    while low < high:
        middle = (low + high) // 2
        packed = best_fit(items, middle)
        if used(packed) <= bins:
            best, high = packed, middle
        else:
            low = middle + 1
    return best


def shards(
    docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, digest, shard, slot) for every row.

    size: UTF-8 bytes of the text (null: none) plus 8. Null and empty texts are one group.
    Shards hold whole groups; their sizes differ by about a bundle (a 64th of a shard), or
    by what one larger group forces. slot counts the rows of a shard from 0 without gaps.
    Repeated rows and null ids are rows like others; an empty table gives no rows; other
    columns are not looked at.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.sha2(text, 256).alias("digest"),
        ),
        "sizes",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    groups = materialize(groups, "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    bound = max(1, total // (n_shards * BUNDLES * 2))
    name = F.when(F.col("size") > bound, F.col("digest")).otherwise(
        F.concat(F.lit("bundle "), F.pmod(F.xxhash64("digest"), F.lit(n_shards * BUNDLES)))
    )
    named = groups.select("digest", "size", "n", name.alias("item"))
    # At most n_shards * BUNDLES * 2 large groups and n_shards * BUNDLES bundles.
    items = [
        (r.size, r.item)
        for r in named.groupBy("item").agg(F.sum("size").alias("size")).collect()
    ]
    packed = pack_into(items, n_shards)
    # Full shards first, so that equal inputs give equal numbers.
    placed = spark.createDataFrame(
        [(k, int(v)) for k, v in sorted(packed.items())], "item string, shard int"
    )
    n_rows = groups.agg(F.sum("n")).first()[0] or 0
    parts = max(16, -(-n_rows // (n_shards * SLOT_ROWS)))
    item = F.coalesce("large", F.concat(
        F.lit("bundle "), F.pmod(F.xxhash64("digest"), F.lit(n_shards * BUNDLES))
    ))
    large = F.broadcast(
        named.where(F.col("size") > bound).select("digest", F.col("item").alias("large"))
    )
    dealt = (
        rows.join(large, "digest", "left")
        .withColumn("item", item)
        .join(F.broadcast(placed), "item")
        .select(
            "doc", "size", "text_crc32", "digest", "shard",
            F.pmod(F.xxhash64("doc", "digest"), F.lit(parts)).alias("part"),
        )
    )
    counts = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = counts.select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc", "digest"))
    return (
        dealt.withColumn("place", place)
        .join(starts, ["shard", "part"])
        .select(
            F.col("doc").alias(id_col), "size", "text_crc32", "digest", "shard",
            (F.col("start") + F.col("place") - 1).alias("slot"),
        )
    )
