"""Exact top-k inner products with an impact-ordered index, score at a time.

Vectors are whole numbers. A block of vectors keeps, for each dimension, posting segments
by the size class of the component: the impact, quantised by powers of two. For a batch of
queries the segments are processed from the largest impact down; each adds its exact
products to the running scores. After a class is done, what is still missing from a score
is at most the product of the lengths of the query and of the vector's unprocessed rest.
Processing stops only when this proves that few vectors can still be among the best k;
those, the possible members, get their exact scores. Blocks are independent: each gives
its k best for each query, and the best of these are the result.

Queries come in blocks of bounded size, each sent to all tasks; vectors are never moved.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkwright.session import ship_package

QUERY_BLOCK = 4096
TILE = 512
BLOCK = 4096
# Stop when at most this share of scores is still open.
OPEN = 0.02


class Index:
    """Posting segments of one block: (class, dimension) -> rows, largest class first."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        size = np.abs(vectors)
        # Class c holds sizes in [2**(c-1), 2**c); class 0 holds zeros and is never read.
        self.level = np.where(size > 0, np.frexp(size.astype(np.float64))[1], 0)
        self.levels = sorted({int(x) for x in np.unique(self.level)} - {0}, reverse=True)
        self.segments = {}
        self.rest = {}
        for c in self.levels:
            for d in range(vectors.shape[1]):
                rows = np.flatnonzero(self.level[:, d] == c)
                if len(rows):
                    self.segments[c, d] = rows
            below = np.where(self.level < c, vectors, 0).astype(np.float64)
            self.rest[c] = np.sqrt((below**2).sum(1)) * (1 + 1e-9)

    def best(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int):
        """Query number, row and exact score of all that may be among the k best of this
        block by score, then smaller id. ``own`` holds each query's id, which is no
        candidate."""
        n, q = len(self.vectors), len(queries)
        banned = ids[:, None] == own[None, :]
        scores = np.zeros((n, q), dtype=np.int64)
        length = np.sqrt((queries.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
        take = min(k, n)
        lowest = -(2**62)  # below any score, and safe to negate
        open_ = ~banned
        for c in self.levels:
            for d in range(queries.shape[1]):
                rows = self.segments.get((c, d))
                if rows is not None:
                    scores[rows] += np.outer(self.vectors[rows, d], queries[:, d])
            missing = np.outer(self.rest[c], length)
            low = np.where(banned, -np.inf, scores - missing)
            bar = -np.partition(-low, take - 1, axis=0)[take - 1]
            open_ = (scores + missing >= bar[None, :]) & ~banned
            if open_.sum() <= max(OPEN * n * q, 4 * take * q):
                break
        row, query = np.nonzero(open_)
        exact = np.empty(len(row), dtype=np.int64)
        for i in range(0, len(row), 1 << 15):
            j = i + (1 << 15)
            exact[i:j] = (self.vectors[row[i:j]] * queries[query[i:j]]).sum(1)
        full = np.full((n, q), lowest, dtype=np.int64)
        full[row, query] = exact
        # Keep ties with the k-th; ids decide between them.
        bar = -np.partition(-full, take - 1, axis=0)[take - 1]
        keep = exact >= bar[query]
        return query[keep], row[keep], exact[keep]


def _whole(vectors, size: int, scale: int):
    """Rows that take part, and their components times ``scale`` rounded down. Shorter
    vectors end in zeros; longer ones than the queries cannot score beyond their length."""
    rows, out = [], []
    for i, v in enumerate(vectors):
        if v is None:
            continue
        x = np.array(v, dtype=np.float64)
        if not np.isfinite(x).all():
            continue
        x = np.floor(scale * x)
        if len(x) < size:
            x = np.r_[x, np.zeros(size - len(x))]
        x = x[:size]
        if np.abs(x).max(initial=0) >= 2**26:
            raise ValueError("components must stay below 2**26 after scaling")
        rows.append(i)
        out.append(x.astype(np.int64))
    return np.array(rows, dtype=np.int64), np.array(out, dtype=np.int64).reshape(len(out), size)


def search_batches(batches, queries: np.ndarray, own: np.ndarray, k: int, scale: int):
    best = None
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            part = batch.slice(lo, BLOCK)
            rows, vectors = _whole(part.column(1).to_pylist(), queries.shape[1], scale)
            if not len(rows):
                continue
            ids = np.asarray(part.column(0))[rows]
            index = Index(vectors)
            for at in range(0, len(queries), TILE):
                query, row, score = index.best(
                    queries[at : at + TILE], own[at : at + TILE], ids, k
                )
                new = np.c_[query + at, ids[row], score]
                best = new if best is None else np.concatenate([best, new])
            best = _first(best, k)
    if best is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[best[:, 0]]), pa.array(best[:, 1]), pa.array(best[:, 2])],
            ["query_id", "vec_id", "score"],
        )


def _first(rows: np.ndarray, k: int) -> np.ndarray:
    order = np.lexsort((rows[:, 1], -rows[:, 2], rows[:, 0]))
    rows = rows[order]
    begin = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
    place = np.arange(len(rows)) - np.repeat(begin, np.diff(np.r_[begin, len(rows)]))
    return rows[place < k]


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
    vector_col: str = "embedding", scale: int = 256,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k highest inner products of
    scaled and floored vectors, ties to the smaller id; its own id is no candidate.

    Null vectors, and such with a null or non-finite component, take no part, nor do null
    ids. Vectors may differ in length; missing components are zero. A repeated row counts
    as often as given, as query and as candidate: a repeated query gives one list. Scaled
    components of 2**26 or more are an error. Without queries or vectors the result is
    empty; other columns are not looked at. Queries are handled in blocks of a fixed
    number, one after the other; each block is sent to all tasks.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    whole = F.expr(f"transform({vector_col}, x -> cast(x AS double))")
    base = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), whole.alias("v")
    )
    asked = queries.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), whole.alias("v")
    )
    asked = asked.dropDuplicates(["id"])
    n = asked.count()
    found = None
    blocks = max(1, -(-n // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    for b in range(blocks):
        rows = asked.where(block == b).orderBy("id").collect()
        size = max((len(r.v) for r in rows), default=0)
        at, whole_q = _whole([r.v for r in rows], size, scale)
        if not len(at):
            continue
        own = np.array([rows[i].id for i in at], dtype=np.int64)
        part = base.mapInArrow(
            functools.partial(search_batches, queries=whole_q, own=own, k=k, scale=scale),
            "query_id long, vec_id long, score long",
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.select(
        "query_id", F.row_number().over(order).alias("rank"), "vec_id", "score"
    ).where(F.col("rank") <= k)
