"""Connected components of a links table, as joins and groupings only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node reachable.

    Alternates two star steps until the edges stay the same: each node hangs its larger
    neighbours, then its smaller ones, under its smallest neighbour. The number of edges
    never grows and rounds follow the logarithm of the longest chain. A node with very
    many links is one row after the partial minimum; the join back is an ordinary one,
    which adaptive execution may split. Loops and null ends are ignored.
    """
    edges = (
        links.select(
            F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
        )
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b")))
        .distinct()
    )
    edges = materialize(edges, "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a"))
        large = materialize(large.select(F.col("b").alias("a"), F.col("m").alias("b")), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .where(F.col("b") != F.col("m"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        edges = materialize(small, "edges")
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
