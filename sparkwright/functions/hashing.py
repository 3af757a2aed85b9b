"""Seeded, engine-independent row hashes that replace random draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 4294967296  # 2**32


def hash32(seed: int | str, *keys: str | Column) -> Column:
    """Uniform integer in [0, 2**32) from the first 8 hex digits of md5('seed:key[:key]')."""
    parts = [F.lit(str(seed))]
    for k in keys:
        parts.append((F.col(k) if isinstance(k, str) else k).cast("string"))
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_below(seed: int | str, share: float, *keys: str | Column) -> Column:
    return hash32(seed, *keys) < F.lit(int(share * SPAN))
