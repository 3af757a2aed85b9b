"""Conversation structure repair: the cheapest edits that turn each conversation's turns
into system?, then user/assistant pairs, found by a lightest-derivation agenda.

Faults (Spark expressions, per row of a conversation in turn order): a row is *blank*
when its text has no character outside ASCII white space, else a *duplicate* when an
earlier row has its role and text, else *truncated* when its last such character is not
one of ``.!?``; only the first fault counts. *Illegal* counts neighbouring rows whose role
initials are not ``su``, ``ua`` or ``au``; *gaps* the missing turns between the smallest
and the largest.

Repair (one conversation, in one task): items are (rows consumed, grammar state) with the
states empty / after system / after user / after assistant; the goal is all rows consumed
in the empty or after-assistant state. Deductions: Keep a row (0) if its role initial fits
the state, Rerole it to user or assistant (2), Delete it (3; the only one for blank and
duplicate rows), Insert an empty user or assistant row (2); a truncated row that is not
deleted adds 1. Knuth's agenda runs from the goal backwards, so that an item's value is
(cost, audit of the edits still to come) and a deduction *prepends* its edit's initial:
prepending keeps the order of (cost, audit) values, which makes the functions monotone,
and items are finalised in order of cost, then of rows remaining fewest first (Keep is the
only free deduction and always consumes a row), so every item is final when popped. Ties
of cost go to the ASCII-least audit (D < I < K < R).

Edge cases: null roles and texts are one space (blank, and an illegal initial); null turns
come first and count in no gap; a conversation without rows has cost 0, an empty audit
and no repaired rows; rows of other roles can only be rerole'd or deleted; repeated rows
are duplicates; extra columns are ignored. Work per conversation grows with the square of
its rows only through the audit strings; a conversation is sequential by nature and is not
split.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkwright.session import ship_package

SPACE = r"[\x20\x09-\x0D]"
INK = r"[^\x20\x09-\x0D]"

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
ACCEPT = (0, 3)


def _after(state: int, initial: str) -> int | None:
    """The grammar state after a row with this role initial, or None if it may not stand."""
    if initial == "s":
        return 1 if state == 0 else None
    if initial == "u":
        return 2 if state in (0, 1, 3) else None
    if initial == "a":
        return 3 if state == 2 else None
    return None


def repair(rows: list[tuple[str, str, str | None]]) -> tuple[int, str, list[tuple[str, str]]]:
    """rows: (role, text, fault) in order. Returns (cost, audit, repaired (role, text))."""
    n = len(rows)
    # Deductions out of each item, as (cost, letter, next item, emitted row or None).
    def edges(i: int, state: int):
        for role, letter in (("user", "I"), ("assistant", "I")):
            nxt = _after(state, role[0])
            if nxt is not None:
                yield INSERT, letter, (i, nxt), (role, "")
        if i == n:
            return
        role, text, fault = rows[i]
        yield DELETE, "D", (i + 1, state), None
        if fault in ("blank", "duplicate"):
            return
        extra = TRUNCATED if fault == "truncated" else 0
        nxt = _after(state, role[:1])
        if nxt is not None:
            yield KEEP + extra, "K", (i + 1, nxt), (role, text)
        for new in ("user", "assistant"):
            nxt = _after(state, new[0])
            if role != new and nxt is not None:
                yield REROLE + extra, "R", (i + 1, nxt), (new, text)

    # Backward deductions: for each item, the items whose edges lead into it.
    def into(item):
        i, state = item
        for s in range(4):
            for e in edges(i, s):
                if e[2] == item:
                    yield (i, s), e
            if i > 0:
                for e in edges(i - 1, s):
                    if e[2] == item:
                        yield (i - 1, s), e

    best: dict[tuple[int, int], tuple[int, str]] = {}
    choice: dict[tuple[int, int], tuple] = {}
    agenda = []
    for s in ACCEPT:
        best[(n, s)] = (0, "")
        heapq.heappush(agenda, (0, 0, s, (n, s)))
    done = set()
    while agenda:
        cost, _, _, item = heapq.heappop(agenda)
        if item in done or best[item][0] != cost:
            continue
        done.add(item)
        if item == (0, 0):
            break
        c, audit = best[item]
        for source, (step, letter, _, emitted) in into(item):
            if source in done:
                continue
            value = (c + step, letter + audit)
            if source not in best or value < best[source]:
                best[source] = value
                choice[source] = (letter, item, emitted)
                heapq.heappush(agenda, (value[0], n - source[0], source[1], source))
    cost, audit = best[(0, 0)]
    repaired, item = [], (0, 0)
    while item in choice:
        _, item, emitted = choice[item]
        if emitted is not None:
            repaired.append(emitted)
    return cost, audit, repaired


def damage(conversations: DataFrame, modulus: int = 20) -> DataFrame:
    """Rows after damage by crc32(`conv_id:turn`) % modulus: 0 drops the row, 1 empties
    its text, 2 removes its ``.!?``, 3 repeats it (same turn), 4 makes it a user row.
    Null roles and texts become one space; a null turn is written as nothing in the key."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit("")))
    code = F.crc32(key) % modulus
    return (
        rows.withColumn("code", code)
        .where(F.col("code") != 0)
        .withColumn("text", F.when(F.col("code") == 1, F.lit(""))
                    .when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")))
        .withColumn("copy", F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("code")
    )


def faults(rows: DataFrame) -> DataFrame:
    """Adds pos (order in the conversation), initial and fault to (conv_id, turn, role,
    text, copy) rows."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "copy", "role", "text")
    seen = Window.partitionBy("conv_id", "role", "text").orderBy("pos")
    last = F.regexp_extract("text", f"({INK}){SPACE}*$", 1)
    return (
        rows.withColumn("pos", F.row_number().over(order))
        .withColumn("initial", F.substring("role", 1, 1))
        .withColumn(
            "fault",
            F.when(~F.col("text").rlike(INK), F.lit("blank"))
            .when(F.row_number().over(seen) > 1, F.lit("duplicate"))
            .when(~last.isin(".", "!", "?"), F.lit("truncated")),
        )
    )


REPAIRED = "conv_id long, cost long, audit string, repaired array<struct<role:string,text:string>>"


def _repair_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("pos")
    rows = list(zip(pdf["role"], pdf["text"], pdf["fault"].where(pdf["fault"].notna(), None)))
    cost, audit, repaired = repair(rows)
    return pd.DataFrame(
        {"conv_id": [pdf["conv_id"].iloc[0]], "cost": [cost], "audit": [audit],
         "repaired": [[{"role": r, "text": t} for r, t in repaired]]}
    )


def repaired(conversations: DataFrame, modulus: int = 20) -> DataFrame:
    """Per original conversation: gaps, blank, duplicate, truncated, illegal, cost, audit
    and the repaired rows (role, text) in order."""
    ship_package(conversations.sparkSession)
    rows = faults(damage(conversations, modulus))
    order = Window.partitionBy("conv_id").orderBy("pos")
    pair = F.concat(F.lag("initial").over(order), F.col("initial"))
    counted = rows.withColumn("bad", (pair.isNotNull() & ~pair.isin("su", "ua", "au")).cast("long"))
    stats = counted.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum((F.col("fault") == "blank").cast("long")).alias("blank"),
        F.sum((F.col("fault") == "duplicate").cast("long")).alias("duplicate"),
        F.sum((F.col("fault") == "truncated").cast("long")).alias("truncated"),
        F.sum("bad").alias("illegal"),
    )
    fixed = rows.select("conv_id", "pos", "role", "text", "fault").groupBy("conv_id").applyInPandas(_repair_group, REPAIRED)
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    zero = F.lit(0).cast("long")
    # Null-safe joins: rows without a conversation id are one conversation too.
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    joined = (
        every.alias("e").join(stats.alias("s"), same("e", "s"), "left")
        .join(fixed.alias("f"), same("e", "f"), "left")
        .select("e.conv_id", "s.gaps", "s.blank", "s.duplicate", "s.truncated", "s.illegal", "f.cost", "f.audit", "f.repaired")
    )
    return joined.select(
        "conv_id",
        *(F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired", F.array().cast("array<struct<role:string,text:string>>")).alias("repaired"),
    )
