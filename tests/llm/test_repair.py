"""Conversation repair against an exhaustive search over edit sequences."""

import random
import re
import zlib

import pytest

from sparkwright.llm import repair

GRAMMAR = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """All edit sequences with at most len(rows) + 2 inserts; the least (cost, audit)."""
    best = None
    limit = len(rows) + 2

    def go(i, out, audit, cost, inserts):
        nonlocal best
        if i == len(rows) and GRAMMAR.fullmatch("".join(r[0][:1] for r in out)):
            value = (cost, audit, list(out))
            if best is None or value[:2] < best[:2]:
                best = value
        if best is not None and cost > best[0]:
            return
        if inserts < limit:
            for role in ("user", "assistant"):
                go(i, out + [(role, "")], audit + "I", cost + 2, inserts + 1)
        if i == len(rows):
            return
        role, text, fault = rows[i]
        go(i + 1, out, audit + "D", cost + 3, inserts)
        if fault in ("blank", "duplicate"):
            return
        extra = 1 if fault == "truncated" else 0
        go(i + 1, out + [(role, text)], audit + "K", cost + extra, inserts)
        for new in ("user", "assistant"):
            if new != role:
                go(i + 1, out + [(new, text)], audit + "R", cost + 2 + extra, inserts)

    go(0, [], "", 0, 0)
    return best


@pytest.mark.parametrize("seed", range(60))
def test_agenda_equals_exhaustive_search(seed):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", " "]
    rows = [(rng.choice(roles), "t", rng.choice([None, None, "truncated", "blank", "duplicate"])) for _ in range(rng.randrange(0, 5))]
    cost, audit, fixed = repair.repair(rows)
    want = brute(rows)
    assert (cost, audit, fixed) == (want[0], want[1], want[2])


def test_known_cases():
    assert repair.repair([]) == (0, "", [])
    assert repair.repair([("user", "a.", None), ("assistant", "b.", None)]) == (0, "KK", [("user", "a."), ("assistant", "b.")])
    assert repair.repair([("system", "x.", None)]) == (3, "D", [])
    assert repair.repair([("assistant", "b.", None)])[:2] == (2, "IK")


def crc(conv, turn):
    return zlib.crc32(f"{conv}:{'' if turn is None else turn}".encode()) % 20


def test_query_rows(spark):
    rows = []
    for conv in range(40):
        for turn in range(4):
            rows.append((conv, turn, ["system", "user", "assistant"][turn % 3], f"say {conv} {turn}" + ("." if turn % 2 else "")))
    rows += [(50, None, None, None), (50, 2, "user", "x"), (51, 0, "user", "   "), (None, 1, "user", "a.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("cost", repair.F.lit(9))
    got = {r.conv_id: r for r in repair.repaired(df).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0)):
            role, text = role if role is not None else " ", text if text is not None else " "
            code = crc(c, turn)
            if code == 0:
                continue
            text = "" if code == 1 else re.sub(r"[.!?]", "", text) if code == 2 else text
            role = "user" if code == 4 else role
            kept += [(turn, role, text)] * (2 if code == 3 else 1)
        seen, faults = set(), []
        for turn, role, text in kept:
            ink = re.findall(r"[^\x20\x09-\x0d]", text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else None if ink[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append((role, text, fault))
        cost, audit, fixed = brute(faults)
        r = got[conv]
        assert (r.cost, r.audit, [tuple(x) for x in r.repaired]) == (cost, audit, fixed)
        assert r.blank == sum(f[2] == "blank" for f in faults)
        assert r.duplicate == sum(f[2] == "duplicate" for f in faults)
        assert r.truncated == sum(f[2] == "truncated" for f in faults)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        assert r.illegal == sum(p not in ("su", "ua", "au") for p in pairs)
        turns = [t for t, _, _ in kept if t is not None]
        assert r.gaps == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
