"""Small tables for the tests of the training-data operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def copies(seed=7):
    """Texts with exact and near copies, shared passages, nulls, empties, repeated rows."""
    rng = random.Random(seed)
    rows, i = [], 0
    passage = words(rng, 70)
    for _ in range(12):
        base = words(rng, rng.randrange(60, 220))
        for _ in range(rng.randrange(1, 6)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 3, 9])):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w[at:at] = passage
            rows.append((i, rng.choice([" ", "\n", "\t "]).join(w)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, "   \n"), (i + 3, "a b c"), (i + 4, "A b  c")]
    rows += [(i + 5, "of " * 300), (i + 6, "of " * 180), (i + 7, "one"), (i + 8, " ".join(words(rng, 6000)))]
    rows += [rows[0], (None, rows[1][1]), (None, None)]
    rng.shuffle(rows)
    return rows
