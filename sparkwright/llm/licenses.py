"""License notices by diagonal voting over word k-grams.

Every run of k words of every text is joined, by hash, to the places where the templates
have it. A hit votes for the diagonal text place minus template place; an inserted or lost
word only shifts the diagonal a little, so neighbouring diagonals are merged. The merged
run is verified by the share of the template's k-grams it holds and by its length.
Templates are arguments, so the index has a fixed size and is broadcast. DataFrame
functions only; no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that decide by themselves, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Well-known notices, as words.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def _index(spark, phrases: dict[str, str], notices: list[tuple[str, str]]) -> DataFrame:
    rows = []
    templates = [(label, p, True) for p, label in phrases.items()]
    templates += [(label, p, False) for label, p in notices]
    for number, (label, phrase, base) in enumerate(templates):
        words = phrase.split()
        if len(words) < K:
            raise ValueError(f"a template needs {K} words: {phrase}")
        for at in range(len(words) - K + 1):
            rows.append((*words[at : at + K], number, at, len(words) - K + 1, label, base))
    seen: dict[tuple, int] = {}
    out = []
    for r in rows:
        out.append((*r, seen.get(r[:K], 0)))
        seen[r[:K]] = out[-1][-1] + 1
    names = [f"t{i} string" for i in range(K)]
    frame = spark.createDataFrame(
        out, ", ".join([*names, "template int, at int, grams int, label string, base boolean, nth int"])
    )
    return frame.withColumn("gram", F.xxhash64(*(f"t{i}" for i in range(K))))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    phrases: dict[str, str] = PHRASES, notices: list[tuple[str, str]] = NOTICES,
    shift: int = 3, share: float = 0.6,
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score), a row each.

    Words are runs of digits, letters and anything beyond ASCII, A-Z in lower case. n_base
    counts the places where a phrase stands word for word; first_word and last_word are
    its smallest and largest. labels adds those of notices of which at least ``share`` of
    the k-grams lie on diagonals at most ``shift`` apart, over a run not much longer than
    the notice. score is the largest share (1 for a phrase, 0 for nothing). Null is an
    empty text; without labels both lists are empty strings. A repeated row (same id and
    text) comes back as often; an empty table gives no rows; other columns are not looked
    at.
    """
    # Two letters beyond ASCII have an ASCII lower case; any other letter will do for them.
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = F.lower(F.translate(text, "Kİ", "éé"))
    split = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("key"),
        F.split(text, SEPARATORS).alias("w"),
    )
    edge = lambda i: (F.element_at("w", i) == "").cast("int")
    split = split.select(
        "id", "key", edge(1).alias("skip"),
        F.greatest(F.size("w") - edge(1) - edge(-1), F.lit(0)).alias("n_words"),
        "w",
    )
    n = F.size("w")
    # Runs past the end hold a null and match nothing.
    runs = split.select(
        "id", "key", "skip", "n_words",
        F.posexplode(
            F.arrays_zip(
                F.col("w").alias("a0"),
                *(F.slice("w", F.lit(i + 1), F.greatest(n, F.lit(1))).alias(f"a{i}") for i in range(1, K)),
            )
        ).alias("pos", "run"),
    )
    runs = runs.select(
        "id", "key", "n_words", "pos", (F.col("pos") - F.col("skip")).alias("word"),
        *(F.col(f"run.a{i}").alias(f"a{i}") for i in range(K)),
    ).withColumn("gram", F.xxhash64(*(f"a{i}" for i in range(K))))
    index = F.broadcast(_index(docs.sparkSession, phrases, notices))
    same = F.lit(True)
    for i in range(K):
        same = same & (F.col(f"a{i}") == F.col(f"t{i}"))
    # The first run of each text stays without a hit as well, to carry its row.
    hits = runs.join(index.withColumnRenamed("gram", "g"), (F.col("gram") == F.col("g")) & same, "left")
    hits = hits.where(F.col("template").isNotNull() | (F.col("pos") == 0))
    by_diagonal = hits.groupBy(
        "id", "key", "template", (F.col("word") - F.col("at")).alias("diagonal")
    ).agg(
        F.max("n_words").alias("n_words"),
        F.sum(((F.col("pos") == 0) & (F.coalesce("nth", F.lit(0)) == 0)).cast("int")).alias("rows"),
        F.collect_set("at").alias("at"),
        F.min("word").alias("low"),
        F.max("word").alias("high"),
        F.first("grams", True).alias("grams"),
        F.first("label", True).alias("label"),
        F.first("base", True).alias("base"),
    )
    order = Window.partitionBy("id", "key", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > shift, F.lit(True))
    # A phrase must stand on one diagonal.
    fresh = fresh | F.coalesce("base", F.lit(False))
    merged = (
        by_diagonal.withColumn("fresh", fresh.cast("int"))
        .withColumn("run", F.sum("fresh").over(order))
        .groupBy("id", "key", "template", "run")
        .agg(
            F.max("n_words").alias("n_words"),
            F.sum("rows").alias("rows"),
            F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("votes"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.min("diagonal").alias("start"),
            *(F.first(c, True).alias(c) for c in ("grams", "label", "base")),
        )
        .withColumn("part", F.col("votes") / F.col("grams"))
        .withColumn(
            "holds",
            F.when(F.col("base"), F.col("votes") == F.col("grams")).otherwise(
                (F.col("part") >= share)
                & (F.col("high") - F.col("low") < 2 * (F.col("grams") + shift))
            ),
        )
    )
    # Of notices that fit the same place, the best fitting ones count.
    along = Window.partitionBy("id", "key").orderBy("low", "high", "template")
    reach = F.max(F.when(F.col("holds"), F.col("high"))).over(
        along.rowsBetween(Window.unboundedPreceding, -1)
    )
    merged = (
        merged.withColumn("apart", F.coalesce(F.col("low") > reach, F.lit(True)).cast("int"))
        .withColumn("place", F.sum("apart").over(along))
        .withColumn(
            "best",
            F.max(F.when(F.col("holds"), F.col("part"))).over(
                Window.partitionBy("id", "key", "place")
            ),
        )
        .withColumn("holds", F.col("holds") & (F.col("base") | (F.col("part") == F.col("best"))))
    )
    base = F.col("base") & F.col("holds")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (
        merged.groupBy("id", "key")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.sum("rows").cast("int").alias("rows"),
            F.coalesce(F.count_if(base), F.lit(0)).cast("long").alias("n_base"),
            F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
            joined(F.when(base, F.col("label"))).alias("base_labels"),
            joined(F.when(F.col("holds"), F.col("label"))).alias("labels"),
            F.coalesce(
                F.max(F.when(F.col("holds") | ~F.col("base"), F.col("part"))), F.lit(0.0)
            ).alias("score"),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
        .select(
            F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
            "base_labels", "labels", "score",
        )
    )
