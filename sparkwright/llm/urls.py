"""URL verdicts from a rule list, and from association rules over URL tokens.

FP-growth mines which combinations of host labels and path words go with which label.
Rules below a support or a confidence are pruned; the rest are matched by an inverted
index from token to rules: a rule fires where all its tokens are found. Addresses with the
same tokens are matched once. DataFrame functions and Spark's own FP-growth only.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """From the first ``://`` to the next slash, question mark or hash, A-Z in lower case;
    empty without a ``://`` and for null."""
    return F.coalesce(
        F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit("")
    )


def path(url: Column) -> Column:
    """From the end of the host to the next question mark or hash; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(rules: dict[str, str], h: Column, p: Column) -> Column:
    """The longest rule that fits: its host is the address's or a parent of it, and the
    address's path starts with its path; null if none does. Ties by the rule itself."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        at = (h == name) | F.endswith(h, F.lit("." + name))
        out = F.when(at & F.startswith(p, F.lit("/" + rest)), F.lit(rule)).otherwise(out)
    return out


def tokens(h: Column, p: Column) -> Column:
    """Distinct host labels (``h:``) and path words (``p:``); numbers are one word."""
    words = lambda c, cut, mark: F.transform(
        F.filter(F.split(c, cut), lambda w: w != ""),
        lambda w: F.concat(F.lit(mark), F.when(w.rlike("^[0-9]+$"), F.lit("#")).otherwise(w)),
    )
    return F.array_sort(
        F.array_distinct(
            F.concat(words(h, r"\.", "h:"), words(F.lower(p), r"[^\p{L}\p{N}]+", "p:"))
        )
    )


def mine(
    labelled: DataFrame, tokens_col: str = "tokens", label_col: str = "label",
    min_support: float = 0.01, min_confidence: float = 0.9,
) -> DataFrame | None:
    """(tokens, verdict, confidence, support): rules from token sets to a label, above
    both bounds. Rows without a label are left out; None if none is left."""
    rows = labelled.where(F.col(label_col).isNotNull()).select(
        F.array_append(F.col(tokens_col), F.concat(F.lit("label="), label_col)).alias("items")
    )
    if rows.isEmpty():
        return None
    found = FPGrowth(
        itemsCol="items", minSupport=min_support, minConfidence=min_confidence
    ).fit(rows).associationRules
    said = F.element_at("consequent", 1)
    return found.where(
        F.startswith(said, F.lit("label="))
        & ~F.exists("antecedent", lambda t: F.startswith(t, F.lit("label=")))
    ).select(
        F.col("antecedent").alias("tokens"),
        F.substring(said, F.lit(7), F.length(said)).alias("verdict"),
        "confidence",
        "support",
    )


def match(rules: DataFrame, sets: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """(tokens, mined, mined_rule) for the token sets in which a rule fires: the verdict of
    the most confident one, then the best supported, the longer, the smaller tokens."""
    rules = rules.withColumn("rule", F.xxhash64("tokens", "verdict"))
    index = rules.select("rule", F.explode("tokens").alias("token"))
    fired = (
        sets.select(tokens_col)
        .distinct()
        .withColumn("token", F.explode(tokens_col))
        .join(index, "token")
        .groupBy(tokens_col, "rule")
        .agg(F.count("*").alias("hits"))
        .join(
            rules.select(
                "rule", "verdict", "confidence", "support", F.col("tokens").alias("of"),
                F.size("tokens").alias("width"),
            ),
            "rule",
        )
        .where("hits = width")
    )
    order = F.struct("confidence", "support", "width", "of")
    return fired.groupBy(tokens_col).agg(
        F.max_by("verdict", order).alias("mined"), F.max_by("of", order).alias("mined_rule")
    )


def verdicts(
    pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url",
    default: str = "allow", min_support: float = 0.01, min_confidence: float = 0.9,
) -> DataFrame:
    """(id, host, path, rule, verdict, mined_rule) for every row.

    ``rules`` maps a host/path rule to its verdict. Addresses that a listed rule decides
    are the labelled ones: association rules are mined from them and judge the others;
    where none fires the verdict is ``default``. Null addresses have an empty host and
    path and no tokens. Equal addresses are judged alike; an empty table gives no rows;
    other columns are not looked at.
    """
    rows = pages.select(
        F.col(id_col), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path")
    )
    said = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        said = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(said)
    rows = (
        rows.withColumn("rule", listed_rule(rules, F.col("host"), F.col("path")))
        .withColumn("said", said)
        .withColumn("tokens", tokens(F.col("host"), F.col("path")))
    )
    mined = mine(rows, "tokens", "said", min_support, min_confidence)
    if mined is None:
        found = rows.withColumn("mined", F.lit(None).cast("string")).withColumn(
            "mined_rule", F.lit(None).cast("array<string>")
        )
    else:
        mined = materialize(mined, "url-rules")
        judged = match(mined, rows.where(F.col("said").isNull()))
        found = rows.join(materialize(judged, "url-verdicts"), "tokens", "left")
    return found.select(
        id_col, "host", "path", "rule",
        F.coalesce("said", "mined", F.lit(default)).alias("verdict"),
        F.when(F.col("said").isNull(), F.array_join("mined_rule", " ")).alias("mined_rule"),
    )
