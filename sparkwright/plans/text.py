"""Text measures and rewrites over whole texts of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import text as T
from sparkwright.operators import audit as A
from sparkwright.operators import ranking as R
from sparkwright.plans import sqlparts as Q
from sparkwright.plans.registry import query
from sparkwright.plans.shaping import labelled_docs
from sparkwright.session import load, load_texts, materialize

LINKS = Q.links_gone("text")
CASED = "list_filter({w}, lambda w: w = {f}(w) AND w <> {g}(w))"
MEASURE_SQL = {
    "email_counts": Q.hits(LINKS, T.MAIL),
    "html_tag_counts": Q.hits(LINKS, T.TAG),
    "url_counts": Q.hits(LINKS, T.URL),
    "twitter_username_counts": Q.hits(LINKS, T.MENTION),
    "hashtag_counts": Q.hits(LINKS, T.HASHTAG),
    "character_counts": "CAST(length(text) AS BIGINT)",
    "word_counts": Q.hits("text", T.NON_SPACE),
    "unique_word_counts": f"CAST(len(list_distinct({Q.split_words('text')})) AS BIGINT)",
    "punctuation_mark_counts": Q.hits("text", T.PUNCT),
    "uppercase_word_counts": "CAST(len("
    + CASED.format(w=Q.split_words("text"), f="upper", g="lower")
    + ") AS BIGINT)",
    "lowercase_word_counts": "CAST(len("
    + CASED.format(w=Q.split_words("text"), f="lower", g="upper")
    + ") AS BIGINT)",
    "digit_counts": Q.hits("text", T.DIGIT),
    "alphabetic_char_counts": Q.hits("text", T.ALPHA),
}

# query name -> (measure column, table, key, text column)
COUNT_QUERIES = {
    "char_count": ("character_counts", "documents", "doc_id", "text"),
    "word_count": ("word_counts", "documents", "doc_id", "text"),
    "unique_word_count": ("unique_word_counts", "documents", "doc_id", "text"),
    "punct_count": ("punctuation_mark_counts", "documents", "doc_id", "text"),
    "upper_word_count": ("uppercase_word_counts", "documents", "doc_id", "text"),
    "lower_word_count": ("lowercase_word_counts", "documents", "doc_id", "text"),
    "digit_count": ("digit_counts", "documents", "doc_id", "text"),
    "alpha_count": ("alphabetic_char_counts", "documents", "doc_id", "text"),
    "tag_count": ("html_tag_counts", "pages", "page_id", "html"),
    "email_count": ("email_counts", "documents", "doc_id", "text"),
    "url_count": ("url_counts", "pages", "page_id", "url"),
    "mention_count": ("twitter_username_counts", "documents", "doc_id", "text"),
    "hashtag_count": ("hashtag_counts", "pages", "page_id", "url"),
}


def _count_query(name, measure, table, key, column):
    sql = (
        f"SELECT {key}, {MEASURE_SQL[measure]} AS {measure} "
        f"FROM (SELECT {key}, {column} AS text FROM {table})"
    )

    @query(name, sql)
    def run(spark, d):
        return load(spark, d, table).select(key, T.TEXT_MEASURES[measure](column).alias(measure))


for _name, _spec in COUNT_QUERIES.items():
    _count_query(_name, *_spec)


@query(
    "collapse_space",
    f"SELECT doc_id, md5(trim({Q.gone('text', T.SPACES, ' ')})) AS text_md5 FROM documents",
)
def collapse_space(spark, d):
    return load(spark, d, "documents").select(
        "doc_id", F.md5(T.collapse_space("text").cast("binary")).alias("text_md5")
    )


@query(
    "truncate_text",
    """
    SELECT doc_id, length(substr(text, 1, 25000)) AS n, md5(substr(text, 1, 25000)) AS text_md5
    FROM documents
    """,
)
def truncate_text(spark, d):
    cut = T.truncate_text("text")
    return load(spark, d, "documents").select(
        "doc_id", T.char_count(cut).alias("n"), F.md5(cut.cast("binary")).alias("text_md5")
    )


def text_features(docs):
    """Label and the 13 counts, one projection."""
    return docs.select(
        "doc_id", "label", *[f("text").alias(name) for name, f in T.TEXT_MEASURES.items()]
    )


FEATURES_SQL = (
    "SELECT doc_id, label, "
    + ", ".join(f"{sql} AS {name}" for name, sql in MEASURE_SQL.items())
    + " FROM (SELECT d.doc_id, d.text, l.toxic AS label FROM documents d "
    "JOIN labels l ON d.doc_id = l.doc_id)"
)


@query("text_features", FEATURES_SQL)
def text_features_query(spark, d):
    return text_features(labelled_docs(spark, d))


@query(
    "features_log_hist",
    f"""
    WITH f AS ({FEATURES_SQL}),
    u AS (UNPIVOT f ON {', '.join(MEASURE_SQL)} INTO NAME feature VALUE v),
    r AS (SELECT feature, label, ln(1 + v) AS x FROM u),
    s AS (SELECT feature, label, min(x) AS lo, max(x) AS hi, count(*) AS n_all FROM r
          GROUP BY feature, label),
    b AS (SELECT r.feature, r.label, s.lo, s.n_all, (s.hi - s.lo) / 20 AS width,
                 CAST(CASE WHEN s.hi = s.lo THEN 0
                      ELSE least(floor((r.x - s.lo) / ((s.hi - s.lo) / 20)), 19)
                      END AS INTEGER) AS bin
          FROM r JOIN s ON r.feature = s.feature AND r.label = s.label)
    SELECT feature, label, bin, round(lo + bin * width, 6) AS left_edge, count(*) AS n,
           CASE WHEN width > 0 THEN round(count(*) / (n_all * width), 6) END AS density
    FROM b GROUP BY feature, label, bin, lo, width, n_all
    """,
)
def features_log_hist(spark, d):
    feats = materialize(text_features(labelled_docs(spark, d)), "features")  # read twice
    long = feats.unpivot(["label"], list(T.TEXT_MEASURES), "feature", "value")
    out = A.histogram(long, F.log(F.col("value") + 1), 20, group=["feature", "label"])
    return out.withColumns(
        {"left_edge": F.round("left_edge", 6), "density": F.round("density", 6)}
    )


@query(
    "clean_text",
    f"""
    SELECT 'document' AS kind, doc_id AS id,
           md5(array_to_string({Q.clean_tokens('text')}, ' ')) AS text_md5 FROM documents
    UNION ALL
    SELECT 'page', page_id, md5(array_to_string({Q.clean_tokens('html')}, ' ')) FROM pages
    """,
)
def clean_text(spark, d):
    def cleaned(table, key, column, kind):
        return load_texts(spark, d, table, key).select(
            F.lit(kind).alias("kind"),
            F.col(key).alias("id"),
            F.md5(T.clean_text(column).cast("binary")).alias("text_md5"),
        )

    return cleaned("documents", "doc_id", "text", "document").unionByName(
        cleaned("pages", "page_id", "html", "page")
    )


@query(
    "clean_corpus",
    f"""
    WITH c AS (SELECT doc_id, array_to_string({Q.clean_tokens('text')}, ' ') AS text_cleaned
               FROM documents)
    SELECT doc_id, md5(text_cleaned) AS text_md5 FROM c WHERE text_cleaned <> ''
    QUALIFY row_number() OVER (PARTITION BY text_cleaned ORDER BY doc_id) = 1
    """,
)
def clean_corpus(spark, d):
    docs = load_texts(spark, d, "documents", "doc_id").select("doc_id", T.clean_text("text").alias("text_cleaned"))
    # The rewrite is the dear part: write it once instead of once per use below.
    docs = materialize(docs, "cleaned")
    kept = R.dedupe_keep_first(docs.where(F.col("text_cleaned") != ""), "text_cleaned", "doc_id")
    return kept.select("doc_id", F.md5(F.col("text_cleaned").cast("binary")).alias("text_md5"))


@query("strip_accents", "SELECT doc_id, md5(strip_accents(text)) AS text_md5 FROM documents")
def strip_accents(spark, d):
    return load(spark, d, "documents").select(
        "doc_id", F.md5(T.strip_accents("text").cast("binary")).alias("text_md5")
    )


def _token_query(name, fn, sql):
    @query(
        name,
        f"""
        SELECT doc_id, CAST(len(t) AS BIGINT) AS n, md5(array_to_string(t, ' ')) AS tokens_md5
        FROM (SELECT doc_id, {sql} AS t FROM documents)
        """,
    )
    def run(spark, d):
        toks = load(spark, d, "documents").select("doc_id", fn("text").alias("t"))
        return toks.select(
            "doc_id",
            F.size("t").cast("bigint").alias("n"),
            F.md5(F.array_join("t", " ").cast("binary")).alias("tokens_md5"),
        )


_token_query("word_tokens", T.word_tokens, f"regexp_extract_all(lower(text), {Q.q(T.WORDS)})")
_token_query("punct_tokens", T.punct_tokens, f"regexp_extract_all(text, {Q.q(T.WORD_OR_PUNCT)})")


@query(
    "redact_pii",
    f"""
    SELECT doc_id, md5({Q.gone(Q.gone('text', T.MAIL, '[MAIL]'), T.DIGITS_7, '[NUMBER]')})
           AS text_md5 FROM documents
    """,
)
def redact_pii(spark, d):
    return load(spark, d, "documents").select(
        "doc_id", F.md5(T.redact_pii("text").cast("binary")).alias("text_md5")
    )
