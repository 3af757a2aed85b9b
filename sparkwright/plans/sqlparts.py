"""SQL fragments shared by the twins."""

from __future__ import annotations

from sparkwright.functions import text as T
from sparkwright.functions.stopwords import default_stop_words


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def gone(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, 'g')"


def links_gone(x: str) -> str:
    return f"replace(replace({x}, 'URL:', ''), 'mailto:', '')"


def hits(x: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {q(pattern)})) AS BIGINT)"


def hash32(key: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT"


def split_words(x: str) -> str:
    return f"regexp_extract_all({x}, {q(T.NON_SPACE)})"


def visible(x: str) -> str:
    t = gone(x, T.MARKUP)
    for name, char in T.ENTITIES.items():
        if name == "&amp;":
            t = f"replace({t}, '&amp;', chr(57344))"
            t = gone(t, T.NAMED_ENTITY)
            t = f"replace({t}, chr(57344), '&')"
        else:
            t = f"replace({t}, {q(name)}, {q(char)})"
    return t


def letters_only(x: str) -> str:
    t = visible(links_gone(x))
    for p in (T.MAIL, T.URL, T.MENTION, T.HASHTAG):
        t = gone(t, p)
    t = gone(f"lower({t})", T.SPECIAL, " ")
    return gone(t, T.NON_LETTER)


def clean_tokens(x: str) -> str:
    stop = ", ".join(q(w) for w in default_stop_words())
    return (
        f"list_filter(regexp_extract_all({letters_only(x)}, {q(T.KEPT_WORD)}), "
        f"lambda w: w NOT IN ({stop}))"
    )


# Labelled documents with cleaned tokens, and one row per token.
LABELLED = f"""
    clean AS (SELECT d.doc_id, l.toxic AS label, {clean_tokens('d.text')} AS toks
              FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
    tok AS (SELECT doc_id, label, unnest(toks) AS word FROM clean)
"""

# All documents with cleaned tokens.
CLEAN_ALL = f"""
    clean AS (SELECT doc_id, {clean_tokens('text')} AS toks FROM documents)
"""


def terms(source: str = "clean", bigrams: bool = True, keep: str = "doc_id") -> str:
    """CTE ``term``: one row per term occurrence, unigrams and bigrams."""
    two = (
        "list_concat(toks, list_transform(range(1, len(toks)), "
        "lambda i: toks[i] || ' ' || toks[i + 1]))"
    )
    return f"term AS (SELECT {keep}, unnest({two if bigrams else 'toks'}) AS term FROM {source})"


# TF-IDF over labelled documents, fitted on the training rows (hash split, 20 % test).
TFIDF = f"""
    {LABELLED},
    docs AS (SELECT *, CAST({hash32('doc_id')} < 858993459 AS INTEGER) AS is_test FROM clean),
    {terms('docs', keep='doc_id, label, is_test')},
    tf AS (SELECT doc_id, label, is_test, term, count(*) AS tf FROM term GROUP BY ALL),
    n AS (SELECT count(*) AS n FROM docs WHERE is_test = 0),
    df AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf WHERE is_test = 0 GROUP BY term),
    vocab AS (SELECT term, df, ln((1 + n.n)::DOUBLE / (1 + df)) + 1 AS idf FROM df, n
              WHERE df >= 2 AND df <= 0.98 * n.n
              ORDER BY total DESC, term LIMIT 20000),
    raw AS (SELECT doc_id, label, is_test, tf.term, (1 + ln(tf.tf)) * idf AS w
            FROM tf JOIN vocab ON tf.term = vocab.term),
    tfidf AS (SELECT doc_id, label, is_test, term,
                     w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM raw)
"""


def nb(alpha: float = 0.1) -> str:
    """Naive Bayes term log probabilities and class priors on the training rows."""
    return f"""
    {TFIDF},
    cls AS (SELECT label, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) AS prior
            FROM docs WHERE is_test = 0 GROUP BY label),
    tc AS (SELECT v.term, c.label, coalesce(sum(t.w), 0) AS n_ci
           FROM vocab v CROSS JOIN cls c
           LEFT JOIN tfidf t ON t.term = v.term AND t.label = c.label AND t.is_test = 0
           GROUP BY v.term, c.label),
    logp AS (SELECT term, label, ln((n_ci + {alpha}) / (sum(n_ci) OVER (PARTITION BY label)
                    + {alpha} * count(*) OVER (PARTITION BY label))) AS logp FROM tc),
    coef AS (SELECT term, max(CASE WHEN label = 1 THEN logp END)
                    - max(CASE WHEN label = 0 THEN logp END) AS coef FROM logp GROUP BY term)
"""


def nb_scored(alpha: float = 0.1) -> str:
    """Adds ``scored``: probability and class of every document."""
    return f"""
    {nb(alpha)},
    sc AS (SELECT d.doc_id, d.label AS y, d.is_test, c.label,
                  c.prior + coalesce(sum(t.w * p.logp), 0) AS s
           FROM docs d CROSS JOIN cls c
           LEFT JOIN tfidf t ON t.doc_id = d.doc_id
           LEFT JOIN logp p ON p.term = t.term AND p.label = c.label
           GROUP BY d.doc_id, d.label, d.is_test, c.label, c.prior),
    scored AS (SELECT doc_id, y AS label, is_test,
                      1 / (1 + exp(max(CASE WHEN label = 0 THEN s END)
                                   - max(CASE WHEN label = 1 THEN s END))) AS p1
               FROM sc GROUP BY doc_id, y, is_test)
"""


# A score every labelled document carries without a model: longer texts score higher.
SCORES = """
    scores AS (SELECT d.doc_id, l.toxic AS label,
                      floor(d.n_chars / (d.n_chars + 1500.0::DOUBLE) * 1000) / 1000 AS p
               FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
"""
