"""Text expressions against Python's own regular expressions on hand-made rows."""

import html
import random
import re
import time

import pytest

from pyspark.sql import functions as F

from sparkwright.functions import text as T
from sparkwright.functions.stopwords import default_stop_words

TEXTS = [
    "Mail me: ann.b@host.org or <joe@x.co>: see https://www.a-b.com/p?q=1&r=2 and http://t.io/x #tag #two_2",
    "Été Naïve ÉTÉ été GROß 12 ٣ don't stop-now wide　space",
    "URL:mailto:bob@x.org @user.name @a-b",
    "",
    "   ",
    "<p>Hello &amp; bye</p> <a href='x'>link</a> MIXed lower UPPER 99",
    "x" * 45 + " words that " + "y" * 39 + " abcd ABCD abc",
]


@pytest.fixture(scope="module")
def measured(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, text string")
    cols = [f("text").alias(n) for n, f in T.TEXT_MEASURES.items()]
    return {r["id"]: r for r in df.select("id", *cols).collect()}


def test_counts_match_python(measured):
    mail = re.compile(r"[<\[(]?[\w][\w.-]+@[\w.]+[>\])]?[:=]?[0-9]{0,}")
    for i, t in enumerate(TEXTS):
        bare = t.replace("URL:", "").replace("mailto:", "")
        words = t.split()
        want = {
            "character_counts": len(t),
            "word_counts": len(words),
            "unique_word_counts": len(set(words)),
            "punctuation_mark_counts": len(re.findall(r"[^\w\s]", t)),
            "uppercase_word_counts": sum(w.isupper() for w in words),
            "lowercase_word_counts": sum(w.islower() for w in words),
            "digit_counts": len(re.findall(r"\d", t)),
            "alphabetic_char_counts": len(re.findall(r"[a-zA-Z]", t)),
            "html_tag_counts": len(re.findall(r"<[^>]+>", bare)),
            "email_counts": len(mail.findall(bare)),
            "twitter_username_counts": len(re.findall(r"@[\w.-]+", bare)),
            "hashtag_counts": len(re.findall(r"#[\w]+", bare)),
        }
        for name, n in want.items():
            assert measured[i][name] == n, (i, name)


def test_urls(measured):
    assert [measured[i]["url_counts"] for i in range(len(TEXTS))] == [2, 0, 0, 0, 0, 0, 0]


def _clean(spark, *texts, stop=None):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in df.select(T.clean_text("text", stop)).collect()]


def test_clean_text(spark):
    got = _clean(
        spark,
        "Visit https://www.shop.com/x now, John@mail.com! #sale @me Great-Offer",
        "keep four only abc " + "z" * 39 + " " + "z" * 40,
        "they there would kept",
        stop=["there"],
    )
    assert got == ["visit great offer", "keep four only " + "z" * 39, "they would kept"]


def test_default_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(default_stop_words()) == StopWordsRemover.loadDefaultStopWords("english")


def test_markup_and_references(spark):
    rows = [
        "<html><head><style>p{margin}</style><script>var t='</p>';</script></head>"
        "<!-- hidden words --><body>seen <b>bold</b>words</body></html>",
        "fish &amp; chips &lt;tag&gt; &#65;&#66;c &#233; &copy; &amp;lt; &#x41; &#12345678901;",
        "tail <script>never closed words",
    ]
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    got = [r[0] for r in df.select(T.strip_markup("text")).collect()]
    assert got[0] == "seen boldwords"
    assert got[1].startswith("fish & chips <tag> ABc ")
    assert "&lt;" in got[1] and "&#x41;" in got[1] and "\u0000" not in got[1]
    assert got[2] == "tail "
    assert html.unescape("&#65;") == "A"


def test_whole_texts_are_measured(spark):
    long = "word " * 30000
    df = spark.createDataFrame([(long,)], "text string")
    r = df.select(T.word_count("text"), T.char_count(T.truncate_text("text"))).first()
    assert tuple(r) == (30000, 25000)


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "text string")
    r = df.select(T.clean_text("text").alias("c"), T.email_count("text").alias("m")).first()
    assert r["c"] in (None, "") and r["m"] in (None, 0)


def _counts(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select("i", expr.alias("x")).orderBy("i").select("x").collect()]


def test_fast_patterns_equal_the_plain_ones(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice("ab1.-@<>[( ]:=é\n/!s") for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += ["a.b@c.d-e@f", ".-a@b", "<.ab@c>:12", "a@b", "ab@@cd", "", "<>", "<a", "<!-- x <b> y"]
    plain = F.regexp_replace("t", T.MAIL, "[MAIL]")
    fast = F.regexp_replace("t", T.MAIL_RUN, "$1[MAIL]")
    assert _counts(spark, texts, fast) == _counts(spark, texts, plain)
    count = F.regexp_count("t", F.lit(T.MAIL))
    assert _counts(spark, texts, F.regexp_count("t", F.lit(T.MAIL_RUN))) == _counts(spark, texts, count)
    tags = F.regexp_count("t", F.lit(T.TAG)).cast("bigint")
    assert _counts(spark, texts, T.tag_count("t")) == _counts(spark, texts, tags)
    markup = F.regexp_replace("t", T.MARKUP, "")
    assert _counts(spark, texts, T._drop_markup(F.col("t"))) == _counts(spark, texts, markup)


def test_long_texts_take_linear_time(spark):
    bad = ["a" * 1_000_000 + " x@", "<" * 1_000_000, "<!--" * 250_000, "</script" * 120_000, "<a " * 300_000,
           "<script>" * 100_000, "a@" * 400_000]
    df = spark.createDataFrame([(t,) for t in bad], "t string").coalesce(1)
    started = time.time()
    df.select(T.redact_pii("t"), T.tag_count("t"), T.email_count("t"), T.strip_markup("t")).write.format(
        "noop"
    ).mode("overwrite").save()
    assert time.time() - started < 40


def test_accents_of_all_scripts(spark):
    assert _counts(spark, ["Čapek ő ş Việt é ø ß", None], T.strip_accents("t")) == [
        "Capek o s Viet e ø ß", None
    ]


def test_open_comment_after_last_tag_reaches_the_end(spark):
    from pyspark.sql import functions as F

    from sparkwright.functions import text as T

    rows = spark.createDataFrame([("x <!-- y secret words",), ("a <b>c</b> <!-- open hidden",), ("p <i>q</i> r < s",)], "t string")
    got = [r[0] for r in rows.select(T.strip_markup("t")).collect()]
    assert "secret" not in got[0] and "hidden" not in got[1]
    assert got[0].startswith("x") and "c" in got[1] and got[2].endswith("r < s")


def test_every_document_gets_a_vector(spark):
    from sparkwright.operators import vocabulary as V

    weights = spark.createDataFrame([(1, "a", 2.0), (2, "zz", 1.0)], "doc_id long, term string, w double")
    vocab = spark.createDataFrame([("a", 0)], "term string, idx int")
    keys = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    got = {r.doc_id: r.features for r in V.to_sparse_vector(weights, "doc_id", vocab, 4, keys=keys).collect()}
    assert set(got) == {1, 2, 3} and got[2].numNonzeros() == 0 and got[1][0] == 2.0
