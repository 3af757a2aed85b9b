"""Cleaning leaves out steps whose mark a text does not hold, with the same words."""

from pyspark.sql import functions as F

from sparkwright.functions import text as T


def test_a_step_is_left_out_where_its_mark_is_missing(spark):
    df = spark.createDataFrame([("plain",), (None,)], "t string")
    kept = T._where_found(F.col("t"), ["<", "&"], lambda x: F.raise_error(F.lit("not left out")).cast("string"))
    assert [r[0] for r in df.select(kept).collect()] == ["plain", None]
    done = T._where_found(F.col("t"), ["n"], F.upper)
    assert [r[0] for r in df.select(done).collect()] == ["PLAIN", None]


def test_clean_tokens_keep_their_words(spark):
    plain = F.regexp_replace(F.lower("t"), T.SPECIAL, " ")
    plain = F.regexp_extract_all(F.regexp_replace(plain, T.NON_LETTER, ""), F.lit(T.KEPT_WORD), F.lit(0))
    odd = ["don't-stop (this_one) cafés İstan", "x" * 39 + " " + "y" * 40 + " abc abcd", "a.b/cdef=ghij\u0085klmn opqr", ""]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    for r in df.select(plain.alias("a"), T.clean_tokens("t", []).alias("b")).collect():
        assert r["a"] == r["b"]
