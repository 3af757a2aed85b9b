"""Projections, filters and reshaping over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import shape as S
from sparkwright.plans.registry import query
from sparkwright.session import load, load_texts, load_texts_by_key


def labelled_docs(spark, d, label="toxic", by_key=False):
    """documents JOIN labels with one label column; ``by_key``: dealt by document."""
    read = load_texts_by_key if by_key else load_texts
    docs = read(spark, d, "documents", "doc_id").select("doc_id", "text", "lang", "n_chars")
    labels = load(spark, d, "labels").select("doc_id", F.col(label).alias("label"))
    return docs.join(labels, "doc_id")


@query(
    "rename_columns",
    "SELECT p_partkey, p_brand AS brand, p_retailprice AS price FROM part",
)
def rename_columns(spark, d):
    part = load(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice")
    return S.rename_columns(part, {"p_brand": "brand", "p_retailprice": "price"})


@query(
    "drop_columns",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders",
)
def drop_columns(spark, d):
    return S.drop_columns(load(spark, d, "orders"), ["o_totalprice", "o_orderdate"])


@query(
    "binary_label",
    "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders",
)
def binary_label(spark, d):
    orders = load(spark, d, "orders")
    return S.binary_label(orders, F.col("o_orderstatus") == "F").select("o_orderkey", "label")


@query(
    "yes_no_encode",
    """
    SELECT l_orderkey, l_linenumber,
           CAST(coalesce(l_returnflag = 'A', false) AS INTEGER) AS l_returnflag,
           CAST(coalesce(l_linestatus = 'A', false) AS INTEGER) AS l_linestatus
    FROM lineitem
    """,
)
def yes_no_encode(spark, d):
    li = load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    return S.yes_no_encode(li, exclude=["l_orderkey", "l_linenumber"], yes="A")


@query("select_by_dtype", "SELECT p_partkey, p_size, p_retailprice FROM part")
def select_by_dtype(spark, d):
    return S.select_by_dtype(load(spark, d, "part"))


@query(
    "class_subset",
    """
    SELECT d.doc_id, d.n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.toxic = 1
    """,
)
def class_subset(spark, d):
    return S.class_subset(labelled_docs(spark, d), "label", 1).select("doc_id", "n_chars")


@query(
    "drop_blank_rows",
    """
    WITH t AS (SELECT doc_id, regexp_replace(text, '[^0-9]', '', 'g') AS digits FROM documents)
    SELECT doc_id, digits FROM t WHERE digits NOT IN ('', ' ')
    """,
)
def drop_blank_rows(spark, d):
    digits = load(spark, d, "documents").select(
        "doc_id", F.regexp_replace("text", "[^0-9]", "").alias("digits")
    )
    return S.drop_blank_rows(digits, "digits")


GUARD_FEATURES = ["l_quantity", "l_discount", "l_tax"]
GUARD_TARGETS = [*GUARD_FEATURES, "l_extendedprice"]


def _guarded(target: str) -> bool:
    try:
        S.leak_guard(GUARD_FEATURES, target)
    except ValueError:
        return True
    return False


@query(
    "leak_guard",
    " UNION ALL ".join(
        f"SELECT '{c}' AS target, {'false' if c == 'l_extendedprice' else 'true'} AS raises, "
        f"count({c}) AS n FROM lineitem"
        for c in GUARD_TARGETS
    ),
)
def leak_guard(spark, d):
    """Whether the guard stops each column as a target, and how many values it has."""
    counts = load(spark, d, "lineitem").agg(*(F.count(c).alias(c) for c in GUARD_TARGETS))
    rows = [
        F.struct(F.lit(c).alias("target"), F.lit(_guarded(c)).alias("raises"), F.col(c).alias("n"))
        for c in GUARD_TARGETS
    ]
    return counts.select(F.inline(F.array(*rows)))


@query(
    "attach_features",
    """
    SELECT l.doc_id, l.toxic AS label, d.n_chars FROM labels l JOIN documents d
    ON l.doc_id = d.doc_id
    """,
)
def attach_features(spark, d):
    labels = load(spark, d, "labels").select("doc_id", F.col("toxic").alias("label"))
    return S.attach_features(labels, load(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")


@query(
    "transpose_metrics",
    """
    WITH m AS (SELECT l_returnflag, avg(l_quantity) AS mean_qty, max(l_quantity) AS max_qty,
                      CAST(count(*) AS DOUBLE) AS n
               FROM lineitem GROUP BY l_returnflag),
    u AS (SELECT l_returnflag, 'mean_qty' AS metric, mean_qty AS value FROM m UNION ALL
          SELECT l_returnflag, 'max_qty', max_qty FROM m UNION ALL
          SELECT l_returnflag, 'n', n FROM m)
    SELECT metric, max(CASE WHEN l_returnflag = 'A' THEN value END) AS "A",
           max(CASE WHEN l_returnflag = 'N' THEN value END) AS "N",
           max(CASE WHEN l_returnflag = 'R' THEN value END) AS "R"
    FROM u GROUP BY metric
    """,
)
def transpose_metrics(spark, d):
    by_flag = (
        load(spark, d, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.avg("l_quantity").alias("mean_qty"),
            F.max("l_quantity").alias("max_qty"),
            F.count("*").alias("n"),
        )
    )
    return S.transpose_metrics(by_flag, "l_returnflag", ["mean_qty", "max_qty", "n"], ["A", "N", "R"])


@query(
    "residuals",
    """
    WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b,
                      regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
    SELECT l_orderkey, l_linenumber,
           round(l_extendedprice - (f.a + f.b * l_quantity), 4) AS residual
    FROM lineitem, f
    """,
)
def residuals(spark, d):
    from sparkwright.operators.baselines import slr_fit, slr_predict

    li = load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    fit = slr_fit(li, "l_quantity", "l_extendedprice")
    scored = slr_predict(li, fit, "l_quantity")
    return S.residuals(scored, "l_extendedprice", "prediction").select(
        "l_orderkey", "l_linenumber", F.round("residual", 4).alias("residual")
    )
