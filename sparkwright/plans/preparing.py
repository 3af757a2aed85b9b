"""Preprocessing queries: fitted on training rows of the hash split, applied to all."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkwright.operators import baselines as B
from sparkwright.operators import preparing as E
from sparkwright.operators import splitting as P
from sparkwright.plans.registry import query
from sparkwright.plans.shaping import labelled_docs
from sparkwright.plans.splitting import LINE
from sparkwright.plans.sqlparts import hash32
from sparkwright.session import load

# Lineitem with holes (a zero discount or tax counts as missing) and the split flag.
LINES = f"""
    li AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
                  nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax,
                  CAST({LINE} < 858993459 AS INTEGER) AS is_test FROM lineitem)
"""


def lines(spark, d):
    li = load(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
        *[F.when(F.col(c) != 0, F.col(c)).alias(c) for c in ("l_discount", "l_tax")],
    )
    return P.random_split(li, ["l_orderkey", "l_linenumber"])


KEY = ["l_orderkey", "l_linenumber"]


@query(
    "impute_median",
    f"""
    WITH {LINES},
    m AS (SELECT quantile_cont(l_discount, 0.5) AS a, quantile_cont(l_tax, 0.5) AS b
          FROM li WHERE is_test = 0)
    SELECT l_orderkey, l_linenumber, coalesce(l_discount, a) AS l_discount,
           coalesce(l_tax, b) AS l_tax FROM li, m
    """,
)
def impute_median(spark, d):
    li = lines(spark, d)
    cols = ["l_discount", "l_tax"]
    fit = E.median_fit(li.where("is_test = 0"), cols)
    return E.impute(li, fit, cols).select(*KEY, *cols)


@query(
    "impute_mode",
    f"""
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '4%' THEN NULL
                      ELSE o_orderpriority END AS o_orderpriority,
                      {hash32('o_orderkey')} < 858993459 AS is_test FROM orders),
    m AS (SELECT o_orderpriority AS v FROM o WHERE NOT is_test AND o_orderpriority IS NOT NULL
          GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)
    SELECT o_orderkey, coalesce(o_orderpriority, v) AS o_orderpriority FROM o, m
    """,
)
def impute_mode(spark, d):
    prio = F.col("o_orderpriority")
    orders = load(spark, d, "orders").select(
        "o_orderkey", F.when(~prio.like("4%"), prio).alias("o_orderpriority")
    )
    orders = P.random_split(orders, "o_orderkey")
    fit = E.mode_fit(orders.where("is_test = 0"), ["o_orderpriority"])
    return E.impute(orders, fit, ["o_orderpriority"]).select("o_orderkey", "o_orderpriority")


@query(
    "standardize",
    f"""
    WITH {LINES},
    s AS (SELECT avg(l_quantity) AS ma, stddev_pop(l_quantity) AS sa,
                 avg(l_extendedprice) AS mb, stddev_pop(l_extendedprice) AS sb
          FROM li WHERE is_test = 0)
    SELECT l_orderkey, l_linenumber, round((l_quantity - ma) / sa, 7) AS l_quantity,
           round((l_extendedprice - mb) / sb, 7) AS l_extendedprice FROM li, s
    """,
)
def standardize(spark, d):
    li = lines(spark, d)
    cols = ["l_quantity", "l_extendedprice"]
    out = E.standardize(li, E.standardize_fit(li.where("is_test = 0"), cols), cols)
    return out.select(*KEY, *[F.round(c, 7).alias(c) for c in cols])


@query(
    "one_hot",
    """
    SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'A' AS INTEGER) AS "l_returnflag_A",
           CAST(l_returnflag = 'N' AS INTEGER) AS "l_returnflag_N",
           CAST(l_returnflag = 'R' AS INTEGER) AS "l_returnflag_R" FROM lineitem
    """,
)
def one_hot(spark, d):
    li = lines(spark, d)
    values = E.categories(li.where("is_test = 0"), "l_returnflag")
    hot = E.one_hot(li.select(*KEY, "l_returnflag"), "l_returnflag", values, drop=True)
    return hot


def part_rows(spark, d):
    """part with the split flag; brand, type and size explain the price."""
    return P.random_split(load(spark, d, "part"), "p_partkey")


@query(
    "column_transformer",
    f"""
    WITH p AS (SELECT *, {hash32('p_partkey')} < 858993459 AS is_test FROM part),
    s AS (SELECT avg(p_size) AS m, stddev_pop(p_size) AS sd FROM p WHERE NOT is_test)
    SELECT p_partkey, round((p_size - m) / sd, 7) AS scaled_size,
           CAST(len(cats) AS INTEGER) + 1 AS width,
           CAST(list_position(cats, p_type) AS INTEGER) AS hot
    FROM p, s, (SELECT list(DISTINCT p_type ORDER BY p_type) AS cats FROM p WHERE NOT is_test)
    """,
)
def column_transformer(spark, d):
    part = part_rows(spark, d)
    model = E.column_transformer(part.where("is_test = 0"), ["p_size"], ["p_type"])
    v = vector_to_array("features")
    return model.transform(part).select(
        "p_partkey",
        F.round(v[0], 7).alias("scaled_size"),
        F.size(v).alias("width"),
        F.array_position(F.slice(v, F.lit(2), F.size(v) - 1), 1.0).cast("int").alias("hot"),
    )


@query(
    "poly_features",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount,
           l_quantity * l_quantity AS l_quantity__x__l_quantity,
           l_quantity * l_discount AS l_quantity__x__l_discount,
           l_discount * l_discount AS l_discount__x__l_discount FROM lineitem
    """,
)
def poly_features(spark, d):
    li = load(spark, d, "lineitem").select(*KEY, "l_quantity", "l_discount")
    return E.poly_features(li, ["l_quantity", "l_discount"])


@query(
    "class_weight",
    """
    WITH x AS (SELECT d.doc_id, l.toxic AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
    c AS (SELECT label, count(*) AS n_k FROM x GROUP BY label)
    SELECT x.doc_id, x.label, round((SELECT count(*) FROM x) / ((SELECT count(*) FROM c) * n_k::DOUBLE), 8)
           AS weight FROM x JOIN c ON x.label = c.label
    """,
)
def class_weight(spark, d):
    docs = labelled_docs(spark, d).select("doc_id", "label")
    out = E.class_weight(docs, "label")
    return out.select("doc_id", "label", F.round("weight", 8).alias("weight"))


@query(
    "mean_baseline",
    f"""
    WITH {LINES}
    SELECT l_orderkey, l_linenumber, l_extendedprice,
           round((SELECT avg(l_extendedprice) FROM li WHERE is_test = 0), 4) AS prediction
    FROM li WHERE is_test = 1
    """,
)
def mean_baseline(spark, d):
    li = lines(spark, d)
    rows = li.where("is_test = 1").select(*KEY, "l_extendedprice")
    out = B.mean_baseline(li.where("is_test = 0"), rows, "l_extendedprice")
    return out.withColumn("prediction", F.round("prediction", 4))


@query(
    "prior_baseline",
    f"""
    WITH x AS (SELECT d.doc_id, l.toxic AS label, {hash32('d.doc_id')} < 858993459 AS is_test
               FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
    s AS (SELECT avg(label) AS share FROM x WHERE NOT is_test)
    SELECT doc_id, label, round(share, 8) AS probability, CAST(share > 0.5 AS INTEGER) AS prediction
    FROM x, s WHERE is_test
    """,
)
def prior_baseline(spark, d):
    docs = P.random_split(labelled_docs(spark, d).select("doc_id", "label"), "doc_id")
    out = B.prior_baseline(
        docs.where("is_test = 0"), docs.where("is_test = 1").drop("is_test"), "label"
    )
    return out.withColumn("probability", F.round("probability", 8))


@query(
    "slr_fit",
    """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem
    """,
)
def slr_fit(spark, d):
    li = load(spark, d, "lineitem")
    fit = B.slr_fit(li, "l_quantity", "l_extendedprice")
    return fit.select(F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))
