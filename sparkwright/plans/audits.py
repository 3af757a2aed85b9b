"""Audit and descriptive aggregates over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import audit as A
from sparkwright.plans.registry import query
from sparkwright.plans.shaping import labelled_docs
from sparkwright.session import load

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(cols):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q25,
        quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max
        FROM lineitem"""
        for c in cols
    )


def _round(df, cols, n=6):
    return df.withColumns({c: F.round(c, n) for c in cols})


@query("shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def shape(spark, d):
    return A.shape(load(spark, d, "lineitem"))


@query("describe_numeric", _describe_sql(NUMERIC))
def describe_numeric(spark, d):
    return _round(A.describe_numeric(load(spark, d, "lineitem"), NUMERIC), ["mean", "std"])


def _modes_sql(col):
    return f"""
    SELECT '{col}' AS "column", sum(n)::BIGINT AS "count", NULL::DOUBLE AS mean,
           NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS q25, NULL::DOUBLE AS q50,
           NULL::DOUBLE AS q75, NULL::DOUBLE AS max, count(*) AS "unique",
           first({col} ORDER BY n DESC, {col}) AS top, max(n) AS freq
    FROM (SELECT {col}, count(*) AS n FROM lineitem WHERE {col} IS NOT NULL GROUP BY {col})
    """


@query(
    "describe_all",
    f"SELECT *, NULL::BIGINT AS \"unique\", NULL::VARCHAR AS top, NULL::BIGINT AS freq "
    f"FROM ({_describe_sql(NUMERIC)}) UNION ALL {_modes_sql('l_returnflag')} "
    f"UNION ALL {_modes_sql('l_linestatus')}",
)
def describe_all(spark, d):
    out = A.describe_all(load(spark, d, "lineitem"), NUMERIC, ["l_returnflag", "l_linestatus"])
    return _round(out, ["mean", "std"])


def _audit_sql():
    cols = {
        "event_id": "num bigint",
        "ts": "ts timestamp_ntz",
        "user_id": "num bigint",
        "event_type": "str string",
        "value": "num double",
        "props": "str string",
        "error_value": "num double",
    }
    shown = {
        "num": "CAST(CAST({f}({c}) AS DECIMAL(38,6)) AS VARCHAR)",
        "str": "{f}({c})",
        "ts": "strftime({f}({c}), '%Y-%m-%d %H:%M:%S.%f')",
    }
    parts = []
    for c, kind in cols.items():
        k, dtype = kind.split()
        parts.append(
            f"""SELECT '{c}' AS "column", '{dtype}' AS dtype, count(*) - count({c}) AS missing,
            (count(*) - count({c})) * 100.0::DOUBLE / count(*) AS missing_pct,
            count(DISTINCT {c}) AS n_unique, {shown[k].format(f='min', c=c)} AS min_value,
            {shown[k].format(f='max', c=c)} AS max_value FROM e"""
        )
    return (
        "WITH e AS (SELECT *, CASE WHEN event_type = 'error' THEN value END AS error_value "
        "FROM events) SELECT * FROM (" + " UNION ALL ".join(parts) + ") "
        'ORDER BY missing_pct DESC, "column" LIMIT 30'
    )


def _events_with_holes(spark, d):
    return load(spark, d, "events").withColumn(
        "error_value", F.when(F.col("event_type") == "error", F.col("value"))
    )


@query("column_audit", _audit_sql())
def column_audit(spark, d):
    return A.column_audit(_events_with_holes(spark, d))


@query(
    "missing_counts",
    "WITH e AS (SELECT *, CASE WHEN event_type = 'error' THEN value END AS error_value "
    "FROM events) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM e"
        for c in ["event_id", "ts", "user_id", "event_type", "value", "props", "error_value"]
    ),
)
def missing_counts(spark, d):
    return A.missing_counts(_events_with_holes(spark, d))


@query(
    "duplicate_count",
    """
    SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (
      SELECT count(*) AS n FROM lineitem
      GROUP BY l_returnflag, l_linestatus, l_quantity, l_discount, l_tax)
    """,
)
def duplicate_count(spark, d):
    return A.duplicate_count(
        load(spark, d, "lineitem").select(
            "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"
        )
    )


@query(
    "value_counts",
    """
    SELECT l.toxic AS label, count(*) AS n FROM documents d JOIN labels l
    ON d.doc_id = l.doc_id GROUP BY l.toxic
    """,
)
def value_counts(spark, d):
    return A.value_counts(labelled_docs(spark, d), "label")


@query(
    "class_share",
    """
    SELECT l.toxic AS label,
           round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 3) * 100 AS share_pct
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.toxic
    """,
)
def class_share(spark, d):
    return A.class_share(labelled_docs(spark, d), "label")


@query(
    "prevalence",
    "SELECT avg(l.toxic) AS prevalence FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def prevalence(spark, d):
    return A.prevalence(labelled_docs(spark, d), "label")


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM lineitem"
        for a in NUMERIC
        for b in NUMERIC
    ),
)
def corr_matrix(spark, d):
    return _round(A.corr_matrix(load(spark, d, "lineitem"), NUMERIC), ["corr"], 8)


_HIST_SQL = """
    WITH r AS (SELECT {group} {x} AS x FROM {src}),
    s AS (SELECT {group} min(x) AS lo, max(x) AS hi, count(*) AS n_all FROM r {by}),
    b AS (SELECT {rgroup} s.lo, s.n_all, (s.hi - s.lo) / {bins} AS width,
                 CAST(CASE WHEN s.hi = s.lo THEN 0
                      ELSE least(floor((r.x - s.lo) / ((s.hi - s.lo) / {bins})), {bins} - 1)
                      END AS INTEGER) AS bin
          FROM r JOIN s ON {on})
    SELECT {group} bin, round(lo + bin * width, 6) AS left_edge, count(*) AS n,
           round(count(*) / (n_all * width), 8) AS density
    FROM b GROUP BY {group} bin, lo, width, n_all
"""


@query(
    "histogram",
    _HIST_SQL.format(
        group="", rgroup="", x="l_extendedprice", src="lineitem", by="", on="1 = 1", bins=20
    ),
)
def histogram(spark, d):
    out = A.histogram(load(spark, d, "lineitem"), F.col("l_extendedprice"))
    return out.select(
        "bin", F.round("left_edge", 6).alias("left_edge"), "n", F.round("density", 8).alias("density")
    )


@query(
    "kde_grid",
    """
    WITH s AS (SELECT count(*) AS n, stddev_samp(p_retailprice) AS sd,
                      min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part),
    g AS (SELECT i AS point, s.lo + i * (s.hi - s.lo) / 199.0::DOUBLE AS x, s.n,
                 s.sd * pow(s.n, -0.2::DOUBLE) AS bw
          FROM s, (SELECT unnest(range(0, 200))::INTEGER AS i))
    SELECT g.point, round(g.x, 6) AS x,
           round(sum(exp(-0.5::DOUBLE * pow((g.x - p.p_retailprice) / g.bw, 2))
               / (g.n * g.bw * sqrt(2 * pi()))), 10) AS density
    FROM g, part p GROUP BY g.point, g.x
    """,
)
def kde_grid(spark, d):
    out = A.kde_grid(load(spark, d, "part"), "p_retailprice")
    return out.select("point", F.round("x", 6).alias("x"), F.round("density", 10).alias("density"))


@query(
    "box_summary",
    """
    WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q25,
                      quantile_cont(l_extendedprice, 0.5) AS q50,
                      quantile_cont(l_extendedprice, 0.75) AS q75
               FROM lineitem GROUP BY l_returnflag),
    b AS (SELECT l.l_returnflag, q25, q50, q75, l_extendedprice AS x,
                 l_extendedprice BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS ok
          FROM lineitem l JOIN q ON l.l_returnflag = q.l_returnflag)
    SELECT l_returnflag, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
           min(CASE WHEN ok THEN x END) AS whisker_low,
           max(CASE WHEN ok THEN x END) AS whisker_high,
           count(*) FILTER (WHERE NOT ok) AS outliers
    FROM b GROUP BY l_returnflag, q25, q50, q75
    """,
)
def box_summary(spark, d):
    out = A.box_summary(load(spark, d, "lineitem"), "l_returnflag", "l_extendedprice")
    return _round(out, ["q25", "q50", "q75"])


@query(
    "xy_sample",
    """
    SELECT p_partkey, p_size, p_retailprice FROM part
    ORDER BY ('0x' || substr(md5('42:' || p_partkey), 1, 8))::BIGINT, p_partkey LIMIT 500
    """,
)
def xy_sample(spark, d):
    return A.xy_sample(load(spark, d, "part"), "p_partkey", ["p_size", "p_retailprice"])


@query(
    "grouped_sum",
    """
    SELECT l_returnflag, sum(l_quantity) AS l_quantity,
           round(sum(l_extendedprice), 2) AS l_extendedprice
    FROM lineitem GROUP BY l_returnflag
    """,
)
def grouped_sum(spark, d):
    out = A.grouped_sum(
        load(spark, d, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice"]
    )
    return _round(out, ["l_extendedprice"], 2)
