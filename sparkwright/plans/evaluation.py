"""Evaluation queries over the labelled documents and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import metrics as M
from sparkwright.operators import splitting as P
from sparkwright.plans import sqlparts as Q
from sparkwright.plans.registry import query
from sparkwright.plans.shaping import labelled_docs
from sparkwright.plans.splitting import LINE
from sparkwright.session import load

R = 8  # decimals kept of every metric


def scores(spark, d):
    """(doc_id, label, p): a score that needs no model, longer texts score higher."""
    p = F.floor(F.col("n_chars") / (F.col("n_chars") + 1500.0) * 1000) / 1000
    return labelled_docs(spark, d).select("doc_id", "label", p.alias("p"))


def rounded(df, *names, digits=R):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(
    "score_binary",
    f"WITH {Q.SCORES} SELECT doc_id, label, p, CAST(p >= 0.5 AS INTEGER) AS prediction FROM scores",
)
def score_binary(spark, d):
    return M.score_binary(scores(spark, d), "p")


@query(
    "regression_metrics",
    """
    WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b,
                      regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
    r AS (SELECT l_extendedprice AS y, f.a + f.b * l_quantity AS p FROM lineitem, f)
    SELECT round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
           round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 8) AS r2 FROM r
    """,
)
def regression_metrics(spark, d):
    from sparkwright.operators.baselines import slr_fit, slr_predict

    li = load(spark, d, "lineitem").select("l_quantity", "l_extendedprice")
    scored = slr_predict(li, slr_fit(li, "l_quantity", "l_extendedprice"), "l_quantity")
    out = M.regression_metrics(scored, "l_extendedprice", "prediction")
    return rounded(rounded(out, "mae", "rmse", digits=4), "r2")


CELLS_SQL = """
    count(*) FILTER (WHERE label = 0 AND p < {t}) AS "TN",
    count(*) FILTER (WHERE label = 0 AND p >= {t}) AS "FP",
    count(*) FILTER (WHERE label = 1 AND p < {t}) AS "FN",
    count(*) FILTER (WHERE label = 1 AND p >= {t}) AS "TP"
"""


@query("confusion", f"WITH {Q.SCORES} SELECT {CELLS_SQL.format(t=0.5)} FROM scores")
def confusion(spark, d):
    return M.confusion(scores(spark, d), "label", "p")


@query(
    "confusion_normalized",
    f"""
    WITH {Q.SCORES}
    SELECT label AS actual, CAST(p >= 0.5 AS INTEGER) AS predicted, count(*) AS n,
           round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY label) AS DOUBLE), 8) AS share
    FROM scores GROUP BY label, p >= 0.5
    """,
)
def confusion_normalized(spark, d):
    out = M.confusion_normalized(M.score_binary(scores(spark, d), "p"), "label", "prediction")
    return rounded(out, "share")


CURVE = """
    s AS (SELECT p, count(*) FILTER (WHERE label = 1) AS pos,
                 count(*) FILTER (WHERE label = 0) AS neg FROM {src} GROUP BY p),
    c AS (SELECT p, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
                 sum(pos) OVER () AS pp, sum(neg) OVER () AS nn
          FROM s WINDOW w AS (ORDER BY p DESC))
"""
AUC = "round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (max(pp) * max(nn)::DOUBLE), 8)"
AP = "round(sum(pos * (tp / (tp + fp)::DOUBLE)) / max(pp), 8)"


@query(
    "roc_points",
    f"""
    WITH {Q.SCORES}, {CURVE.format(src='scores')}
    SELECT p AS threshold, round(fp / nn::DOUBLE, 8) AS fpr, round(tp / pp::DOUBLE, 8) AS tpr FROM c
    """,
)
def roc_points(spark, d):
    return rounded(M.roc_points(scores(spark, d), "label", "p"), "fpr", "tpr")


@query("roc_auc", f"WITH {Q.SCORES}, {CURVE.format(src='scores')} SELECT {AUC} AS roc_auc FROM c")
def roc_auc(spark, d):
    return rounded(M.ranking_metrics(scores(spark, d), "label", "p").select("roc_auc"), "roc_auc")


@query(
    "average_precision",
    f"WITH {Q.SCORES}, {CURVE.format(src='scores')} SELECT {AP} AS pr_auc FROM c",
)
def average_precision(spark, d):
    return rounded(M.ranking_metrics(scores(spark, d), "label", "p").select("pr_auc"), "pr_auc")


@query(
    "brier",
    f"WITH {Q.SCORES} SELECT round(avg((p - label) * (p - label)), 8) AS brier_score FROM scores",
)
def brier(spark, d):
    return rounded(M.brier(scores(spark, d), "label", "p"), "brier_score")


RATES_SQL = """
    round(("TP" + "TN") / ("TP" + "TN" + "FP" + "FN")::DOUBLE, 8) AS accuracy,
    round(("TP" / ("TP" + "FN")::DOUBLE + "TN" / ("TN" + "FP")::DOUBLE) / 2, 8) AS balanced_accuracy,
    round("TP" / nullif("TP" + "FN", 0)::DOUBLE, 8) AS sensitivity,
    round("TN" / nullif("TN" + "FP", 0)::DOUBLE, 8) AS specificity,
    round("TP" / nullif("TP" + "FP", 0)::DOUBLE, 8) AS precision_ppv,
    round("TN" / nullif("TN" + "FN", 0)::DOUBLE, 8) AS npv,
    round(coalesce(2 * "TP" / nullif(2 * "TP" + "FP" + "FN", 0)::DOUBLE, 0), 8) AS f1
"""
RATE_NAMES = [
    "accuracy", "balanced_accuracy", "sensitivity", "specificity", "precision_ppv", "npv", "f1",
]


@query(
    "binary_report",
    f"""
    WITH {Q.SCORES}, {CURVE.format(src='scores')},
    m AS (SELECT {CELLS_SQL.format(t=0.6)}, round(avg((p - label) * (p - label)), 8) AS brier_score
          FROM scores),
    a AS (SELECT {AUC} AS roc_auc, {AP} AS pr_auc FROM c)
    SELECT 0.6::DOUBLE AS threshold, "TN", "FP", "FN", "TP", {RATES_SQL},
           round(("TP" * "TN" - "FP" * "FN") / sqrt(("TP" + "FP")::DOUBLE * ("TP" + "FN")
                 * ("TN" + "FP") * ("TN" + "FN")), 8) AS mcc,
           roc_auc, pr_auc, brier_score FROM m, a
    """,
)
def binary_report(spark, d):
    out = M.binary_report(scores(spark, d), "label", "p", 0.6)
    return rounded(out, *RATE_NAMES, "mcc", "roc_auc", "pr_auc", "brier_score")


REPORT_SQL = """
    pr AS (SELECT label AS y, CAST(p >= 0.6 AS INTEGER) AS z FROM scores),
    k AS (SELECT unnest([0, 1])::INTEGER AS c),
    e AS (SELECT c, count(*) FILTER (WHERE y = c AND z = c) AS tp,
                 count(*) FILTER (WHERE z = c) AS pred, count(*) FILTER (WHERE y = c) AS support
          FROM pr, k GROUP BY c),
    pc AS (SELECT c, tp, support, coalesce(tp / nullif(pred, 0)::DOUBLE, 0) AS precision,
                 coalesce(tp / nullif(support, 0)::DOUBLE, 0) AS recall,
                 coalesce(2 * tp / nullif(pred + support, 0)::DOUBLE, 0) AS f1 FROM e)
"""


@query(
    "class_report",
    f"""
    WITH {Q.SCORES}, {REPORT_SQL},
    u AS (SELECT CAST(c AS VARCHAR) AS class, precision, recall, f1, support FROM pc
          UNION ALL
          SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support)::DOUBLE, CAST(sum(support) AS BIGINT)
          FROM pc
          UNION ALL
          SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT)
          FROM pc
          UNION ALL
          SELECT 'weighted avg', sum(precision * support) / sum(support),
                 sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
                 CAST(sum(support) AS BIGINT) FROM pc)
    SELECT class, round(precision, 8) AS precision, round(recall, 8) AS recall,
           round(f1, 8) AS f1, support FROM u
    """,
)
def class_report(spark, d):
    pred = M.score_binary(scores(spark, d), "p", 0.6)
    return rounded(M.class_report(pred, "label", "prediction"), "precision", "recall", "f1")


@query(
    "macro_f1",
    f"WITH {Q.SCORES}, {REPORT_SQL} SELECT round(avg(f1), 8) AS macro_f1 FROM pc",
)
def macro_f1(spark, d):
    pred = M.score_binary(scores(spark, d), "p", 0.6)
    return rounded(M.macro_f1(pred, "label", "prediction"), "macro_f1")


GRID_SQL = f"""
    g AS (SELECT CASE WHEN i = 180 THEN 0.95::DOUBLE
                 ELSE i * {M.GRID_STEP!r}::DOUBLE + 0.05::DOUBLE END AS t
          FROM (SELECT unnest(range(181)) AS i)),
    gr AS (SELECT t AS threshold, {CELLS_SQL.format(t='t')} FROM scores, g GROUP BY t),
    grid AS (SELECT *, coalesce("TP" / nullif("TP" + "FN", 0)::DOUBLE, 0) AS sens,
                    coalesce("TN" / nullif("TN" + "FP", 0)::DOUBLE, 0) AS spec FROM gr)
"""


@query(
    "threshold_grid",
    f"""
    WITH {Q.SCORES}, {GRID_SQL}
    SELECT round(threshold, 6) AS threshold, "TN", "FP", "FN", "TP", round(sens, 8) AS sens,
           round(spec, 8) AS spec FROM grid
    """,
)
def threshold_grid(spark, d):
    out = M.threshold_grid(scores(spark, d), "label", "p")
    return rounded(rounded(out, "threshold", digits=6), "sens", "spec")


@query(
    "pick_threshold",
    f"""
    WITH {Q.SCORES}, {GRID_SQL}
    SELECT round(threshold, 6) AS threshold, round(sens, 8) AS sens, round(spec, 8) AS spec
    FROM grid WHERE sens >= 0.9 ORDER BY spec DESC, threshold LIMIT 1
    """,
)
def pick_threshold(spark, d):
    out = M.pick_threshold(M.threshold_grid(scores(spark, d), "label", "p"))
    return rounded(rounded(out, "threshold", digits=6), "sens", "spec").select(
        "threshold", "sens", "spec"
    )


@query(
    "expected_cost",
    f"""
    WITH {Q.SCORES}, {GRID_SQL}
    SELECT round(threshold, 6) AS threshold, "FN" * 10.0::DOUBLE + "FP" * 1.0::DOUBLE AS cost FROM grid
    """,
)
def expected_cost(spark, d):
    out = M.expected_cost(M.threshold_grid(scores(spark, d), "label", "p"), 10.0, 1.0)
    return out.select(F.round("threshold", 6).alias("threshold"), "cost")


@query(
    "cv_scores",
    f"""
    WITH l AS (SELECT l_quantity AS x, l_extendedprice AS y, {LINE} % 5 AS fold FROM lineitem),
    f AS (SELECT k AS fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
          FROM l, (SELECT unnest(range(5)) AS k) WHERE fold <> k GROUP BY k),
    r AS (SELECT l.fold, y, a + b * x AS p FROM l JOIN f ON l.fold = f.fold),
    m AS (SELECT fold, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
                 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM r GROUP BY fold),
    u AS (UNPIVOT m ON mae, rmse, r2 INTO NAME metric VALUE v)
    SELECT metric, round(avg(v), 5) AS mean, round(stddev_pop(v), 5) AS std FROM u GROUP BY metric
    """,
)
def cv_scores(spark, d):
    li = P.kfold_assign(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])
    out = M.slr_cv_scores(li, "l_quantity", "l_extendedprice")
    return rounded(out, "mean", "std", digits=5)
