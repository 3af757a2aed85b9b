"""Interpretation, error analysis, model comparison and stream scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import text as T
from sparkwright.operators import explain as X
from sparkwright.operators import metrics as M
from sparkwright.operators import models as L
from sparkwright.operators import preparing as E
from sparkwright.operators import pruning as C
from sparkwright.operators import selection as S
from sparkwright.operators import splitting as P
from sparkwright.operators import vocabulary as V
from sparkwright.plans import sqlparts as Q
from sparkwright.plans.bayes import ALPHA, fitted_bayes, scored_docs
from sparkwright.plans.evaluation import AUC, CELLS_SQL, CURVE, RATES_SQL, rounded
from sparkwright.plans.shaping import labelled_docs
from sparkwright.plans.registry import query
from sparkwright.plans.text import text_features
from sparkwright.plans.vocabulary import labelled_tokens, split_docs
from sparkwright.session import load, materialize, scratch_path
from sparkwright.streaming.scoring import score_stream, score_stream_once, text_pipeline

ALPHAS = [0.01, 0.1, 0.5, 1.0, 2.0, 5.0]
SENT_BASE = 1_700_000_000


# ---- naive Bayes as the checkable model -------------------------------------

COEF = "coefs AS (SELECT term, round(coef, 7) AS coef FROM coef)"


def coefficients(spark, d):
    """Log odds per term, rounded so that equal terms tie in every engine."""
    return fitted_bayes(spark, d).coefficients.withColumn("coef", F.round("coef", 7))


@query(
    "coef_table",
    f"""
    WITH {Q.nb(ALPHA)}, {COEF}
    (SELECT term, coef, 'top' AS side FROM coefs ORDER BY coef DESC, term LIMIT 25)
    UNION ALL
    (SELECT term, coef, 'bottom' AS side FROM coefs ORDER BY coef, term LIMIT 25)
    """,
)
def coef_table(spark, d):
    return X.coef_table(coefficients(spark, d), 25)


@query(
    "misclassified",
    f"""
    WITH {Q.nb_scored(ALPHA)}
    SELECT doc_id, label, CAST(p1 > 0.5 AS INTEGER) AS prediction,
           round(1 - p1, 6) AS proba_0, round(p1, 6) AS proba_1
    FROM scored WHERE label <> CAST(p1 > 0.5 AS INTEGER)
    """,
)
def misclassified(spark, d):
    wrong = X.misclassified(scored_docs(spark, d), "label", "prediction", "p1")
    return rounded(
        wrong.select("doc_id", "label", "prediction", "proba_0", "proba_1"),
        "proba_0", "proba_1", digits=6,
    )


@query(
    "doc_contributions",
    f"""
    WITH {Q.nb(ALPHA)}, {COEF},
    o AS (SELECT t.doc_id, t.word, c.coef, row_number() OVER
                 (PARTITION BY t.doc_id ORDER BY abs(c.coef) DESC, t.word) AS rn
          FROM tok t JOIN coefs c ON t.word = c.term)
    SELECT doc_id, word, count(*) AS occurrences, round(sum(coef), 7) AS coef,
           CAST(max(coef) >= 0 AS INTEGER) AS class
    FROM o WHERE rn <= 25 GROUP BY doc_id, word
    """,
)
def doc_contributions(spark, d):
    coef = coefficients(spark, d).withColumnRenamed("term", "word")
    out = X.doc_contributions(labelled_tokens(spark, d), coef, "doc_id")
    return rounded(out, "coef", digits=7)


@query(
    "route_by_confidence",
    f"""
    WITH {Q.nb_scored(ALPHA)}
    SELECT doc_id, round(p1, 6) AS p1, CASE WHEN greatest(p1, 1 - p1) < 0.75 THEN 'review'
           WHEN p1 >= 0.5 THEN 'suppress' ELSE 'pass' END AS route FROM scored
    """,
)
def route_by_confidence(spark, d):
    routed = X.route_by_confidence(scored_docs(spark, d), "p1")
    return rounded(routed.select("doc_id", "p1", "route"), "p1", digits=6)


NB_OOF = f"""
    {Q.LABELLED},
    docs AS (SELECT *, CAST({Q.hash32('doc_id')} < 858993459 AS INTEGER) AS is_test FROM clean),
    {Q.terms('docs', keep='doc_id, is_test')},
    tf AS (SELECT doc_id, term, count(*) AS tf FROM term WHERE is_test = 0 GROUP BY ALL),
    fd AS (SELECT doc_id, label, (row_number() OVER (PARTITION BY label
                  ORDER BY {Q.hash32('doc_id')}, doc_id) - 1) % 5 AS fold
           FROM docs WHERE is_test = 0),
    c AS (SELECT fd.doc_id, fd.label, fd.fold, tf.term, tf.tf FROM tf JOIN fd ON tf.doc_id = fd.doc_id),
    ks AS (SELECT unnest(range(5)) AS f),
    nf AS (SELECT f, count(*) AS n, ln(count(*) FILTER (WHERE label = 0) / count(*)::DOUBLE) AS q0,
                  ln(count(*) FILTER (WHERE label = 1) / count(*)::DOUBLE) AS q1
           FROM fd, ks WHERE fold <> f GROUP BY f),
    dff AS (SELECT f, term, count(*) AS df, sum(tf) AS total FROM c, ks WHERE fold <> f
            GROUP BY f, term),
    voc AS (SELECT dff.f, term, ln((1 + n)::DOUBLE / (1 + df)) + 1 AS idf
            FROM dff JOIN nf ON dff.f = nf.f WHERE df >= 2 AND df <= 0.98 * n
            QUALIFY row_number() OVER (PARTITION BY dff.f ORDER BY total DESC, term) <= 20000),
    rw AS (SELECT v.f, c.doc_id, c.label, c.fold, c.term, (1 + ln(c.tf)) * v.idf AS w
           FROM c JOIN voc v ON c.term = v.term),
    wt AS (SELECT f, doc_id, label, fold, term,
                  w / sqrt(sum(w * w) OVER (PARTITION BY f, doc_id)) AS w FROM rw),
    sm AS (SELECT v.f, v.term, sum(CASE WHEN t.label = 0 THEN t.w ELSE 0 END) AS n0,
                  sum(CASE WHEN t.label = 1 THEN t.w ELSE 0 END) AS n1
           FROM voc v LEFT JOIN wt t ON t.f = v.f AND t.term = v.term AND t.fold <> v.f
           GROUP BY v.f, v.term),
    tt AS (SELECT f, sum(n0) AS t0, sum(n1) AS t1, count(*) AS v FROM sm GROUP BY f),
    al AS (SELECT unnest({ALPHAS})::DOUBLE AS alpha),
    lg AS (SELECT al.alpha, sm.f, sm.term, ln((n0 + alpha) / (t0 + alpha * v)) AS l0,
                  ln((n1 + alpha) / (t1 + alpha * v)) AS l1 FROM al, sm JOIN tt ON sm.f = tt.f),
    sd AS (SELECT lg.alpha, wt.doc_id, sum(w * l0) AS s0, sum(w * l1) AS s1
           FROM wt JOIN lg ON wt.f = lg.f AND wt.term = lg.term WHERE wt.fold = wt.f
           GROUP BY lg.alpha, wt.doc_id),
    oof AS (SELECT al.alpha, fd.fold, fd.doc_id, fd.label,
                   1 / (1 + exp(nf.q0 + coalesce(s0, 0) - nf.q1 - coalesce(s1, 0))) AS p1
            FROM fd CROSS JOIN al JOIN nf ON nf.f = fd.fold
            LEFT JOIN sd ON sd.alpha = al.alpha AND sd.doc_id = fd.doc_id)
"""


def nb_oof(spark, d, alphas, label="toxic"):
    docs = P.random_split(labelled_docs(spark, d, label), "doc_id").where("is_test = 0")
    folded = P.stratified_kfold(docs.select("doc_id", "label"), "label", "doc_id")
    folded = materialize(folded, "folds")
    toks = docs.select("doc_id", T.clean_tokens("text").alias("toks"))
    counts = V.term_counts(toks, V.with_bigrams("toks"), ["doc_id"]).join(folded, "doc_id")
    return S.nb_oof(materialize(counts, "fold-counts"), folded, alphas)


@query(
    "oof_probs",
    f"WITH {NB_OOF} SELECT doc_id, label, CAST(fold AS INTEGER) AS fold, round(p1, 6) AS p1 "
    "FROM oof WHERE alpha = 0.1",
)
def oof_probs(spark, d):
    out = nb_oof(spark, d, [0.1])
    return rounded(out.select("doc_id", "label", "fold", "p1"), "p1", digits=6)


@query(
    "grid_search",
    f"""
    WITH {NB_OOF},
    m AS (SELECT alpha, fold, CAST(p1 > 0.5 AS INTEGER) AS z, label AS y FROM oof),
    k AS (SELECT alpha, fold, count(*) FILTER (WHERE y = 1 AND z = 1) AS tp,
                 count(*) FILTER (WHERE y = 0 AND z = 0) AS tn,
                 count(*) FILTER (WHERE y <> z) AS bad FROM m GROUP BY alpha, fold),
    f AS (SELECT alpha, (coalesce(2 * tp / nullif(2 * tp + bad, 0)::DOUBLE, 0)
                 + coalesce(2 * tn / nullif(2 * tn + bad, 0)::DOUBLE, 0)) / 2 AS f1 FROM k)
    SELECT alpha, round(avg(f1), 8) AS mean, round(stddev_pop(f1), 8) AS std FROM f GROUP BY alpha
    """,
)
def grid_search(spark, d):
    return rounded(S.grid_scores(nb_oof(spark, d, ALPHAS), ["alpha"]), "mean", "std")


@query(
    "subgroup_metrics",
    f"""
    WITH {Q.SCORES},
    b AS (SELECT s.label, s.p, CASE WHEN d.n_chars <= 1500 THEN 'short' ELSE 'long' END AS bucket
          FROM scores s JOIN documents d ON s.doc_id = d.doc_id),
    m AS (SELECT bucket, count(*) AS n, {CELLS_SQL.format(t=0.5)} FROM b GROUP BY bucket),
    r AS (SELECT bucket, n, "TP", "FN", {RATES_SQL} FROM m)
    SELECT bucket, n, round(("TP" + "FN") / n::DOUBLE, 8) AS positive_share, sensitivity,
           specificity, precision_ppv AS precision FROM r
    """,
)
def subgroup_metrics(spark, d):
    p = F.floor(F.col("n_chars") / (F.col("n_chars") + 1500.0) * 1000) / 1000
    docs = labelled_docs(spark, d).withColumn("p", p)
    bucket = F.when(F.col("n_chars") <= 1500, "short").otherwise("long")
    out = X.subgroup_metrics(docs, bucket, "label", "p")
    return rounded(out, "positive_share", "sensitivity", "specificity", "precision")


def _perm_sql():
    p = "floor({c} / ({c} + 1500.0::DOUBLE) * 1000) / 1000"
    return f"""
    WITH x AS (SELECT d.doc_id, l.toxic AS label, d.n_chars FROM documents d
               JOIN labels l ON d.doc_id = l.doc_id),
    t AS (SELECT *, row_number() OVER (ORDER BY {Q.hash32('doc_id', '42:to')}, doc_id) AS rn FROM x),
    f AS (SELECT n_chars, row_number() OVER
                 (ORDER BY {Q.hash32('doc_id', '42:from:n_chars')}, doc_id) AS rn FROM x),
    b AS (SELECT label, {p.format(c='n_chars')} AS p FROM x),
    m AS (SELECT t.label, {p.format(c='f.n_chars')} AS p FROM t JOIN f ON t.rn = f.rn),
    a1 AS (WITH {CURVE.format(src='b')} SELECT {AUC} AS auc FROM c),
    a2 AS (WITH {CURVE.format(src='m')} SELECT {AUC} AS auc FROM c)
    SELECT 'n_chars' AS feature, a2.auc AS shuffled_auc, a1.auc AS base_auc,
           round(a1.auc - a2.auc, 6) AS importance FROM a1, a2
    """


@query("permutation_importance", _perm_sql())
def permutation_importance(spark, d):
    docs = labelled_docs(spark, d).select("doc_id", "label", "n_chars")

    def score(df):
        return df.withColumn("p", F.floor(F.col("n_chars") / (F.col("n_chars") + 1500.0) * 1000) / 1000)

    out = X.permutation_importance(docs, ["n_chars"], "doc_id", "label", score)
    return rounded(rounded(out, "shuffled_auc", "base_auc"), "importance", digits=6)


# ---- MLlib classifiers on the 13 text counts --------------------------------


def tabular(spark, d, label="toxic"):
    """Text counts as a feature vector, split flag, folds and class weights; written
    once because every fit reads it several times."""
    feats, prep = tabular_parts(spark, d, label)
    out = prep.transform(feats).select("doc_id", "label", "is_test", "fold", "weight", "features")
    return materialize(out, "vectors")


def tabular_parts(spark, d, label="toxic"):
    """(raw rows with the 13 counts, split, folds and weights; the column transformer
    fitted on the training rows)."""
    feats = P.random_split(text_features(labelled_docs(spark, d, label)), "doc_id")
    train = feats.where("is_test = 0")
    folds = P.stratified_kfold(train.select("doc_id", "label"), "label", "doc_id")
    weights = E.class_weight(train.select("doc_id", "label"), "label").drop("label")
    feats = materialize(
        feats.join(folds.drop("label"), "doc_id", "left").join(weights, "doc_id", "left"), "tabular"
    )
    prep = E.column_transformer(feats.where("is_test = 0"), list(T.TEXT_MEASURES))
    return feats, prep


def _scored(spark, d, fit):
    rows = tabular(spark, d)
    model = fit(rows.where("is_test = 0"))
    out = L.with_probability(model.transform(rows.where("is_test = 1")))
    return out.select(
        "doc_id", "label", F.round("p", 6).alias("p"), F.col("prediction").cast("int").alias("prediction")
    )


@query("tree_classifier")
def tree_classifier(spark, d):
    return _scored(spark, d, lambda t: L.tree_classifier(t, "label"))


@query("forest_classifier")
def forest_classifier(spark, d):
    return _scored(spark, d, lambda t: L.forest_classifier(t, "label", weight="weight"))


@query("logistic_tabular")
def logistic_tabular(spark, d):
    return _scored(spark, d, lambda t: L.logistic(t, "label", weight="weight"))


def _sql_type(values):
    if isinstance(values[0], bool):
        return "boolean"
    if isinstance(values[0], int):
        return "int" if all(-(2**31) <= v < 2**31 for v in values) else "bigint"
    return "double" if isinstance(values[0], float) else "string"


def _rows(spark, records):
    """A table of the driver's records (steps, rules, shares: as large as a model). They are
    local rows; as literals of one plan, thousands take the analyzer longer than the fit."""
    names = list(records[0])
    schema = ", ".join(f"{n} {_sql_type([r[n] for r in records])} NOT NULL" for n in names)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in records], schema)


def _cart(spark, d):
    train = tabular(spark, d).where("is_test = 0")
    return L.tree_classifier(train, "label"), train


@query("tree_prune_path")
def tree_prune_path(spark, d):
    model, _ = _cart(spark, d)
    steps = C.tree_nodes(model, spark).path()
    return _rows(
        spark,
        [{"step": i, "alpha": round(s["alpha"], 9), "leaves": s["leaves"],
          "impurity": round(s["impurity"], 9)} for i, s in enumerate(steps)],
    )


@query("tree_shape")
def tree_shape(spark, d):
    return _rows(spark, [X.tree_shape(_cart(spark, d)[0])])


@query("tree_rules")
def tree_rules(spark, d):
    lines = X.tree_rules(_cart(spark, d)[0])
    return _rows(spark, [{"line": i, "rule": s} for i, s in enumerate(lines)])


@query("impurity_importance")
def impurity_importance(spark, d):
    values = _cart(spark, d)[0].featureImportances.toArray()
    return _rows(
        spark,
        [{"feature": n, "importance": round(float(v), 9)} for n, v in zip(T.TEXT_MEASURES, values)],
    )


# Training rows of the fits that run side by side: a full tree may have a leaf for each row,
# and the driver holds the trees it is growing.
FIT_ROWS = 400_000


def _side_by_side(train):
    return max(1, min(4, FIT_ROWS // max(1, train.count())))


def _written(fit_score):
    """The fitted model's output as a table: the driver need not keep the model for it, and
    no job carries the models of all folds at once."""

    def run(part, valid):
        return materialize(fit_score(part, valid), "fold-scores")

    return run


def _tuned_tree(spark, train):
    """Pruning strength chosen by cross-validated ROC-AUC on the training rows."""
    alphas = C.prune_alphas(C.tree_nodes(L.tree_classifier(train, "label"), spark)) or [0.0]

    def fit_score(part, valid):
        model = L.tree_classifier(part, "label")
        return C.pruned_spans(model, C.tree_nodes(model, spark), valid, alphas)

    spans = S.oof_probs(train, _written(fit_score), parallelism=_side_by_side(train))
    return C.best_alpha(C.grid_metrics(spans, alphas))


def _classifiers(spark, best_alpha):
    keep = ["doc_id", "label", "fold"]

    def plain(fit):
        def run(part, valid):
            return L.with_probability(fit(part).transform(valid)).select(*keep, "p")

        return run

    def dummy(part, valid):
        share = part.agg(F.avg("label")).scalar()
        return valid.select(*keep, share.alias("p"))

    def pruned(part, valid):
        model = L.tree_classifier(part, "label")
        return C.score_pruned(model, C.tree_nodes(model, spark), valid, [best_alpha], keep).select(
            *keep, "p"
        )

    return {
        "Dummy Baseline": dummy,
        "Basic CART": plain(lambda t: L.tree_classifier(t, "label")),
        "Tuned & Pruned CART": pruned,
        "Random Forest": plain(lambda t: L.forest_classifier(t, "label", weight="weight")),
        "Logistic Regression": plain(lambda t: L.logistic(t, "label", weight="weight")),
    }


def compare_models(spark, rows):
    """Test and cross-validation metrics of every model; scores are written as each model is
    fitted, and all are reported by one grouped aggregation."""
    train, test = rows.where("is_test = 0"), rows.where("is_test = 1")
    parts, at_once = None, _side_by_side(train)
    for name, fit_score in _classifiers(spark, _tuned_tree(spark, train)).items():
        fit_score = _written(fit_score)
        cv = S.oof_probs(train, fit_score, parallelism=at_once).withColumn("part", F.lit("cv"))
        held = fit_score(train, test.withColumn("fold", F.lit(-1))).withColumn("part", F.lit("test"))
        both = cv.unionByName(held).withColumn("model", F.lit(name))
        parts = both if parts is None else parts.unionByName(both)
    scored = materialize(parts, "model-scores")
    report = M.binary_report(scored, "label", "p", group=["model", "part", "fold"])
    test_rows = report.where("part = 'test'").select(
        "model",
        F.col("sensitivity").alias("test_recall"),
        F.col("specificity").alias("test_specificity"),
        F.col("precision_ppv").alias("test_precision"),
        F.col("f1").alias("test_f1"),
        F.col("roc_auc").alias("test_roc_auc"),
        F.col("pr_auc").alias("test_pr_auc"),
    )
    cv_rows = report.where("part = 'cv'").groupBy("model").agg(
        F.avg("roc_auc").alias("cv_roc_auc_mean"), F.stddev_pop("roc_auc").alias("cv_roc_auc_std")
    )
    return test_rows.join(cv_rows, "model").orderBy(F.desc("cv_roc_auc_mean"), "model")


@query("model_comparison")
def model_comparison(spark, d):
    return compare_models(spark, tabular(spark, d))


@query("cross_dataset_summary")
def cross_dataset_summary(spark, d):
    """Logistic model on two label sets: cross-validated beside held-out ROC-AUC."""
    out = None
    for label in ("toxic", "quality"):
        rows = tabular(spark, d, label)
        fit = _classifiers(spark, 0.0)["Logistic Regression"]
        train, test = rows.where("is_test = 0"), rows.where("is_test = 1")
        cv = S.oof_probs(train, fit).withColumn("dataset", F.lit(label)).withColumn("part", F.lit("cv"))
        held = fit(train, test.withColumn("fold", F.lit(-1)))
        held = held.withColumn("dataset", F.lit(label)).withColumn("part", F.lit("test"))
        both = cv.unionByName(held)
        out = both if out is None else out.unionByName(both)
    auc = M.ranking_metrics(materialize(out, "summary"), "label", "p", group=["dataset", "part", "fold"])
    return (
        auc.groupBy("dataset")
        .pivot("part", ["cv", "test"])
        .agg(F.avg("roc_auc"))
        .select("dataset", F.col("cv").alias("cv_roc_auc"), F.col("test").alias("test_roc_auc"))
    )


# ---- text models -------------------------------------------------------------


@query("logistic_text")
def logistic_text(spark, d):
    """Word counts -> balanced logistic regression (C = 0.1), 70:30 stratified split."""
    docs = labelled_docs(spark, d)
    split = P.stratified_split(docs.select("doc_id", "label"), "label", "doc_id", 0.3, seed=0)
    split = materialize(split, "split")
    toks = labelled_docs(spark, d, by_key=True).select("doc_id", T.clean_tokens("text").alias("toks"))
    counts = materialize(V.term_counts(toks, F.col("toks"), ["doc_id"]), "counts")
    train_counts = counts.join(split.where("is_test = 0").select("doc_id"), "doc_id")
    vocab = V.df_prune(train_counts, F.lit(1), 2, float("inf"))
    vocab = materialize(V.index_terms(vocab).select("term", "idx"), "vocab")
    # Every document has a vector: one without a vocabulary term gets an empty one.
    vectors = V.to_sparse_vector(
        counts.withColumn("w", F.col("tf").cast("double")), "doc_id", vocab, V.MAX_FEATURES,
        keys=split.select("doc_id"),
    )
    rows = materialize(split.join(vectors, "doc_id"), "vectors")
    train = E.class_weight(rows.where("is_test = 0"), "label")
    model = L.logistic(train, "label", c=0.1, weight="weight")
    out = L.with_probability(model.transform(rows.where("is_test = 1")))
    return out.select(
        "doc_id", "label", F.round("p", 4).alias("p"), F.col("prediction").cast("int").alias("prediction")
    )


@query("embedding_classifier")
def embedding_classifier(spark, d):
    """Mean word vectors -> logistic regression."""
    from pyspark.ml.functions import array_to_vector

    from sparkwright.plans.vocabulary import mean_embedding

    rows = split_docs(spark, d).join(mean_embedding(spark, d), "doc_id").select(
        "doc_id", "label", "is_test", array_to_vector("mean").alias("features")
    )
    rows = materialize(rows, "mean-vectors")
    train = E.class_weight(rows.where("is_test = 0"), "label")
    model = L.logistic(train, "label", weight="weight")
    out = L.with_probability(model.transform(rows.where("is_test = 1")))
    return out.select(
        "doc_id", "label", F.round("p", 4).alias("p"), F.col("prediction").cast("int").alias("prediction")
    )


@query("score_stream")
def score_stream_query(spark, d):
    """Fit the model of logistic_text on its training texts, then stream the whole
    documents table."""
    docs = labelled_docs(spark, d)
    split = P.stratified_split(docs.select("doc_id", "label"), "label", "doc_id", 0.3, seed=0)
    train = docs.join(split.where("is_test = 0").select("doc_id"), "doc_id")
    model = text_pipeline(train.select("text", "label"))
    source = scratch_path(spark, "stream-in")
    texts = load(spark, d, "documents").select("doc_id", "text")
    texts.write.parquet(source)
    stream = spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", 100).parquet(source)
    out = scratch_path(spark, "stream-out")
    score_stream(stream, model, ["doc_id"], out, scratch_path(spark, "stream-state")).awaitTermination()
    scored = spark.read.parquet(out)
    return scored.select("doc_id", F.round("p1", 4).alias("p1"), "prediction")


@query("score_stream_once")
def score_stream_once_query(spark, d):
    """The documents arrive twice (every message repeated, in other files); each is scored
    once. Event time: the id read as seconds after SENT_BASE (a time at the epoch itself
    would equal the first watermark and count as late)."""
    docs = labelled_docs(spark, d)
    split = P.stratified_split(docs.select("doc_id", "label"), "label", "doc_id", 0.3, seed=0)
    train = docs.join(split.where("is_test = 0").select("doc_id"), "doc_id")
    model = text_pipeline(train.select("text", "label"))
    source = scratch_path(spark, "stream-in")
    texts = load(spark, d, "documents").select(
        "doc_id", "text", F.timestamp_seconds(F.col("doc_id") + SENT_BASE).alias("sent_at")
    )
    texts.write.parquet(f"{source}/first")
    texts.write.parquet(f"{source}/again")
    stream = spark.readStream.schema(texts.schema).option("recursiveFileLookup", True).parquet(source)
    out = scratch_path(spark, "stream-out")
    state = scratch_path(spark, "stream-state")
    score_stream_once(stream, model, ["doc_id"], "doc_id", "sent_at", out, state, watermark="100000 days").awaitTermination()
    return spark.read.parquet(out).select("doc_id", F.round("p1", 4).alias("p1"), "prediction")
