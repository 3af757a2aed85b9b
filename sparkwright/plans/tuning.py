"""Grid search with refit, and permutation importance of fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import text as T
from sparkwright.operators import explain as X
from sparkwright.operators import models as L
from sparkwright.operators import pruning as C
from sparkwright.operators import selection as S
from sparkwright.operators import splitting as P
from sparkwright.operators import vocabulary as V
from sparkwright.plans.evaluation import rounded
from sparkwright.plans.explaining import ALPHAS, tabular, tabular_parts
from sparkwright.plans.registry import query
from sparkwright.plans.shaping import labelled_docs
from sparkwright.session import materialize

SUMMARY = [f"{s}_{m}" for m in S.GRID_METRICS for s in ("mean", "std")]


def tree_grid(spark, d):
    """Pruning strengths of the full training tree, each scored by 5-fold ROC-AUC from one
    fit a fold; the best refitted: the full tree, pruned at it, scores the test rows."""
    rows = tabular(spark, d)
    train, test = rows.where("is_test = 0"), rows.where("is_test = 1")
    full = L.tree_classifier(train, "label")
    full_nodes = C.tree_nodes(full, spark)
    alphas = C.prune_alphas(full_nodes) or [0.0]

    def fit_score(part, valid):
        model = L.tree_classifier(part, "label")
        return C.pruned_spans(model, C.tree_nodes(model, spark), valid, alphas)

    def fold_metrics(part):
        return C.grid_metrics(S.oof_probs(part, fit_score), alphas)

    def refit(part, held, best):
        # The tree grown on all training rows is the refit; only its pruning changes.
        return C.score_pruned(full, full_nodes, held, [best["alpha"]], ["doc_id", "label"])

    return S.grid_search_refit(train, test, None, refit, ["alpha"], "roc_auc", fold_metrics=fold_metrics)


@query("grid_search_tree")
def grid_search_tree(spark, d):
    summary, _, _ = tree_grid(spark, d)
    return rounded(summary.select("alpha", *SUMMARY, "folds", "rank"), *SUMMARY)


@query("grid_search_tree_refit")
def grid_search_tree_refit(spark, d):
    _, _, held = tree_grid(spark, d)
    return held.select(
        "doc_id", "label", "alpha", F.round("p", 6).alias("p"), (F.col("p") > 0.5).cast("int").alias("prediction")
    )


def bayes_grid(spark, d, label="toxic"):
    """Naive Bayes smoothing grid by 5-fold macro F1, all folds and alphas in one plan,
    vocabulary refitted per fold; the refit is the same plan with the test rows as a
    sixth fold, whose training rows are then exactly all five others."""
    docs = P.random_split(labelled_docs(spark, d, label), "doc_id")
    train = docs.where("is_test = 0")
    folded = P.stratified_kfold(train.select("doc_id", "label"), "label", "doc_id")
    held = docs.where("is_test = 1").select("doc_id", "label", F.lit(5).cast(folded.schema["fold"].dataType).alias("fold"))
    everyone = materialize(folded.unionByName(held), "nb-grid-folds")
    # The folds join a document's text, before it becomes many rows. An id may stand for
    # several labelled rows: their words count together, and the counts for each of them.
    who = everyone.groupBy("doc_id").agg(F.collect_list(F.struct("label", "fold")).alias("who"))
    texts = labelled_docs(spark, d, label, by_key=True).select("doc_id", "text").join(who, "doc_id")
    toks = texts.select("doc_id", "who", T.clean_tokens("text").alias("toks"))
    counts = V.term_counts(toks, V.with_bigrams("toks"), ["doc_id", "who"])
    counts = materialize(counts.select("doc_id", F.inline("who"), "term", "tf"), "nb-grid-counts")
    # A term of a single training document is in no fold's vocabulary.
    terms = S.fold_terms(counts.where("fold < 5"), range(5)).where("n >= 2")
    terms = materialize(terms, "nb-grid-terms")

    def grid_oof(_):
        out = S.nb_oof(counts.where("fold < 5"), everyone.where("fold < 5"), ALPHAS, terms=terms)
        return out.withColumnRenamed("p1", "p")

    def refit(_, __, best):
        out = S.nb_oof(counts, everyone, [best["alpha"]], k=6, folds=[5], terms=terms)
        return out.withColumnRenamed("p1", "p")

    return S.grid_search_refit(train, held, grid_oof, refit, ["alpha"], "macro_f1")


@query("grid_search_nb_refit")
def grid_search_nb_refit(spark, d):
    _, _, held = bayes_grid(spark, d)
    return held.select(
        "doc_id", "label", "alpha", F.round("p", 6).alias("p"), (F.col("p") > 0.5).cast("int").alias("prediction")
    )


@query("grid_search_nb")
def grid_search_nb(spark, d):
    summary, _, _ = bayes_grid(spark, d)
    return rounded(summary.select("alpha", *SUMMARY, "folds", "rank"), *SUMMARY)


@query("permutation_importance_tree")
def permutation_importance_tree(spark, d):
    """ROC-AUC drop of the fitted tree on the test rows for each of the 13 counts."""
    feats, prep = tabular_parts(spark, d)
    feats = materialize(feats, "perm-rows")
    train = prep.transform(feats.where("is_test = 0"))
    model = L.tree_classifier(train, "label")
    test = feats.where("is_test = 1").select("doc_id", "label", *T.TEXT_MEASURES)

    def score(rows):
        return L.with_probability(model.transform(prep.transform(rows)))

    out = X.permutation_importance_stacked(test, list(T.TEXT_MEASURES), "doc_id", "label", score)
    return rounded(out, "shuffled_auc", "base_auc", "importance")
