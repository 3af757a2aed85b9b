"""Evaluation of scored tables. Everything is an aggregate over rows or over
distinct scores; curves use ranged prefix sums instead of one ordered task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.operators.ordered import prefix_sums

# 181 thresholds from 0.05 to 0.95.
GRID_START, GRID_STOP, GRID_SIZE = 0.05, 0.95, 181
GRID_STEP = (GRID_STOP - GRID_START) / (GRID_SIZE - 1)
BINARY_SCORES = (
    "accuracy",
    "balanced_accuracy",
    "recall",
    "precision",
    "f1",
    "roc_auc",
    "pr_auc",
)


def regression_metrics(
    df: DataFrame, label: str, prediction: str, group: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE and R2 = 1 - SSE / SST."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    sst = F.var_pop(y) * F.count(y)
    return df.groupBy(*group).agg(
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)), sst)).alias("r2"),
    )


def score_binary(df: DataFrame, probability: str, threshold: float = 0.5) -> DataFrame:
    return df.withColumn("prediction", (F.col(probability) >= threshold).cast("int"))


def _cells(label: str, predicted: Column) -> dict[str, Column]:
    actual = F.col(label) == 1
    return {
        "TN": F.count_if(~actual & ~predicted),
        "FP": F.count_if(~actual & predicted),
        "FN": F.count_if(actual & ~predicted),
        "TP": F.count_if(actual & predicted),
    }


def confusion(
    df: DataFrame, label: str, probability: str, threshold: float = 0.5, group: Sequence[str] = ()
) -> DataFrame:
    cells = _cells(label, F.col(probability) >= threshold)
    return df.groupBy(*group).agg(*[c.alias(name) for name, c in cells.items()])


def confusion_normalized(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(actual, predicted, n, share of the actual class)."""
    counts = df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count("*").alias("n")
    )
    row = F.sum("n").over(Window.partitionBy("actual"))
    return counts.withColumn("share", F.col("n") / row)


def rates(cm: DataFrame) -> DataFrame:
    """Add the threshold metrics to TN / FP / FN / TP columns; 0/0 is NULL, except
    F1 and MCC where it is 0."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("TN", "FP", "FN", "TP"))
    sens, spec = F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)
    mcc_base = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    balanced = F.coalesce((sens + spec) / 2, sens, spec)
    return cm.withColumns(
        {
            "accuracy": F.try_divide(tp + tn, tp + tn + fp + fn),
            "balanced_accuracy": balanced,
            "sensitivity": sens,
            "specificity": spec,
            "precision_ppv": F.try_divide(tp, tp + fp),
            "npv": F.try_divide(tn, tn + fn),
            "f1": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)),
            "mcc": F.coalesce(F.try_divide(tp * tn - fp * fn, mcc_base), F.lit(0.0)),
        }
    )


def _by_score(df: DataFrame, label: str, probability: str, group: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score with the sums above each score."""
    counts = df.groupBy(*group, F.col(probability).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return prefix_sums(
        counts, "threshold", {"pos": "pos", "neg": "neg"}, group=group, descending=True
    )


def roc_points(
    df: DataFrame, label: str, probability: str, group: Sequence[str] = ()
) -> DataFrame:
    """False and true positive rate at every distinct score."""
    s = _by_score(df, label, probability, group)
    return s.select(
        *group,
        "threshold",
        F.try_divide(F.col("neg_before") + F.col("neg"), F.col("neg_total")).alias("fpr"),
        F.try_divide(F.col("pos_before") + F.col("pos"), F.col("pos_total")).alias("tpr"),
    )


def ranking_metrics(
    df: DataFrame, label: str, probability: str, group: Sequence[str] = ()
) -> DataFrame:
    """ROC-AUC with half credit for ties, and step-wise average precision."""
    s = _by_score(df, label, probability, group)
    beaten = F.col("neg") * (F.col("pos_before") + F.col("pos") / 2)
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    pos, neg = F.max("pos_total").cast("double"), F.max("neg_total").cast("double")
    step = F.col("pos") * F.try_divide(tp, tp + fp)
    return s.groupBy(*group).agg(
        F.try_divide(F.sum(beaten), pos * neg).alias("roc_auc"),
        F.try_divide(F.sum(step), pos).alias("pr_auc"),
    )


def brier(df: DataFrame, label: str, probability: str, group: Sequence[str] = ()) -> DataFrame:
    gap = F.col(probability) - F.col(label)
    return df.groupBy(*group).agg(F.avg(gap * gap).alias("brier_score"))


def binary_report(
    df: DataFrame,
    label: str,
    probability: str,
    threshold: float = 0.5,
    group: Sequence[str] = (),
) -> DataFrame:
    """The whole report at one threshold: one row per group."""
    g = list(group)
    gap = F.col(probability) - F.col(label)
    cells = _cells(label, F.col(probability) >= threshold)
    cm = df.groupBy(*g).agg(
        *[c.alias(name) for name, c in cells.items()], F.avg(gap * gap).alias("brier_score")
    )
    ranked = ranking_metrics(df, label, probability, g)
    if g:
        out = rates(cm).join(ranked, g)
    else:
        both = ranked.agg(F.struct(F.max("roc_auc").alias("a"), F.max("pr_auc").alias("b"))).scalar()
        out = rates(cm).withColumn("_r", both).withColumns(
            {"roc_auc": F.col("_r.a"), "pr_auc": F.col("_r.b")}
        )
    return out.select(
        *g,
        F.lit(float(threshold)).alias("threshold"),
        *["TN", "FP", "FN", "TP", "accuracy", "balanced_accuracy", "sensitivity", "specificity"],
        *["precision_ppv", "npv", "f1", "mcc", "roc_auc", "pr_auc", "brier_score"],
    )


def class_report(df: DataFrame, label: str, prediction: str, group: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, their macro and weighted means,
    and the accuracy (in the ``f1`` column, as the usual report prints it)."""
    g = list(group)
    cells = df.groupBy(*g, F.col(label).alias("_y"), F.col(prediction).alias("_p")).agg(
        F.count("*").alias("n")
    )
    hit = F.when(F.col("_y") == F.col("_p"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = cells.select(
        *g,
        F.explode(
            F.array(
                F.struct(
                    F.col("_y").alias("c"), F.col("n").alias("support"), zero.alias("pred"),
                    hit.alias("tp"),
                ),
                F.struct(
                    F.col("_p").alias("c"), zero.alias("support"), F.col("n").alias("pred"),
                    zero.alias("tp"),
                ),
            )
        ).alias("s"),
    ).select(*g, "s.*")
    per = sides.groupBy(*g, "c").agg(
        F.sum("support").alias("support"), F.sum("pred").alias("pred"), F.sum("tp").alias("tp")
    )
    per = per.select(
        *g,
        F.col("c").cast("string").alias("class"),
        F.coalesce(F.try_divide("tp", "pred"), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide("tp", "support"), F.lit(0.0)).alias("recall"),
        F.coalesce(
            F.try_divide(F.col("tp") * 2, F.col("pred") + F.col("support")), F.lit(0.0)
        ).alias("f1"),
        "support",
        "tp",
    )
    names = ["precision", "recall", "f1"]
    total = F.sum("support")
    macro = per.groupBy(*g).agg(
        F.lit("macro avg").alias("class"),
        *[F.avg(m).alias(m) for m in names],
        total.alias("support"),
    )
    weighted = per.groupBy(*g).agg(
        F.lit("weighted avg").alias("class"),
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in names],
        total.alias("support"),
    )
    nothing = F.lit(None).cast("double")
    accuracy = per.groupBy(*g).agg(
        F.lit("accuracy").alias("class"),
        nothing.alias("precision"),
        nothing.alias("recall"),
        (F.sum("tp") / total).alias("f1"),
        total.alias("support"),
    )
    return (
        per.drop("tp").unionByName(accuracy).unionByName(macro).unionByName(weighted)
    )


def macro_f1(df: DataFrame, label: str, prediction: str, group: Sequence[str] = ()) -> DataFrame:
    """Mean F1 over the two classes 0 and 1, an absent class counting 0."""
    p, y = F.col(prediction) == 1, F.col(label) == 1
    tp, tn = F.count_if(p & y), F.count_if(~p & ~y)
    wrong = F.count_if(p != y)
    f1 = [F.coalesce(F.try_divide(2 * t, 2 * t + wrong), F.lit(0.0)) for t in (tp, tn)]
    return df.groupBy(*group).agg(((f1[0] + f1[1]) / 2).alias("macro_f1"))


def _threshold(i: Column) -> Column:
    return F.when(i == GRID_SIZE - 1, F.lit(GRID_STOP)).otherwise(
        i * F.lit(GRID_STEP) + F.lit(GRID_START)
    )


def threshold_grid(df: DataFrame, label: str, probability: str) -> DataFrame:
    """Confusion counts, sensitivity and specificity at each of the 181 thresholds.

    Each row finds the number of thresholds it passes by arithmetic, so the table is
    reduced to at most 182 counts and the grid is a running sum over those; rows are
    never paired with thresholds.
    """
    p = F.col(probability)
    guess = F.floor((p - GRID_START) / GRID_STEP).cast("int")
    guess = F.greatest(F.lit(0), F.least(guess, F.lit(GRID_SIZE - 1)))
    passed = (
        F.when(p < _threshold(guess), guess)
        .when((guess + 1 < GRID_SIZE) & (p >= _threshold(guess + 1)), guess + 2)
        .otherwise(guess + 1)
    )
    counts = (
        df.select(passed.alias("passed"), F.col(label).alias("_y"))
        .groupBy("passed")
        .agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
    )
    totals = df.agg(
        F.struct(
            F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
        )
    ).scalar()
    grid = df.sparkSession.range(GRID_SIZE).select(
        F.col("id").cast("int").alias("i"), (F.col("id") + 1).cast("int").alias("passed")
    )
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("i"))  # 181 rows
    run = grid.join(F.broadcast(counts), "passed", "left").select(
        "i",
        F.sum(F.coalesce("pos", F.lit(0))).over(above).alias("TP"),
        F.sum(F.coalesce("neg", F.lit(0))).over(above).alias("FP"),
    )
    out = run.withColumn("_t", totals).select(
        _threshold(F.col("i")).alias("threshold"),
        (F.col("_t.neg") - F.col("FP")).alias("TN"),
        "FP",
        (F.col("_t.pos") - F.col("TP")).alias("FN"),
        "TP",
    )
    return out.withColumns(
        {
            "sens": F.coalesce(F.try_divide(F.col("TP"), F.col("TP") + F.col("FN")), F.lit(0.0)),
            "spec": F.coalesce(F.try_divide(F.col("TN"), F.col("TN") + F.col("FP")), F.lit(0.0)),
        }
    )


def pick_threshold(grid: DataFrame, min_sensitivity: float = 0.9) -> DataFrame:
    """Highest specificity among the thresholds that keep the sensitivity (ties: lowest
    threshold)."""
    return (
        grid.where(F.col("sens") >= min_sensitivity).orderBy(F.desc("spec"), "threshold").limit(1)
    )


def expected_cost(grid: DataFrame, cost_fn: float, cost_fp: float) -> DataFrame:
    return grid.withColumn("cost", F.col("FN") * cost_fn + F.col("FP") * cost_fp)


def fold_scores(
    oof: DataFrame,
    label: str,
    probability: str,
    fold: str = "fold",
    threshold: float = 0.5,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The seven scores of each fold from out-of-fold probabilities; an undefined
    precision counts as 0, as in the usual scorer."""
    rep = binary_report(oof, label, probability, threshold, group=[*keep, fold])
    return rep.select(
        *keep,
        fold,
        "accuracy",
        "balanced_accuracy",
        F.coalesce("sensitivity", F.lit(0.0)).alias("recall"),
        F.coalesce("precision_ppv", F.lit(0.0)).alias("precision"),
        "f1",
        "roc_auc",
        "pr_auc",
    )


def summarize_folds(
    scores: DataFrame, names: Sequence[str] = BINARY_SCORES, keep: Sequence[str] = ()
) -> DataFrame:
    """Mean and population standard deviation over folds, one row per metric."""
    long = scores.unpivot(list(keep), list(names), "metric", "value")
    return long.groupBy(*keep, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )


def slr_cv_scores(
    df: DataFrame, feature: str, label: str, fold: str = "fold", k: int = 5
) -> DataFrame:
    """Cross-validated MAE / RMSE / R2 of the one-feature line: all k fits are
    conditional aggregates of one pass."""
    fits = []
    for f in range(k):
        y, x = (F.when(F.col(fold) != f, F.col(c)) for c in (label, feature))
        fits.append(
            F.struct(
                F.lit(f).alias(fold),
                F.regr_slope(y, x).alias("slope"),
                F.regr_intercept(y, x).alias("intercept"),
            )
        )
    lines = df.agg(F.array(*fits).alias("l")).select(F.explode("l").alias("l")).select("l.*")
    scored = df.join(F.broadcast(lines), fold).withColumn(
        "prediction", F.col("intercept") + F.col("slope") * F.col(feature)
    )
    per_fold = regression_metrics(scored, label, "prediction", group=[fold])
    return summarize_folds(per_fold, ["mae", "rmse", "r2"])
