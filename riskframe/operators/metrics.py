"""Binary-classifier evaluation on a ``(label, score)`` table.

Counts are one aggregate; curves and rank metrics first collapse the rows
to one row per distinct score (map-side partial aggregation), then take
running totals with bucket offsets (``rank.running_totals``), so no step
orders the raw rows in a single task. Division by zero gives 0, as the
reference's library does with ``zero_division=0``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_ratio
from ..spec import DEFAULT_THRESHOLD, MIN_RECALL
from .rank import running_totals


def complete(df: DataFrame, *cols: str) -> DataFrame:
    """Rows on which an evaluation can count: label and score (or prediction) known. Every operator
    here leaves out the others; :func:`unscored` counts them."""
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def unscored(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``(n_rows, n_no_label, n_no_score)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(label).isNull()).alias("n_no_label"),
                  F.count_if(F.col(score).isNull()).alias("n_no_score"))


def _pos(label: str) -> Column:
    return (F.col(label) == 1).cast("long")


def predict_at(score: str, threshold: float) -> Column:
    return (F.col(score) >= F.lit(float(threshold))).cast("int")


def confusion(df: DataFrame, label: str = "label", score: str = "score", threshold: float = DEFAULT_THRESHOLD,
              prediction: str | None = None, group_cols: Sequence[str] = ()) -> DataFrame:
    """``(tn, fp, fn, tp)``, always four counts (a missing class counts 0)."""
    df = complete(df, label, prediction or score)
    pred = F.col(prediction) if prediction else predict_at(score, threshold)
    y = F.col(label) == 1
    p = pred == 1
    aggs = [
        F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"),
    ]
    return df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)


def ratios(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    return {
        "accuracy": safe_ratio(tp + tn, tp + tn + fp + fn),
        "recall": safe_ratio(tp, tp + fn),
        "precision": safe_ratio(tp, tp + fp),
        "f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
        "specificity": safe_ratio(tn, tn + fp),
    }


def binary_metrics(df: DataFrame, label: str = "label", score: str = "score",
                   threshold: float = DEFAULT_THRESHOLD, group_cols: Sequence[str] = ()) -> DataFrame:
    """Counts plus accuracy, recall, precision, f1 at a threshold."""
    c = confusion(df, label, score, threshold, group_cols=group_cols)
    r = ratios(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    return c.select(*group_cols, "tn", "fp", "fn", "tp", *[v.alias(k) for k, v in r.items() if k != "specificity"])


def score_groups(df: DataFrame, label: str = "label", score: str = "score", group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score (per group): ``(score, pos, neg)``."""
    return complete(df, label, score).groupBy(*group_cols, F.col(score).cast("double").alias("score")).agg(
        F.sum(_pos(label)).alias("pos"), F.sum(1 - _pos(label)).alias("neg"))


def curve_table(df: DataFrame, label: str = "label", score: str = "score", group_cols: Sequence[str] = ()) -> DataFrame:
    """``(score, pos, neg, cum_pos, cum_neg)`` per distinct score from the highest down, per group.

    The one table that AUC, average precision and both curves are read from;
    the raw rows are scanned once.
    """
    return running_totals(score_groups(df, label, score, group_cols), "score", ["pos", "neg"], descending=True, partition_cols=group_cols)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", group_cols: Sequence[str] = (),
            curve: DataFrame | None = None) -> DataFrame:
    """Area under ROC, ties count one half (Mann-Whitney), per group."""
    cum = curve_table(df, label, score, group_cols) if curve is None else curve
    part = cum.groupBy(*group_cols).agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.sum(F.col("pos") * F.col("cum_neg")).alias("above"),
        F.sum(F.col("pos") * F.col("neg")).alias("tied"))
    u = F.col("P") * F.col("N") - F.col("above") + F.col("tied") * 0.5
    return part.select(*group_cols, F.try_divide(u, F.col("P") * F.col("N")).alias("roc_auc"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score", curve: DataFrame | None = None) -> DataFrame:
    """Sum over thresholds (high to low) of (R_n - R_{n-1}) * P_n (step-wise)."""
    cum = curve_table(df, label, score) if curve is None else curve
    return cum.agg(
        F.try_divide(F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))),
                     F.sum("pos")).alias("average_precision"))


def _totals(curve: DataFrame) -> tuple[Column, Column]:
    """All positives and negatives: two numbers."""
    t = curve.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    return F.lit(t["P"] or 0).cast("double"), F.lit(t["N"] or 0).cast("double")


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", curve: DataFrame | None = None) -> DataFrame:
    """``(threshold, fpr, tpr)`` at each distinct score, high to low, plus
    the start point (NULL threshold, 0, 0). Every distinct score is kept."""
    cum = curve_table(df, label, score) if curve is None else curve
    P, N = _totals(cum)
    points = cum.select(F.col("score").alias("threshold"),
                        F.try_divide(F.col("cum_neg"), N).alias("fpr"),
                        F.try_divide(F.col("cum_pos"), P).alias("tpr"))
    start = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(start)


def pr_curve(df: DataFrame, label: str = "label", score: str = "score", curve: DataFrame | None = None) -> DataFrame:
    """``(threshold, precision, recall)`` for distinct scores down to the first
    one reaching full recall, plus the end point (NULL, 1, 0)."""
    cum = curve_table(df, label, score) if curve is None else curve
    P, _ = _totals(cum)
    pts = cum.where((F.col("cum_pos") - F.col("pos") < P))
    points = pts.select(F.col("score").alias("threshold"),
                        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                        F.coalesce(F.try_divide(F.col("cum_pos"), P), F.lit(1.0)).alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(end)


def _threshold_bucket(score: Column, lo: int, hi: int) -> Column:
    """Largest i in [lo, hi] with score >= i / 100, else lo - 1 (exact at the edges)."""
    b0 = F.floor(score * 100).cast("int")
    b = (F.when(score >= (b0 + 1) / F.lit(100.0), b0 + 1)
         .when(score < b0 / F.lit(100.0), b0 - 1).otherwise(b0))
    return F.when(score.isNull(), F.lit(lo - 1)).otherwise(F.greatest(F.lit(lo - 1), F.least(F.lit(hi), b)))


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score", lo: int = 10, hi: int = 90) -> DataFrame:
    """Recall / precision / f1 at thresholds i / 100 for i in [lo, hi], one pass.

    Each row lands in the bucket of the highest threshold it reaches; a
    reverse running sum over the (hi - lo + 2)-row bucket table gives the
    counts at every threshold.
    """
    spark = df.sparkSession
    counted = complete(df, label, score).groupBy(_threshold_bucket(F.col(score).cast("double"), lo, hi).alias("i")).agg(
        F.sum(_pos(label)).alias("pos"), F.sum(1 - _pos(label)).alias("neg"))
    grid = spark.range(lo - 1, hi + 1).select(F.col("id").cast("int").alias("i"))
    full = grid.join(counted, "i", "left").fillna(0, ["pos", "neg"])
    w = Window.orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)  # <= 82 rows
    w_all = Window.partitionBy()
    sw = full.select(
        "i",
        F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"),
        F.sum("pos").over(w_all).alias("P"),
    ).where(F.col("i") >= lo)
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("P") - tp
    return sw.select(
        (F.col("i").cast("double") / F.lit(100.0)).alias("threshold"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def optimal_threshold(df: DataFrame, label: str = "label", score: str = "score", min_recall: float = MIN_RECALL,
                      lo: int = 10, hi: int = 89, default: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Best f1 among thresholds with recall >= min_recall (lowest threshold on a
    tie, f1 must beat 0); otherwise the default threshold. Metrics at the pick."""
    sw = threshold_sweep(df, label, score, lo, max(hi, int(round(default * 100))))
    good = (F.col("threshold") <= F.lit(hi / 100.0)) & (F.col("recall") >= F.lit(min_recall)) & (F.col("f1") > 0)
    best = F.max(F.when(good, F.struct("f1", (-F.col("threshold")).alias("neg")))).over(Window.partitionBy())  # over <= 81 rows
    picked = sw.withColumn("__t", F.coalesce(-best["neg"], F.lit(float(default))))
    return picked.where(F.col("threshold") == F.col("__t")).select("threshold", "recall", "precision", "f1")


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E5: per-class precision / recall / f1 / support, then accuracy, macro and weighted averages.

    The accuracy row carries the accuracy in ``f1`` and the row count in ``support``.
    """
    cm = df.groupBy(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    support = cm.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    predicted = cm.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    correct = cm.where(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    per = (support.join(predicted, "cls", "full").join(correct, "cls", "left")
           .fillna(0, ["support", "predicted", "tp"]))
    per = per.select(
        F.col("cls").alias("label"),
        safe_ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("support")).alias("recall"),
        safe_ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        F.col("support").cast("bigint").alias("support"),
        F.col("tp"),
    )
    acc = per.agg(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                  F.lit(None).cast("double").alias("recall"),
                  safe_ratio(F.sum("tp"), F.sum("support")).alias("f1"), F.sum("support").cast("bigint").alias("support"))
    macro = per.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("bigint").alias("support"))
    weighted = per.agg(
        F.lit("weighted avg").alias("label"),
        *[safe_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in ("precision", "recall", "f1")],
        F.sum("support").cast("bigint").alias("support"))
    return per.drop("tp").unionByName(acc).unionByName(macro).unionByName(weighted)


def cv_metrics(df: DataFrame, fold: str = "fold", label: str = "label", score: str = "score",
               threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Per-fold recall, precision, f1, balanced accuracy (what the reference's
    hard-label "roc_auc" scorer computes) and the real ROC-AUC from scores."""
    c = confusion(df, label, score, threshold, group_cols=[fold])
    r = ratios(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    per = c.select(fold, r["recall"].alias("recall"), r["precision"].alias("precision"), r["f1"].alias("f1"),
                   ((r["recall"] + r["specificity"]) / 2).alias("balanced_accuracy"))
    auc = roc_auc(df, label, score, group_cols=[fold])
    return per.join(auc, fold)


def cv_summary(per_fold: DataFrame, metrics: Sequence[str] = ("recall", "precision", "f1", "balanced_accuracy", "roc_auc")) -> DataFrame:
    """``(metric, mean, std)`` over folds, population std."""
    long = per_fold.unpivot([], list(metrics), "metric", "value")
    return long.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
