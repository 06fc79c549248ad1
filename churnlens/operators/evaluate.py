"""Binary-classification evaluation on ``(label, prediction[, score])`` frames, distributed.

Counts come from one conditional aggregate; probability AUC and ROC points are exact (ties
get mid-ranks) via two-phase running sums over distinct scores -- no binning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions.prefix import running_sums

# Quality-gate thresholds of the training job.
MIN_TEST_F1 = 0.60
MAX_F1_GAP = 0.05
CHAMPION_MARGIN = 0.02
AUTO_PROMOTE_F1 = 0.60


def _div(a: Column, b: Column) -> Column:
    """a / b, 0.0 when b is 0 (sklearn's zero_division=0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction", keys: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    aggs = [
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    ]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def metrics_from_confusion(cm: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, F1 (0 when undefined) and hard-label AUC = (TPR + TNR) / 2."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    pos, neg = tp + fn, tn + fp
    auc = F.when((pos == 0) | (neg == 0), F.lit(0.0)).otherwise((tp / pos + tn / neg) / 2)
    checked_n = F.when(n == 0, F.raise_error(F.lit("empty input: no rows to evaluate"))).otherwise(n)
    return cm.select(
        *keys,
        checked_n.cast("bigint").alias("n"),
        F.round(_div(tp + tn, n), 6).alias("accuracy"),
        F.round(_div(tp, tp + fp), 6).alias("precision"),
        F.round(_div(tp, tp + fn), 6).alias("recall"),
        F.round(_div(2 * tp, 2 * tp + fp + fn), 6).alias("f1"),
        F.round(auc, 6).alias("roc_auc"),
    )


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", keys: Sequence[str] = ()) -> DataFrame:
    return metrics_from_confusion(confusion(df, label, pred, keys), keys)


def auc_from_scores(df: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC (Mann-Whitney with mid-ranks for ties) per key group."""
    keys = list(keys)
    y = F.col(label).cast("int")
    counts = df.groupBy(*keys, F.col(score).cast("double").alias("_s")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    cum = running_sums(counts, keys, "_s", ["neg"])
    part = cum.groupBy(*keys).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))).alias("u"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("q"),
    )
    return part.select(
        *keys,
        F.round(F.when((F.col("p") == 0) | (F.col("q") == 0), F.lit(None).cast("double")).otherwise(F.col("u") / (F.col("p") * F.col("q"))), 6).alias("roc_auc"),
    )


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """One ROC point per distinct score (threshold), from the highest score down."""
    keys = list(keys)
    y = F.col(label).cast("int")
    counts = df.groupBy(*keys, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(y == 1).alias("tp_at"), F.count_if(y == 0).alias("fp_at")
    )
    cum = running_sums(counts, keys, "threshold", ["tp_at", "fp_at"], descending=True)
    j = cum.withColumns({"P": F.col("tot_tp_at"), "N": F.col("tot_fp_at")})
    return j.select(
        *keys,
        "threshold",
        F.round(_div(F.col("cum_fp_at"), F.col("N")), 6).alias("fpr"),
        F.round(_div(F.col("cum_tp_at"), F.col("P")), 6).alias("tpr"),
    )


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class precision/recall/F1/support plus accuracy, macro and weighted averages (4 dp)."""
    cm = confusion(df, label, pred)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    # class 1 is the positive class; class 0 swaps the roles of the cells
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1_1, f1_0 = _div(2 * tp, 2 * tp + fp + fn), _div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _div(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"), s.cast("bigint").alias("support"))

    rows = F.array(
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("accuracy", acc, acc, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted avg", _div(p0 * s0 + p1 * s1, n), _div(r0 * s0 + r1 * s1, n), _div(f1_0 * s0 + f1_1 * s1, n), n),
    )
    out = cm.select(F.explode(rows).alias("_r")).select("_r.*")
    return out.select("class", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1_score")], "support")


def business_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", keys: Sequence[str] = ()) -> DataFrame:
    cm = confusion(df, label, pred, keys)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    actual, predicted = tp + fn, tp + fp
    return cm.select(
        *keys,
        F.col("tn").alias("true_negatives"),
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
        F.col("tp").alias("true_positives"),
        F.round(_div(actual, n), 6).alias("actual_churn_rate"),
        F.round(_div(predicted, n), 6).alias("predicted_churn_rate"),
        F.round(_div(tp, actual), 6).alias("churn_capture_rate"),
        F.round(_div(fp, fp + tn), 6).alias("false_alarm_rate"),
        F.round(_div(fn, actual), 6).alias("missed_churn_rate"),
    )


def train_test_gap(metrics: DataFrame, threshold: float = 0.5, split_col: str = "split") -> DataFrame:
    """|F1 train - F1 test|, |acc train - acc test| and the overfit flag (either above threshold)."""
    w = metrics.groupBy().pivot(split_col, ["train", "test"]).agg(F.first("f1").alias("f1"), F.first("accuracy").alias("acc"))
    f1_gap = F.abs(F.col("train_f1") - F.col("test_f1"))
    acc_gap = F.abs(F.col("train_acc") - F.col("test_acc"))
    return w.select(
        F.col("train_f1"), F.col("test_f1"),
        F.round(f1_gap, 6).alias("f1_gap"), F.round(acc_gap, 6).alias("accuracy_gap"),
        ((f1_gap > threshold) | (acc_gap > threshold)).cast("int").alias("is_overfit"),
    )


def quality_gates(gap: DataFrame, min_f1: float = MIN_TEST_F1, max_gap: float = MAX_F1_GAP) -> DataFrame:
    """Fail when test F1 < min_f1; warn when the train/test F1 gap exceeds max_gap."""
    return gap.select(
        "test_f1", "f1_gap",
        (F.col("test_f1") >= min_f1).cast("int").alias("passed"),
        (F.col("f1_gap") > max_gap).cast("int").alias("overfit_warning"),
    )


def champion_challenger(current: DataFrame | None, challenger: DataFrame, margin: float = CHAMPION_MARGIN) -> DataFrame:
    """Accept the challenger iff new F1 - current F1 > margin, or when there is no current model.

    Both inputs are one-row metric frames scored on the same holdout.
    """
    new = challenger.select(F.col("f1").alias("new_f1"))
    if current is None:
        return new.select("new_f1", F.lit(0.0).alias("current_f1"), F.round("new_f1", 6).alias("improvement"), F.lit(1).alias("accepted"))
    # The incumbent's F1 enters as a scalar subquery (one value), not as a join.
    j = new.withColumn("current_f1", current.select(F.max("f1")).scalar())
    imp = F.col("new_f1") - F.col("current_f1")
    return j.select(
        "new_f1", "current_f1", F.round(imp, 6).alias("improvement"),
        F.when(F.col("current_f1").isNull() | (imp > margin), 1).otherwise(0).alias("accepted"),
    )
