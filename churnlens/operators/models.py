"""Class weights, folds and the classifiers of ``pyspark.ml`` that the learners are compared with.

Estimator factories map the reference configurations onto Spark ML:
sklearn ``C`` becomes ``regParam = 1 / (C * sum(weights))`` with ``standardization=False``;
``class_weight='balanced'`` becomes a ``weight`` column ``n / (2 * n_class)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions.prefix import running_sums
from churnlens.operators import evaluate as E
from churnlens.operators.ranking import split_key
from churnlens.session import checkpoint_dir

SEED = 42


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (2 * n_c) per class and the positive-class multiplier n0 / n1."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    # Totals over the per-class rows only (one per class), so the input is scanned once.
    whole = Window.partitionBy()
    n = F.sum("n_c").over(whole)
    n0 = F.sum(F.when(F.col(label) == 0, F.col("n_c"))).over(whole)
    n1 = F.sum(F.when(F.col(label) == 1, F.col("n_c"))).over(whole)
    return counts.select(
        label,
        "n_c",
        (n / (2.0 * F.col("n_c"))).alias("weight"),
        (n0 / n1.cast("double")).alias("scale_pos_weight"),
    )


def with_weights(df: DataFrame, mode: str = "balanced", label: str = "label") -> DataFrame:
    """Attach ``weight``: balanced class weights, or 1 / (n0/n1) on positives for ``'pos_scale'``."""
    w = class_weights(df, label)
    if mode == "balanced":
        return df.join(F.broadcast(w.select(label, "weight")), label)  # two rows: one per class
    spw = w.select(F.first("scale_pos_weight")).scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, spw).otherwise(F.lit(1.0)))


def _reg(c: float, weight_sum: float) -> float:
    return 1.0 / (c * weight_sum)


def estimator(name: str, weight_sum: float | None = None):
    """Model configurations by name (fixed values)."""
    if name == "gbt_production":
        return GBTClassifier(maxIter=200, stepSize=0.05, maxDepth=4, subsamplingRate=0.8, seed=SEED)
    if name == "gbt_baseline":
        return GBTClassifier(maxIter=100, stepSize=0.1, maxDepth=3, seed=SEED)
    if name == "rf_baseline":
        return RandomForestClassifier(numTrees=100, maxDepth=10, featureSubsetStrategy="sqrt", weightCol="weight", seed=SEED)
    if name == "rf_tuned":
        return RandomForestClassifier(numTrees=294, maxDepth=11, minInstancesPerNode=9, impurity="entropy",
                                      featureSubsetStrategy="sqrt", weightCol="weight", seed=SEED)
    if name in ("logreg_baseline", "logreg_l2", "logreg_notebook"):
        c = {"logreg_baseline": 1.0, "logreg_l2": 0.1, "logreg_notebook": 1.0}[name]
        iters = 100 if name == "logreg_notebook" else 1000
        return LogisticRegression(regParam=_reg(c, weight_sum or 1.0), elasticNetParam=0.0, standardization=False,
                                  maxIter=iters, weightCol="weight")
    if name == "linear_svm":
        return LinearSVC(regParam=_reg(1.0, weight_sum or 1.0), standardization=False, maxIter=100, weightCol="weight")
    if name == "gbt_weighted":
        return GBTClassifier(maxIter=200, stepSize=0.05, maxDepth=5, subsamplingRate=0.8, featureSubsetStrategy="0.8",
                             weightCol="weight", seed=SEED)
    if name == "gbt_weighted_small":
        return GBTClassifier(maxIter=100, stepSize=0.1, maxDepth=6, weightCol="weight", seed=SEED)
    if name == "gbt_default":
        return GBTClassifier(maxIter=100, stepSize=0.3, maxDepth=6, seed=SEED)
    raise KeyError(name)


WEIGHT_MODE = {
    "rf_baseline": "balanced", "rf_tuned": "balanced", "logreg_baseline": "balanced", "logreg_l2": "balanced",
    "logreg_notebook": "balanced", "linear_svm": "balanced", "gbt_weighted": "pos_scale", "gbt_weighted_small": "pos_scale",
}


def positive_score(df: DataFrame, prob_col: str = "probability", raw_col: str = "rawPrediction") -> DataFrame:
    """``score`` = P(class 1) when the model gives probabilities, else the margin of class 1."""
    if prob_col in df.columns:
        return df.withColumn("score", vector_to_array(prob_col)[1])
    return df.withColumn("score", vector_to_array(raw_col)[1])


def fit(name: str, train: DataFrame):
    """Fit a named configuration on ``(features, label[, weight])`` rows of the train split."""
    # Boosting checkpoints its lineage every ``checkpointInterval`` (10) iterations only when the
    # context has a checkpoint folder, so a lost executor never replays hundreds of iterations.
    checkpoint_dir(train.sparkSession)
    mode = WEIGHT_MODE.get(name)
    data = with_weights(train, mode) if mode else train
    ws = data.agg(F.sum("weight")).first()[0] if mode == "balanced" else None
    return estimator(name, ws).fit(compact(data))


def evaluate_model(model, feats: DataFrame, keys: Sequence[str] = ("split",)) -> DataFrame:
    """Metrics per split: hard-label metrics plus the exact probability AUC."""
    scored = positive_score(model.transform(feats))
    hard = E.classification_metrics(scored, keys=list(keys))
    auc = E.auc_from_scores(scored, keys=list(keys)).withColumnRenamed("roc_auc", "roc_auc_prob")
    return hard.join(auc, list(keys))


def persist(df: DataFrame) -> DataFrame:
    """Iterative learners pass over their input many times: keep it in memory, spilling to disk."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


#: Rows of one task of a learner: each iteration costs a task per partition, however few its rows.
ROWS_PER_TASK = 50_000


def compact(df: DataFrame) -> DataFrame:
    """``df`` in as few partitions as its rows need; a frame that is longer than that keeps its own."""
    return df.coalesce(max(1, -(-df.count() // ROWS_PER_TASK)))


def stratified_folds(df: DataFrame, k: int, label: str = "label", id_col: str = "CustomerId") -> DataFrame:
    """``fold`` = (rank within class by hash order) mod k, via exact two-phase running counts."""
    keyed = df.withColumns({"_k": F.struct(split_key(id_col).alias("h"), F.col(id_col).alias("i")), "_one": F.lit(1)})
    ranked = running_sums(keyed, [label], "_k", ["_one"])
    return ranked.withColumn("fold", ((F.col("cum__one") - 1) % k).cast("int")).drop("_k", "_one", "cum__one", "tot__one")
