"""Run log, leaderboard, latest run, model registry snapshot and promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.operators.evaluate import AUTO_PROMOTE_F1, CHAMPION_MARGIN, champion_challenger

EVALUATION_REPORT_SCHEMA = T.StructType([
    T.StructField("section", T.StringType()), T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType()),
])


def run_log(leaderboard: DataFrame, params: list[str], metrics: list[str]) -> DataFrame:
    """Long experiment log ``(run_id, start_time, key, kind, value)``: one row per param and metric."""
    structs = [F.struct(F.lit(p).alias("key"), F.lit("param").alias("kind"), F.col(p).cast("string").alias("value")) for p in params]
    structs += [F.struct(F.lit(m).alias("key"), F.lit("metric").alias("kind"), F.col(m).cast("string").alias("value")) for m in metrics]
    return leaderboard.select("run_id", "start_time", F.explode(F.array(*structs)).alias("_r")).select("run_id", "start_time", "_r.*")


def best_model(leaderboard: DataFrame, metric: str = "f1") -> DataFrame:
    """Leaderboard ranked by ``metric`` descending (ties by run id); rank 1 is the best model."""
    # One row per candidate model: the ranking window is over a bounded, tiny frame.
    w = Window.orderBy(F.col(metric).desc(), F.col("run_id"))
    return leaderboard.withColumn("rank", F.row_number().over(w).cast("bigint"))


def latest_run(runs: DataFrame) -> DataFrame:
    """Newest run that produced a best model: order by start time descending, take one."""
    return runs.where(F.col("best_model").isNotNull()).orderBy(F.col("start_time").desc(), F.col("run_id").desc()).limit(1)


def promote(registry: DataFrame, candidate: DataFrame, model_name: str, manual_review: bool = True,
            threshold: float = AUTO_PROMOTE_F1) -> DataFrame:
    """Register ``candidate`` as version max(version)+1 in Staging; move it to Production iff
    F1 >= threshold and no manual review is required, archiving the model's previous Production
    version.  Versions and stages of other models are left alone.
    """
    next_version = registry.where(F.col("model_name") == model_name).agg(F.coalesce(F.max("version"), F.lit(0)) + 1).scalar()
    promote_now = (F.col("f1") >= threshold) & F.lit(not manual_review)
    new = candidate.select(
        F.lit(model_name).alias("model_name"),
        next_version.cast("int").alias("version"),
        "run_id",
        "f1",
        F.when(promote_now, "Production").otherwise("Staging").alias("stage"),
    )
    new_is_prod = new.agg(F.max((F.col("stage") == "Production").cast("int"))).scalar()
    old = registry.select(
        "model_name", "version", "run_id", "f1",
        F.when((F.col("model_name") == model_name) & (F.col("stage") == "Production") & (new_is_prod == 1), "Archived").otherwise(F.col("stage")).alias("stage"),
    )
    return old.unionByName(new)


def evaluation_report(current: DataFrame | None, challenger: DataFrame, margin: float = CHAMPION_MARGIN) -> DataFrame:
    """Long report ``(section, metric, value)`` of a one-row challenger: its metrics, the production
    model's F1 (null if there is none), and the comparison that decides on acceptance."""
    c = champion_challenger(current, challenger, margin).select("current_f1", "improvement", "accepted")
    # Two frames of one row: the decision columns enter as scalar subqueries.
    row = challenger.withColumns({name: c.select(name).scalar() for name in c.columns})
    live = F.col("current_f1") > 0
    entries = [("trained_model", m, F.col(of)) for m, of in (("f1_score", "f1"), *((m, m) for m in ("precision", "recall", "accuracy", "roc_auc")))]
    entries += [
        ("production_model", "f1_score", F.when(live, F.col("current_f1"))),
        ("production_model", "exists", F.lit(0 if current is None else 1)),
        ("comparison", "improvement", F.col("improvement")), ("comparison", "threshold", F.lit(margin)),
        ("comparison", "is_accepted", F.col("accepted")),
    ]
    structs = [F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"), v.cast("double").alias("value")) for s, m, v in entries]
    return row.select(F.explode(F.array(*structs)).alias("_e")).select("_e.*")
