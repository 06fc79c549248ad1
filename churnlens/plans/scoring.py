"""Batch scoring: fetch unscored customers -> score -> tier -> append predictions -> mark scored -> alerts.

Idempotent: the fetch is an anti join against the predictions table, so a second run over the
same inputs appends nothing.  New prediction ids continue the table's ids in customer order,
assigned by exact two-phase running counts (no single-partition ``row_number``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens import schema as S
from churnlens.functions import features as FX
from churnlens.functions.prefix import running_sums
from churnlens.sources import files, store

# Fixed value: the rule scorer's probability is RiskScore divided by its maximum (sum of weights).
RISK_SCORE_MAX = 11.8
RULE_MODEL_VERSION = "rule_v1"

Scorer = Callable[[DataFrame], DataFrame]


def rule_scorer(customers: DataFrame) -> DataFrame:
    """Deterministic scorer: P(churn) = RiskScore / max score; input in store (snake_case) columns."""
    back = {v: k for k, v in S.STORE_RENAMES.items()}
    raw = customers.withColumnsRenamed({c: back[c] for c in customers.columns if c in back})
    scored = FX.risk_score(raw)
    return scored.select(
        F.col("CustomerId").alias("customer_id"), F.round(F.col("RiskScore") / F.lit(RISK_SCORE_MAX), 6).alias("churn_probability")
    )


def model_scorer(pipeline_model, id_col: str = "customer_id") -> Scorer:
    """Scorer from a fitted raw-rows PipelineModel (preprocessing + classifier)."""
    from pyspark.ml.functions import vector_to_array

    back = {v: k for k, v in S.STORE_RENAMES.items()}

    def score(customers: DataFrame) -> DataFrame:
        raw = customers.withColumnsRenamed({c: back[c] for c in customers.columns if c in back})
        out = pipeline_model.transform(raw)
        return out.select(F.col("CustomerId").alias(id_col), F.round(vector_to_array("probability")[1], 6).alias("churn_probability"))

    return score


def fetch_new(customers: DataFrame, predictions: DataFrame) -> DataFrame:
    """Customers with no prediction yet (left anti join on customer_id).

    The prediction ids are de-duplicated first (map-side partial aggregate), so a customer holding
    a large share of all predictions becomes one row instead of a skewed join partition.
    """
    return customers.join(predictions.select("customer_id").distinct(), "customer_id", "left_anti")


def to_prediction_rows(scored: DataFrame, base_id, model_version: str) -> DataFrame:
    p = F.col("churn_probability")
    ranked = running_sums(scored.withColumn("_one", F.lit(1)), [], "customer_id", ["_one"])
    return ranked.select(
        (F.lit(base_id) + F.col("cum__one")).cast("bigint").alias("id"),
        "customer_id",
        p.alias("churn_probability"),
        (p > 0.5).cast("int").alias("churn_prediction"),
        FX.risk_tier(p).alias("risk_category"),
        F.lit(model_version).alias("model_version"),
        F.current_date().alias("prediction_date"),
    )


@dataclass
class ScoringResult:
    appended: DataFrame
    alerts: DataFrame
    test_data: DataFrame
    rows_appended: int


def score_and_append(spark: SparkSession, customers: DataFrame, predictions_path: str, scorer: Scorer,
                     model_version: str = RULE_MODEL_VERSION) -> tuple[DataFrame, int]:
    """Score customers that have no row in the predictions table yet and append them."""
    current = spark.read.parquet(predictions_path)
    base = current.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = fetch_new(customers, current.select("customer_id"))
    rows = to_prediction_rows(scorer(new), base, model_version)
    n = store.insert_dataframe(rows, predictions_path, "append", table="predictions")
    appended = spark.read.parquet(predictions_path).where(F.col("id") > F.lit(base))
    return appended, n


def batch_scoring(spark: SparkSession, test_data: DataFrame, predictions_path: str, test_data_path: str,
                  scorer: Scorer = rule_scorer, model_version: str = RULE_MODEL_VERSION) -> ScoringResult:
    appended, n = score_and_append(spark, test_data, predictions_path, scorer, model_version)
    # All rows that this model version has written: a run that appended but stopped before marking is
    # made good here.
    written = spark.read.parquet(predictions_path).where(F.col("model_version") == model_version)
    marked = store.mark_scored(test_data, written.select("customer_id"))
    snapshot = files.write_snapshot(marked, test_data_path)
    alerts = appended.where(F.col("churn_probability") > 0.7)
    return ScoringResult(appended, alerts, spark.read.parquet(snapshot), n)
