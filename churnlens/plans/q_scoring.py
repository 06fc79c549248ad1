"""Batch and streaming scoring queries (rule scorer, so results are value-checked in SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens.plans import scoring as SC
from churnlens.plans.oracle_base import with_ctes
from churnlens.plans.registry import query
from churnlens.session import scratch_path
from churnlens.sources import store
from churnlens.sources.fixture import scored_predictions, read_table
from churnlens.streaming.scoring import EVENTS_SCHEMA, stream_scoring

_OUT = ["customer_id", "churn_probability", "churn_prediction", "risk_category", "model_version"]


def _seed_predictions(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    store.insert_dataframe(scored_predictions(spark, sf_dir), path, "replace", table="predictions")
    return path


def _scored_sql(new_ids: str) -> str:
    return f"""new AS ({new_ids}),
sc AS (SELECT r.CustomerId AS customer_id, round(r.RiskScore / CAST(11.8 AS DOUBLE), 6) AS churn_probability
       FROM risk r JOIN new ON new.customer_id = r.CustomerId)"""


_TIER = "CASE WHEN churn_probability >= 0.7 THEN 'High' WHEN churn_probability >= 0.5 THEN 'Medium' ELSE 'Low' END"


@query(
    "batch_scoring",
    with_ctes(
        f"""SELECT CAST((SELECT max(id) FROM preds) + row_number() OVER (ORDER BY customer_id) AS BIGINT) AS id, customer_id,
       churn_probability, CAST(churn_probability > 0.5 AS INT) AS churn_prediction, {_TIER} AS risk_category,
       'rule_v1' AS model_version FROM sc""",
        "SCORED",
        "TEST",
        "RISK",
        extra=_scored_sql("SELECT customer_id FROM test_data t WHERE NOT EXISTS (SELECT 1 FROM preds p WHERE p.customer_id = t.customer_id)"),
    ),
)
def q_batch_scoring(spark, sf_dir):
    path = _seed_predictions(spark, sf_dir)
    res = SC.batch_scoring(spark, store.test_data(spark, sf_dir), path, scratch_path(spark, "test_data"))
    return res.appended.select("id", *_OUT)


@query(
    "stream_scoring",
    with_ctes(
        f"""SELECT customer_id, churn_probability, CAST(churn_probability > 0.5 AS INT) AS churn_prediction,
       {_TIER} AS risk_category, 'rule_v1' AS model_version FROM sc""",
        "SCORED",
        "TEST",
        "RISK",
        extra=_scored_sql(
            """SELECT DISTINCT e.user_id AS customer_id FROM events e JOIN test_data t ON t.customer_id = e.user_id
               WHERE NOT EXISTS (SELECT 1 FROM preds p WHERE p.customer_id = e.user_id)"""
        ),
    ),
)
def q_stream_scoring(spark, sf_dir):
    path = _seed_predictions(spark, sf_dir)
    base = spark.read.parquet(path).agg(F.max("id")).first()[0]
    events_dir = scratch_path(spark, "events")
    # The arriving files: the events table, range-partitioned on time (one file per shuffle
    # partition), consumed in about four micro-batches.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ev = read_table(spark, sf_dir, "events").select(*[F.col(f.name).cast(f.dataType) for f in EVENTS_SCHEMA.fields])
    ev.repartitionByRange(n, "ts").write.parquet(events_dir)
    stream_scoring(spark, events_dir, store.test_data(spark, sf_dir), path, scratch_path(spark, "stream-ckpt"),
                   files_per_trigger=max(1, n // 4))
    return spark.read.parquet(path).where(F.col("id") > base).select(*_OUT)
