"""SQL-store queries: views, joins, anti joins, snapshot updates, limits, parameterised SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens.operators.explore import monthly_churn_stats
from churnlens.plans.oracle_base import with_ctes
from churnlens.functions.features import exact_avg_round_sql
from churnlens.plans.registry import query
from churnlens.session import scratch_path
from churnlens.sources import store
from churnlens.sources.fixture import bank_customers, predictions, scored_predictions

_HR = ["customer_id", "geography", "gender", "age", "balance", "churn_probability", "prediction_date"]


@query(
    "high_risk_customers",
    with_ctes(
        """SELECT t.customer_id, t.geography, t.gender, t.age, t.balance, p.churn_probability, p.prediction_date
FROM test_data t JOIN preds p ON t.customer_id = p.customer_id
WHERE p.risk_category = 'High' ORDER BY p.churn_probability DESC""",
        "PRED",
        "TEST",
    ),
)
def q_high_risk_customers(spark, sf_dir):
    t = store.test_data(spark, sf_dir)
    p = predictions(spark, sf_dir).where(F.col("risk_category") == "High")
    # Ties on the probability are broken by customer, date and prediction id, so the range
    # partitioning of the sort can split a hot probability value (or a hot customer) across tasks.
    ordered = t.join(p, "customer_id", "inner").orderBy(
        F.col("churn_probability").desc(), F.col("customer_id"), F.col("prediction_date"), p["id"]
    )
    return ordered.select(*_HR)


@query(
    "fetch_new_customers",
    with_ctes(
        """SELECT t.* EXCLUDE (is_scored) FROM test_data t
WHERE NOT EXISTS (SELECT 1 FROM preds p WHERE p.customer_id = t.customer_id)""",
        "SCORED",
        "TEST",
    ),
)
def q_fetch_new_customers(spark, sf_dir):
    t = store.test_data(spark, sf_dir).drop("is_scored", "scored_at")
    return t.join(scored_predictions(spark, sf_dir).select("customer_id").distinct(), "customer_id", "left_anti")


_SCORED = """scored AS (
  SELECT t.customer_id, CAST(CASE WHEN s.customer_id IS NOT NULL THEN 1 ELSE t.is_scored END AS INT) AS is_scored
  FROM test_data t LEFT JOIN (SELECT DISTINCT customer_id FROM preds) s ON s.customer_id = t.customer_id)"""


def _scored_snapshot(spark, sf_dir):
    ids = scored_predictions(spark, sf_dir).select("customer_id")
    return store.mark_scored(store.test_data(spark, sf_dir), ids)


@query("mark_scored", with_ctes("SELECT customer_id, is_scored FROM scored", "SCORED", "TEST", extra=_SCORED))
def q_mark_scored(spark, sf_dir):
    return _scored_snapshot(spark, sf_dir).select("customer_id", "is_scored")


@query(
    "unscored_rows",
    with_ctes("SELECT customer_id FROM scored WHERE is_scored = 0", "SCORED", "TEST", extra=_SCORED),
)
def q_unscored_rows(spark, sf_dir):
    return _scored_snapshot(spark, sf_dir).where(F.col("is_scored") == 0).select("customer_id")


@query(
    "alert_filter",
    with_ctes("SELECT id, customer_id, churn_probability, risk_category FROM preds WHERE churn_probability > 0.7", "PRED"),
)
def q_alert_filter(spark, sf_dir):
    return predictions(spark, sf_dir).where(F.col("churn_probability") > 0.7).select(
        "id", "customer_id", "churn_probability", "risk_category"
    )


@query("training_data_limit", with_ctes("SELECT * FROM training_data ORDER BY id LIMIT 100", "TRAIN"))
def q_training_data_limit(spark, sf_dir):
    return store.training_data(spark, sf_dir).orderBy("id").limit(100)


@query(
    "sample_head",
    with_ctes("SELECT id, customer_id, credit_score, geography, gender FROM training_data ORDER BY id LIMIT 5", "TRAIN"),
)
def q_sample_head(spark, sf_dir):
    return store.training_data(spark, sf_dir).orderBy("id").limit(5).select("id", "customer_id", "credit_score", "geography", "gender")


@query(
    "churn_rate_sql",
    with_ctes(
        "SELECT count(*) AS total, CAST(sum(exited) AS BIGINT) AS churned, round(avg(exited) * 100, 2) AS churn_rate FROM training_data",
        "TRAIN",
    ),
)
def q_churn_rate_sql(spark, sf_dir):
    store.training_data(spark, sf_dir).createOrReplaceTempView("training_data")
    return spark.sql(
        "SELECT COUNT(*) AS total, SUM(exited) AS churned, ROUND(AVG(exited) * 100, 2) AS churn_rate FROM training_data"
    )


@query(
    "sql_query",
    with_ctes(
        "SELECT customer_id, geography, age, balance FROM training_data WHERE geography = 'Germany' AND age > 40",
        "TRAIN",
    ),
)
def q_sql_query(spark, sf_dir):
    store.training_data(spark, sf_dir).createOrReplaceTempView("training_data")
    return spark.sql(
        "SELECT customer_id, geography, age, balance FROM training_data WHERE geography = ? AND age > ?",
        args=["Germany", 40],
    )


@query("bulk_load", with_ctes("SELECT * FROM training_data", "TRAIN"))
def q_bulk_load(spark, sf_dir):
    path = scratch_path(spark, "training_data")
    source = bank_customers(spark, sf_dir)
    store.insert_dataframe(store.bulk_load(source), path, "replace", table="training_data")
    loaded = spark.read.parquet(path)
    if loaded.count() != source.count():
        raise AssertionError("bulk load row count mismatch")
    return loaded.drop("created_at", "updated_at")


@query("table_append", with_ctes("SELECT * FROM preds", "PRED"))
def q_table_append(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    p = predictions(spark, sf_dir)
    cut = F.col("prediction_date") < F.lit("1997-01-01").cast("date")
    store.insert_dataframe(p.where(cut), path, "replace", table="predictions")
    store.insert_dataframe(p.where(~cut), path, "append", table="predictions")
    return spark.read.parquet(path).drop("created_at")


def _table_ddl_sql() -> str:
    from churnlens import schema as S

    cat = ", ".join(
        f"('{t}', {i}, '{f.name}', '{f.dataType.simpleString()}', {str(f.nullable).lower()})"
        for t in S.STORE_SCHEMAS for i, f in enumerate(S.STORE_SCHEMAS[t].fields)
    )
    return with_ctes(
        """SELECT c.table_name, CAST(c.position AS INT) AS position, c.column_name, c.data_type, c.nullable,
       CAST(n.row_count AS BIGINT) AS row_count
FROM cat c LEFT JOIN cnt n ON n.table_name = c.table_name""",
        "PRED",
        "TEST",
        "TRAIN",
        extra=f"""cat(table_name, position, column_name, data_type, nullable) AS (VALUES {cat}),
cnt AS (SELECT 'training_data' AS table_name, count(*) AS row_count FROM training_data
        UNION ALL SELECT 'test_data', count(*) FROM test_data UNION ALL SELECT 'predictions', count(*) FROM preds
        UNION ALL SELECT 'model_metadata', 0 UNION ALL SELECT 'monitoring_metrics', 0)""",
    )


@query("table_ddl", _table_ddl_sql())
def q_table_ddl(spark, sf_dir):
    """Create the five store tables, load the derived rows, return the column catalogue with row counts."""
    root = scratch_path(spark, "store")
    catalogue = store.create_tables(spark, root)
    store.insert_into(store.training_data(spark, sf_dir), "training_data")
    store.insert_into(store.test_data(spark, sf_dir), "test_data")
    store.insert_into(predictions(spark, sf_dir), "predictions")
    counts = store.table_stats({t: spark.table(f"{store.DATABASE}.{t}") for t in ("training_data", "test_data", "predictions", "model_metadata", "monitoring_metrics")})
    return catalogue.join(counts, "table_name", "left")


@query(
    "table_stats",
    with_ctes(
        """SELECT 'training_data' AS table_name, count(*) AS row_count FROM training_data
UNION ALL SELECT 'test_data', count(*) FROM test_data
UNION ALL SELECT 'predictions', count(*) FROM preds""",
        "PRED",
        "TEST",
        "TRAIN",
    ),
)
def q_table_stats(spark, sf_dir):
    return store.table_stats(
        {
            "training_data": store.training_data(spark, sf_dir),
            "test_data": store.test_data(spark, sf_dir),
            "predictions": predictions(spark, sf_dir),
        }
    )


@query(
    "monitoring_append",
    with_ctes(
        """SELECT m.metric_name, m.metric_value, CAST(month || '-01' AS DATE) AS metric_date, month AS details
FROM (SELECT strftime(prediction_date, '%Y-%m') AS month, count(*) AS n, """ + exact_avg_round_sql("churn_probability", 4) + """ AS avg_p,
             count(CASE WHEN risk_category = 'High' THEN 1 END) AS hi FROM preds GROUP BY 1) s,
     LATERAL (SELECT 'prediction_count' AS metric_name, CAST(n AS DOUBLE) AS metric_value
              UNION ALL SELECT 'avg_churn_probability', avg_p
              UNION ALL SELECT 'high_risk_share', round(hi / n, 6)) m""",
        "PRED",
    ),
)
def q_monitoring_append(spark, sf_dir):
    stats = monthly_churn_stats(predictions(spark, sf_dir))
    rows = store.monitoring_rows(
        stats,
        [
            ("prediction_count", F.col("total_predictions")),
            ("avg_churn_probability", F.col("avg_churn_prob")),
            ("high_risk_share", F.round(F.col("high_risk_count") / F.col("total_predictions"), 6)),
        ],
        F.to_date(F.concat(F.col("month"), F.lit("-01"))),
        F.col("month"),
    )
    path = scratch_path(spark, "monitoring_metrics")
    store.insert_dataframe(store.with_ids(rows, "metric_date", "metric_name"), path, "append", table="monitoring_metrics")
    return spark.read.parquet(path).select("metric_name", "metric_value", "metric_date", "details")
