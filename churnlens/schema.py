"""Column roles and explicit schemas of the customer table (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and roles of the raw customer table.
ID_COLUMNS = ("RowNumber", "CustomerId", "Surname")
NUMERIC_COLUMNS = ("CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "EstimatedSalary")
CATEGORICAL_COLUMNS = ("Geography", "Gender")
BINARY_COLUMNS = ("HasCrCard", "IsActiveMember")
TARGET = "Exited"
# Scoring input order of the 10 features.
FEATURE_COLUMNS = (
    "CreditScore", "Geography", "Gender", "Age", "Tenure",
    "Balance", "NumOfProducts", "HasCrCard", "IsActiveMember", "EstimatedSalary",
)
# Columns required by the training DAG gate.
DAG_REQUIRED_COLUMNS = ("CreditScore", "Age", "Balance", "Exited")

# CamelCase -> snake_case names of the SQL store.
STORE_RENAMES = {
    "CustomerId": "customer_id",
    "CreditScore": "credit_score",
    "Geography": "geography",
    "Gender": "gender",
    "Age": "age",
    "Tenure": "tenure",
    "Balance": "balance",
    "NumOfProducts": "num_of_products",
    "HasCrCard": "has_credit_card",
    "IsActiveMember": "is_active_member",
    "EstimatedSalary": "estimated_salary",
    "Exited": "exited",
}

RAW_SCHEMA = T.StructType([
    T.StructField("RowNumber", T.LongType()),
    T.StructField("CustomerId", T.LongType()),
    T.StructField("Surname", T.StringType()),
    T.StructField("CreditScore", T.IntegerType()),
    T.StructField("Geography", T.StringType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("Tenure", T.IntegerType()),
    T.StructField("Balance", T.DoubleType()),
    T.StructField("NumOfProducts", T.IntegerType()),
    T.StructField("HasCrCard", T.IntegerType()),
    T.StructField("IsActiveMember", T.IntegerType()),
    T.StructField("EstimatedSalary", T.DoubleType()),
    T.StructField("Exited", T.IntegerType()),
])

# Store tables (SQL layer); ids are bigint, flags int, money double.
TRAINING_DATA_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("credit_score", T.IntegerType()),
    T.StructField("geography", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("balance", T.DoubleType()),
    T.StructField("num_of_products", T.IntegerType()),
    T.StructField("has_credit_card", T.IntegerType()),
    T.StructField("is_active_member", T.IntegerType()),
    T.StructField("estimated_salary", T.DoubleType()),
    T.StructField("exited", T.IntegerType(), False),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

TEST_DATA_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("credit_score", T.IntegerType()),
    T.StructField("geography", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("balance", T.DoubleType()),
    T.StructField("num_of_products", T.IntegerType()),
    T.StructField("has_credit_card", T.IntegerType()),
    T.StructField("is_active_member", T.IntegerType()),
    T.StructField("estimated_salary", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("is_scored", T.IntegerType()),
    T.StructField("scored_at", T.TimestampType()),
])

PREDICTIONS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("churn_probability", T.DoubleType(), False),
    T.StructField("churn_prediction", T.IntegerType(), False),
    T.StructField("risk_category", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("prediction_date", T.DateType(), False),
    T.StructField("created_at", T.TimestampType()),
])

MODEL_METADATA_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("model_name", T.StringType(), False),
    T.StructField("model_version", T.StringType(), False),
    T.StructField("algorithm", T.StringType()),
    T.StructField("f1_score", T.DoubleType()),
    T.StructField("precision_score", T.DoubleType()),
    T.StructField("recall_score", T.DoubleType()),
    T.StructField("roc_auc_score", T.DoubleType()),
    T.StructField("training_date", T.TimestampType()),
    T.StructField("training_records", T.LongType()),
    T.StructField("mlflow_run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("promoted_at", T.TimestampType()),
])

MONITORING_METRICS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("metric_date", T.DateType(), False),
    T.StructField("details", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

STORE_SCHEMAS = {
    "training_data": TRAINING_DATA_SCHEMA,
    "test_data": TEST_DATA_SCHEMA,
    "predictions": PREDICTIONS_SCHEMA,
    "model_metadata": MODEL_METADATA_SCHEMA,
    "monitoring_metrics": MONITORING_METRICS_SCHEMA,
}

# NOT NULL columns per store table (the DDL's constraints).
NOT_NULL = {
    "training_data": ("customer_id", "exited"),
    "test_data": ("customer_id",),
    "predictions": ("customer_id", "churn_probability", "churn_prediction", "prediction_date"),
    "model_metadata": ("model_name", "model_version"),
    "monitoring_metrics": ("metric_name", "metric_date"),
}
