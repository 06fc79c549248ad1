"""The customer table, derived from the driver's TPC-H-style tables.

``bank_customers`` has the 14-column raw churn schema (see ``schema.RAW_SCHEMA``) with one row per
``customer`` row.  It is a left join of ``customer`` to a per-customer aggregate of ``orders``:
the aggregate runs map-side-partial, its output is hash-partitioned on the customer key, and the
join reuses that partitioning, so the whole derivation costs one shuffle of ``orders``' partial
aggregates plus one of ``customer``.  Money is summed as integer cents so the result does not
depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hash_mod(col: str, mult: int, mod: int) -> Column:
    return (F.col(col) * F.lit(mult)) % F.lit(mod)


def order_summary(orders: DataFrame) -> DataFrame:
    """Per customer: order count, first/last order date, total price in cents."""
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("o_orderdate").alias("lo"),
        F.max("o_orderdate").alias("hi"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
    )


def churn_label(df: DataFrame) -> Column:
    score = (
        F.when(F.col("Geography") == "Germany", 16).otherwise(0)
        + F.when(F.col("Age") > 50, 28).otherwise(0)
        + F.when(F.col("IsActiveMember") == 0, 12).otherwise(0)
        + F.when(F.col("Gender") == "Female", 8).otherwise(0)
        + F.when(F.col("NumOfProducts") >= 3, 30).otherwise(0)
        + _hash_mod("CustomerId", 7561, 101)
    )
    return F.when(score >= 113, 1).otherwise(0).cast("int")


def bank_customers_from(customer: DataFrame, orders: DataFrame) -> DataFrame:
    o = order_summary(orders.select("o_custkey", "o_orderdate", "o_totalprice"))
    c = customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    j = c.join(o, c["c_custkey"] == o["o_custkey"], "left")
    age_bump = _hash_mod("c_custkey", 389, 23)
    n = F.coalesce(F.col("n"), F.lit(0))
    f = j.select(
        (F.col("c_custkey") + 1).alias("RowNumber"),
        F.col("c_custkey").alias("CustomerId"),
        F.col("c_name").alias("Surname"),
        (F.lit(300) + _hash_mod("c_custkey", 7919, 551)).cast("int").alias("CreditScore"),
        F.when(F.col("c_nationkey") % 4 == 2, "Germany")
        .when(F.col("c_nationkey") % 4 == 3, "Spain")
        .otherwise("France")
        .alias("Geography"),
        F.when(_hash_mod("c_custkey", 31, 11) < 5, "Female").otherwise("Male").alias("Gender"),
        (F.lit(18) + _hash_mod("c_custkey", 613, 53) + F.when(age_bump < 5, age_bump).otherwise(0))
        .cast("int")
        .alias("Age"),
        F.least(F.lit(10), F.coalesce(F.year("hi") - F.year("lo"), F.lit(0))).cast("int").alias("Tenure"),
        F.when((F.col("c_acctbal") <= 1000) | (_hash_mod("c_custkey", 17, 10) < 2), F.lit(0.0))
        .otherwise(F.col("c_acctbal") * 20)
        .cast("double")
        .alias("Balance"),
        F.when(n >= 15, 4).when(n >= 13, 3).when(n >= 9, 2).otherwise(1).cast("int").alias("NumOfProducts"),
        F.when(_hash_mod("c_custkey", 53, 10) < 7, 1).otherwise(0).cast("int").alias("HasCrCard"),
        F.when(_hash_mod("c_custkey", 71, 100) < 52, 1).otherwise(0).cast("int").alias("IsActiveMember"),
        (F.coalesce(F.col("cents"), F.lit(0)).cast("double") / 1000).alias("EstimatedSalary"),
    )
    return f.withColumn("Exited", churn_label(f))


def bank_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bank_customers_from(read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "orders"))


def predictions_from(orders: DataFrame) -> DataFrame:
    """Prediction log derived from orders: one scored row per order."""
    p = (F.col("o_orderkey") * 7919) % 1000
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        (p.cast("double") / 1000).alias("churn_probability"),
        F.when(p > 500, 1).otherwise(0).cast("int").alias("churn_prediction"),
        F.when(p >= 700, "High").when(p >= 500, "Medium").otherwise("Low").alias("risk_category"),
        F.concat(F.lit("v"), (F.col("o_orderkey") % 3).cast("string")).alias("model_version"),
        F.to_date("o_orderdate").alias("prediction_date"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions_from(read_table(spark, sf_dir, "orders"))


def scored_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a store in which two customers in five are not scored yet, for the operators that
    work on unscored customers."""
    return predictions(spark, sf_dir).where(F.col("customer_id") % 5 < 3)


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose the raw tables and the derived views to ``spark.sql``."""
    for name in ("customer", "orders", "events"):
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
    bank_customers(spark, sf_dir).createOrReplaceTempView("bank_customers")
    predictions(spark, sf_dir).createOrReplaceTempView("predictions")
