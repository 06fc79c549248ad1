"""Data-quality operators on hand-made edge cases."""

from pyspark.sql import functions as F

from churnlens import schema as S
from churnlens.operators import profile as P


def test_fk_summary_counts_orphans_hot_and_null_keys(spark):
    # Key 1 holds most child rows; key 9 and the null key have no parent.
    child = spark.createDataFrame([(1,)] * 30 + [(2,)] * 3 + [(9,)] * 4 + [(None,)] * 2, "customer_id long")
    parent = spark.createDataFrame([(1,), (2,), (2,), (3,)], "customer_id long")
    r = P.fk_summary(child, parent, "customer_id").first()
    assert (r.n_rows, r.orphan_rows) == (39, 6)
    assert P.fk_orphans(child, parent, "customer_id").count() == r.orphan_rows


def test_fk_summary_empty_child(spark):
    child = spark.createDataFrame([], "customer_id long")
    parent = spark.createDataFrame([(1,)], "customer_id long")
    r = P.fk_summary(child, parent, "customer_id").first()
    assert (r.n_rows, r.orphan_rows) == (0, 0)


def test_validation_report_states_missing_values_copies_and_a_missing_column(spark):
    from churnlens.operators import ranking as R
    from churnlens.plans.q_quality import validation_report_df
    from churnlens.sources.fixture import bank_customers

    from conftest import SF_SMALL

    df = R.stratified_split(bank_customers(spark, SF_SMALL)).drop("Gender")
    df = df.withColumn("Balance", F.when(F.col("CustomerId") % 2 == 0, F.col("Balance")))
    report = validation_report_df(df.unionByName(df.where("split = 'test'")))
    rows = {(r.split, r.section, r.column, r.metric): (r.value, r.text) for r in report.where("section <> 'drift'").collect()}
    tests, odd = df.where("split = 'test'").count(), df.where("split = 'test' AND CustomerId % 2 = 1").count()
    assert rows["test", "duplicates", "*", "rows"][0] == tests and rows["train", "duplicates", "*", "rows"][0] == 0
    assert rows["test", "missing", "Balance", "count"][0] == 2 * odd
    assert rows["all", "status", "*", "validation_status"][0] == 0 and rows["test", "status", "*", "categorical_valid"][0] == 0
    assert rows["test", "status", "*", "numerical_valid"][0] == 1
    assert rows["all", "error", "Gender", "categorical"][1] == "Missing categorical column: Gender"
    assert ("test", "missing", S.TARGET, "count") not in rows
