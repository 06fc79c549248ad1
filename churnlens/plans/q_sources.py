"""Source and sink queries: each writes to the shared scratch folder and reads the result back."""

from __future__ import annotations

from churnlens import schema as S
from churnlens.operators import ranking as R
from churnlens.plans.oracle_base import with_ctes
from churnlens.plans.registry import query
from churnlens.session import scratch_path
from churnlens.sources import files
from churnlens.sources.fixture import bank_customers


@query("csv_scan", with_ctes("SELECT * FROM bank_customers"))
def q_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(bank_customers(spark, sf_dir), path)
    return files.read_customers_csv(spark, path)


@query("raw_snapshot", with_ctes("SELECT * FROM bank_customers"))
def q_raw_snapshot(spark, sf_dir):
    root = scratch_path(spark, "runs")
    path = files.snapshot(bank_customers(spark, sf_dir), root, files.new_run_id())
    return spark.read.parquet(path)


@query("split_sink", with_ctes("SELECT * FROM split_customers", "SPLIT"))
def q_split_sink(spark, sf_dir):
    path = scratch_path(spark, "splits")
    files.write_splits(R.stratified_split(bank_customers(spark, sf_dir)), path)
    train = files.read_split(spark, path, "train")
    test = files.read_split(spark, path, "test")
    return train.unionByName(test).select(*[f.name for f in S.RAW_SCHEMA.fields], "split")


@query("run_versioning", with_ctes("SELECT * FROM bank_customers WHERE Exited = 1"))
def q_run_versioning(spark, sf_dir):
    """Two runs appended under run_id partitions; reading one run prunes to its folder."""
    root = scratch_path(spark, "versioned")
    first, second = files.new_run_id(), files.new_run_id() + "b"
    df = bank_customers(spark, sf_dir)
    files.versioned_write(df, root, first)
    files.versioned_write(df.where("Exited = 1"), root, second)
    return files.read_run(spark, root, second).drop("run_id")


def _report_oracle() -> str:
    from churnlens.plans.q_quality import _validation_sql

    return _validation_sql()


@query("report_sink", _report_oracle())
def q_report_sink(spark, sf_dir):
    from churnlens.plans.q_quality import validation_report_df

    path = scratch_path(spark, "report")
    files.write_report(validation_report_df(R.stratified_split(bank_customers(spark, sf_dir))), path)
    return files.read_report(spark, path)
