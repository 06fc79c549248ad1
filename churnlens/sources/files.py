"""File sources and sinks: CSV ingest, per-run snapshots, split sink, report sink."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens import schema as S


class EmptyInputError(ValueError):
    pass


def read_customers_csv(spark: SparkSession, path: str, schema: T.StructType = S.RAW_SCHEMA) -> DataFrame:
    """Header CSV with an explicit schema (never inferred); error when the input has no rows."""
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    if df.isEmpty():
        raise EmptyInputError(f"no rows in {path}")
    return df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def snapshot(df: DataFrame, root: str, run_id: str, name: str = "raw") -> str:
    """Copy of an input under ``root/run_id=<id>/<name>``; each run gets its own folder."""
    path = f"{root.rstrip('/')}/run_id={run_id}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_splits(split_df: DataFrame, path: str) -> None:
    """Both splits in one write, partitioned by ``split`` so readers prune to one folder."""
    split_df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


REPORT_SCHEMA = T.StructType([
    T.StructField("split", T.StringType()),
    T.StructField("section", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("text", T.StringType()),
])


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType = REPORT_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def versioned_write(df: DataFrame, root: str, run_id: str) -> None:
    """Append one run's rows under ``root/run_id=<id>`` (partition column added by the writer)."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(root)


def read_run(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    return spark.read.parquet(root).where(F.col("run_id") == run_id)


def new_run_id() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%m_%d_%Y_%H_%M_%S_%f")


def write_snapshot(df: DataFrame, root: str) -> str:
    """A whole new copy of a table under ``root``, in a folder of its own; returns that folder.  A write
    that stops in the middle leaves the earlier snapshots as they are."""
    now = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")  # in order of time
    path = f"{root.rstrip('/')}/snapshot-{now}"
    df.write.parquet(path)
    return path


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """The newest complete snapshot under ``root`` (one with a success marker), or None."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop(root)):
        return None
    whole = [f.getPath() for f in fs.listStatus(hadoop(root)) if f.isDirectory() and fs.exists(hadoop(f.getPath(), "_SUCCESS"))]
    return max(whole, key=lambda p: p.getName()).toString() if whole else None
