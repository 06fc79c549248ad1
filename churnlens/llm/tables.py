"""Small helpers shared by the operators of this subpackage: inputs, partitions, checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
