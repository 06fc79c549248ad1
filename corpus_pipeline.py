"""A training corpus from raw documents: quality filter, near and substring de-duplication, mixing,
tokenising.  Each stage reads what its predecessor wrote and works on all of it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import bpe, mixing, quality, simhash, substring
from churnlens.llm.queries import vocabulary
from churnlens.llm.tables import table
from churnlens.session import checkpoint_dir, ship_package

#: No SQL: the classifier is a fitted model.  The tests compare the stages with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, unchanged."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of smallest id, rows without an id last, then that
    of the smallest text hash."""
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages; ``n_chars`` follows the text."""
    rows = substring.deduplicate(docs, window=13, with_text=True)
    chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumns({"text": F.col("kept_text"), "n_chars": chars}).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents repeated or cut to the words that are taken."""
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return bpe.round_trip(docs, vocabulary())


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_dedup", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("source_mix", mixing_stage),
    ("byte_bpe", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex[:12]}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
