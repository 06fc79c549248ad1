"""Queries of the pipeline operators, one ``opN_<name>`` each, and their DuckDB SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import ann, bpe, conversations, divergence, fingerprint, html, mixing, quality, simhash, substring, urlfilter, vecdedup, warc
from churnlens.llm.tables import table
from churnlens.plans.registry import shipped
from churnlens.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str):
    def deco(fn):
        QUERIES[name] = shipped(fn)
        return fn

    return deco


@_query("op1_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@_query("op2_simhash_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return rows.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@_query("op3_warc")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(warc.plan_records(table(spark, sf_dir, "pages"), min_bytes=1000), path)
    return warc.read_back(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@_query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


@_query("op6_source_mix")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@_query("op7_ann")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
    return found.select("query_id", "rank", "vec_id", "score")


@_query("op8_url_filter")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urlfilter.fit(urlfilter.labelled_urls())
    return urlfilter.judge(table(spark, sf_dir, "pages"), model).select("page_id", "host", "path", "rule", "verdict")


@_query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(quality.fold() == 0, F.lit(False)).alias("held_out")
    return quality.score(docs, model, with_text=False).select("doc_id", held, "score", "predicted")


@_query("op10_vector_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vecdedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@_query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damaged_and_repaired(table(spark, sf_dir, "conversations"))


@_query("op12_document_fingerprints")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_pairs(table(spark, sf_dir, "documents"))


@_query("op13_source_divergence")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op6_source_mix"] = mixing.oracle_sql()
ORACLES["op11_conversation_repair"] = conversations.oracle_sql()
ORACLES["op12_document_fingerprints"] = fingerprint.oracle_sql()
ORACLES["op13_source_divergence"] = divergence.oracle_sql()
