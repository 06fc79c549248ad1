"""The SQL store re-expressed as Parquet tables and temp views.

Tables: ``training_data``, ``test_data``, ``predictions``, ``model_metadata``,
``monitoring_metrics`` (schemas in ``churnlens.schema``).  There are no UPDATE statements on
Parquet: a changed table is derived by a join and written as a new snapshot; the path being read
is never overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens import schema as S
from churnlens.functions.prefix import running_sums
from churnlens.sources.fixture import bank_customers


def rename_to_store(df: DataFrame) -> DataFrame:
    """CamelCase -> snake_case for the columns present (missing ones are ignored)."""
    return df.withColumnsRenamed({k: v for k, v in S.STORE_RENAMES.items() if k in df.columns})


def bulk_load(raw: DataFrame) -> DataFrame:
    """CSV rows -> ``training_data`` rows: rename, drop RowNumber/Surname if present.

    The insertion-order id of the store is the source row number.
    """
    with_id = raw.withColumn("id", F.col("RowNumber").cast("bigint")) if "RowNumber" in raw.columns else raw.withColumn(
        "id", F.monotonically_increasing_id()
    )
    out = rename_to_store(with_id.drop(*[c for c in ("RowNumber", "Surname") if c in raw.columns]))
    return out.select("id", *[c for c in S.STORE_RENAMES.values() if c in out.columns])


def training_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bulk_load(bank_customers(spark, sf_dir))


def test_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers to score: features without the label, ``is_scored = 0``."""
    t = bulk_load(bank_customers(spark, sf_dir)).drop("exited")
    return t.withColumns({"is_scored": F.lit(0).cast("int"), "scored_at": F.lit(None).cast("timestamp")})


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Project ``df`` onto a store schema: cast, fill DEFAULTs, add missing nullable columns."""
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
            if f.name in defaults:
                c = F.coalesce(c, defaults[f.name])
        elif f.name in defaults:
            c = defaults[f.name]
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def store_defaults(table: str) -> dict[str, Column]:
    """Column DEFAULTs of a store table (built per call: Columns need an active session)."""
    now = F.current_timestamp()
    return {
        "training_data": {"created_at": now, "updated_at": now},
        "test_data": {"created_at": now, "is_scored": F.lit(0)},
        "predictions": {"created_at": now},
        "model_metadata": {"created_at": now, "status": F.lit("training")},
        "monitoring_metrics": {"created_at": now},
    }.get(table, {})


DATABASE = "churnlens_store"


def create_tables(spark: SparkSession, root: str, tables: Iterable[str] = S.STORE_SCHEMAS) -> DataFrame:
    """Each store table in the library's own database, over Parquet under ``root``; returns the column
    catalogue.  A table of that database that is not external, so that dropping it would delete data,
    is refused; tables of other databases are never touched."""
    rows = []
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    for name in tables:
        schema = S.STORE_SCHEMAS[name]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields)
        full = f"{DATABASE}.{name}"
        if spark.catalog.tableExists(full):
            if spark.catalog.getTable(full).tableType != "EXTERNAL":
                raise ValueError(f"{full} holds data of its own and is not replaced")
            spark.sql(f"DROP TABLE {full}")  # the catalogue entry; the files stay
        spark.sql(f"CREATE TABLE {full} ({cols}) USING parquet LOCATION '{root}/{name}'")
        for i, f in enumerate(schema.fields):
            rows.append((name, i, f.name, f.dataType.simpleString(), f.nullable))
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string, nullable boolean")


def _files(spark: SparkSession, path: str) -> set[str]:
    """Data files of a table path; a path that does not exist has none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return set()
    return {str(f.getPath()) for f in fs.listStatus(hadoop) if f.isFile() and not f.getPath().getName().startswith(("_", "."))}


def with_ids(df: DataFrame, *order: str, start: int = 0) -> DataFrame:
    """Consecutive ids from ``start + 1`` in the order of unique ``order`` columns (exact two-phase
    running counts; null ids never reach a table)."""
    keyed = df.withColumns({"_at": F.struct(*order), "_one": F.lit(1)})
    ranked = running_sums(keyed, [], "_at", ["_one"])
    return ranked.withColumn("id", (F.lit(start) + F.col("cum__one")).cast("bigint")).drop("_at", "_one", "cum__one", "tot__one")


def insert_into(df: DataFrame, table: str) -> None:
    """Append rows to a catalogue table, conformed to its schema (positional insert)."""
    conform(df, S.STORE_SCHEMAS[table], store_defaults(table)).write.insertInto(f"{DATABASE}.{table}")


def insert_dataframe(df: DataFrame, path: str, if_exists: str = "append", table: str | None = None) -> int:
    """Write ``df`` to a store table path; ``if_exists`` in {'append', 'replace', 'fail'}.

    An append is written to a folder of its own beside the table's files and moved in when it is whole, so
    a failed one leaves nothing in the table.  Returns the number of rows written, from the footers of
    exactly those files, whatever other writers add meanwhile."""
    if table is not None:
        df = conform(df, S.STORE_SCHEMAS[table], store_defaults(table))
    spark = df.sparkSession
    if if_exists != "append":
        df.write.mode({"replace": "overwrite", "fail": "errorifexists"}[if_exists]).parquet(path)
        return spark.read.parquet(path).count()
    run = f"{path.rstrip('/')}/_append-{uuid.uuid4().hex}"  # readers skip names that begin with _
    df.write.parquet(run)
    n = spark.read.schema(df.schema).parquet(run).count()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for file in sorted(_files(spark, run)):
        if not fs.rename(hadoop(file), hadoop(f"{path.rstrip('/')}/{file.rsplit('/', 1)[1]}")):
            raise OSError(f"could not move {file} into the table")
    fs.delete(hadoop(run), True)
    return n


def mark_scored(test: DataFrame, scored_ids: DataFrame, key: str = "customer_id", now: Column | None = None) -> DataFrame:
    """``UPDATE test_data SET is_scored = 1, scored_at = now WHERE customer_id IN (ids)`` as a new snapshot.

    A left join on the distinct id set (broadcast only if the planner measures it small).
    """
    now = now if now is not None else F.current_timestamp()
    ids = scored_ids.select(F.col(key)).distinct().withColumn("_hit", F.lit(True))
    j = test.join(ids, key, "left")
    return j.select(
        *[
            F.when(F.col("_hit"), F.lit(1)).otherwise(F.col("is_scored")).cast("int").alias("is_scored")
            if c == "is_scored"
            else F.when(F.col("_hit"), now).otherwise(F.col("scored_at")).cast("timestamp").alias("scored_at")
            if c == "scored_at"
            else F.col(c)
            for c in test.columns
        ]
    )


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """``{table: COUNT(*)}`` as rows, one aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def model_metadata_row(spark: SparkSession, metrics: DataFrame, model_name: str, model_version: str, algorithm: str,
                       run_id: str | None = None, status: str | None = None, next_id: int = 1) -> DataFrame:
    """One ``model_metadata`` row from a one-row metrics frame (f1/precision/recall/roc_auc/n)."""
    row = metrics.select(
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.lit(algorithm).alias("algorithm"),
        F.col("f1").alias("f1_score"),
        F.col("precision").alias("precision_score"),
        F.col("recall").alias("recall_score"),
        F.col("roc_auc").alias("roc_auc_score"),
        F.current_timestamp().alias("training_date"),
        F.col("n").cast("bigint").alias("training_records"),
        F.lit(run_id).cast("string").alias("mlflow_run_id"),
        F.lit(status).cast("string").alias("status"),
    )
    return conform(row.withColumn("id", F.lit(next_id).cast("bigint")), S.MODEL_METADATA_SCHEMA, store_defaults("model_metadata"))


def monitoring_rows(df: DataFrame, name_value: Sequence[tuple[str, Column]], date: Column, details: Column | None = None) -> DataFrame:
    """Rows in ``monitoring_metrics`` shape: one per (metric name, value) per input row."""
    structs = [F.struct(F.lit(n).alias("metric_name"), v.cast("double").alias("metric_value")) for n, v in name_value]
    out = df.select(F.explode(F.array(*structs)).alias("_m"), date.alias("metric_date"), (details if details is not None else F.lit(None).cast("string")).alias("details"))
    return out.select("_m.metric_name", "_m.metric_value", F.col("metric_date").cast("date").alias("metric_date"), "details")
