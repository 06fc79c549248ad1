"""Data-quality and profiling operators (one aggregation pass each, long-form outputs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens import schema as S


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns whose Spark type is numeric (pandas ``select_dtypes('number')``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _long(df: DataFrame, names: Sequence[str], metric_exprs: dict[str, callable], keys: Sequence[str] = ()) -> DataFrame:
    """Compute ``metric(col)`` for every column in one aggregate, then unpivot to one row per column."""
    aggs = [fn(c).alias(f"{m}__{c}") for c in names for m, fn in metric_exprs.items()]
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{m}__{c}`").alias(m) for m in metric_exprs]) for c in names
    ]
    return wide.select(*keys, F.explode(F.array(*structs)).alias("_r")).select(*keys, "_r.*")


def is_missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def missing_values(df: DataFrame) -> DataFrame:
    """Per column: missing count and % of rows; only columns with at least one missing value."""
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.count_if(is_missing(df, c)).alias(f"m__{c}") for c in df.columns]
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"`m__{c}`").alias("missing_count")) for c in df.columns]
    out = wide.select("__n", F.explode(F.array(*structs)).alias("_r")).select("__n", "_r.*")
    return out.where("missing_count > 0").select(
        "column", "missing_count", F.round(F.col("missing_count") * 100.0 / F.col("__n"), 6).alias("missing_pct")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact duplicate rows (null equals null): rows - distinct rows, keep-first semantics."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(
        F.sum("_c").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.col("_c") - 1).cast("bigint").alias("n_duplicates"),
    ).select(F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "n_distinct", F.coalesce("n_duplicates", F.lit(0)).alias("n_duplicates"))


def dtype_report(df: DataFrame) -> DataFrame:
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")


def numeric_stats(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """min, max, mean and sample std per numeric column (optionally per key, e.g. split)."""
    cols = [c for c in numeric_columns(df) if c not in keys]
    out = _long(
        df,
        cols,
        {
            "min": lambda c: F.min(c).cast("double"),
            "max": lambda c: F.max(c).cast("double"),
            "mean": lambda c: F.avg(c),
            "std": lambda c: F.stddev_samp(c),
        },
        keys,
    )
    return out.select(*keys, "column", *[F.round(m, 6).alias(m) for m in ("min", "max", "mean", "std")])


def category_counts(df: DataFrame, columns: Sequence[str] = S.CATEGORICAL_COLUMNS + S.BINARY_COLUMNS) -> DataFrame:
    """value_counts for each column (nulls dropped), as ``(column, value, count, pct)``."""
    stacked = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
        ).alias("_r")
    ).select("_r.*")
    counts = stacked.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("column").agg(F.sum("count").alias("_t"))
    return counts.join(totals, "column").select(
        "column", "value", "count", F.round(F.col("count") * 100.0 / F.col("_t"), 6).alias("pct")
    )


def target_distribution(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Class counts and %, churn rate and imbalance ratio n0/n1, in one pass."""
    agg = df.agg(
        F.count_if(F.col(target) == 0).alias("n0"),
        F.count_if(F.col(target) == 1).alias("n1"),
        F.count(target).alias("n"),
    )
    rows = F.explode(
        F.array(
            F.struct(F.lit(0).alias("label"), F.col("n0").alias("count")),
            F.struct(F.lit(1).alias("label"), F.col("n1").alias("count")),
        )
    )
    return agg.select("n", "n0", "n1", rows.alias("_r")).select(
        F.col("_r.label").alias("label"),
        F.col("_r.count").alias("count"),
        F.round(F.col("_r.count") * 100.0 / F.col("n"), 6).alias("pct"),
        F.round(F.col("n1") * 100.0 / F.col("n"), 6).alias("churn_rate_pct"),
        F.round(F.try_divide(F.col("n0").cast("double"), F.col("n1")), 6).alias("imbalance_ratio"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: non-null, null, null % (2 dp, half-even like pandas), distinct non-null values.
    One scan: rows, nulls and distinct values all come from the counts per (column, value)."""
    stacked = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in df.columns])).alias("_r")
    ).select("_r.*")
    n, cnt = F.col("_n"), F.col("cnt")
    per_value = stacked.groupBy("column", "v").agg(F.count(F.lit(1)).alias("cnt"))
    per_column = per_value.groupBy("column").agg(
        F.sum(cnt).alias("_n"),
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), cnt)), F.lit(0)).cast("bigint").alias("non_null"),
        F.count("v").alias("nunique"),
    )
    return per_column.select(
        "column", "non_null", (n - F.col("non_null")).alias("null_count"),
        F.bround((n - F.col("non_null")) * 100.0 / n, 2).alias("null_pct"), "nunique",
    )


def zero_counts(df: DataFrame, columns: Sequence[str] = S.NUMERIC_COLUMNS) -> DataFrame:
    """Zeros and % per numeric column, only where there is at least one zero."""
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c) == 0).alias(f"z__{c}") for c in columns])
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"`z__{c}`").alias("zero_count")) for c in columns]
    return (
        wide.select("__n", F.explode(F.array(*structs)).alias("_r"))
        .select("__n", "_r.*")
        .where("zero_count > 0")
        .select("column", "zero_count", F.round(F.col("zero_count") * 100.0 / F.col("__n"), 6).alias("zero_pct"))
    )


def not_null_violations(tables: dict[str, DataFrame], not_null: dict[str, Sequence[str]]) -> DataFrame:
    """``(table_name, column_name, null_count)`` for every declared NOT NULL column."""
    parts = []
    for t, df in tables.items():
        cols = [c for c in not_null.get(t, ()) if c in df.columns]
        if not cols:
            continue
        wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        structs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols]
        parts.append(wide.select(F.lit(t).alias("table_name"), F.explode(F.array(*structs)).alias("_r")).select("table_name", "_r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def key_duplicates(df: DataFrame, key: str, table_name: str) -> DataFrame:
    """Keys seen more than once and the extra rows they add (pandas ``duplicated().sum()``)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
    return per_key.agg(
        F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("extra_rows")
    ).select(F.lit(table_name).alias("table_name"), F.lit(key).alias("key_column"), "duplicate_keys", "extra_rows")


def fk_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose ``key`` has no match in ``parent`` (left anti join)."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def fk_summary(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """``n_rows`` of ``child`` and ``orphan_rows`` (no ``key`` match in ``parent``) in one scan.

    The child is first counted per key (map-side partial aggregate, so a key holding a third of
    the rows becomes one row per task), then joined one-to-one with the distinct parent keys.
    """
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    parents = parent.select(key).distinct().withColumn("_hit", F.lit(True))
    j = per_key.join(parents, key, "left")
    return j.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
    )


def schema_findings(df: DataFrame, target: str | None = S.TARGET) -> list[tuple[str, str, bool, str]]:
    """Expected columns present?  ``(check, column, ok, message)`` for every expectation."""
    present = set(df.columns)
    rows = []
    for c in S.FEATURE_COLUMNS:
        rows.append(("required", c, c in present, "" if c in present else f"Missing required column: {c}"))
    if target:
        rows.append(("target", target, target in present, "" if target in present else f"Missing target column: {target}"))
    for c in S.NUMERIC_COLUMNS:
        ok = c in present and isinstance(df.schema[c].dataType, T.NumericType)
        rows.append(("numeric", c, ok, "" if ok else f"Numeric column missing or not numeric: {c}"))
    for c in S.CATEGORICAL_COLUMNS:
        rows.append(("categorical", c, c in present, "" if c in present else f"Missing categorical column: {c}"))
    return rows


def schema_check(df: DataFrame, target: str | None = S.TARGET) -> DataFrame:
    """``schema_findings`` as a report with one row per expectation."""
    return df.sparkSession.createDataFrame(schema_findings(df, target), "check string, column string, ok boolean, message string")


def dag_gate(df: DataFrame, min_rows: int = 1000, required: Sequence[str] = S.DAG_REQUIRED_COLUMNS) -> DataFrame:
    """Training-DAG gate: row count, churn rate, missing required columns, pass flag (one agg)."""
    missing = [c for c in required if c not in df.columns]
    rate = F.avg(S.TARGET) if S.TARGET in df.columns else F.lit(None).cast("double")
    return df.agg(F.count(F.lit(1)).alias("row_count"), rate.alias("_rate")).select(
        "row_count",
        F.round("_rate", 6).alias("churn_rate"),
        F.lit(len(missing)).alias("missing_columns"),
        F.when((F.col("row_count") >= min_rows) & F.lit(not missing), 1).otherwise(0).alias("passed"),
    )


def assert_gate(gate: DataFrame) -> dict:
    """Driver-side raise on a one-row gate result (the DAG task's failure)."""
    row = gate.first().asDict()
    if not row["passed"]:
        raise ValueError(f"data gate failed: {row}")
    return row
