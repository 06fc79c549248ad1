"""Data-quality, profiling and gate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens import schema as S
from churnlens.operators import explore as X
from churnlens.operators import profile as P
from churnlens.operators import ranking as R
from churnlens.operators import stattests as ST
from churnlens.plans.oracle_base import with_ctes
from churnlens.plans.registry import query
from churnlens.plans.sqlgen import stack_sql
from churnlens.sources import store
from churnlens.sources.fixture import bank_customers, predictions

_ALL = [f.name for f in S.RAW_SCHEMA.fields]
_RAW_NUMERIC = [f.name for f in S.RAW_SCHEMA.fields if f.name not in ("Surname", "Geography", "Gender")]


def _missing_sql() -> str:
    cols = ", ".join(
        f"CAST(count_if({c} IS NULL{' OR isnan(' + c + ')' if c in ('Balance', 'EstimatedSalary') else ''}) AS BIGINT) AS m_{c}" for c in _ALL
    )
    rows = "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", m_{c} AS missing_count, n FROM a" for c in _ALL)
    return with_ctes(
        f"SELECT \"column\", missing_count, round(missing_count * 100.0 / n, 6) AS missing_pct FROM ({rows}) t WHERE missing_count > 0",
        extra=f"a AS (SELECT count(*) AS n, {cols} FROM bank_customers)",
    )


@query("missing_values", _missing_sql())
def q_missing_values(spark, sf_dir):
    return P.missing_values(bank_customers(spark, sf_dir))


@query(
    "duplicate_rows",
    with_ctes(
        f"""SELECT coalesce(CAST(sum(c) AS BIGINT), 0) AS n_rows, count(*) AS n_distinct, coalesce(CAST(sum(c - 1) AS BIGINT), 0) AS n_duplicates
FROM (SELECT {', '.join(_ALL)}, count(*) AS c FROM bank_customers GROUP BY ALL) g"""
    ),
)
def q_duplicate_rows(spark, sf_dir):
    return P.duplicate_rows(bank_customers(spark, sf_dir))


# DuckDB type names of the derived table, as Spark's simple type strings.
_DTYPE_SQL = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
       WHEN 'DOUBLE' THEN 'double' ELSE lower(column_type) END"""


@query(
    "dtype_report",
    with_ctes(
        f"""SELECT CAST(row_number() OVER () - 1 AS INT) AS position, column_name AS "column", {_DTYPE_SQL} AS dtype
FROM (DESCRIBE bank_customers) d"""
    ),
)
def q_dtype_report(spark, sf_dir):
    return P.dtype_report(bank_customers(spark, sf_dir))


@query(
    "numeric_stats",
    with_ctes(
        """SELECT split, feature AS column, round(min(value), 6) AS min, round(max(value), 6) AS max,
       round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std
FROM long GROUP BY split, feature""",
        "SPLIT",
        extra=f"long AS ({stack_sql('split_customers', _RAW_NUMERIC, keep=['split'], cast='DOUBLE')})",
    ),
)
def q_numeric_stats(spark, sf_dir):
    return P.numeric_stats(R.stratified_split(bank_customers(spark, sf_dir)), keys=["split"])


_CATS = S.CATEGORICAL_COLUMNS + S.BINARY_COLUMNS


@query(
    "category_counts",
    with_ctes(
        """SELECT feature AS column, value, count(*) AS count,
       round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY feature), 6) AS pct
FROM long WHERE value IS NOT NULL GROUP BY feature, value""",
        extra=f"long AS ({stack_sql('bank_customers', _CATS)})",
    ),
)
def q_category_counts(spark, sf_dir):
    return P.category_counts(bank_customers(spark, sf_dir))


@query(
    "target_distribution",
    with_ctes(
        """SELECT label, count, round(count * 100.0 / n, 6) AS pct, round(n1 * 100.0 / n, 6) AS churn_rate_pct,
       round(CAST(n0 AS DOUBLE) / n1, 6) AS imbalance_ratio
FROM (SELECT CAST(count_if(Exited = 0) AS BIGINT) AS n0, CAST(count_if(Exited = 1) AS BIGINT) AS n1, count(Exited) AS n FROM bank_customers) a,
     (SELECT 0 AS label UNION ALL SELECT 1) l, LATERAL (SELECT CASE WHEN label = 0 THEN n0 ELSE n1 END AS count) c"""
    ),
)
def q_target_distribution(spark, sf_dir):
    return P.target_distribution(bank_customers(spark, sf_dir))


def _profile_sql() -> str:
    nn = ", ".join(f"count({c}) AS nn_{c}" for c in _ALL)
    rows = "\nUNION ALL ".join(f"SELECT '{c}' AS column, nn_{c} AS non_null, n FROM a" for c in _ALL)
    dist = "\nUNION ALL ".join(f"SELECT '{c}' AS column, count(DISTINCT {c}) AS nunique FROM bank_customers" for c in _ALL)
    return with_ctes(
        f"""SELECT r.column, non_null, n - non_null AS null_count, round_even((n - non_null) * 100.0 / n, 2) AS null_pct,
       CAST(coalesce(d.nunique, 0) AS BIGINT) AS nunique
FROM ({rows}) r LEFT JOIN ({dist}) d ON d.column = r.column""",
        extra=f"a AS (SELECT count(*) AS n, {nn} FROM bank_customers)",
    )


@query("column_profile", _profile_sql())
def q_column_profile(spark, sf_dir):
    return P.column_profile(bank_customers(spark, sf_dir))


def _zero_sql() -> str:
    z = ", ".join(f"CAST(count_if({c} = 0) AS BIGINT) AS z_{c}" for c in S.NUMERIC_COLUMNS)
    rows = "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", z_{c} AS zero_count, n FROM a" for c in S.NUMERIC_COLUMNS)
    return with_ctes(
        f"SELECT \"column\", zero_count, round(zero_count * 100.0 / n, 6) AS zero_pct FROM ({rows}) t WHERE zero_count > 0",
        extra=f"a AS (SELECT count(*) AS n, {z} FROM bank_customers)",
    )


@query("zero_counts", _zero_sql())
def q_zero_counts(spark, sf_dir):
    return P.zero_counts(bank_customers(spark, sf_dir))


def _not_null_sql() -> str:
    parts = []
    for t, src in (("training_data", "training_data"), ("test_data", "test_data"), ("predictions", "preds")):
        for c in S.NOT_NULL[t]:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM {src}")
    return with_ctes("\nUNION ALL ".join(parts), "PRED", "TEST", "TRAIN")


@query("not_null_check", _not_null_sql())
def q_not_null_check(spark, sf_dir):
    tables = {
        "training_data": store.training_data(spark, sf_dir),
        "test_data": store.test_data(spark, sf_dir),
        "predictions": predictions(spark, sf_dir),
    }
    return P.not_null_violations(tables, S.NOT_NULL)


def _dup_sql(table: str, key: str, name: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, '{key}' AS key_column, count(*) AS duplicate_keys, "
        f"coalesce(CAST(sum(c - 1) AS BIGINT), 0) AS extra_rows FROM (SELECT {key}, count(*) AS c FROM {table} GROUP BY {key} HAVING count(*) > 1) d"
    )


@query(
    "unique_check",
    with_ctes(
        "\nUNION ALL ".join(
            [
                _dup_sql("bank_customers", "CustomerId", "customers"),
                _dup_sql("test_data", "customer_id", "test_data"),
                _dup_sql("preds", "customer_id", "predictions"),
            ]
        ),
        "PRED",
        "TEST",
    ),
)
def q_unique_check(spark, sf_dir):
    a = P.key_duplicates(bank_customers(spark, sf_dir), "CustomerId", "customers")
    b = P.key_duplicates(store.test_data(spark, sf_dir), "customer_id", "test_data")
    c = P.key_duplicates(predictions(spark, sf_dir), "customer_id", "predictions")
    return a.unionByName(b).unionByName(c)


@query(
    "fk_check",
    with_ctes(
        """SELECT (SELECT count(*) FROM preds) AS n_rows,
       (SELECT count(*) FROM preds p WHERE NOT EXISTS (SELECT 1 FROM test_data t WHERE t.customer_id = p.customer_id)) AS orphan_rows""",
        "PRED",
        "TEST",
    ),
)
def q_fk_check(spark, sf_dir):
    return P.fk_summary(predictions(spark, sf_dir), store.test_data(spark, sf_dir), "customer_id")


def _schema_check_body() -> str:
    exp = [(k, c) for k, cols in (("required", S.FEATURE_COLUMNS), ("target", (S.TARGET,)), ("numeric", S.NUMERIC_COLUMNS),
                                  ("categorical", S.CATEGORICAL_COLUMNS)) for c in cols]
    values = ", ".join(f"('{k}', '{c}')" for k, c in exp)
    numeric = "d.column_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'FLOAT', 'DOUBLE') OR d.column_type LIKE 'DECIMAL%'"
    return f"""SELECT e.k AS "check", e.c AS "column", ok,
       CASE WHEN ok THEN '' WHEN e.k = 'required' THEN 'Missing required column: ' || e.c
            WHEN e.k = 'target' THEN 'Missing target column: ' || e.c
            WHEN e.k = 'numeric' THEN 'Numeric column missing or not numeric: ' || e.c
            ELSE 'Missing categorical column: ' || e.c END AS message
FROM (SELECT e.k, e.c, CASE WHEN e.k = 'numeric' THEN coalesce({numeric}, false) ELSE d.column_name IS NOT NULL END AS ok
      FROM (VALUES {values}) e(k, c) LEFT JOIN (DESCRIBE bank_customers) d ON d.column_name = e.c) e"""


@query("schema_check", with_ctes(_schema_check_body()))
def q_schema_check(spark, sf_dir):
    return P.schema_check(bank_customers(spark, sf_dir))


@query(
    "dag_gate",
    with_ctes(
        """SELECT count(*) AS row_count, round(avg(Exited), 6) AS churn_rate, 0 AS missing_columns,
       CASE WHEN count(*) >= 1000 THEN 1 ELSE 0 END AS passed FROM bank_customers"""
    ),
)
def q_dag_gate(spark, sf_dir):
    return P.dag_gate(bank_customers(spark, sf_dir))


_STATS = {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp}
#: Which checks of ``schema_findings`` make up each validity flag of a split.
_VALIDITY = {"columns_valid": ("required", "target"), "numerical_valid": ("numeric",), "categorical_valid": ("categorical",)}


def _entry(section: str, column: str, metric, value=None, text=None):
    """One report row; ``value`` for numbers, ``text`` for everything else."""
    return F.struct(
        F.lit(section).alias("section"), F.lit(column).alias("column"), F.lit(metric).alias("metric"),
        (F.lit(None) if value is None else value).cast("double").alias("value"),
        (F.lit(None) if text is None else F.lit(text)).cast("string").alias("text"),
    )


def _spread(df, entries, split):
    """The entries that hold something, as report rows."""
    rows = df.select(split.alias("split"), F.explode(F.array(*entries)).alias("_e")).select("split", "_e.*")
    return rows.where("value IS NOT NULL OR text IS NOT NULL")


def split_quality(split_df, findings):
    """Shape, validity, missing values, types, numeric statistics and target of each split: one aggregate."""
    data = split_df.drop("split")
    n, target = F.col("n"), F.col(S.TARGET)
    numeric = P.numeric_columns(data)
    wide = split_df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(target == 0).alias("n0"), F.count_if(target == 1).alias("n1"),
        *[F.count_if(P.is_missing(data, c)).alias(f"missing_{c}") for c in data.columns],
        *[fn(c).cast("double").alias(f"{m}_{c}") for c in numeric for m, fn in _STATS.items()],
    )
    missing = {c: F.when(F.col(f"missing_{c}") > 0, F.col(f"missing_{c}")) for c in data.columns}
    entries = [
        _entry("shape", "*", "rows", n), _entry("shape", "*", "columns", F.lit(len(data.columns))),
        *[_entry("status", "*", flag, F.lit(int(all(ok for k, _, ok, _ in findings if k in kinds)))) for flag, kinds in _VALIDITY.items()],
        *[_entry("missing", c, "count", missing[c]) for c in data.columns],
        *[_entry("missing", c, "percentage", F.round(missing[c] * 100.0 / n, 6)) for c in data.columns],
        *[_entry("dtype", c, "dtype", text=t) for c, t in data.dtypes],
        *[_entry("numeric", c, m, F.round(F.col(f"{m}_{c}"), 6)) for c in numeric for m in _STATS],
        _entry("target", S.TARGET, "rows", n), _entry("target", S.TARGET, "retained", F.col("n0")),
        _entry("target", S.TARGET, "churned", F.col("n1")), _entry("target", S.TARGET, "churn_rate", F.round(F.col("n1") / n, 6)),
    ]
    return _spread(wide, entries, F.col("split"))


def validation_report_df(split_df):
    """Long report ``(split, section, column, metric, value, text)``: the quality sections of each split,
    drift between them, and the overall status with its error messages (split ``all``)."""
    data = split_df.drop("split")
    findings = P.schema_findings(data)
    errors = [(c, k, message) for k, c, ok, message in findings if not ok]
    overall = _spread(
        split_df.sparkSession.range(1),
        [_entry("status", "*", "validation_status", F.lit(int(not errors))), *[_entry("error", c, k, text=m) for c, k, m in errors]],
        F.lit("all"),
    )
    nothing = F.lit(None).cast("string").alias("text")
    copies = split_df.groupBy("split", *data.columns).agg(F.count(F.lit(1)).alias("_c"))
    duplicates = copies.groupBy("split").agg(F.sum(F.col("_c") - 1).cast("double").alias("value")).select(
        "split", F.lit("duplicates").alias("section"), F.lit("*").alias("column"), F.lit("rows").alias("metric"), "value", nothing
    )
    present = [c for c in S.CATEGORICAL_COLUMNS if c in data.columns]
    named = X.stack_columns(split_df, present, keep=["split"]) if present else split_df.selectExpr("split", "'' AS feature", "NULL AS value")
    categories = named.where("value IS NOT NULL")
    categories = categories.groupBy("split", "feature", "value").agg(F.count(F.lit(1)).alias("_n")).select(
        "split", F.lit("category").alias("section"), F.col("feature").alias("column"), F.col("value").alias("metric"),
        F.col("_n").cast("double").alias("value"), nothing,
    )
    metrics = {"ks_statistic": "statistic", "p_value": "p_value", "drift": "drift"}
    drift = ST.ks_drift(split_df).select(
        F.lit("drift").alias("split"), F.lit("drift").alias("section"), F.col("feature").alias("column"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in metrics.items()])).alias("_m"),
    ).select("split", "section", "column", "_m.metric", "_m.value", nothing)
    return split_quality(split_df, findings).unionByName(duplicates).unionByName(categories).unionByName(drift).unionByName(overall)


def _validation_sql() -> str:
    from churnlens.plans.q_stats import _RAW_NUMERIC as KS_COLS
    from churnlens.plans.q_stats import _ks_sql

    none = "CAST(NULL AS VARCHAR) AS text"
    missing = "\nUNION ALL ".join(
        f"SELECT split, '{c}' AS feature, count(*) AS n, count_if({c} IS NULL{f' OR isnan({c})' if c in ('Balance', 'EstimatedSalary') else ''}) AS k "
        "FROM split_customers GROUP BY split" for c in _ALL
    )
    flags = "\nUNION ALL ".join(
        f"SELECT '{flag}' AS metric, CAST(CAST(bool_and(ok) AS INT) AS DOUBLE) AS value FROM findings WHERE \"check\" IN ({', '.join(repr(k) for k in kinds)})"
        for flag, kinds in _VALIDITY.items()
    )
    body = f"""SELECT split, 'numeric' AS section, feature AS column, m.metric, m.value, {none}
FROM (SELECT split, feature, round(min(value), 6) AS mn, round(max(value), 6) AS mx, round(avg(value), 6) AS mean,
             round(stddev_samp(value), 6) AS std FROM nlong GROUP BY split, feature) s,
     LATERAL (SELECT 'min' AS metric, mn AS value UNION ALL SELECT 'max', mx UNION ALL SELECT 'mean', mean UNION ALL SELECT 'std', std) m
WHERE m.value IS NOT NULL
UNION ALL
SELECT split, x.section, x.col, x.metric, x.value, {none}
FROM (SELECT split, count(*) AS rows, count_if(Exited = 0) AS retained, count_if(Exited = 1) AS churned FROM split_customers GROUP BY split) t,
     LATERAL (SELECT 'target' AS section, 'Exited' AS col, 'rows' AS metric, CAST(rows AS DOUBLE) AS value
              UNION ALL SELECT 'target', 'Exited', 'retained', CAST(retained AS DOUBLE)
              UNION ALL SELECT 'target', 'Exited', 'churned', CAST(churned AS DOUBLE)
              UNION ALL SELECT 'target', 'Exited', 'churn_rate', round(churned / rows, 6)
              UNION ALL SELECT 'shape', '*', 'rows', CAST(rows AS DOUBLE)
              UNION ALL SELECT 'shape', '*', 'columns', (SELECT CAST(count(*) AS DOUBLE) FROM (DESCRIBE bank_customers) d)) x
UNION ALL
SELECT split, 'missing', feature, m.metric, m.value, {none}
FROM ({missing}) miss, LATERAL (SELECT 'count' AS metric, CAST(k AS DOUBLE) AS value UNION ALL SELECT 'percentage', round(k * 100.0 / n, 6)) m
WHERE k > 0
UNION ALL
SELECT split, 'duplicates', '*', 'rows', CAST(sum(c - 1) AS DOUBLE), {none}
FROM (SELECT split, {', '.join(_ALL)}, count(*) AS c FROM split_customers GROUP BY ALL) g GROUP BY split
UNION ALL
SELECT s.split, 'dtype', column_name, 'dtype', CAST(NULL AS DOUBLE), {_DTYPE_SQL}
FROM (DESCRIBE bank_customers) d, (SELECT DISTINCT split FROM split_customers) s
UNION ALL
SELECT split, 'category', feature, value, CAST(count(*) AS DOUBLE), {none} FROM clong WHERE value IS NOT NULL GROUP BY split, feature, value
UNION ALL
SELECT s.split, 'status', '*', f.metric, f.value, {none} FROM ({flags}) f, (SELECT DISTINCT split FROM split_customers) s
UNION ALL
SELECT 'all', 'status', '*', 'validation_status', CAST(CAST(bool_and(ok) AS INT) AS DOUBLE), {none} FROM findings
UNION ALL
SELECT 'all', 'error', "column", "check", CAST(NULL AS DOUBLE), message FROM findings WHERE NOT ok
UNION ALL
SELECT 'drift', 'drift', feature, m.metric, m.value, {none}
FROM ksp, LATERAL (SELECT 'ks_statistic' AS metric, statistic AS value UNION ALL SELECT 'p_value', p_value
                   UNION ALL SELECT 'drift', CAST(CAST(p_value < 0.05 AS INT) AS DOUBLE)) m"""
    extra = (
        f"nlong AS ({stack_sql('split_customers', _RAW_NUMERIC, keep=['split'], cast='DOUBLE')}),\n"
        + f"clong AS ({stack_sql('split_customers', S.CATEGORICAL_COLUMNS, keep=['split'])}),\n"
        + f"findings AS ({_schema_check_body()}),\n"
        + _ks_sql("split", "'train'", "'test'", "split_customers", KS_COLS, "")
    )
    return with_ctes(body, "SPLIT", extra=extra).replace("WITH ", "WITH RECURSIVE ", 1)


@query("validation_report", _validation_sql())
def q_validation_report(spark, sf_dir):
    return validation_report_df(R.stratified_split(bank_customers(spark, sf_dir)))
