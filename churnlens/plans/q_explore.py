"""Exploratory queries (segment table, churn by group, pivots, quantiles, correlation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens import schema as S
from churnlens.functions import features as FX
from churnlens.operators import explore as X
from churnlens.plans.oracle_base import with_ctes
from churnlens.functions.features import exact_avg_round_sql
from churnlens.plans.registry import query
from churnlens.plans.sqlgen import stack_sql
from churnlens.sources.fixture import bank_customers, predictions

_SEG = FX.SEGMENTS


def _segment_sql() -> str:
    aggs = ",\n  ".join(
        f"CAST(count_if({p}) AS BIGINT) AS n{i}, avg(CASE WHEN {p} THEN Exited END) AS r{i}" for i, (_, p) in enumerate(_SEG)
    )
    rows = "\nUNION ALL ".join(
        f"SELECT '{name}' AS segment, n{i} AS size, round(r{i} * 100, 6) AS churn_pct, round(r{i} / base, 6) AS lift FROM a"
        for i, (name, _) in enumerate(_SEG)
    )
    return with_ctes(rows, extra=f"a AS (SELECT avg(Exited) AS base,\n  {aggs}\n FROM bank_customers)")


@query("segment_lift", _segment_sql())
def q_segment_lift(spark, sf_dir):
    return X.segment_lift(bank_customers(spark, sf_dir))


def _seg_members_sql() -> str:
    rows = "\nUNION ALL ".join(f"SELECT CustomerId, Exited, '{n}' AS segment FROM bank_customers WHERE {p}" for n, p in _SEG)
    return with_ctes(rows)


@query("segment_filter", _seg_members_sql())
def q_segment_filter(spark, sf_dir):
    return X.segment_members(bank_customers(spark, sf_dir)).select("CustomerId", "Exited", "segment")


_CAT = X.CHURN_GROUP_COLUMNS


@query(
    "churn_by_category",
    with_ctes(
        f"""SELECT feature, value, round(avg(Exited), 6) AS churn_rate, count(*) AS total, CAST(sum(Exited) AS BIGINT) AS churned,
       (SELECT round(avg(Exited), 6) FROM bank_customers) AS baseline
FROM long WHERE value IS NOT NULL GROUP BY feature, value""",
        extra=f"long AS ({stack_sql('bank_customers', _CAT, keep=['Exited'])})",
    ),
)
def q_churn_by_category(spark, sf_dir):
    return X.churn_by_category(bank_customers(spark, sf_dir))


@query(
    "product_profile",
    with_ctes(
        """SELECT NumOfProducts, round_even(avg(Exited), 2) AS churn_rate, count(*) AS count,
       round_even(avg(Balance), 2) AS avg_balance, round_even(avg(Age), 2) AS avg_age
FROM bank_customers GROUP BY NumOfProducts"""
    ),
)
def q_product_profile(spark, sf_dir):
    return X.product_profile(bank_customers(spark, sf_dir))


@query(
    "balance_impact",
    with_ctes(
        """SELECT CAST(Balance > 0 AS INT) AS HasBalance, round(avg(Exited), 6) AS churn_rate, count(*) AS count,
       CASE WHEN Balance > 0 THEN 'Has Balance' ELSE 'Zero Balance' END AS label
FROM bank_customers GROUP BY 1, 4"""
    ),
)
def q_balance_impact(spark, sf_dir):
    return X.balance_impact(bank_customers(spark, sf_dir))


_AGE_BIN_SQL = (
    "CASE WHEN Age > 0 AND Age <= 30 THEN '18-30' WHEN Age > 30 AND Age <= 40 THEN '31-40' "
    "WHEN Age > 40 AND Age <= 50 THEN '41-50' WHEN Age > 50 AND Age <= 60 THEN '51-60' "
    "WHEN Age > 60 AND Age <= 100 THEN '60+' END"
)


def _pivot_sql(index: str, expr: str, values: list, names: list[str], where: str = "") -> str:
    lits = [f"'{v}'" if isinstance(v, str) else str(v) for v in values]
    cols = ", ".join(f'round(avg(CASE WHEN {expr} = {lit} THEN Exited END), 6) AS "{n}"' for lit, n in zip(lits, names))
    return with_ctes(f"SELECT {index}, {cols} FROM bank_customers {where} GROUP BY {index}")


@query("pivot_geo_age", _pivot_sql("Geography", _AGE_BIN_SQL, list(FX.AGE_BIN_LABELS), list(FX.AGE_BIN_LABELS)))
def q_pivot_geo_age(spark, sf_dir):
    return X.pivot_mean(bank_customers(spark, sf_dir), "Geography", FX.age_bin(), list(FX.AGE_BIN_LABELS))


@query("pivot_gender_active", _pivot_sql("Gender", "IsActiveMember", [0, 1], ["Inactive", "Active"]))
def q_pivot_gender_active(spark, sf_dir):
    return X.pivot_mean(bank_customers(spark, sf_dir), "Gender", F.col("IsActiveMember"), [0, 1], ["Inactive", "Active"])


_GEOS = ["France", "Germany", "Spain"]


@query("pivot_products_geo", _pivot_sql("NumOfProducts", "Geography", _GEOS, _GEOS))
def q_pivot_products_geo(spark, sf_dir):
    return X.pivot_mean(bank_customers(spark, sf_dir), "NumOfProducts", F.col("Geography"), _GEOS)


@query("pivot_products_balance", _pivot_sql("NumOfProducts", "CAST(Balance > 0 AS INT)", [0, 1], ["Zero Balance", "Has Balance"]))
def q_pivot_products_balance(spark, sf_dir):
    return X.pivot_mean(
        bank_customers(spark, sf_dir), "NumOfProducts", FX.flag_columns()["HasBalance"], [0, 1], ["Zero Balance", "Has Balance"]
    )


@query(
    "crosstab",
    with_ctes(
        """SELECT feature, value, CAST(count_if(Exited = 0) AS BIGINT) AS retained, CAST(count_if(Exited = 1) AS BIGINT) AS churned
FROM long WHERE value IS NOT NULL GROUP BY feature, value""",
        extra=f"long AS ({stack_sql('bank_customers', X.CROSSTAB_FEATURES, keep=['Exited'])})",
    ),
)
def q_crosstab(spark, sf_dir):
    return X.crosstab(bank_customers(spark, sf_dir))


_NUM = S.NUMERIC_COLUMNS
_LONG_NUM = f"long AS ({stack_sql('bank_customers', _NUM, keep=['Exited'], cast='DOUBLE')})"


@query(
    "iqr_outliers",
    with_ctes(
        """SELECT q.feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper,
       CAST(count_if(l.value < q1 - 1.5 * (q3 - q1) OR l.value > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers,
       round(CAST(count_if(l.value < q1 - 1.5 * (q3 - q1) OR l.value > q3 + 1.5 * (q3 - q1)) AS BIGINT) * 100.0 / count(*), 6) AS outlier_pct
FROM q JOIN long l ON l.feature = q.feature
GROUP BY q.feature, q1, q3""",
        extra=_LONG_NUM
        + ",\nq AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY feature)",
    ),
)
def q_iqr_outliers(spark, sf_dir):
    return X.iqr_outliers(bank_customers(spark, sf_dir))


@query(
    "univariate_stats",
    with_ctes(
        """SELECT feature, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(skewness(value), 6) AS skew
FROM long GROUP BY feature""",
        extra=_LONG_NUM,
    ),
)
def q_univariate_stats(spark, sf_dir):
    return X.univariate_stats(bank_customers(spark, sf_dir))


@query(
    "class_summary",
    with_ctes(
        """SELECT feature, Exited, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std
FROM long GROUP BY feature, Exited""",
        extra=_LONG_NUM,
    ),
)
def q_class_summary(spark, sf_dir):
    return X.class_summary(bank_customers(spark, sf_dir))


@query(
    "histogram",
    with_ctes(
        """SELECT g.feature, g.bin, round(lo + g.bin * w, 6) AS bin_lo, round(lo + (g.bin + 1) * w, 6) AS bin_hi,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count,
       round(CASE WHEN w > 0 THEN coalesce(c.cnt, 0) / (total * w) END, 10) AS density
FROM (SELECT r.*, CAST(b.bin AS INT) AS bin FROM r, range(0, 50) AS b(bin)) g
LEFT JOIN c ON c.feature = g.feature AND c.bin = g.bin""",
        extra=_LONG_NUM
        + """,
r AS (SELECT feature, min(value) AS lo, max(value) AS hi, count(*) AS total, (max(value) - min(value)) / 50 AS w
      FROM long WHERE value IS NOT NULL GROUP BY feature),
c AS (SELECT l.feature, CAST(CASE WHEN w > 0 THEN least(floor((value - lo) / w), 49) ELSE 0 END AS INT) AS bin, count(*) AS cnt
      FROM long l JOIN r ON r.feature = l.feature WHERE value IS NOT NULL GROUP BY 1, 2)""",
    ),
)
def q_histogram(spark, sf_dir):
    return X.histogram(bank_customers(spark, sf_dir))


@query(
    "histogram_by_class",
    with_ctes(
        """SELECT g.feature, g.Exited, g.bin, round(lo + g.bin * w, 6) AS bin_lo, round(lo + (g.bin + 1) * w, 6) AS bin_hi,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count,
       round(CASE WHEN w > 0 THEN coalesce(c.cnt, 0) / (total * w) END, 10) AS density
FROM (SELECT r.*, CAST(b.bin AS INT) AS bin FROM r, range(0, 30) AS b(bin)) g
LEFT JOIN c ON c.feature = g.feature AND c.Exited = g.Exited AND c.bin = g.bin""",
        extra=_LONG_NUM
        + """,
r AS (SELECT feature, Exited, min(value) AS lo, max(value) AS hi, count(*) AS total, (max(value) - min(value)) / 30 AS w
      FROM long WHERE value IS NOT NULL GROUP BY feature, Exited),
c AS (SELECT l.feature, l.Exited, CAST(CASE WHEN w > 0 THEN least(floor((value - lo) / w), 29) ELSE 0 END AS INT) AS bin, count(*) AS cnt
      FROM long l JOIN r ON r.feature = l.feature AND r.Exited = l.Exited WHERE value IS NOT NULL GROUP BY 1, 2, 3)""",
    ),
)
def q_histogram_by_class(spark, sf_dir):
    return X.histogram(bank_customers(spark, sf_dir), bins=30, by=[S.TARGET])


_CORR = list(X.CORR_COLUMNS)


def _corr_sql(where: str = "") -> str:
    rows = []
    for i, a in enumerate(_CORR):
        for j, b in enumerate(_CORR):
            val = "max(1.0)" if i == j else f"round(corr(CAST({_CORR[min(i, j)]} AS DOUBLE), CAST({_CORR[max(i, j)]} AS DOUBLE)), 6)"
            rows.append(f"SELECT {i} AS i, {j} AS j, '{a}' AS var1, '{b}' AS var2, {val} AS corr FROM bank_customers")
    body = "\nUNION ALL ".join(rows)
    return f"SELECT * FROM ({body}) m {where}"


@query("correlation_matrix", with_ctes(_corr_sql()))
def q_correlation_matrix(spark, sf_dir):
    return X.correlation_matrix(bank_customers(spark, sf_dir))


@query("lower_triangle", with_ctes(_corr_sql("WHERE i > j")))
def q_lower_triangle(spark, sf_dir):
    return X.lower_triangle(X.correlation_matrix(bank_customers(spark, sf_dir)))


@query(
    "target_correlation",
    with_ctes(
        f"""SELECT var1 AS feature, corr, abs(corr) AS abs_corr,
       row_number() OVER (ORDER BY abs(corr) DESC, var1) AS rank
FROM ({_corr_sql()}) t WHERE var2 = 'Exited' AND var1 <> 'Exited'"""
    ),
)
def q_target_correlation(spark, sf_dir):
    return X.target_correlation(X.correlation_matrix(bank_customers(spark, sf_dir)))


@query(
    "monthly_churn_stats",
    with_ctes(
        """SELECT strftime(prediction_date, '%Y-%m') AS month, count(*) AS total_predictions,
       CAST(sum(CASE WHEN churn_prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS predicted_churns,
       """ + exact_avg_round_sql("churn_probability", 4) + """ AS avg_churn_prob,
       count(CASE WHEN risk_category = 'High' THEN 1 END) AS high_risk_count
FROM preds GROUP BY 1 ORDER BY month DESC""",
        "PRED",
    ),
)
def q_monthly_churn_stats(spark, sf_dir):
    return X.monthly_churn_stats(predictions(spark, sf_dir))
