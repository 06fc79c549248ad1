"""Statistical-test queries (KS, chi-square, effect sizes, KDE, ECDF, split)."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens import schema as S
from churnlens.functions.stats import KS_EXACT_LAMBDA, KS_EXACT_ROWS, ks_pvalue_sql
from churnlens.operators import ranking as R
from churnlens.operators import stattests as ST
from churnlens.operators.explore import CROSSTAB_FEATURES
from churnlens.operators.profile import numeric_columns
from churnlens.plans.oracle_base import with_ctes
from churnlens.plans.registry import query
from churnlens.plans.sqlgen import stack_sql
from churnlens.sources.fixture import bank_customers

_NUM = S.NUMERIC_COLUMNS
_RAW_NUMERIC = ("RowNumber", "CustomerId", "CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "HasCrCard",
                "IsActiveMember", "EstimatedSalary", "Exited")

_STARS = (
    "CASE WHEN p_value < 0.001 THEN 'YES ***' WHEN p_value < 0.01 THEN 'YES **' "
    "WHEN p_value < 0.05 THEN 'YES *' ELSE 'NO' END"
)


def split_frame(spark, sf_dir):
    return R.stratified_split(bank_customers(spark, sf_dir))


@query(
    "stratified_split",
    with_ctes("SELECT CustomerId, Exited, split FROM split_customers", "SPLIT"),
)
def q_stratified_split(spark, sf_dir):
    return split_frame(spark, sf_dir).select("CustomerId", "Exited", "split")


@query(
    "split_churn_rate",
    with_ctes(
        """SELECT split, count(*) AS rows, round(avg(Exited), 6) AS churn_rate,
       round(count(*) / (SELECT count(*) FROM split_customers), 6) AS share
FROM split_customers GROUP BY split""",
        "SPLIT",
    ),
)
def q_split_churn_rate(spark, sf_dir):
    return R.split_churn_rate(split_frame(spark, sf_dir))


def _ks_sql(sample_col: str, first: str, second: str, table: str, cols, extra_select: str, keep_cols=None) -> str:
    keep = [sample_col]
    long = stack_sql(table, cols, keep=keep, cast="DOUBLE")
    return f"""long AS ({long}),
cnt AS (SELECT feature, value, CAST(count_if({sample_col} = {first}) AS BIGINT) AS c1, CAST(count_if({sample_col} = {second}) AS BIGINT) AS c2
        FROM long WHERE value IS NOT NULL GROUP BY feature, value),
cum AS (SELECT feature, value,
          sum(c1) OVER (PARTITION BY feature ORDER BY value) AS s1, sum(c2) OVER (PARTITION BY feature ORDER BY value) AS s2,
          sum(c1) OVER (PARTITION BY feature) AS n1, sum(c2) OVER (PARTITION BY feature) AS n2 FROM cnt),
ks AS MATERIALIZED (SELECT feature, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, max(abs(s1 / n1 - s2 / n2)) AS statistic,
         CAST(max(abs(s1 * n2 - s2 * n1)) AS BIGINT) AS h, CAST(least(n1, n2) AS BIGINT) AS m, CAST(greatest(n1, n2) AS BIGINT) AS n
       FROM cum GROUP BY feature, n1, n2),
paths AS (
  SELECT feature, m, n, h, 0 AS t, list_prepend(CAST(1 AS DOUBLE), list_transform(range(m), lambda i: CAST(0 AS DOUBLE))) AS p FROM ks
  WHERE n <= {KS_EXACT_ROWS} AND m > 0 AND statistic * sqrt(CAST(m AS DOUBLE) / (m + n) * n) <= {KS_EXACT_LAMBDA}
  UNION ALL
  SELECT feature, m, n, h, t + 1, list_transform(range(m + 1), lambda i: CASE WHEN t + 1 - i BETWEEN 0 AND n AND abs(i * n - (t + 1 - i) * m) < h
    THEN (p[i + 1] * (n - (t - i)) + CASE WHEN i > 0 THEN p[i] * (m - i + 1) ELSE 0 END) / (m + n - t) ELSE 0 END)
  FROM paths WHERE t < m + n),
counted AS (SELECT feature, CASE WHEN h <= 0 THEN 1 ELSE greatest(0, 1 - p[m + 1]) END AS exact FROM paths WHERE t = m + n),
ksp AS (SELECT feature, n1, n2, round(statistic, 6) AS statistic,
          round(CASE WHEN exact IS NOT NULL THEN exact ELSE {ks_pvalue_sql('statistic', 'n1', 'n2', 'duckdb')} END, 6) AS p_value
        FROM ks LEFT JOIN counted USING (feature))"""


@query(
    "ks_drift",
    with_ctes(
        "SELECT feature, statistic, p_value, CAST(p_value < 0.05 AS INT) AS drift FROM ksp",
        "SPLIT",
        extra=_ks_sql("split", "'train'", "'test'", "split_customers", _RAW_NUMERIC, ""),
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def q_ks_drift(spark, sf_dir):
    return ST.ks_drift(split_frame(spark, sf_dir))


@query(
    "ks_by_class",
    with_ctes(
        f"SELECT feature, n1 AS n_retained, n2 AS n_churned, statistic, p_value, {_STARS} AS significant FROM ksp",
        extra=_ks_sql("Exited", "0", "1", "bank_customers", _NUM, ""),
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def q_ks_by_class(spark, sf_dir):
    return ST.ks_by_class(bank_customers(spark, sf_dir))


def chi2_tail_integral_sql(x: str, dof: str, steps: int = 4000) -> str:
    """The tail by Simpson's rule over u = sqrt(t / 2): its density 2 u^(2a-1) exp(-u^2) / Gamma(a) is
    smooth, and nothing is left 12 units beyond its peak.  Shares nothing with the library's formula."""
    a, lo = f"(CAST({dof} AS DOUBLE) / 2)", f"sqrt(CAST({x} AS DOUBLE) / 2)"
    step = f"((greatest({lo}, sqrt({a})) + 12 - {lo}) / {steps})"
    u = f"({lo} + k_ * {step})"
    density = f"CASE WHEN {u} <= 0 THEN 0.0 ELSE exp((2 * {a} - 1) * ln({u}) - {u} * {u} + ln(2.0) - lgamma({a})) END"
    weight = f"CASE WHEN k_ = 0 OR k_ = {steps} THEN 1 WHEN k_ % 2 = 1 THEN 4 ELSE 2 END"
    total = f"list_sum(list_transform(range(0, {steps} + 1), lambda k_: {weight} * ({density})))"
    return f"CASE WHEN {dof} <= 0 THEN NULL WHEN {x} <= 0 THEN 1.0 ELSE least(1.0, greatest(0.0, {step} / 3 * {total})) END"


_CHI_CTE = f"""long AS ({stack_sql('bank_customers', CROSSTAB_FEATURES, keep=['Exited'])}),
cells AS (SELECT feature, value, Exited AS label, count(*) AS o FROM long WHERE value IS NOT NULL AND Exited IS NOT NULL GROUP BY 1, 2, 3),
rt AS (SELECT feature, value, sum(o) AS row_t FROM cells GROUP BY 1, 2),
ct AS (SELECT feature, label, sum(o) AS col_t FROM cells GROUP BY 1, 2),
dims AS (SELECT feature, sum(o) AS n, count(DISTINCT value) AS r, count(DISTINCT label) AS c FROM cells GROUP BY 1),
grid AS (SELECT rt.feature, rt.value, ct.label, coalesce(cells.o, 0) AS o, row_t, col_t, n, r, c,
                row_t * col_t / n AS e, (r - 1) * (c - 1) AS dof
         FROM rt JOIN ct ON rt.feature = ct.feature
         LEFT JOIN cells ON cells.feature = rt.feature AND cells.value = rt.value AND cells.label = ct.label
         JOIN dims ON dims.feature = rt.feature),
stat AS (SELECT feature, dof, CAST(n AS BIGINT) AS n, r, c,
           sum(power(abs(o - e) - CASE WHEN dof = 1 THEN least(0.5, abs(o - e)) ELSE 0.0 END, 2) / e) AS chi2,
           sum(power(abs(o - e), 2) / e) AS chi2_uncorrected
         FROM grid GROUP BY feature, dof, n, r, c),
chi AS (SELECT feature, dof, n, r, c, round(chi2, 6) AS chi2, round(chi2_uncorrected, 6) AS chi2_uncorrected,
          round({chi2_tail_integral_sql('chi2', 'dof')}, 6) AS p_value FROM stat)"""


@query("chi_square", with_ctes(f"SELECT *, {_STARS} AS significant FROM chi", extra=_CHI_CTE))
def q_chi_square(spark, sf_dir):
    return ST.chi_square(bank_customers(spark, sf_dir))


@query(
    "cramers_v",
    with_ctes(
        """SELECT feature, round(sqrt(chi2_uncorrected / (n * (least(r, c) - 1))), 6) AS cramers_v,
       CASE WHEN round(sqrt(chi2_uncorrected / (n * (least(r, c) - 1))), 6) < 0.1 THEN 'Negligible'
            WHEN round(sqrt(chi2_uncorrected / (n * (least(r, c) - 1))), 6) < 0.3 THEN 'Small'
            WHEN round(sqrt(chi2_uncorrected / (n * (least(r, c) - 1))), 6) < 0.5 THEN 'Medium' ELSE 'Large' END AS strength
FROM chi""",
        extra=_CHI_CTE,
    ),
)
def q_cramers_v(spark, sf_dir):
    return ST.cramers_v(ST.chi_square(bank_customers(spark, sf_dir)))


_COHEN = f"long AS ({stack_sql('bank_customers', ST.COHEN_FEATURES, keep=['Exited'], cast='DOUBLE')})"


@query(
    "cohens_d",
    with_ctes(
        """SELECT feature, d AS cohens_d,
       CASE WHEN abs(d) < 0.2 THEN 'Negligible' WHEN abs(d) < 0.5 THEN 'Small' WHEN abs(d) < 0.8 THEN 'Medium' ELSE 'Large' END AS effect,
       CASE WHEN abs(d) < 0.2 THEN 'NO' WHEN abs(d) < 0.5 THEN 'Maybe' WHEN abs(d) < 0.8 THEN 'YES' ELSE 'YES!' END AS useful
FROM (SELECT feature, round((m1 - m0) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2)), 6) AS d
      FROM (SELECT feature, count(value) FILTER (WHERE Exited = 0) AS n0, count(value) FILTER (WHERE Exited = 1) AS n1,
                   avg(value) FILTER (WHERE Exited = 0) AS m0, avg(value) FILTER (WHERE Exited = 1) AS m1,
                   var_samp(value) FILTER (WHERE Exited = 0) AS v0, var_samp(value) FILTER (WHERE Exited = 1) AS v1
            FROM long GROUP BY feature) g) t""",
        extra=_COHEN,
    ),
)
def q_cohens_d(spark, sf_dir):
    return ST.cohens_d(bank_customers(spark, sf_dir))


@query(
    "kde_density",
    with_ctes(
        """SELECT st.feature, k.k, round(lo + k.k * (hi - lo) / 199, 6) AS x,
       round(sum(cnt * exp(-0.5 * power(((lo + k.k * (hi - lo) / 199) - value) / h, 2)) / (n * h * sqrt(2 * 3.141592653589793))), 10) AS density
FROM st JOIN vc ON vc.feature = st.feature, (SELECT CAST(range AS INT) AS k FROM range(0, 200)) k
GROUP BY st.feature, k.k, lo, hi""",
        extra=f"""long AS ({stack_sql('bank_customers', _NUM, cast='DOUBLE')}),
vc AS (SELECT feature, value, count(*) AS cnt FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
st AS (SELECT feature, count(*) AS n, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi,
              power(CAST(count(*) AS DOUBLE), -0.2) * stddev_samp(value) AS h
       FROM long WHERE value IS NOT NULL GROUP BY feature HAVING stddev_samp(value) > 0)""",
    ),
)
def q_kde_density(spark, sf_dir):
    return ST.kde_density(bank_customers(spark, sf_dir))


@query(
    "kde_age_by_geography",
    with_ctes(
        """SELECT 'Age' AS feature, st.Geography, st.Exited, k.k, round(18 + k.k * CAST(62 AS DOUBLE) / 99, 6) AS x,
       round(sum(cnt * exp(-0.5 * power(((18 + k.k * CAST(62 AS DOUBLE) / 99) - value) / h, 2)) / (n * h * sqrt(2 * 3.141592653589793))), 10) AS density
FROM st JOIN vc ON vc.Geography = st.Geography AND vc.Exited = st.Exited, (SELECT CAST(range AS INT) AS k FROM range(0, 100)) k
GROUP BY st.Geography, st.Exited, k.k""",
        extra="""vc AS (SELECT Geography, Exited, CAST(Age AS DOUBLE) AS value, count(*) AS cnt FROM bank_customers WHERE Age IS NOT NULL GROUP BY ALL),
st AS (SELECT Geography, Exited, count(*) AS n, power(CAST(count(*) AS DOUBLE), -0.2) * stddev_samp(CAST(Age AS DOUBLE)) AS h
       FROM bank_customers WHERE Age IS NOT NULL GROUP BY ALL HAVING stddev_samp(CAST(Age AS DOUBLE)) > 0)""",
    ),
)
def q_kde_age_by_geography(spark, sf_dir):
    return ST.kde_density(bank_customers(spark, sf_dir), ["Age"], points=100, by=["Geography", S.TARGET], bounds=(18, 80))


@query(
    "ecdf",
    with_ctes(
        """SELECT feature, Exited, value, count(*) AS count,
       CAST(sum(count(*)) OVER (PARTITION BY feature, Exited ORDER BY value) AS BIGINT) AS cum_count,
       round(sum(count(*)) OVER (PARTITION BY feature, Exited ORDER BY value) / sum(count(*)) OVER (PARTITION BY feature, Exited), 6) AS ecdf
FROM long WHERE value IS NOT NULL GROUP BY feature, Exited, value""",
        extra=f"long AS ({stack_sql('bank_customers', _NUM, keep=['Exited'], cast='DOUBLE')})",
    ),
)
def q_ecdf(spark, sf_dir):
    return R.ecdf(bank_customers(spark, sf_dir), _NUM)
