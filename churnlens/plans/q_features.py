"""Scalar feature expressions, projections and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens import schema as S
from churnlens.functions import features as FX
from churnlens.operators import ranking as R
from churnlens.operators.profile import numeric_columns
from churnlens.plans.oracle_base import with_ctes
from churnlens.plans.registry import query
from churnlens.sources.fixture import bank_customers, predictions
from churnlens.sources.store import rename_to_store


def _r6(c: str):
    return F.round(F.col(c), 6).alias(c)


@query(
    "prod_features",
    with_ctes(
        """SELECT CustomerId, round(ln(1 + CAST(Age AS DOUBLE)), 6) AS Age_log,
       round(Balance / (EstimatedSalary + 1), 6) AS Balance_Salary_Ratio,
       round(CAST(NumOfProducts AS DOUBLE) / (Tenure + 1), 6) AS Products_Per_Tenure,
       CAST(IsActiveMember * HasCrCard AS INT) AS Active_CreditCard
FROM bank_customers"""
    ),
)
def q_prod_features(spark, sf_dir):
    df = FX.prod_features(bank_customers(spark, sf_dir))
    return df.select("CustomerId", _r6("Age_log"), _r6("Balance_Salary_Ratio"), _r6("Products_Per_Tenure"), "Active_CreditCard")


_FLAGS = ["HasBalance", "IsSenior", "Has3PlusProducts", "IsInactive", "IsGermany", "IsFemale"]
_INTER = ["Germany_Female", "Senior_Inactive", "Germany_Senior"]


@query("flag_features", with_ctes(f"SELECT CustomerId, {', '.join(_FLAGS)} FROM risk", "RISK"))
def q_flag_features(spark, sf_dir):
    return FX.flag_features(bank_customers(spark, sf_dir)).select("CustomerId", *_FLAGS)


@query("interaction_features", with_ctes(f"SELECT CustomerId, {', '.join(_INTER)} FROM risk", "RISK"))
def q_interaction_features(spark, sf_dir):
    return FX.interaction_features(bank_customers(spark, sf_dir)).select("CustomerId", *_INTER)


@query(
    "ratio_features",
    with_ctes(
        """SELECT CustomerId, round(ln(1 + CAST(Age AS DOUBLE)), 6) AS Age_Log,
       round(Balance / greatest(NumOfProducts, 1), 6) AS BalancePerProduct FROM bank_customers"""
    ),
)
def q_ratio_features(spark, sf_dir):
    return FX.ratio_features(bank_customers(spark, sf_dir)).select("CustomerId", _r6("Age_Log"), _r6("BalancePerProduct"))


@query("risk_score", with_ctes("SELECT CustomerId, round(RiskScore, 6) AS RiskScore FROM risk", "RISK"))
def q_risk_score(spark, sf_dir):
    return FX.risk_score(bank_customers(spark, sf_dir)).select("CustomerId", _r6("RiskScore"))


_AGE_BIN_SQL = (
    "CASE WHEN Age > 0 AND Age <= 30 THEN '18-30' WHEN Age > 30 AND Age <= 40 THEN '31-40' "
    "WHEN Age > 40 AND Age <= 50 THEN '41-50' WHEN Age > 50 AND Age <= 60 THEN '51-60' "
    "WHEN Age > 60 AND Age <= 100 THEN '60+' END"
)


@query("age_bin", with_ctes(f"SELECT CustomerId, Age, {_AGE_BIN_SQL} AS AgeBin FROM bank_customers"))
def q_age_bin(spark, sf_dir):
    return bank_customers(spark, sf_dir).select("CustomerId", "Age", FX.age_bin().alias("AgeBin"))


@query(
    "yes_no_encode",
    with_ctes(
        """SELECT CustomerId, answer, CAST(CASE WHEN answer = 'Yes' THEN 1 ELSE 0 END AS INT) AS encoded
FROM (SELECT CustomerId, CASE WHEN HasCrCard = 1 THEN 'Yes' ELSE 'No' END AS answer FROM bank_customers) t"""
    ),
)
def q_yes_no_encode(spark, sf_dir):
    answers = bank_customers(spark, sf_dir).select(
        "CustomerId", F.when(F.col("HasCrCard") == 1, "Yes").otherwise("No").alias("answer")
    )
    return answers.withColumn("encoded", FX.yes_no(F.col("answer")))


_TIER = "CASE WHEN churn_probability >= 0.7 THEN 'High' WHEN churn_probability >= 0.5 THEN 'Medium' ELSE 'Low' END"


@query(
    "risk_tier",
    with_ctes(
        f"""SELECT id, churn_probability, {_TIER} AS tier,
       CASE WHEN churn_probability > 0.5 THEN 'Will Churn' ELSE 'Will Stay' END AS prediction FROM preds""",
        "PRED",
    ),
)
def q_risk_tier(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return p.select(
        "id", "churn_probability", FX.risk_tier(F.col("churn_probability")).alias("tier"),
        FX.churn_label_text(F.col("churn_probability")).alias("prediction"),
    )


def _rec_sql(part: int) -> str:
    whens = " ".join(f"WHEN tier = '{k}' THEN '{v[part]}'" for k, v in FX.RECOMMENDATIONS.items())
    return f"CASE {whens} END"


@query(
    "recommendation",
    with_ctes(
        f"SELECT id, tier, {_rec_sql(0)} AS headline, {_rec_sql(1)} AS action FROM (SELECT id, {_TIER} AS tier FROM preds) t",
        "PRED",
    ),
)
def q_recommendation(spark, sf_dir):
    t = predictions(spark, sf_dir).select("id", FX.risk_tier(F.col("churn_probability")).alias("tier"))
    return t.select("id", "tier", FX.recommendation(F.col("tier"), 0).alias("headline"), FX.recommendation(F.col("tier"), 1).alias("action"))


@query(
    "clean_nonfinite",
    with_ctes(
        """SELECT CustomerId, round(coalesce(CASE WHEN EstimatedSalary = 0 THEN NULL ELSE Balance / EstimatedSalary END, 0.0), 6) AS balance_to_salary
FROM bank_customers"""
    ),
)
def q_clean_nonfinite(spark, sf_dir):
    df = bank_customers(spark, sf_dir)
    raw = F.try_divide(F.col("Balance"), F.col("EstimatedSalary"))
    return df.select("CustomerId", F.round(FX.clean_nonfinite(raw), 6).alias("balance_to_salary"))


def _stars_oracle() -> str:
    from churnlens.plans.q_stats import _CHI_CTE

    return with_ctes(
        "SELECT feature, p_value, CASE WHEN p_value < 0.001 THEN 'YES ***' WHEN p_value < 0.01 THEN 'YES **' "
        "WHEN p_value < 0.05 THEN 'YES *' ELSE 'NO' END AS stars FROM chi",
        extra=_CHI_CTE,
    )


def _effect_oracle() -> str:
    from churnlens.plans.registry import ORACLES

    return ORACLES["cohens_d"]


@query("significance_stars", _stars_oracle())
def q_significance_stars(spark, sf_dir):
    from churnlens.operators.stattests import chi_square

    return chi_square(bank_customers(spark, sf_dir)).select("feature", "p_value", FX.significance_stars(F.col("p_value")).alias("stars"))


@query("effect_label", _effect_oracle())
def q_effect_label(spark, sf_dir):
    from churnlens.operators.stattests import cohens_d

    d = cohens_d(bank_customers(spark, sf_dir))
    return d.select("feature", "cohens_d", FX.effect_size(F.col("cohens_d")).alias("effect"), FX.effect_meaningful(F.col("cohens_d")).alias("useful"))


_FEATURES_ONLY = [c for c in [f.name for f in S.RAW_SCHEMA.fields] if c not in S.ID_COLUMNS]


@query("drop_ids", with_ctes(f"SELECT {', '.join(_FEATURES_ONLY)} FROM bank_customers"))
def q_drop_ids(spark, sf_dir):
    return bank_customers(spark, sf_dir).drop(*S.ID_COLUMNS)


@query("split_xy", with_ctes(f"SELECT {', '.join(S.FEATURE_COLUMNS)}, Exited AS label FROM bank_customers"))
def q_split_xy(spark, sf_dir):
    df = bank_customers(spark, sf_dir)
    return df.select(*S.FEATURE_COLUMNS, F.col(S.TARGET).alias("label"))


@query(
    "rename_columns",
    with_ctes(
        "SELECT RowNumber, Surname, " + ", ".join(f"{k} AS {v}" for k, v in S.STORE_RENAMES.items()) + " FROM bank_customers"
    ),
)
def q_rename_columns(spark, sf_dir):
    return rename_to_store(bank_customers(spark, sf_dir))


@query("filter_by_label", with_ctes("""SELECT *, 'churned' AS part FROM bank_customers WHERE Exited = 1
UNION ALL SELECT *, 'retained' FROM bank_customers WHERE Exited = 0"""))
def q_filter_by_label(spark, sf_dir):
    """Both label filters, each row named by the one that keeps it; one scan."""
    part = F.when(F.col(S.TARGET) == 1, "churned").when(F.col(S.TARGET) == 0, "retained")
    return bank_customers(spark, sf_dir).withColumn("part", part).where(F.col("part").isNotNull())


_NUMERIC_RAW = [f.name for f in S.RAW_SCHEMA.fields if f.name not in ("Surname", "Geography", "Gender")]


@query("numeric_columns", with_ctes(f"SELECT {', '.join(_NUMERIC_RAW)} FROM bank_customers"))
def q_numeric_columns(spark, sf_dir):
    df = bank_customers(spark, sf_dir)
    return df.select(*numeric_columns(df))


@query(
    "prefix_sample",
    with_ctes("SELECT * FROM split_customers WHERE split = 'train' ORDER BY RowNumber LIMIT 2000", "SPLIT"),
)
def q_prefix_sample(spark, sf_dir):
    """The experiment's fixed-size subsample of the training split (the limit is the operator)."""
    s = R.stratified_split(bank_customers(spark, sf_dir))
    return s.where(F.col("split") == "train").orderBy("RowNumber").limit(2000)
