"""Scalar feature expressions (pure ``Column`` builders, JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Risk-score weights of the engineered score.
RISK_WEIGHTS = {
    "IsGermany": 1.6,
    "IsFemale": 1.2,
    "IsInactive": 1.3,
    "IsSenior": 1.5,
    "Has3PlusProducts": 4.2,
    "Senior_Inactive": 2.0,
}

# Age bands (right-closed) and their labels.
AGE_BIN_EDGES = (0, 30, 40, 50, 60, 100)
AGE_BIN_LABELS = ("18-30", "31-40", "41-50", "51-60", "60+")

# Retention recommendation (headline, text) by risk tier.
RECOMMENDATIONS = {
    "High": ("High Risk Customer", "Immediate retention action required. Assign to senior specialist."),
    "Medium": ("Medium Risk Customer", "Proactive engagement needed. Add to monitoring list."),
    "Low": ("Low Risk Customer", "Maintain standard service. Consider upsell opportunities."),
}

# Risk segments (name, predicate) of the exploratory segment table.
SEGMENTS = (
    ("Germany + Female + Inactive", "Geography = 'Germany' AND Gender = 'Female' AND IsActiveMember = 0"),
    ("Germany + Age>50", "Geography = 'Germany' AND Age > 50"),
    ("NumOfProducts >= 3", "NumOfProducts >= 3"),
    ("Germany + Female + NumOfProducts=1", "Geography = 'Germany' AND Gender = 'Female' AND NumOfProducts = 1"),
    ("Age>50 + Inactive", "Age > 50 AND IsActiveMember = 0"),
)


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0).cast("int")


def prod_features(df: DataFrame) -> DataFrame:
    """Production derived columns; each one only when its inputs exist (same code at fit and score)."""
    cols = set(df.columns)
    new: dict[str, Column] = {}
    if "Age" in cols:
        new["Age_log"] = F.log1p(F.col("Age").cast("double"))
    if {"Balance", "EstimatedSalary"} <= cols:
        new["Balance_Salary_Ratio"] = F.col("Balance") / (F.col("EstimatedSalary") + 1)
    if {"NumOfProducts", "Tenure"} <= cols:
        new["Products_Per_Tenure"] = F.col("NumOfProducts").cast("double") / (F.col("Tenure") + 1)
    if {"IsActiveMember", "HasCrCard"} <= cols:
        new["Active_CreditCard"] = (F.col("IsActiveMember") * F.col("HasCrCard")).cast("int")
    return df.withColumns(new) if new else df


def flag_columns() -> dict[str, Column]:
    return {
        "HasBalance": _flag(F.col("Balance") > 0),
        "IsSenior": _flag(F.col("Age") > 50),
        "Has3PlusProducts": _flag(F.col("NumOfProducts") >= 3),
        "IsInactive": _flag(F.col("IsActiveMember") == 0),
        "IsGermany": _flag(F.col("Geography") == "Germany"),
        "IsFemale": _flag(F.col("Gender") == "Female"),
    }


def flag_features(df: DataFrame) -> DataFrame:
    return df.withColumns(flag_columns())


def interaction_columns() -> dict[str, Column]:
    return {
        "Germany_Female": (F.col("IsGermany") * F.col("IsFemale")).cast("int"),
        "Senior_Inactive": (F.col("IsSenior") * F.col("IsInactive")).cast("int"),
        "Germany_Senior": (F.col("IsGermany") * F.col("IsSenior")).cast("int"),
    }


def interaction_features(df: DataFrame) -> DataFrame:
    return flag_features(df).withColumns(interaction_columns())


def ratio_columns() -> dict[str, Column]:
    return {
        "Age_Log": F.log1p(F.col("Age").cast("double")),
        "BalancePerProduct": F.col("Balance") / F.greatest(F.col("NumOfProducts"), F.lit(1)),
    }


def ratio_features(df: DataFrame) -> DataFrame:
    return df.withColumns(ratio_columns())


def risk_score_column() -> Column:
    total = None
    for name, w in RISK_WEIGHTS.items():
        term = F.lit(w) * F.col(name)
        total = term if total is None else total + term
    return total


def risk_score(df: DataFrame) -> DataFrame:
    """Flags + interactions + weighted risk score on a raw customer frame."""
    return interaction_features(df).withColumn("RiskScore", risk_score_column())


def age_bin(col: str = "Age") -> Column:
    """Right-closed age bands; outside (0, 100] -> null."""
    c = F.col(col)
    out = None
    for lo, hi, label in zip(AGE_BIN_EDGES[:-1], AGE_BIN_EDGES[1:], AGE_BIN_LABELS):
        cond = (c > lo) & (c <= hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def yes_no(col: Column) -> Column:
    return F.when(col == "Yes", 1).otherwise(0).cast("int")


def risk_tier(prob: Column) -> Column:
    """p >= 0.7 High, p >= 0.5 Medium, else Low."""
    return F.when(prob >= 0.7, "High").when(prob >= 0.5, "Medium").otherwise("Low")


def churn_label_text(prob: Column) -> Column:
    """'Will Churn' iff p > 0.5 (strict)."""
    return F.when(prob > 0.5, "Will Churn").otherwise("Will Stay")


def recommendation(tier: Column, part: int = 1) -> Column:
    """Retention text for a tier; ``part=0`` gives the headline."""
    out = None
    for k, v in RECOMMENDATIONS.items():
        out = F.when(tier == k, v[part]) if out is None else out.when(tier == k, v[part])
    return out


def clean_nonfinite(col: Column) -> Column:
    """NaN, +/-Inf and null -> 0.0."""
    d = col.cast("double")
    return F.when(d.isNull() | F.isnan(d) | (F.abs(d) == float("inf")), F.lit(0.0)).otherwise(d)


def significance_stars(p: Column) -> Column:
    return (
        F.when(p < 0.001, "YES ***")
        .when(p < 0.01, "YES **")
        .when(p < 0.05, "YES *")
        .otherwise("NO")
    )


def effect_size(d: Column) -> Column:
    a = F.abs(d)
    return F.when(a < 0.2, "Negligible").when(a < 0.5, "Small").when(a < 0.8, "Medium").otherwise("Large")


def effect_meaningful(d: Column) -> Column:
    a = F.abs(d)
    return F.when(a < 0.2, "NO").when(a < 0.5, "Maybe").when(a < 0.8, "YES").otherwise("YES!")


def exact_avg_round(col: str, digits: int = 4) -> Column:
    """ROUND(AVG(col), digits) (half up) computed exactly for non-negative values.

    Values are summed as integers in 1e-9 units (exact, independent of summation order), and the
    half-up division happens in integer arithmetic, so exact ties round the same way every time.
    """
    unit = 10**9
    scale = 10**digits
    s = F.sum(F.round(F.col(col) * unit).cast("decimal(38,0)"))
    n = F.count(col).cast("decimal(38,0)")
    q = (F.lit(2 * scale) * s + n * F.lit(unit)) / (F.lit(2) * n * F.lit(unit))
    return F.floor(q).cast("double") / scale


def exact_avg_round_sql(col: str, digits: int = 4) -> str:
    unit = 10**9
    scale = 10**digits
    s = f"sum(CAST(round({col} * {unit}) AS HUGEINT))"
    n = f"count({col})"
    return f"CAST(({2 * scale} * {s} + {n} * {unit}) // (2 * {n} * {unit}) AS DOUBLE) / {scale}"
