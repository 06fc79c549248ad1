"""Shared DuckDB CTEs for the oracle SQL (same derivations as ``sources.fixture``)."""

from __future__ import annotations

BANK_CUSTOMERS = """
bank_customers AS (
  WITH o AS (SELECT o_custkey, count(*) AS n, min(o_orderdate) AS lo, max(o_orderdate) AS hi,
                    sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
             FROM orders GROUP BY o_custkey),
  f AS (SELECT c_custkey + 1 AS RowNumber, c_custkey AS CustomerId, c_name AS Surname,
    CAST(300 + (c_custkey * 7919) % 551 AS INT) AS CreditScore,
    CASE c_nationkey % 4 WHEN 2 THEN 'Germany' WHEN 3 THEN 'Spain' ELSE 'France' END AS Geography,
    CASE WHEN (c_custkey * 31) % 11 < 5 THEN 'Female' ELSE 'Male' END AS Gender,
    CAST(18 + (c_custkey * 613) % 53 + CASE WHEN (c_custkey * 389) % 23 < 5 THEN (c_custkey * 389) % 23 ELSE 0 END AS INT) AS Age,
    CAST(least(10, coalesce(year(hi) - year(lo), 0)) AS INT) AS Tenure,
    CASE WHEN c_acctbal <= 1000 OR (c_custkey * 17) % 10 < 2 THEN CAST(0 AS DOUBLE) ELSE c_acctbal * 20 END AS Balance,
    CAST(CASE WHEN coalesce(n, 0) >= 15 THEN 4 WHEN coalesce(n, 0) >= 13 THEN 3 WHEN coalesce(n, 0) >= 9 THEN 2 ELSE 1 END AS INT) AS NumOfProducts,
    CAST(CASE WHEN (c_custkey * 53) % 10 < 7 THEN 1 ELSE 0 END AS INT) AS HasCrCard,
    CAST(CASE WHEN (c_custkey * 71) % 100 < 52 THEN 1 ELSE 0 END AS INT) AS IsActiveMember,
    CAST(coalesce(cents, 0) AS DOUBLE) / 1000 AS EstimatedSalary
   FROM customer LEFT JOIN o ON o_custkey = c_custkey)
  SELECT *, CAST(CASE WHEN CASE WHEN Geography = 'Germany' THEN 16 ELSE 0 END + CASE WHEN Age > 50 THEN 28 ELSE 0 END
    + CASE WHEN IsActiveMember = 0 THEN 12 ELSE 0 END + CASE WHEN Gender = 'Female' THEN 8 ELSE 0 END
    + CASE WHEN NumOfProducts >= 3 THEN 30 ELSE 0 END + (CustomerId * 7561) % 101 >= 113 THEN 1 ELSE 0 END AS INT) AS Exited
  FROM f
)"""

PREDICTIONS = """
preds AS (
  SELECT o_orderkey AS id, o_custkey AS customer_id, CAST((o_orderkey * 7919) % 1000 AS DOUBLE) / 1000 AS churn_probability,
    CAST(CASE WHEN (o_orderkey * 7919) % 1000 > 500 THEN 1 ELSE 0 END AS INT) AS churn_prediction,
    CASE WHEN (o_orderkey * 7919) % 1000 >= 700 THEN 'High' WHEN (o_orderkey * 7919) % 1000 >= 500 THEN 'Medium' ELSE 'Low' END AS risk_category,
    concat('v', CAST(o_orderkey % 3 AS VARCHAR)) AS model_version, CAST(o_orderdate AS DATE) AS prediction_date
  FROM orders
)"""

#: The log of the first three customers in five: what the operators on unscored customers start from.
SCORED = PREDICTIONS.replace("FROM orders\n", "FROM orders WHERE o_custkey % 5 < 3\n")

SPLIT = """
split_customers AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY Exited ORDER BY (CustomerId * 2654435761) % 4294967296, CustomerId)
    <= round(0.2 * count(*) OVER (PARTITION BY Exited)) THEN 'test' ELSE 'train' END AS split
  FROM bank_customers
)"""

TEST_DATA = """
test_data AS (
  SELECT RowNumber AS id, CustomerId AS customer_id, CreditScore AS credit_score, Geography AS geography, Gender AS gender,
    Age AS age, Tenure AS tenure, Balance AS balance, NumOfProducts AS num_of_products, HasCrCard AS has_credit_card,
    IsActiveMember AS is_active_member, EstimatedSalary AS estimated_salary, CAST(0 AS INT) AS is_scored
  FROM bank_customers
)"""

TRAINING_DATA = """
training_data AS (
  SELECT RowNumber AS id, CustomerId AS customer_id, CreditScore AS credit_score, Geography AS geography, Gender AS gender,
    Age AS age, Tenure AS tenure, Balance AS balance, NumOfProducts AS num_of_products, HasCrCard AS has_credit_card,
    IsActiveMember AS is_active_member, EstimatedSalary AS estimated_salary, Exited AS exited
  FROM bank_customers
)"""

RISK = """
risk AS (
  SELECT *, CAST(1.6 AS DOUBLE) * IsGermany + CAST(1.2 AS DOUBLE) * IsFemale + CAST(1.3 AS DOUBLE) * IsInactive
       + CAST(1.5 AS DOUBLE) * IsSenior + CAST(4.2 AS DOUBLE) * Has3PlusProducts + CAST(2.0 AS DOUBLE) * Senior_Inactive AS RiskScore
  FROM (SELECT *, IsGermany * IsFemale AS Germany_Female, IsSenior * IsInactive AS Senior_Inactive,
               IsGermany * IsSenior AS Germany_Senior
        FROM (SELECT *, CAST(Balance > 0 AS INT) AS HasBalance, CAST(Age > 50 AS INT) AS IsSenior,
                     CAST(NumOfProducts >= 3 AS INT) AS Has3PlusProducts, CAST(IsActiveMember = 0 AS INT) AS IsInactive,
                     CAST(Geography = 'Germany' AS INT) AS IsGermany, CAST(Gender = 'Female' AS INT) AS IsFemale
              FROM bank_customers) f0) f1
)"""

_ORDER = ["BANK", "SPLIT", "PRED", "SCORED", "TEST", "TRAIN", "RISK"]
_CTES = {"BANK": BANK_CUSTOMERS, "SPLIT": SPLIT, "PRED": PREDICTIONS, "SCORED": SCORED, "TEST": TEST_DATA, "TRAIN": TRAINING_DATA, "RISK": RISK}


def with_ctes(body: str, *needs: str, extra: str = "") -> str:
    """``WITH <bank_customers>[, split_customers, preds, test_data, training_data, risk][, extra] body``."""
    names = {"BANK", *needs}
    parts = [_CTES[n].strip() for n in _ORDER if n in names]
    if extra.strip():
        parts.append(extra.strip())
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
