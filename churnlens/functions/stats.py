"""Closed-form test distributions as SQL expressions (run JVM-side in Spark, and in DuckDB).

Each builder takes SQL text for its inputs and a ``dialect`` (``"spark"`` or ``"duckdb"``) and
returns SQL text; Spark callers wrap it in ``F.expr``.  Series are summed left to right in both
dialects so the two engines agree to rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KS_TERMS = 20


def _series(dialect: str, n_from: int, n_to: int, var: str, term: str) -> str:
    """sum_{var = n_from..n_to} term, folded left to right."""
    if dialect == "spark":
        return f"aggregate(sequence({n_from}, {n_to}), CAST(0 AS DOUBLE), (acc_, {var}) -> acc_ + ({term}))"
    return (
        f"list_reduce(list_transform(range({n_from}, {n_to} + 1), lambda {var}: CAST({term} AS DOUBLE)), "
        f"lambda acc_, t_: acc_ + t_)"
    )


def ks_pvalue_sql(d: str, n1: str, n2: str, dialect: str = "spark") -> str:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value Q(lambda), lambda = D*sqrt(n1*n2/(n1+n2))."""
    lam = f"(({d}) * sqrt(CAST({n1} AS DOUBLE) * ({n2}) / (({n1}) + ({n2}))))"
    small = _series(dialect, 1, KS_TERMS, "k_", f"exp(-((2 * k_ - 1) * (2 * k_ - 1)) * pi() * pi() / (8 * {lam} * {lam}))")
    large = _series(dialect, 1, KS_TERMS, "k_", f"(CASE WHEN k_ % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2 * k_ * k_ * {lam} * {lam})")
    raw = (
        f"CASE WHEN {lam} < 1e-9 THEN 1.0 "
        f"WHEN {lam} < 1.18 THEN 1.0 - sqrt(2 * pi()) / {lam} * {small} "
        f"ELSE {large} END"
    )
    return f"least(1.0, greatest(0.0, {raw}))"


#: Largest sample for which the distribution is counted; beyond it the asymptotic one is used.
KS_EXACT_ROWS = 10_000
#: Above this lambda the probability is below 1e-13, so it is not counted either.
KS_EXACT_LAMBDA = 4.0


def ks_exact_pvalue(h: Column, n1: Column, n2: Column) -> Column:
    """P(D >= h / (n1 n2)) of two samples of one continuous distribution, by lattice paths.

    The merged sample is a path from (0, 0) to (m, n), m the smaller, each order equally likely.  The fold
    goes through its m + n steps and holds, for the first coordinates i of a step that keep
    |i n - j m| < h, the probability of being there and of never having been outside."""
    m, n = F.least(n1, n2).cast("long"), F.greatest(n1, n2).cast("long")

    def step(row: Column, t: Column) -> Column:
        left = (m + n - t + 1).cast("double")
        # i (m + n) lies strictly between t m - h and t m + h.
        low = F.greatest(F.lit(0), t - n, F.floor((t * m - h) / (m + n)).cast("long") + 1)
        high = F.least(m, t, F.ceil((t * m + h) / (m + n)).cast("long") - 1)

        def before(i: Column) -> Column:
            return F.coalesce(F.get(row["p"], (i - row["low"]).cast("int")), F.lit(0.0))

        cells = F.transform(F.sequence(low, high), lambda i: before(i) * (n - (t - 1 - i)) / left + before(i - 1) * (m - i + 1) / left)
        return F.struct(low.alias("low"), F.when(low <= high, cells).otherwise(F.array().cast("array<double>")).alias("p"))

    start = F.struct(F.lit(0).cast("long").alias("low"), F.array(F.lit(1.0)).alias("p"))
    inside = F.aggregate(F.sequence(F.lit(1).cast("long"), m + n), start, step, lambda row: F.coalesce(F.get(row["p"], F.lit(0)), F.lit(0.0)))
    return F.when(h <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1.0 - inside))


def _lngamma_sql(z: str) -> str:
    """ln Gamma(z) for z > 0: Stirling series at z + 8, shifted back by the recurrence."""
    w = f"(({z}) + 8)"
    stirling = (
        f"(({w} - 0.5) * ln({w}) - {w} + 0.5 * ln(2 * pi()) + 1 / (12 * {w}) - 1 / (360 * power({w}, 3))"
        f" + 1 / (1260 * power({w}, 5)) - 1 / (1680 * power({w}, 7)))"
    )
    shift = " + ".join(f"ln(({z}) + {i})" for i in range(8))
    return f"({stirling} - ({shift}))"


def chi2_sf_sql(x: str, dof: str) -> str:
    """Upper tail of the chi-square distribution, Q(a = dof / 2, h = x / 2), for any ``dof``.

    Below the mean the series of the lower tail, above it the continued fraction of the upper one.
    Either needs some sqrt(a) steps, so their number follows ``a``."""
    a = f"(CAST({dof} AS DOUBLE) / 2)"
    h = f"(CAST({x} AS DOUBLE) / 2)"
    steps = f"CAST(ceil(12 * sqrt({a})) + 200 AS INT)"
    front = f"exp(-{h} + {a} * ln({h}) - {_lngamma_sql(a)})"
    series = (
        f"aggregate(sequence(1, {steps}), named_struct('t', 1 / {a}, 's', 1 / {a}), "
        f"(z, n_) -> named_struct('t', z.t * {h} / ({a} + n_), 's', z.s + z.t * {h} / ({a} + n_)), z -> z.s)"
    )
    # Steed's form: convergents d and deltas of the continued fraction 1 / (h + 1 - a - 1 (1 - a) / ...).
    first = f"1 / ({h} + 1 - {a})"
    d = f"(1 / (({h} + 1 - {a} + 2 * n_) - n_ * (n_ - {a}) * z.d))"
    fraction = (
        f"aggregate(sequence(1, {steps}), named_struct('d', {first}, 'e', {first}, 's', {first}), "
        f"(z, n_) -> named_struct('d', {d}, 'e', (({h} + 1 - {a} + 2 * n_) * {d} - 1) * z.e, "
        f"'s', z.s + (({h} + 1 - {a} + 2 * n_) * {d} - 1) * z.e), z -> z.s)"
    )
    return (
        f"CASE WHEN ({x}) IS NULL OR ({dof}) IS NULL OR ({dof}) <= 0 THEN NULL "
        f"WHEN {h} <= 0 THEN CAST(1 AS DOUBLE) "
        f"WHEN {h} < {a} + 1 THEN least(1.0, greatest(0.0, 1.0 - {front} * {series})) "
        f"ELSE least(1.0, greatest(0.0, {front} * {fraction})) END"
    )


def ks_pvalue(d: str, n1: str, n2: str) -> Column:
    return F.expr(ks_pvalue_sql(d, n1, n2, "spark"))


def chi2_sf(x: str, dof: str) -> Column:
    return F.expr(chi2_sf_sql(x, dof))
