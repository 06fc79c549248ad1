"""Two-sample and association tests, effect sizes, KDE, VIF and PCA variance."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens import schema as S
from churnlens.functions import features as FX
from churnlens.functions.prefix import running_sums
from churnlens.functions.stats import KS_EXACT_LAMBDA, KS_EXACT_ROWS, chi2_sf, ks_exact_pvalue, ks_pvalue
from churnlens.operators.explore import CROSSTAB_FEATURES, stack_columns, wide_stats

KS_FEATURES = S.NUMERIC_COLUMNS
COHEN_FEATURES = ("CreditScore", "Age", "Tenure", "Balance", "EstimatedSalary")


def ks_two_sample(long: DataFrame, sample_col: str, first, second, group: str = "feature") -> DataFrame:
    """KS statistic per ``group`` between two samples of a long ``(group, sample, value)`` frame.

    Counts per distinct value, exact running sums of both samples in one two-phase pass, then
    ``D = max |F1 - F2|`` per group.  The p-value counts lattice paths for samples of up to
    ``KS_EXACT_ROWS`` rows and is the asymptotic Kolmogorov one beyond.
    """
    counts = (
        long.where(F.col("value").isNotNull())
        .groupBy(group, "value")
        .agg(
            F.count_if(F.col(sample_col) == first).alias("c1"),
            F.count_if(F.col(sample_col) == second).alias("c2"),
        )
    )
    cum = running_sums(counts, [group], "value", ["c1", "c2"])
    small = F.greatest("n1", "n2") <= KS_EXACT_ROWS
    # The distance in whole steps of 1 / (n1 n2), where it is counted.
    steps = F.when(small, F.abs(F.col("cum_c1").cast("bigint") * F.col("n2") - F.col("cum_c2").cast("bigint") * F.col("n1")))
    d = (
        cum.withColumns({"n1": F.col("tot_c1").cast("bigint"), "n2": F.col("tot_c2").cast("bigint")})
        .groupBy(group, "n1", "n2")
        .agg(
            F.max(F.abs(F.col("cum_c1") / F.col("n1") - F.col("cum_c2") / F.col("n2"))).alias("statistic"),
            F.max(steps).alias("steps"),
        )
    )
    spread = F.col("statistic") * F.sqrt(F.col("n1") / (F.col("n1") + F.col("n2")) * F.col("n2"))
    p = F.when(
        small & (F.least("n1", "n2") > 0) & (spread <= KS_EXACT_LAMBDA), ks_exact_pvalue(F.col("steps"), F.col("n1"), F.col("n2"))
    ).otherwise(ks_pvalue("statistic", "n1", "n2"))
    return d.select(group, "n1", "n2", F.round("statistic", 6).alias("statistic"), F.round(p, 6).alias("p_value"))


def ks_drift(split_df: DataFrame, threshold: float = 0.05, columns: Sequence[str] | None = None) -> DataFrame:
    """Train (base) vs test (current) drift on every numeric column; drift iff p < threshold."""
    from churnlens.operators.profile import numeric_columns

    cols = list(columns or numeric_columns(split_df.drop("split")))
    long = stack_columns(split_df, cols, keep=["split"], as_string=False)
    ks = ks_two_sample(long, "split", "train", "test")
    return ks.select("feature", "statistic", "p_value", (F.col("p_value") < threshold).cast("int").alias("drift"))


def ks_by_class(df: DataFrame, columns: Sequence[str] = KS_FEATURES) -> DataFrame:
    long = stack_columns(df, columns, keep=[S.TARGET], as_string=False)
    ks = ks_two_sample(long, S.TARGET, 0, 1)
    return ks.select(
        "feature", F.col("n1").alias("n_retained"), F.col("n2").alias("n_churned"), "statistic", "p_value",
        FX.significance_stars(F.col("p_value")).alias("significant"),
    )


def contingency(df: DataFrame, features: Sequence[str] = CROSSTAB_FEATURES) -> DataFrame:
    """Observed counts of (feature value, class) with row, column and grand totals attached."""
    long = stack_columns(df, features, keep=[S.TARGET]).where(F.col("value").isNotNull() & F.col(S.TARGET).isNotNull())
    cells = long.groupBy("feature", "value", F.col(S.TARGET).alias("label")).agg(F.count(F.lit(1)).alias("o"))
    rows = cells.groupBy("feature", "value").agg(F.sum("o").alias("row_t"))
    cols = cells.groupBy("feature", "label").agg(F.sum("o").alias("col_t"))
    dims = cells.groupBy("feature").agg(
        F.sum("o").alias("n"), F.count_distinct("value").alias("r"), F.count_distinct("label").alias("c")
    )
    # Complete the grid so zero cells contribute their expected count.
    grid = rows.join(cols, "feature").join(cells, ["feature", "value", "label"], "left").join(dims, "feature")
    return grid.select("feature", "value", "label", F.coalesce("o", F.lit(0)).alias("o"), "row_t", "col_t", "n", "r", "c")


def chi_square(df: DataFrame, features: Sequence[str] = CROSSTAB_FEATURES) -> DataFrame:
    """Pearson chi-square of independence per feature vs churn; Yates correction when dof = 1."""
    g = contingency(df, features).withColumn("e", F.col("row_t") * F.col("col_t") / F.col("n"))
    g = g.withColumn("dof", (F.col("r") - 1) * (F.col("c") - 1))
    dev = F.abs(F.col("o") - F.col("e"))
    corr = F.when(F.col("dof") == 1, F.least(F.lit(0.5), dev)).otherwise(0.0)
    stat = g.groupBy("feature", "dof", "n", "r", "c").agg(
        F.sum(F.pow(dev - corr, 2) / F.col("e")).alias("chi2"),
        F.sum(F.pow(dev, 2) / F.col("e")).alias("chi2_uncorrected"),
    )
    return stat.select(
        "feature", "dof", "n", "r", "c",
        F.round("chi2", 6).alias("chi2"),
        F.round("chi2_uncorrected", 6).alias("chi2_uncorrected"),
        F.round(chi2_sf("chi2", "dof"), 6).alias("p_value"),
    ).withColumn("significant", FX.significance_stars(F.col("p_value")))


def cramers_v(chi: DataFrame) -> DataFrame:
    """V = sqrt(chi2 / (n * (min(r, c) - 1))) on the uncorrected statistic, with a size label."""
    v = F.sqrt(F.col("chi2_uncorrected") / (F.col("n") * (F.least("r", "c") - 1)))
    return chi.select("feature", F.round(v, 6).alias("cramers_v")).withColumn(
        "strength",
        F.when(F.col("cramers_v") < 0.1, "Negligible").when(F.col("cramers_v") < 0.3, "Small")
        .when(F.col("cramers_v") < 0.5, "Medium").otherwise("Large"),
    )


def cohens_d(df: DataFrame, columns: Sequence[str] = COHEN_FEATURES) -> DataFrame:
    """(mean churned - mean retained) / pooled sample std, with effect label; one aggregation."""
    def of(label: int, fn):
        return lambda value: fn(F.when(F.col(S.TARGET) == label, value))

    g = wide_stats(df, columns, {
        "n0": of(0, F.count), "n1": of(1, F.count), "m0": of(0, F.avg), "m1": of(1, F.avg), "v0": of(0, F.var_samp), "v1": of(1, F.var_samp),
    })
    pooled = F.sqrt(((F.col("n0") - 1) * F.col("v0") + (F.col("n1") - 1) * F.col("v1")) / (F.col("n0") + F.col("n1") - 2))
    d = F.try_divide(F.col("m1") - F.col("m0"), pooled)
    return g.select("feature", F.round(d, 6).alias("cohens_d")).select(
        "feature", "cohens_d", FX.effect_size(F.col("cohens_d")).alias("effect"), FX.effect_meaningful(F.col("cohens_d")).alias("useful")
    )


#: Width of a cell of the transform in bandwidths, terms of its series, and the distance in bandwidths
#: beyond which a cell adds nothing to a point.  With u = 1/4 the largest offset of a value from its
#: cell's centre in bandwidths, a value's series leaves out at most K u^p / sqrt(p!) / (1 - u) of its kernel
#: with K = 1.09 (Cramer's bound on Hermite functions): 2e-14 at p = 14; a cell out of reach, exp(-32) = 1e-14.
KDE_CELL, KDE_TERMS, KDE_REACH = 0.5, 14, 8.25


def kde_density(df: DataFrame, columns: Sequence[str] = S.NUMERIC_COLUMNS, points: int = 200,
                by: Sequence[str] = (), bounds: tuple[float, float] | None = None) -> DataFrame:
    """Gaussian KDE (Scott bandwidth n^-1/5 * sample std) on ``points`` grid points over [min, max] of
    the group, or over ``bounds``; ``by`` gives every group of those columns a density of its own.

    Fast Gauss transform: values fall into cells of half a bandwidth, one aggregate keeps the first
    ``KDE_TERMS`` moments of each cell about its centre, and the Hermite series of a cell is summed at
    the grid points in its reach.  No row is made per value and point; cells number at most twice the
    range in bandwidths.  The error is below 1e-12 of the density's scale 1 / h.  Columns with zero spread
    are skipped (as the plot does)."""
    keys = ["feature", *by]
    long = stack_columns(df, columns, keep=list(by), as_string=False).where(F.col("value").isNotNull())
    st = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("value").alias("sd"), F.min("value").alias("least"), F.max("value").alias("most")
    ).where(F.col("sd") > 0)
    st = st.withColumns({
        "h": F.pow(F.col("n").cast("double"), -0.2) * F.col("sd"),
        "lo": F.lit(float(bounds[0])) if bounds else F.col("least"), "hi": F.lit(float(bounds[1])) if bounds else F.col("most"),
    })
    # Without groups one stats row per column, bounded by the column list; groups have no such bound.
    j = long.join(st if by else F.broadcast(st), keys)
    at = (F.col("value") - F.col("least")) / F.col("h")  # in bandwidths from the least value
    cell = F.floor(at / KDE_CELL).cast("long")
    off = at - (cell + 0.5) * KDE_CELL
    moments = [F.sum(F.pow(off, i) / math.factorial(i)).alias(f"m{i}") for i in range(KDE_TERMS)]
    cells = j.groupBy(*keys, cell.alias("cell"), "n", "h", "lo", "hi", "least").agg(*moments)
    # Every group keeps a row for each point, also where no cell reaches.
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    centre = F.col("least") + (F.col("cell") + 0.5) * KDE_CELL * F.col("h")
    first = F.greatest(F.lit(0), F.ceil((centre - KDE_REACH * F.col("h") - F.col("lo")) / step).cast("int"))
    last = F.least(F.lit(points - 1), F.floor((centre + KDE_REACH * F.col("h") - F.col("lo")) / step).cast("int"))
    near = cells.withColumn("k", F.explode(F.when(first <= last, F.sequence(first, last))))
    y = (F.col("lo") + F.col("k") * step - centre) / F.col("h")
    # Hermite polynomials of the Gaussian exp(-y^2 / 2) by their recurrence, times the moments.
    he = F.lit(KDE_TERMS - 1)
    series = F.aggregate(
        F.sequence(F.lit(1), he),
        F.struct(F.lit(0.0).alias("a"), F.lit(1.0).alias("b"), F.col("m0").alias("s")),
        lambda z, i: F.struct(
            z["b"].alias("a"), (y * z["b"] - (i - 1) * z["a"]).alias("b"),
            (z["s"] + F.array(*[F.col(f"m{i}") for i in range(KDE_TERMS)])[i] * (y * z["b"] - (i - 1) * z["a"])).alias("s"),
        ),
        lambda z: z["s"],
    )
    sums = near.groupBy(*keys, "k").agg(F.sum(F.exp(-0.5 * y * y) * series).alias("d"))
    grid = st.select(*keys, "n", "h", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("k"))
    dens = grid.alias("g").join(sums.alias("s"), [F.col(f"g.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*keys, "k")], "left")
    value = F.coalesce("s.d", F.lit(0.0)) / (F.col("g.n") * F.col("g.h") * F.sqrt(F.lit(2 * 3.141592653589793)))
    return dens.select(
        *[F.col(f"g.{c}").alias(c) for c in (*keys, "k")], F.round(F.col("g.lo") + F.col("g.k") * step, 6).alias("x"),
        F.round(F.greatest(value, F.lit(0.0)), 10).alias("density"),
    )


def feature_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of ``columns``, long ``(var1, var2, corr)``; null where a
    column is constant, 1 on the diagonal.  One distributed pass; only the k x k matrix reaches the driver."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    cols = list(columns)
    vectors = VectorAssembler(inputCols=cols, outputCol="_v").transform(df).select("_v")
    m = Correlation.corr(vectors, "_v").first()[0].toArray()
    rows = [
        (a, b, 1.0 if i == j else None if m[i, j] != m[i, j] else round(float(m[i, j]), 6) + 0.0)
        for i, a in enumerate(cols) for j, b in enumerate(cols)
    ]
    return df.sparkSession.createDataFrame(rows, "var1 string, var2 string, corr double")


def gram_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Uncentred X'X as long ``(i, j, g)`` in one distributed aggregate."""
    cols = list(columns)
    aggs = [F.sum(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"g_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]
    return df.agg(*aggs)


def vif(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Variance inflation per column without an intercept (uncentred R^2 of x_i on the others).

    Only the k x k Gram matrix X'X (one distributed aggregate) reaches the driver.  With
    G the Gram matrix: RSS_i = G_ii - g_i' pinv(G_oo) g_i and VIF_i = G_ii / RSS_i; columns that are
    exact combinations of others (a full one-hot block) get ``inf``.
    """
    import numpy as np

    cols = list(columns)
    k = len(cols)
    row = gram_matrix(df, cols).first()
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = row[f"g_{i}_{j}"] or 0.0
    vals = []
    for i in range(k):
        others = [j for j in range(k) if j != i]
        gii = g[i, i]
        if not others or gii == 0:
            vals.append(float("inf") if gii == 0 else 1.0)
            continue
        goo = g[np.ix_(others, others)]
        gi = g[others, i]
        rss = gii - gi @ np.linalg.pinv(goo, rcond=1e-12) @ gi
        vals.append(float("inf") if rss <= 1e-9 * gii else float(gii / rss))
    return df.sparkSession.createDataFrame(list(zip(cols, vals)), "feature string, vif double")


def pca_variance(df: DataFrame, features_col: str = "features") -> DataFrame:
    """Explained-variance ratio and cumulative ratio of all principal components (centred first)."""
    from pyspark.ml.feature import PCA, StandardScaler

    centred = StandardScaler(inputCol=features_col, outputCol="_c", withMean=True, withStd=False).fit(df).transform(df)
    k = len(df.select(features_col).first()[0])
    model = PCA(k=k, inputCol="_c", outputCol="_p").fit(centred)
    ev = [float(x) for x in model.explainedVariance.toArray()]
    cum, rows = 0.0, []
    for i, v in enumerate(ev):
        cum += v
        rows.append((i + 1, v, cum))
    return df.sparkSession.createDataFrame(rows, "component int, explained_variance_ratio double, cumulative_ratio double")
