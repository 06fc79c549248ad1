"""Split invariants, closed-form p-values, chi-square with Yates, KDE sanity."""

import math

from pyspark.sql import functions as F

from churnlens.functions.stats import chi2_sf, ks_pvalue
from churnlens.operators import ranking as R
from churnlens.operators import stattests as ST
from churnlens.sources.fixture import bank_customers

from conftest import SF_CHECK, SF_SMALL


def test_scalable_split_equals_window_split(spark):
    df = bank_customers(spark, SF_CHECK)
    a = R.stratified_split(df).select("CustomerId", "split")
    b = R.stratified_split_window(df).select("CustomerId", F.col("split").alias("s2"))
    j = a.join(b, "CustomerId")
    assert j.count() == df.count()
    assert j.where("split <> s2").count() == 0


def test_split_counts_stratified(spark):
    s = R.stratified_split(bank_customers(spark, SF_CHECK))
    c = {(r.Exited, r.split): r["count"] for r in s.groupBy("Exited", "split").count().collect()}
    assert c == {(0, "test"): 240, (1, "test"): 60, (0, "train"): 961, (1, "train"): 239}


def test_chi2_sf_known_values(spark):
    df = spark.createDataFrame([(3.841458820694124, 1), (5.991464547107979, 2), (11.070497693516351, 5)], "x double, d int")
    ps = [r.p for r in df.select(chi2_sf("x", "d").alias("p")).collect()]
    assert all(abs(p - 0.05) < 1e-9 for p in ps)


def test_ks_pvalue_known_value(spark):
    # Kolmogorov tail: Q(1.36) = 0.0494859, Q(1.0) = 0.2699997 (n1*n2/(n1+n2) ~= 1)
    df = spark.createDataFrame([(1.36, 1, 10**12), (1.0, 1, 10**12), (0.5, 1, 10**12)], "d double, n1 long, n2 long")
    p = [r.p for r in df.select(ks_pvalue("d", "n1", "n2").alias("p")).collect()]
    assert abs(p[0] - 0.0494859) < 1e-6 and abs(p[1] - 0.2699997) < 1e-6 and abs(p[2] - 0.9639452) < 1e-6


def test_chi_square_yates_two_by_two(spark):
    # table [[10, 20], [20, 10]]: Yates chi2 = sum((|O-E| - 0.5)^2 / E) with E = 15 -> 4 * 4.5^2 / 15
    rows = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 20 + [("b", 1)] * 10
    df = spark.createDataFrame(rows, "Geography string, Exited int")
    r = ST.chi_square(df, ["Geography"]).first()
    assert r.dof == 1 and abs(r.chi2 - 4 * 4.5**2 / 15) < 1e-6 and abs(r.chi2_uncorrected - 4 * 25 / 15) < 1e-6


def test_kde_integrates_to_about_one(spark):
    d = ST.kde_density(bank_customers(spark, SF_SMALL), ["Age"]).toPandas().sort_values("k")
    step = d["x"].iloc[1] - d["x"].iloc[0]
    assert 0.8 < d["density"].sum() * step < 1.05


def test_vif_identity_and_singular(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1.0), (0.0, 1.0, 1.0), (1.0, 1.0, 2.0), (2.0, 1.0, 3.0)], "a double, b double, c double")
    v = {r.feature: r.vif for r in ST.vif(df, ["a", "b", "c"]).collect()}
    assert all(math.isinf(x) for x in v.values())  # c = a + b exactly
    v2 = {r.feature: r.vif for r in ST.vif(df, ["a", "b"]).collect()}
    assert all(x >= 1.0 and not math.isinf(x) for x in v2.values())


def test_kde_reach_matches_full_grid_brute_force(spark):
    # A tight cluster plus far outliers: the bandwidth is a small fraction of the range, so most
    # values reach only a few grid points; every grid point must still appear with the exact sum.
    import numpy as np

    vals = [float(i % 50) / 10.0 for i in range(400)] + [1000.0, 2000.0, 2000.0]
    df = spark.createDataFrame([(v,) for v in vals], "Balance double")
    got = ST.kde_density(df, ["Balance"], points=200).toPandas().sort_values("k")
    x = np.asarray(vals)
    n, h = len(x), len(x) ** -0.2 * x.std(ddof=1)
    grid = x.min() + np.arange(200) * ((x.max() - x.min()) / 199)
    want = (np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2) / (n * h * math.sqrt(2 * math.pi))).sum(axis=1)
    assert list(got["k"]) == list(range(200))
    assert np.allclose(got["density"].to_numpy(), np.round(want, 10), atol=1e-10)
    assert (got["density"] == 0).sum() > 100  # the reach cut is exercised


def test_chi2_tail_for_any_dof(spark):
    """Against the Wilson-Hilferty value (about 1e-3 at dof 1,000, better above) and exact closed forms."""
    import math

    def approx(x, k):
        z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
        return 0.5 * math.erfc(z / math.sqrt(2))

    cases = [(x, k) for k in (1000, 10_000, 100_000) for x in (k - 2 * math.sqrt(2 * k), k, k + math.sqrt(2 * k), k + 3 * math.sqrt(2 * k))]
    cases += [(100_447.0, 100_000), (10_400.0, 10_000), (900.0, 1), (3.0, 1), (0.01, 1), (5.0, 2), (50.0, 2)]
    df = spark.createDataFrame([(float(x), int(k)) for x, k in cases], "x double, d int")
    for r in df.select("x", "d", chi2_sf("x", "d").alias("p")).collect():
        want = math.erfc(math.sqrt(r.x / 2)) if r.d == 1 else math.exp(-r.x / 2) if r.d == 2 else approx(r.x, r.d)
        assert abs(r.p - want) < (1e-9 if r.d < 3 else 2e-4), (r.x, r.d, r.p, want)


def test_split_moves_and_writes_no_row(spark, tmp_path):
    df = spark.range(1, 1001).selectExpr("id AS CustomerId", "CAST(id % 7 = 0 AS INT) AS Exited")
    plan = R.stratified_split(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Scan parquet" not in plan and "Window" not in plan


def test_split_of_empty_small_and_null_classes(spark):
    empty = spark.createDataFrame([], "CustomerId long, Exited int")
    assert R.stratified_split(empty).count() == 0
    rows = [(i, None if i % 3 == 0 else i % 3) for i in range(1, 41)] + [(100, 5)]
    df = spark.createDataFrame(rows, "CustomerId long, Exited int")
    key = lambda d: sorted((r.CustomerId, r.split) for r in d.collect())
    assert key(R.stratified_split(df)) == key(R.stratified_split_window(df))


def test_kde_of_groups_equals_kde_of_each_group_alone(spark):
    df = bank_customers(spark, SF_SMALL)
    key = lambda rows: {r.k: r.density for r in rows}
    both = ST.kde_density(df, ["Age"], points=50, by=["Geography"], bounds=(18, 80)).where("Geography = 'Spain'").collect()
    alone = ST.kde_density(df.where("Geography = 'Spain'"), ["Age"], points=50, bounds=(18, 80)).collect()
    assert key(both) == key(alone) and len(both) == 50


def test_feature_correlation_of_constant_and_opposite_columns(spark):
    df = spark.createDataFrame([(1.0, -2.0, 3.0), (2.0, -4.0, 3.0), (4.0, -8.0, 3.0)], "a double, b double, c double")
    got = {(r.var1, r.var2): r["corr"] for r in ST.feature_correlation(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == -1.0 and got["a", "c"] is None and got["c", "c"] == 1.0


def test_wide_stats_per_group_with_nulls(spark):
    from churnlens.operators.explore import wide_stats

    df = spark.createDataFrame([("x", 1, None), ("x", 3, 2.0), ("y", None, 4.0)], "k string, a int, b double")
    got = {(r.k, r.feature): (r.n, r.m) for r in wide_stats(df, ["a", "b"], {"n": F.count, "m": F.avg}, ["k"]).collect()}
    assert got == {("x", "a"): (2, 2.0), ("x", "b"): (1, 2.0), ("y", "a"): (0, None), ("y", "b"): (1, 4.0)}
    empty = wide_stats(df.where("k = 'z'"), ["a"], {"n": F.count, "m": F.avg}).collect()
    assert [(r.feature, r.n, r.m) for r in empty] == [("a", 0, None)]


def test_ks_exact_pvalue_equals_counted_paths(spark):
    from itertools import combinations

    from churnlens.functions.stats import ks_exact_pvalue

    rows, want = [], {}
    for m, n in ((1, 1), (2, 5), (5, 3), (4, 4), (6, 7), (1, 9)):
        worst = []
        for first in combinations(range(m + n), m):
            i, most = 0, 0
            for t in range(m + n):
                i += t in first
                most = max(most, abs(i * n - (t + 1 - i) * m))
            worst.append(most)
        for h in range(0, m * n + 1):
            rows.append((h, m, n))
            want[h, m, n] = sum(w >= h for w in worst) / len(worst)
    df = spark.createDataFrame(rows, "h long, m long, n long")
    for r in df.select("h", "m", "n", ks_exact_pvalue(F.col("h"), F.col("m"), F.col("n")).alias("p")).collect():
        assert abs(r["p"] - want[r["h"], r["m"], r["n"]]) < 1e-12, r
