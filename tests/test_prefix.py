"""Two-phase running sums and exact quantiles against pandas / numpy (incl. a hot group)."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlens.functions.prefix import exact_quantiles, running_sums


def test_running_sums_hot_group_many_partitions(spark):
    rng = np.random.default_rng(0)
    # group 'a' holds most of the rows: it must be split over many partitions and stay exact
    g = np.where(rng.random(3000) < 0.7, "a", rng.choice(["b", "c"], 3000))
    v = rng.integers(0, 100000, 3000)
    pdf = pd.DataFrame({"g": g, "v": v, "w": rng.integers(1, 5, 3000)}).groupby(["g", "v"], as_index=False)["w"].sum()
    df = spark.createDataFrame(pdf)
    out = running_sums(df, ["g"], "v", ["w"], num_partitions=16).toPandas().sort_values(["g", "v"])
    exp = pdf.sort_values(["g", "v"]).groupby("g")["w"].cumsum().to_numpy()
    assert np.array_equal(out["cum_w"].to_numpy(), exp.astype(float))


def test_running_sums_descending(spark):
    df = spark.createDataFrame([(i, 1) for i in range(50)], "v long, w long")
    out = running_sums(df, [], "v", ["w"], descending=True, num_partitions=5).toPandas().sort_values("v")
    assert out["cum_w"].tolist() == [float(50 - i) for i in range(50)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 1.0]))
def test_exact_quantiles_match_numpy(spark, values, q):
    df = spark.createDataFrame([(float(x),) for x in values], "x double")
    got = exact_quantiles(df, [], "x", {"q": q}).first().q
    assert abs(got - float(np.percentile(values, q * 100))) < 1e-9


def test_ecdf_monotone_and_ends_at_one(spark):
    from churnlens.operators.ranking import ecdf
    from churnlens.sources.fixture import bank_customers

    from conftest import SF_SMALL

    e = ecdf(bank_customers(spark, SF_SMALL), ["Age", "Balance"]).toPandas()
    for _, grp in e.groupby(["feature", "Exited"]):
        grp = grp.sort_values("value")
        assert (np.diff(grp["ecdf"].to_numpy()) > 0).all()
        assert grp["ecdf"].iloc[-1] == 1.0


def test_ks_identical_samples_is_zero(spark):
    from churnlens.operators.stattests import ks_two_sample

    rows = [(s, "f", float(v)) for v in range(40) for s in ("x", "y")]
    long = spark.createDataFrame(rows, "sample string, feature string, value double")
    r = ks_two_sample(long, "sample", "x", "y").first()
    assert r.statistic == 0.0 and r.p_value == 1.0


def test_running_sums_carry_across_small_arrow_batches(spark):
    # Tiny Arrow batches make groups continue across batches of one partition (the carry path),
    # with two group columns, one of them null for some rows.
    rng = np.random.default_rng(1)
    n = 2000
    g1 = rng.choice(["a", "b"], n, p=[0.8, 0.2])
    g2 = rng.choice([1.0, 2.0, np.nan], n)
    pdf = pd.DataFrame({"g1": g1, "g2": g2, "v": rng.integers(0, 10**6, n), "w": rng.integers(1, 5, n)})
    pdf = pdf.groupby(["g1", "g2", "v"], as_index=False, dropna=False)["w"].sum()
    df = spark.createDataFrame(pdf, "g1 string, g2 double, v long, w long").withColumn(
        "g2", F.when(F.isnan("g2"), F.lit(None)).otherwise(F.col("g2"))
    )
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        out = running_sums(df, ["g1", "g2"], "v", ["w"], num_partitions=4).toPandas()
    finally:
        spark.conf.set(key, old)
    out = out.sort_values(["g1", "g2", "v"], na_position="first")
    exp = pdf.sort_values(["g1", "g2", "v"], na_position="first").groupby(["g1", "g2"], dropna=False)["w"].cumsum()
    assert np.array_equal(out["cum_w"].to_numpy(), exp.to_numpy().astype(float))
    tot = pdf.groupby(["g1", "g2"], dropna=False)["w"].transform("sum")
    assert np.array_equal(out["tot_w"].to_numpy(), pdf.sort_values(["g1", "g2", "v"], na_position="first").assign(t=tot)["t"].to_numpy().astype(float))
