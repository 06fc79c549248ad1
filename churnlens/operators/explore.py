"""Exploratory aggregates: churn by group, pivots, segments, quantiles, histograms, correlation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens import schema as S
from churnlens.functions import features as FX
from churnlens.functions.prefix import quantiles_of, ranked_values

CHURN_GROUP_COLUMNS = S.CATEGORICAL_COLUMNS + S.BINARY_COLUMNS
CROSSTAB_FEATURES = ("Geography", "Gender", "HasCrCard", "IsActiveMember", "NumOfProducts")
CORR_COLUMNS = S.NUMERIC_COLUMNS + (S.TARGET,)
_ALL_ROWS = "_all_rows"


def stack_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), as_string: bool = True) -> DataFrame:
    """Unpivot ``columns`` to ``(keep..., feature, value)``; one projection, no shuffle."""
    cast = (lambda c: F.col(c).cast("string")) if as_string else (lambda c: F.col(c).cast("double"))
    return df.select(
        *keep, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), cast(c).alias("value")) for c in columns])).alias("_r")
    ).select(*keep, "_r.feature", "_r.value")


def churn_by_category(df: DataFrame, columns: Sequence[str] = CHURN_GROUP_COLUMNS) -> DataFrame:
    """Churn mean/count/sum per value of each column plus the global baseline, one scan, one shuffle.

    The baseline rides along as one more group holding every row, so the input is read once.
    """
    src = df.withColumn(_ALL_ROWS, F.lit("all"))
    long = stack_columns(src, [*columns, _ALL_ROWS], keep=[S.TARGET]).where(F.col("value").isNotNull())
    g = long.groupBy("feature", "value").agg(
        F.avg(S.TARGET).alias("churn_rate"), F.count(F.lit(1)).alias("total"), F.sum(S.TARGET).cast("bigint").alias("churned")
    )
    # Over the aggregated frame only: one row per (column, category), bounded by the categories.
    baseline = F.max(F.when(F.col("feature") == _ALL_ROWS, F.col("churn_rate"))).over(Window.partitionBy())
    return g.withColumn("_base", baseline).where(F.col("feature") != _ALL_ROWS).select(
        "feature", "value", F.round("churn_rate", 6).alias("churn_rate"), "total", "churned", F.round("_base", 6).alias("baseline")
    )


def product_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("NumOfProducts").agg(
        F.bround(F.avg(S.TARGET), 2).alias("churn_rate"),
        F.count(F.lit(1)).alias("count"),
        F.bround(F.avg("Balance"), 2).alias("avg_balance"),
        F.bround(F.avg("Age"), 2).alias("avg_age"),
    )


def balance_impact(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("HasBalance", FX.flag_columns()["HasBalance"])
        .groupBy("HasBalance")
        .agg(F.round(F.avg(S.TARGET), 6).alias("churn_rate"), F.count(F.lit(1)).alias("count"))
        .withColumn("label", F.when(F.col("HasBalance") == 1, "Has Balance").otherwise("Zero Balance"))
    )


def pivot_mean(df: DataFrame, index: str, columns: Column, values: Sequence, names: Sequence[str] | None = None) -> DataFrame:
    """Mean churn in a ``index x columns`` grid with a fixed value list (no distinct pre-pass)."""
    names = list(names or [str(v) for v in values])
    out = (
        df.withColumn("_pv", columns)
        .groupBy(index)
        .pivot("_pv", list(values))
        .agg(F.avg(S.TARGET))
    )
    return out.select(index, *[F.round(F.col(f"`{v}`"), 6).alias(n) for v, n in zip(values, names)])


def crosstab(df: DataFrame, features: Sequence[str] = CROSSTAB_FEATURES) -> DataFrame:
    """Count matrix feature value x Exited for several features, long form."""
    long = stack_columns(df, features, keep=[S.TARGET]).where(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(
        F.count_if(F.col(S.TARGET) == 0).alias("retained"), F.count_if(F.col(S.TARGET) == 1).alias("churned")
    )


def segment_lift(df: DataFrame, segments: Sequence[tuple[str, str]] = FX.SEGMENTS) -> DataFrame:
    """Size, churn % and lift of overlapping segments: one scan with conditional aggregates."""
    aggs = [F.count(F.lit(1)).alias("__n"), F.avg(S.TARGET).alias("__base")]
    for i, (_, pred) in enumerate(segments):
        aggs.append(F.count_if(F.expr(pred)).alias(f"n{i}"))
        aggs.append(F.avg(F.when(F.expr(pred), F.col(S.TARGET))).alias(f"r{i}"))
    wide = df.agg(*aggs)
    structs = [
        F.struct(F.lit(name).alias("segment"), F.col(f"n{i}").alias("size"), F.col(f"r{i}").alias("rate"))
        for i, (name, _) in enumerate(segments)
    ]
    return wide.select("__base", F.explode(F.array(*structs)).alias("_r")).select(
        F.col("_r.segment").alias("segment"),
        F.col("_r.size").alias("size"),
        F.round(F.col("_r.rate") * 100, 6).alias("churn_pct"),
        F.round(F.col("_r.rate") / F.col("__base"), 6).alias("lift"),
    )


def segment_members(df: DataFrame, segments: Sequence[tuple[str, str]] = FX.SEGMENTS) -> DataFrame:
    """Rows matching each segment predicate, tagged with the segment name (narrow, no shuffle)."""
    tagged = df.select(
        "*",
        F.explode(
            F.filter(
                F.array(*[F.when(F.expr(p), F.lit(n)) for n, p in segments]),
                lambda x: x.isNotNull(),
            )
        ).alias("segment"),
    )
    return tagged


def iqr_outliers(df: DataFrame, columns: Sequence[str] = S.NUMERIC_COLUMNS) -> DataFrame:
    """Exact Q1/Q3 (linear), fences at 1.5 IQR (strict), outlier count and % per column; one scan, as
    outliers are counted on the ranked distinct values."""
    ranked = ranked_values(stack_columns(df, columns, as_string=False), ["feature"], "value")
    q = quantiles_of(ranked, ["feature"], "value", {"q1": 0.25, "q3": 0.75})
    fences = q.select(
        "feature", "n", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr")
    ).withColumns({"lower": F.col("q1") - 1.5 * F.col("iqr"), "upper": F.col("q3") + 1.5 * F.col("iqr")})
    # One fence row per column: a size bound known from the column list.
    flagged = ranked.join(F.broadcast(fences.select("feature", "lower", "upper")), "feature")
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    counts = flagged.groupBy("feature").agg(F.sum(F.when(outside, F.col("cnt")).otherwise(0)).cast("bigint").alias("outliers"))
    return fences.join(counts, "feature").select(
        "feature",
        *[F.round(c, 6).alias(c) for c in ("q1", "q3", "iqr", "lower", "upper")],
        "outliers",
        F.round(F.col("outliers") * 100.0 / F.col("n"), 6).alias("outlier_pct"),
    )


def wide_stats(df: DataFrame, columns: Sequence[str], stats: dict[str, Callable[[Column], Column]], keys: Sequence[str] = ()) -> DataFrame:
    """``keys, feature`` and each of ``stats`` of every column: one aggregate over the rows as they
    are; only its result, a row per group, is unpivoted."""
    aggs = [fn(F.col(c).cast("double")).alias(f"{c}__{k}") for c in columns for k, fn in stats.items()]
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{k}").alias(k) for k in stats]) for c in columns])
    return wide.select(*keys, F.inline(rows))


def univariate_stats(df: DataFrame, columns: Sequence[str] = S.NUMERIC_COLUMNS) -> DataFrame:
    """n, mean, sample std and bias-corrected (pandas) skewness per column."""
    g = wide_stats(df, columns, {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "g1": F.skewness})
    n = F.col("n").cast("double")
    adj = F.sqrt(n * (n - 1)) / (n - 2)
    return g.select(
        "feature", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), F.round(F.col("g1") * adj, 6).alias("skew")
    )


def class_summary(df: DataFrame, columns: Sequence[str] = S.NUMERIC_COLUMNS) -> DataFrame:
    g = wide_stats(df, columns, {"n": F.count, "mean": F.avg, "std": F.stddev_samp}, [S.TARGET])
    return g.select("feature", S.TARGET, "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def histogram(df: DataFrame, columns: Sequence[str] = S.NUMERIC_COLUMNS, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed), density n/(N*w), empty bins included; with
    ``by`` every group of those columns has a range and a total of its own."""
    keys = ["feature", *by]
    long = stack_columns(df, columns, keep=list(by), as_string=False).where(F.col("value").isNotNull())
    rng = long.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count(F.lit(1)).alias("total"))
    width = (F.col("hi") - F.col("lo")) / bins
    rng = rng.withColumn("w", width)
    # Without groups one range row per column, bounded by the column list; groups have no such bound.
    b = long.join(rng if by else F.broadcast(rng), keys).select(
        *keys,
        F.when(F.col("w") > 0, F.least(F.floor((F.col("value") - F.col("lo")) / F.col("w")), F.lit(bins - 1)))
        .otherwise(0)
        .cast("int")
        .alias("bin"),
    )
    counts = b.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(*keys, "lo", "w", "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        F.round(F.col("lo") + F.col("bin") * F.col("w"), 6).alias("bin_lo"),
        F.round(F.col("lo") + (F.col("bin") + 1) * F.col("w"), 6).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        F.round(
            F.when(F.col("w") > 0, F.coalesce("count", F.lit(0)) / (F.col("total") * F.col("w"))), 10
        ).alias("density"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORR_COLUMNS) -> DataFrame:
    """Pearson correlation of every ordered pair, long form ``(i, j, var1, var2, corr)``; one agg."""
    cols = list(columns)
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    wide = df.agg(*aggs)
    structs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                val = F.lit(1.0)
            else:
                val = F.col(f"c_{min(i, j)}_{max(i, j)}")
            structs.append(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(a).alias("var1"), F.lit(b).alias("var2"), val.alias("corr")))
    return wide.select(F.explode(F.array(*structs)).alias("_r")).select("_r.i", "_r.j", "_r.var1", "_r.var2", F.round("_r.corr", 6).alias("corr"))


def lower_triangle(corr: DataFrame) -> DataFrame:
    """Keep the strictly lower triangle (the heatmap mask hides the upper one and the diagonal)."""
    return corr.where(F.col("i") > F.col("j"))


def target_correlation(corr: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Correlation of each feature with the target, ranked by |r| descending (sign kept)."""
    t = corr.where((F.col("var2") == target) & (F.col("var1") != target))
    return t.select(
        F.col("var1").alias("feature"),
        "corr",
        F.abs("corr").alias("abs_corr"),
        F.row_number().over(_rank_window()).cast("bigint").alias("rank"),
    )


def _rank_window():
    from pyspark.sql import Window

    # The frame has one row per feature (bounded by the column list), so a global order is cheap.
    return Window.orderBy(F.abs(F.col("corr")).desc(), F.col("var1"))


def monthly_churn_stats(preds: DataFrame) -> DataFrame:
    """Prediction volume, churns, mean probability and High count per month, newest first."""
    return (
        preds.groupBy(F.date_format("prediction_date", "yyyy-MM").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("total_predictions"),
            F.sum(F.when(F.col("churn_prediction") == 1, 1).otherwise(0)).cast("bigint").alias("predicted_churns"),
            FX.exact_avg_round("churn_probability", 4).alias("avg_churn_prob"),
            F.count(F.when(F.col("risk_category") == "High", 1)).alias("high_risk_count"),
        )
        .orderBy(F.col("month").desc())
    )
