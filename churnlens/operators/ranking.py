"""Order-dependent operators: ECDF, exact stratified split, split summary."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from churnlens import schema as S
from churnlens.functions.prefix import running_sums, value_counts
from churnlens.session import scratch_path


def ecdf(df: DataFrame, columns: Sequence[str], by: str = S.TARGET) -> DataFrame:
    """Empirical CDF per ``(feature, class)``: one row per distinct value, ``ecdf = #(x <= v) / n``."""
    from churnlens.operators.explore import stack_columns

    long = stack_columns(df, columns, keep=[by], as_string=False)
    vc = value_counts(long, ["feature", by], "value")
    cum = running_sums(vc, ["feature", by], "value", ["cnt"]).withColumn("n", F.col("tot_cnt"))
    return cum.select(
        "feature", by, "value", F.col("cnt").alias("count"), F.col("cum_cnt").cast("bigint").alias("cum_count"),
        F.round(F.col("cum_cnt") / F.col("n"), 6).alias("ecdf"),
    )


def split_key(id_col: str = "CustomerId"):
    """Deterministic pseudo-random order key (integer hashing, identical in SQL engines)."""
    return (F.col(id_col) * F.lit(2654435761)) % F.lit(4294967296)


def stratified_split_window(df: DataFrame, test_size: float = 0.2, label: str = S.TARGET, id_col: str = "CustomerId") -> DataFrame:
    """Reference formulation: per class, the first round(test_size * n_c) rows by hash order are test.

    Orders each class inside one window partition, i.e. in one task; kept as the specification that
    ``stratified_split`` is tested against.
    """
    w = Window.partitionBy(label).orderBy(split_key(id_col), F.col(id_col))
    n = Window.partitionBy(label)
    return df.withColumn(
        "split",
        F.when(F.row_number().over(w) <= F.round(F.lit(test_size) * F.count(F.lit(1)).over(n)), "test").otherwise("train"),
    )


#: Hash values per bucket, as a power of two: the 32-bit hash space makes about a million buckets.
BUCKET_BITS = 12


def _test_cuts(keyed: DataFrame, test_size: float) -> list[Row]:
    """The last test row ``(c, h, i)`` of each class ``c`` that has one.

    One aggregate counts rows per class and hash bucket and finds the bucket that holds the cut; a
    second look ranks the rows of those buckets alone.  The windows see at most 2^20 buckets a class,
    and a millionth of a class's rows; the driver sees one row a class, like any fitted threshold."""
    bucket = F.shiftright("h", BUCKET_BITS)
    running = Window.partitionBy("c").orderBy("b")
    whole = Window.partitionBy("c")
    counts = keyed.groupBy("c", bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    want = F.round(F.lit(test_size) * F.sum("n").over(whole)).cast("bigint")
    found = counts.select("c", "b", want.alias("want"), F.sum("n").over(running).alias("upto"), "n")
    found = found.where("want > 0 AND upto >= want AND upto - n < want").collect()
    if not found:
        return []

    def at(r: Row, *more: Column) -> Column:
        cond = F.col("c").eqNullSafe(F.lit(r["c"])) & F.col("h").between(r["b"] << BUCKET_BITS, ((r["b"] + 1) << BUCKET_BITS) - 1)
        return functools.reduce(lambda a, b: a & b, more, cond)

    any_of = lambda conds: functools.reduce(lambda a, b: a | b, conds)
    rank = F.row_number().over(Window.partitionBy("c").orderBy("h", "i"))
    near = keyed.where(any_of([at(r) for r in found])).withColumn("rank", rank)
    return near.where(any_of([at(r, F.col("rank") == r["want"] - (r["upto"] - r["n"])) for r in found])).collect()


def stratified_split(df: DataFrame, test_size: float = 0.2, label: str = S.TARGET, id_col: str = "CustomerId") -> DataFrame:
    """Exact stratified 80/20 split with the same assignment as ``stratified_split_window``.

    ``id_col`` is unique and not null.  Each class is cut at one (hash, id) key, found from bucket
    counts, so marking the rows is a narrow projection and no row is shuffled.  ``df`` is computed once
    for that: its (class, hash, id) are written to the shared folder, where both looks read them."""
    h, i = split_key(id_col), F.col(id_col)
    in_test = F.lit(False)
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "split-keys")
    df.select(F.col(label).alias("c"), h.alias("h"), i.alias("i")).write.parquet(path)
    for cut in _test_cuts(spark.read.parquet(path), test_size):
        same = F.col(label).eqNullSafe(F.lit(cut["c"]))
        in_test = in_test | (same & ((h < cut["h"]) | ((h == cut["h"]) & (i <= cut["i"]))))
    return df.withColumn("split", F.when(in_test, "test").otherwise("train"))


def split_churn_rate(split_df: DataFrame, label: str = S.TARGET) -> DataFrame:
    """Rows, churn rate and share of rows per split (one scan: the total comes from the two rows)."""
    g = split_df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.avg(label).alias("_rate"))
    total = F.sum("rows").over(Window.partitionBy())  # over the per-split rows only
    return g.select("split", "rows", F.round("_rate", 6).alias("churn_rate"), F.round(F.col("rows") / total, 6).alias("share"))

