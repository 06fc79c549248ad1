"""Exact running sums and quantiles without a single-partition window.

A window ``ORDER BY value`` with no (or a skewed) ``PARTITION BY`` funnels every row through one
task.  ``running_sums`` instead works in two phases on the already-collapsed
``(group..., value, weights...)`` frame:

1. range-partition on ``(group..., value)`` (a hot group is split across many partitions),
   sort within partitions, and compute local running sums per partition (Arrow-batched
   ``mapInPandas``; state carried across batches of the same partition);
2. per-(partition, group) totals -- at most ``partitions + groups`` rows -- turned into
   offsets by a window over that tiny frame, then joined back by ``(pid, group)``.

The result is exact and its cost is one range shuffle of the collapsed data plus one write of it
to the shared checkpoint folder (which also cuts the lineage, so a lost executor never recomputes
the range shuffle).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.session import scratch_path

_PID = "_pid"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _group_key(idx) -> tuple:
    """Hashable key of one group; nulls (None / NaN) compare equal across batches."""
    t = idx if isinstance(idx, tuple) else (idx,)
    return tuple(None if v is None or (isinstance(v, float) and v != v) else v for v in t)


def _local_cumsum(group_cols: list[str], weights: list[str], out_cols: list[str]):
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Running total of the last group of the batch before; rows are sorted by group, so no other
        # group goes on.
        carry: dict[tuple, np.ndarray] = {}
        zero = np.zeros(len(weights))
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(**{c: pd.Series(dtype="float64") for c in out_cols})
                continue
            keys = [pdf[g] for g in group_cols] if group_cols else [pd.Series(0, index=pdf.index)]
            grouped = pdf[weights].astype("float64").groupby(keys, sort=False, dropna=False)
            local = grouped.cumsum().to_numpy()
            last = grouped.sum()  # groups in order of first appearance, like ngroup() codes
            group_keys = [_group_key(i) for i in last.index]
            if carry:
                prev = np.array([carry.get(k, zero) for k in group_keys])
                local = local + prev[grouped.ngroup().to_numpy()]  # vectorised gather per row
            carry = {group_keys[-1]: carry.get(group_keys[-1], zero) + last.to_numpy()[-1]}
            out = pdf.copy()
            for i, c in enumerate(out_cols):
                out[c] = local[:, i]
            yield out

    return fn


def running_sums(
    df: DataFrame,
    group_cols: Sequence[str],
    order_col: str,
    weights: Sequence[str],
    descending: bool = False,
    prefix: str = "cum_",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``{prefix}{w}`` = sum of ``w`` over rows of the same group ordered at or before this row,
    and ``tot_{w}`` = the group's total of ``w``.

    ``df`` must hold one row per ``(group..., order_col)`` (collapse with ``groupBy`` first), so
    ties never straddle two rows and the inclusive sum is the ``cume_dist``-style count.
    """
    group_cols = list(group_cols)
    weights = list(weights)
    out_cols = [f"{prefix}{w}" for w in weights]
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    keys = [F.col(g) for g in group_cols] + [order]
    n = num_partitions or _partitions(df)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(_PID, F.spark_partition_id())

    schema = T.StructType(ranged.schema.fields + [T.StructField(c, T.DoubleType()) for c in out_cols])
    # Range bounds are sampled from the input, whose row order after a shuffle is not fixed, so
    # two evaluations could disagree on partition ids.  Materialise the local sums once, as a
    # table in the shared checkpoint folder (one job; it also cuts the lineage), and derive the
    # totals from that same copy.
    spark = df.sparkSession
    path = scratch_path(spark, "prefix")
    ranged.mapInPandas(_local_cumsum(group_cols, weights, out_cols), schema).write.parquet(path)
    local = spark.read.parquet(path)

    totals = local.groupBy(_PID, *group_cols).agg(*[F.sum(F.col(w).cast("double")).alias(w) for w in weights])
    before = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols)
    # At most (partitions + groups) rows: offsets of earlier partitions and the group totals.
    offsets = totals.select(
        _PID, *group_cols,
        *[F.coalesce(F.sum(w).over(before), F.lit(0.0)).alias(f"_off_{w}") for w in weights],
        *[F.sum(w).over(whole).alias(f"tot_{w}") for w in weights],
    )
    # Null-safe on the group keys, so a null group gets its offsets too (still an equi-join).
    off = offsets.select(*[F.col(c).alias(f"_o{c}") for c in [_PID, *group_cols]], *[c for c in offsets.columns if c.startswith(("_off_", "tot_"))])
    cond = [local[_PID] == off[f"_o{_PID}"]] + [local[g].eqNullSafe(off[f"_o{g}"]) for g in group_cols]
    joined = local.join(off, cond, how="left")
    return joined.select(
        *[local[c] for c in df.columns],
        *[(F.col(c) + F.col(f"_off_{w}")).alias(c) for w, c in zip(weights, out_cols)],
        *[f"tot_{w}" for w in weights],
    )


def value_counts(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """Collapse to one row per ``(group..., value)`` with its count ``cnt`` (nulls dropped)."""
    return (
        df.where(F.col(value_col).isNotNull())
        .groupBy(*group_cols, value_col)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def exact_quantiles(
    df: DataFrame, group_cols: Sequence[str], value_col: str, probs: dict[str, float]
) -> DataFrame:
    """Linear-interpolation quantiles (numpy/pandas default), exact, per group.

    Returns ``group..., n, <name>...`` for each ``name -> q`` in ``probs``.
    """
    return quantiles_of(ranked_values(df, group_cols, value_col), group_cols, value_col, probs)


def ranked_values(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """One row per ``(group..., value)`` with its count ``cnt``, running count ``cum_cnt`` and the
    group's total ``tot_cnt``."""
    return running_sums(value_counts(df, group_cols, value_col), group_cols, value_col, ["cnt"])


def quantiles_of(ranked: DataFrame, group_cols: Sequence[str], value_col: str, probs: dict[str, float]) -> DataFrame:
    """``exact_quantiles`` from ``ranked_values``."""
    group_cols = list(group_cols)
    cum = ranked.withColumn("n", F.col("tot_cnt"))
    aggs: list[Column] = [F.max("n").alias("n")]
    v = F.col(value_col).cast("double")
    for name, q in probs.items():
        pos = F.lit(q) * (F.col("n") - 1)
        lo = F.floor(pos)
        hi = F.least(lo + 1, F.col("n") - 1)
        aggs.append(F.min(F.when(F.col("cum_cnt") > lo, v)).alias(f"_lo_{name}"))
        aggs.append(F.min(F.when(F.col("cum_cnt") > hi, v)).alias(f"_hi_{name}"))
        aggs.append(F.max(pos - lo).alias(f"_fr_{name}"))
    res = cum.groupBy(*group_cols).agg(*aggs)
    return res.select(
        *group_cols,
        "n",
        *[
            (F.col(f"_lo_{name}") + F.col(f"_fr_{name}") * (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))).alias(name)
            for name in probs
        ],
    )
