"""Connected components over an edge table (alternating large-star / small-star contraction).

No node list, link or component ever reaches the driver: each round is two joins over the edge
table, checkpointed to the shared folder; the driver only compares one (count, hash sum) row.
The per-node minima are checkpointed before they are joined back, so both join sides are plain
shuffles and AQE can split a hub that holds a large share of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.tables import checkpointed


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("u", "v")).alias("x"),
        F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31))).alias("s"),
    ).first()
    return row["n"], row["x"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = checkpointed(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = checkpointed(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node with a link to another node; ``component`` is the
    smallest node reachable.  Links may repeat, point either way or join a node to itself; null
    ends are ignored.  No links: no rows."""
    e = checkpointed(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    seen = _signature(e)
    while seen[0]:
        e = checkpointed(_small_star(checkpointed(_large_star(e))))
        now = _signature(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
