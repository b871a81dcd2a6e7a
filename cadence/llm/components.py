"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.tables import drop, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on the smallest node of its neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge (u, v), both longs; root is the smallest node reachable.

    Each round is two joins on a node and its neighbourhood's minimum (pre-aggregated before the shuffle, hubs
    split by the adaptive skew join); no neighbourhood is gathered. Rounds end when the edges are stars, known by a
    sum over the edge table; the number of rounds grows with the logarithm of the graph. Loops (u = u) and repeated
    edges are harmless; null ends are dropped; no edges give no rows."""

    def clean(e: DataFrame) -> DataFrame:
        return e.where("u <> v").distinct()

    def mark(e: DataFrame) -> tuple:
        row = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        return tuple(row)

    now = stored(clean(edges.select(F.col("u").cast("long"), F.col("v").cast("long"))), "edges")
    before = mark(now)
    while True:
        step = stored(clean(_small_star(clean(_large_star(now)))), "stars")
        drop(now)
        now, after = step, mark(step)
        if after == before:
            break
        before = after
    # Now every edge runs from a node to its root: u > v, and roots have no edge upwards.
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
