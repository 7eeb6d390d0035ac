"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatella.functions import lineage, skew


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of an edge; component is the smallest node that it reaches.

    Alternating large-star and small-star rounds: each node's neighbours are hooked to the smallest of
    them, so paths halve and a component becomes a star in a number of rounds logarithmic in its
    diameter. A round aggregates minima with map-side combine and joins them back, the hub of a star too
    large for a task by salts; nothing is gathered in the driver, and every round is cut off by a checkpoint. Self-loops and repeated edges do no harm;
    edges with null ends are ignored.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    e = lineage.cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), guess=False)
    rows, last = e.count(), None

    def joined(neighbours: DataFrame) -> DataFrame:
        """neighbours (u, v) with m, the smallest of u and its neighbours."""
        least = neighbours.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("_n"))
        if 2 * rows <= skew.LEAST:
            return neighbours.join(least.drop("_n"), "u")
        hot = least.where(F.col("_n") > max(skew.LEAST, rows // (4 * skew.partitions(e)))).select("u")
        return skew.salted_join(neighbours, least.drop("_n"), ["u"], "inner", rows, hot=hot)

    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = joined(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(e.where(F.col("u") == F.col("v"))).distinct()
        small = joined(large)
        e = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        e = lineage.cut(e, guess=False)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        rows, last = now[0], now
    else:
        raise RuntimeError(f"no fixed point in {most_rounds} rounds")
    ends = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")))
    return ends.groupBy("node").agg(F.min("component").alias("component"))
