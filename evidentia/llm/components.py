"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from evidentia.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs every node's neighbours (large: the greater ones, small: the lesser ones and itself) on its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    d = both.join(least, "a")
    if large:
        out = d.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = d.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(d.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that isn't the least of its component; root is that least node.

    Each round is two aggregations and joins over the edges; the table is written to the
    shared folder after each, and a round that changes nothing ends it.  Loops and
    repeated edges do no harm.
    """

    def kept(d: DataFrame) -> tuple[DataFrame, dict]:
        """``d`` stored, and its mark, taken while it is written."""
        mark = Observation()
        d = d.observe(mark, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"))
        return stored(d, "edges", compact=True), mark.get

    d = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    d, was = kept(d.distinct())
    for _ in range(rounds):
        if not was["n"]:
            break
        d, now = kept(_star(_star(d, large=True), large=False))
        if now == was:
            break
        was = now
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return d.select(F.col("a").alias("node"), F.col("b").alias("root"))
