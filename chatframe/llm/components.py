"""Connected components by alternating large-star and small-star steps.

Edges are rows ``(a, b)`` of longs.  Each step is a grouped minimum (combined
before the shuffle) and an equi-join, so a node with very many edges is split
by the skew handling of the join and is never one task's list.  Steps are
written to the shared folder, which ends their lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatframe.llm.spark_util import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(low, "a")
    if large:  # larger neighbours move to the smallest one
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:      # smaller neighbours and the node itself do
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node with an edge; ``root`` is the smallest
    node that can be reached.  Raises if ``max_rounds`` don't settle it."""
    def summary(df):
        r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    cur = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a <> b").distinct(), "edges")
    before = summary(cur)
    for _ in range(max_rounds):
        cur = stored(_star(_star(cur, True), False), "edges")
        now = summary(cur)
        if now == before:
            stars = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return stars.unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
    raise RuntimeError("components did not settle")
