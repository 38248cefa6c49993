"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearmiss.llm.common import cut


#: Rows of a part of a table of edges.
PART_ROWS = 250_000


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` (the smallest node) of every node that isn't the smallest of its
    component, from edges between numbers.

    Alternates two steps on the edge table until nothing changes: every node links its
    larger neighbours to its smallest one, then its smaller neighbours. The number of
    rounds grows with the logarithm of the nodes. Null ends and loops don't count.
    """
    high, low = F.greatest(left, right), F.least(left, right)
    edges = cut(edges.dropna().select(high.alias("high"), low.alias("low")).filter("high != low").distinct())
    n, state = edges.count(), None
    if not n:
        return edges.toDF("node", "component")

    def small(df: DataFrame) -> DataFrame:
        """Written down in as few parts as so many rows need: a table is as long as the edges."""
        return cut(df.coalesce(1 + n // PART_ROWS))

    edges = edges.coalesce(1 + n // PART_ROWS)
    while True:
        around = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionAll(
            edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = around.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("least", "node").alias("least"))
        # written down, the least neighbours are a table of their own in the join, so that Spark
        # can split the rows of a node with very many neighbours over tasks
        larger = around.filter("other > node").join(small(least), "node").select(F.col("other").alias("high"), F.col("least").alias("low"))
        larger = small(larger.distinct())
        least = small(larger.groupBy("high").agg(F.min("low").alias("least")))
        smaller = larger.join(least, "high").filter("low != least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        edges = small(smaller.unionAll(least.select("high", F.col("least").alias("low"))).distinct())
        # xor and sum of hashes stand for the set of edges
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low")), F.sum(F.xxhash64("low", "high") % (1 << 31))).first()
        if tuple(now) == state:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
        n, state = now[0], tuple(now)
