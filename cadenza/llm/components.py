"""Connected components of an undirected graph given as edges, by alternating star steps.

Every step rewires edges towards the smallest neighbour: the large step hangs a node's
larger neighbours on its smallest neighbour, the small step its smaller ones. The number of
steps is logarithmic in the size of a component in practice. Minima are aggregated before
the shuffle and joined back, so a node with very many neighbours is an ordinary skewed
join; every step's edges are written to the shared folder, and only their count and a
checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b) with a > b: the rewired edges, again a > b, distinct."""
    if large:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        out = both.join(near, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        near = edges.groupBy("a").agg(F.min("b").alias("low"))
        out = edges.join(near, "a")
        out = out.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(near.select("a", F.col("low").alias("b")))
    return out.where("a > b").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node with an edge: the smallest node it can reach.

    Self edges, repeated and reversed edges are allowed; rows with a null end are ignored.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    now = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = staged(now.select(high.alias("a"), low.alias("b")).distinct(), "edges")
    seen = None
    while True:
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sums) == seen or not sums[0]:
            break
        seen = tuple(sums)
        now = staged(_star(_star(now, large=True), large=False), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
