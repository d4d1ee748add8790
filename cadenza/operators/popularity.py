"""Popularity baseline.

The top list is bounded by construction (``n`` rows), which is what makes the global
steps safe at any data size: the global ordering is a ``TakeOrderedAndProject`` (each
task keeps its own top ``n``; one task merges ``n × tasks`` rows), and the windows
without a partition key only ever see those ``n`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the original pipeline: 100 popular items kept, the first 50 used as recs.
TOP_N = 100
RECS_N = 50


def item_popularity(train: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Plays (non-null timestamps) and exact distinct users per item.

    Two explicit levels: ``(item, user)`` groups first (shuffled on both keys, so a hot
    item is spread over many tasks), then per item a sum of plays and a count of users,
    whose map-side partial aggregation reduces a hot item to one row per task before
    its shuffle. Same result as ``count(started_at), count(DISTINCT user_id)``.
    ``approx=True`` estimates users with a HyperLogLog++ sketch instead.
    """
    if approx:  # HyperLogLog++ sketch per item: one pass, no (item, user) shuffle
        return train.groupBy("item_id").agg(F.count("started_at").alias("plays"),
                                            F.approx_count_distinct("user_id", rsd).alias("users"))
    pairs = train.groupBy("item_id", "user_id").agg(F.count("started_at").alias("c"))
    return pairs.groupBy("item_id").agg(F.sum("c").alias("plays"), F.count("user_id").alias("users"))


def top_popular(train: DataFrame, items: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top ``n`` items by plays, then users (ties: lower ``item_id``), ``rank`` 1..n assigned
    before the inner join with item metadata; ``score = plays / sum(plays)`` over the joined rows.
    """
    order = [F.desc("plays"), F.desc("users"), F.asc("item_id")]
    top = item_popularity(train).orderBy(*order).limit(n)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    meta = items.select("item_id", "name", "genres", "artists", "albums")
    joined = meta.join(F.broadcast(ranked), "item_id", "inner")
    return joined.select("item_id", "plays", "users", "rank", "name", "genres", "artists", "albums",
                         (F.col("plays") / F.sum("plays").over(Window.partitionBy())).alias("score"))


def default_list(top: DataFrame) -> DataFrame:
    """The fallback list in its order: ``(pos, item_id, score)``, ``pos`` dense from 1.

    Ranks are assigned before the metadata join, so they may have gaps; the list order
    (the file order of the original) is the rank order, and positions are re-numbered.
    """
    return top.select("item_id", "score",
                      F.row_number().over(Window.orderBy("rank")).alias("pos"))


def popular_as_recs(top: DataFrame, users: DataFrame, n: int = RECS_N) -> DataFrame:
    """Every user in ``users`` × the first ``n`` entries of the popular list.

    Expressed as an equi-join on list position: each user row is expanded to positions
    ``1..n`` and joined with the (at most ``n``-row, broadcast) list on ``pos``. Output is
    linear in users; the broadcast side is bounded by ``n``.
    """
    head = F.broadcast(default_list(top).filter(F.col("pos") <= n))
    expanded = users.select("user_id", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("pos"))
    return (expanded.join(head, "pos")
            .select("user_id", "item_id", "score", F.col("pos").cast("int").alias("rank")))
