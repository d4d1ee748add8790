"""Adapters from the driver's TPC-H-style tables to the recommendation schemas.

These only reshape rows into the schemas the jobs expect (see FIXTURES.md); none of the
recommendation work happens here. Every adapter is a plain DataFrame expression over the
given Parquet tables, so its cost grows with them and Catalyst prunes the scans.

Fixed values of the fixture definitions:
  split instant            2000-07-01 00:00:00 on ``o_orderdate``
  online events            all ``events`` rows, item = ``props.k``
  requests                 two per customer: k = 10, and by ``c_custkey % 4`` k = none, 1, 3 or 5
  deterministic recs       top 50 items per customer nation by train plays
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.functions.joins import growing
from cadenza.session import checkpoint_dir
from cadenza.sources.tables import (CATALOG_NAMES, INTERACTIONS, ONLINE_EVENTS, REQUESTS, TRACKS,
                                    conform, write_stage)

SPLIT_INSTANT = dt.datetime(2000, 7, 1)
NATION_RECS_PER_USER = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⨝ orders: customer → user, part → track, line number → position, order date → time."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = li.join(growing(orders), li.l_orderkey == orders.o_orderkey)
    return conform(joined.select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("track_id"),
        F.col("l_linenumber").alias("track_seq"), F.col("o_orderdate").alias("started_at")),
        INTERACTIONS)


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as tracks: album = brand number; artists / genres = suppliers of all their line
    items / these suppliers' nations. Parts never sold get null artist and genre lists.

    The pairs are made distinct before they are collected, so a part with very many line
    items reaches its list with one row per supplier."""
    sold = (table(spark, sf_dir, "lineitem")
            .select(F.col("l_partkey").alias("track_id"), F.col("l_suppkey").alias("s_suppkey")).distinct())
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lists = (sold.join(growing(supplier), "s_suppkey", "left")
             .groupBy("track_id")
             .agg(F.array_sort(F.collect_set(F.col("s_suppkey").cast("int"))).alias("artists"),
                  F.array_sort(F.collect_set(F.col("s_nationkey").cast("int"))).alias("genres")))
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("track_id"), F.array(F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")).alias("albums"))
    return conform(part.join(growing(lists), "track_id", "left"), TRACKS)


def catalog_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    track = part.select(F.col("p_partkey").alias("id"), F.lit("track").alias("type"),
                        F.col("p_name").alias("name"))
    album = part.select(F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("id"),
                        F.lit("album").alias("type"), F.col("p_brand").alias("name")).distinct()
    artist = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.lit("artist").alias("type"), F.col("s_name").alias("name"))
    genre = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.lit("genre").alias("type"), F.col("n_name").alias("name"))
    return conform(track.unionByName(album).unionByName(artist).unionByName(genre), CATALOG_NAMES)


def online_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "events").select(
        "user_id", F.get_json_object("props", "$.k").alias("item_id"), "ts", "event_id"), ONLINE_EVENTS)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two requests per customer; one of four customers leaves k out of the second."""
    other = F.element_at(F.array(F.lit(None).cast("int"), F.lit(1), F.lit(3), F.lit(5)), (F.col("c_custkey") % 4 + 1).cast("int"))
    both = F.explode(F.array(F.struct(F.lit(0).alias("n"), F.lit(10).alias("k")), F.struct(F.lit(1).alias("n"), other.alias("k")))).alias("r")
    return conform(table(spark, sf_dir, "customer").select("c_custkey", both).select(
        (F.col("c_custkey") * 2 + F.col("r.n")).alias("request_id"), F.col("c_custkey").alias("user_id"), F.col("r.k").alias("k")),
        REQUESTS)


def user_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("user_id"), F.col("c_nationkey").alias("nation"))


def nation_recs(spark: SparkSession, sf_dir: str, train: DataFrame, users: DataFrame,
                n: int = NATION_RECS_PER_USER) -> DataFrame:
    """Deterministic stand-in for a model's recommendations (no training involved).

    Per customer nation, items ranked by train plays of that nation's users (ties: lower
    item id); every user in ``users`` gets its nation's top ``n`` with
    score = plays / all train plays of the nation.

    The per-nation ranking runs on the ``(nation, item)`` aggregate, never on raw rows; how the
    ranked list meets the users is left to Spark, which broadcasts it only if it measures small.
    """
    nation = user_nation(spark, sf_dir)
    per_item = (train.join(growing(nation), "user_id").groupBy("nation", "item_id")
                .agg(F.count(F.lit(1)).alias("plays")))
    totals = per_item.groupBy("nation").agg(F.sum("plays").alias("nation_plays"))
    w = Window.partitionBy("nation").orderBy(F.desc("plays"), F.asc("item_id"))
    top = (per_item.withColumn("rank", F.row_number().over(w))
           .filter(F.col("rank") <= n)  # map-side WindowGroupLimit: ≤ n rows per nation per task
           .join(totals, "nation")
           .select("nation", "item_id", "rank",
                   (F.col("plays") / F.col("nation_plays")).alias("score")))
    return (users.select("user_id").join(growing(nation), "user_id")
            .join(top, "nation")
            .select("user_id", "item_id", "score", "rank"))


class Fixture:
    """Lazily built fixture frames and pipeline stages for one scale-factor folder.

    Properties are cached as DataFrame plans, except the stages that several branches of a
    query reuse, which are written once as Parquet below the session's shared folder and
    scanned from there (as the original writes its tables): their readers get column pruning
    and pushed filters, and lineage ends at files that every executor reaches.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, split: dt.datetime = SPLIT_INSTANT):
        self.spark, self.sf_dir, self.split = spark, sf_dir, split

    def folder(self, name: str) -> str:
        """A fresh folder below the session's shared checkpoint folder."""
        return f"{checkpoint_dir(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        return write_stage(df, self.folder(name))

    @cached_property
    def interactions(self) -> DataFrame:
        return interactions(self.spark, self.sf_dir)

    @cached_property
    def tracks(self) -> DataFrame:
        return tracks(self.spark, self.sf_dir)

    @cached_property
    def catalog_names(self) -> DataFrame:
        return catalog_names(self.spark, self.sf_dir)

    @cached_property
    def online_events(self) -> DataFrame:
        return online_events(self.spark, self.sf_dir)

    @cached_property
    def requests(self) -> DataFrame:
        return requests(self.spark, self.sf_dir)

    @cached_property
    def clean(self) -> DataFrame:
        from cadenza.operators.clean import clean_interactions
        return clean_interactions(self.interactions, self.tracks)

    @cached_property
    def items(self) -> DataFrame:
        from cadenza.operators.catalog import build_items
        return self.stored("items", build_items(self.tracks, self.catalog_names))

    @cached_property
    def events(self) -> DataFrame:
        from cadenza.operators.catalog import item_ids
        from cadenza.operators.clean import prepare_events
        return self.stored("events", prepare_events(self.clean, item_ids(self.tracks)))

    @cached_property
    def train_test(self) -> tuple[DataFrame, DataFrame]:
        from cadenza.operators.clean import time_split
        return time_split(self.events, self.split)

    @property
    def train(self) -> DataFrame:
        return self.train_test[0]

    @property
    def test(self) -> DataFrame:
        return self.train_test[1]

    @cached_property
    def test_users(self) -> DataFrame:
        return self.test.select("user_id").distinct()

    @cached_property
    def nation_recs(self) -> DataFrame:
        return self.stored("recs", nation_recs(self.spark, self.sf_dir, self.train, self.test_users))

    @cached_property
    def top_popular(self) -> DataFrame:
        from cadenza.operators.popularity import top_popular
        return top_popular(self.train, self.items)

    @cached_property
    def embeddings(self) -> DataFrame:
        return table(self.spark, self.sf_dir, "embeddings").select(
            F.col("vec_id").cast("int").alias("item_id"), F.col("embedding").alias("vector"))

    @cached_property
    def similar(self) -> DataFrame:
        from cadenza.operators.similar import similar_items
        return similar_items(self.embeddings, k=10)
