"""Cleaning, event preparation and the global time split.

All three are narrow transformations plus one existence check, so they work unchanged on
a streaming DataFrame (stream–static semi join) as well as on a batch one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.columns import SAMPLE_EVERY, SAMPLE_PHASE, systematic_sample
from cadenza.functions.joins import growing
from cadenza.sources.tables import INTERACTIONS, conform


def clean_interactions(interactions: DataFrame, tracks: DataFrame, sample_every: int = SAMPLE_EVERY,
                       sample_phase: int = SAMPLE_PHASE) -> DataFrame:
    """Typed interactions, sub-sampled, restricted to known tracks, ``track_seq`` dropped.

    The known-track check is a left semi join: it never multiplies rows, and the build side
    holds only track ids, sorted and merged, as they are as many as the catalogue has tracks.
    """
    typed = conform(interactions, INTERACTIONS)
    kept = typed.filter(systematic_sample(F.col("track_seq"), sample_every, sample_phase))
    known = tracks.select("track_id")
    return kept.join(growing(known), "track_id", "left_semi").select("user_id", "track_id", "started_at")


def prepare_events(clean: DataFrame, items: DataFrame) -> DataFrame:
    """Clean interactions of tracks that made it into ``items``, as ``(user_id, item_id, started_at)``."""
    return (clean.withColumnRenamed("track_id", "item_id")
            .join(growing(items.select("item_id")), "item_id", "left_semi")
            .select("user_id", "item_id", "started_at"))


def _instant(events: DataFrame, column: str, at: dt.datetime | str) -> Column:
    dtype = events.schema[column].dataType
    return F.lit(str(at)).cast(dtype)


def time_split(events: DataFrame, at: dt.datetime | str, column: str = "started_at") -> tuple[DataFrame, DataFrame]:
    """Global time split: train ``< at``, test ``>= at`` (the boundary instant is test)."""
    t = _instant(events, column, at)
    return events.filter(F.col(column) < t), events.filter(F.col(column) >= t)


def split_ranges(train: DataFrame, test: DataFrame, column: str = "started_at") -> DataFrame:
    """Row count and min/max instant of each side of the split."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("rows"),
                      F.min(column).alias("min_dt"), F.max(column).alias("max_dt"))
    return side(train, "train").unionByName(side(test, "test"))
