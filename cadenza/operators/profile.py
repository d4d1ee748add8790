"""Exploratory profiles of the raw and cleaned tables.

Each profile is one DataFrame expression. Global top-k reports plan as
``TakeOrderedAndProject``; the name joins run after the limit, on ≤ k rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.catalog import catalog_slice
from cadenza.session import checkpoint_dir
from cadenza.sources.tables import write_stage

# Fixed values of the original analysis: 10 rows in top reports, 50 histogram bins,
# quartiles with linear interpolation.
TOP_REPORT = 10
HIST_BINS = 50
QUARTILES = (0.25, 0.5, 0.75)


def null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, column_name, nulls)`` for every column of every given table.

    One pass per table: all ``count_if`` aggregates in a single ``agg``, then unpivoted.
    """
    out = None
    for name, df in tables.items():
        wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        long = wide.unpivot([], df.columns, "column_name", "nulls").select(
            F.lit(name).alias("table_name"), "column_name", "nulls")
        out = long if out is None else out.unionByName(long)
    return out


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, rows)`` for every given table (one count per table)."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


def type_counts(catalog_names: DataFrame) -> DataFrame:
    return catalog_names.groupBy("type").agg(F.count(F.lit(1)).alias("rows"))


def plays_per_user(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("user_id").agg(F.count(F.lit(1)).alias("tracks_played"))


def plays_per_track(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("track_id").agg(F.count(F.lit(1)).alias("plays"))


def _stored(df: DataFrame) -> DataFrame:
    return write_stage(df, f"{checkpoint_dir(df.sparkSession).rstrip('/')}/profile-{uuid.uuid4().hex[:12]}")


def quantiles(values: DataFrame, column: str, at: tuple[float, ...] = QUARTILES) -> DataFrame:
    """Exact quantiles with linear interpolation, one row ``q0, q1, ...``, from counted values.

    Equal values are counted before anything moves. The counts are dealt out by ranges of the
    value and summed per range; only these sums (one row per task) meet in a window, then
    each range counts on within itself, so no task holds all distinct values. The value at a
    0-based position of the ordered rows is the first whose running count exceeds it.
    """
    c = F.col(column)
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = _stored(values.where(c.isNotNull()).groupBy(c.cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
                      .repartitionByRange(tasks, "v").withColumn("part", F.spark_partition_id()))
    sums = counted.groupBy("part").agg(F.sum("n").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sums = sums.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
                       F.sum("rows").over(Window.partitionBy()).alias("total"))
    within = Window.partitionBy("part").orderBy("v")
    ordered = counted.join(sums, "part").select("v", "total", (F.col("before") + F.sum("n").over(within)).alias("upto"),
                                                (F.col("before") + F.sum("n").over(within) - F.col("n")).alias("from"))
    picked = []
    for i, q in enumerate(at):
        spot = F.lit(q) * (F.col("total") - 1)
        low, share = F.floor(spot), spot - F.floor(spot)
        value = lambda p: F.max(F.when((F.col("from") <= p) & (p < F.col("upto")), F.col("v")))
        first, second = value(low), value(F.least(low + 1, F.col("total") - 1))
        picked.append((first + F.max(share) * (second - first)).alias(f"q{i}"))
    return ordered.agg(*picked)


def describe(values: DataFrame, column: str) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation, exact), max; one row.

    The input is used twice (moments, counted values); pass a stored table where it is dear."""
    c = F.col(column)
    moments = values.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                         F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))
    one = F.lit(1).alias("one")
    q = quantiles(values, column).withColumnsRenamed({"q0": "p25", "q1": "p50", "q2": "p75"}).select("*", one)
    return (moments.select("*", one).join(q, "one")
            .select("count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def histogram(values: DataFrame, column: str, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histogram between min and max: ``(bin, bin_start, bin_end, users)``.

    Bins are 1-based and the maximum falls into the last bin. All ``bins`` rows are
    returned, empty ones with 0; nothing for an empty input. The input is read once: equal
    values are counted first, and bounds and bins come from that counted table, which is
    written to the shared folder.
    """
    spark = values.sparkSession
    counted = _stored(values.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v"))
                      .agg(F.count(F.lit(1)).alias("n")))
    lo, hi = counted.agg(F.min("v"), F.max("v")).first()
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, users bigint")
    width = (hi - lo) / bins
    idx = (F.lit(1) if hi == lo else
           F.least(F.floor((F.col("v") - F.lit(lo)) * bins / F.lit(hi - lo)).cast("int") + 1, F.lit(bins)))
    per_bin = counted.groupBy(idx.alias("bin")).agg(F.sum("n").alias("users"))
    grid = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(per_bin, "bin", "left")
            .select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("bin_start"),
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_end"),
                    F.coalesce("users", F.lit(0)).cast("bigint").alias("users")))


def top_tracks(interactions: DataFrame, catalog_names: DataFrame, n: int = TOP_REPORT) -> DataFrame:
    """Most played tracks (ties: lower id) with their names, joined after the limit."""
    top = plays_per_track(interactions).orderBy(F.desc("plays"), F.asc("track_id")).limit(n)
    return top.join(catalog_slice(catalog_names, "track", "track_id", "name"), "track_id", "left")


def top_genres(tracks: DataFrame, interactions: DataFrame, catalog_names: DataFrame, n: int = TOP_REPORT) -> DataFrame:
    """Plays summed per genre over exploded genre lists; a null or empty list counts as a
    null genre. Plays are aggregated per track before the join (one row per track)."""
    per_track = plays_per_track(interactions)
    exploded = tracks.select("track_id", F.explode_outer("genres").alias("genre_id"))
    per_genre = (exploded.join(per_track, "track_id")
                 .groupBy("genre_id").agg(F.sum("plays").alias("plays")))
    top = per_genre.orderBy(F.desc("plays"), F.asc_nulls_last("genre_id")).limit(n)
    return top.join(catalog_slice(catalog_names, "genre", "genre_id", "name"), "genre_id", "left")


def unplayed_tracks(tracks: DataFrame, interactions: DataFrame) -> DataFrame:
    """Tracks nobody played: count, catalog size and share (one row).

    Played ids are de-duplicated (map-side partial aggregation) and left-joined to the
    catalog; both counts come out of one aggregation over the catalog."""
    played = interactions.select("track_id").distinct().withColumn("played", F.lit(True))
    flagged = tracks.select("track_id").join(played, "track_id", "left")
    return (flagged.agg(F.count_if(F.col("played").isNull()).alias("unplayed"),
                        F.count(F.lit(1)).alias("tracks"))
            .select("unplayed", "tracks", (F.col("unplayed") / F.col("tracks")).alias("share")))
