"""Registered streaming queries.

Each one writes its input (derived by Spark from the driver's tables) in time order as
Parquet files of bounded size into a fresh folder under the session's checkpoint directory,
runs the streaming query over them with ``availableNow`` in ``MICRO_BATCHES`` micro-batches, so
that state really carries across batches, and returns a batch read of the sink. The number
of files, and with it the files and tasks of a micro-batch, follows the number of rows.
Their final answers equal the batch queries of the same data, so the batch oracles apply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.plans.oracles import BASE
from cadenza.sources.fixtures import Fixture
from cadenza.sources.tables import write_stage
from cadenza.streaming import lists, online

MICRO_BATCHES = 4
ROWS_PER_FILE = 500_000


def _write_source(df: DataFrame, path: str, order_col: str) -> int:
    """Write ``df`` in ranges of ``order_col``; returns how many files make up a micro-batch."""
    files = max(MICRO_BATCHES, -(-df.count() // ROWS_PER_FILE))
    df.repartitionByRange(files, order_col).write.parquet(path)
    return -(-files // MICRO_BATCHES)


def q_stream_last_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    base = fx.folder("stream-last-events")
    n = _write_source(fx.online_events, f"{base}/source", "ts")
    q = online.run_last_events(spark, f"{base}/source", f"{base}/sink", f"{base}/checkpoint", files_per_trigger=n)
    q.awaitTermination()
    latest = online.latest_per_user(spark.read.parquet(f"{base}/sink"))
    return online.state_as_list(latest)


def q_stream_blended(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    base = fx.folder("stream-blended")
    n = _write_source(fx.online_events, f"{base}/source", "ts")
    # static sides are written tables, as the build's outputs are in production: each
    # micro-batch then reads the changed users' parts of them
    static = {name: write_stage(df, f"{base}/static/{name}", range_by=["user_id"] if "user_id" in df.columns else None)
              for name, df in (("recs", fx.nation_recs), ("top", fx.top_popular), ("similar", fx.similar),
                               ("events", fx.events), ("requests", fx.requests))}
    q = online.run_blended_refresh(spark, f"{base}/source", f"{base}/sink", f"{base}/checkpoint",
                                   static["recs"], static["top"], static["similar"], static["events"],
                                   static["requests"], files_per_trigger=n)
    q.awaitTermination()
    online.compact(spark, f"{base}/sink", f"{base}/compacted")
    return online.latest_per_user(spark.read.parquet(f"{base}/compacted")).select("request_id", "user_id", "pos", "item_id")


def q_stream_state_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest events of every user, read from the keyed state in the checkpoint, not from a sink."""
    fx = Fixture(spark, sf_dir)
    base = fx.folder("stream-state")
    n = _write_source(fx.online_events, f"{base}/source", "ts")
    online.run_last_events(spark, f"{base}/source", f"{base}/sink", f"{base}/checkpoint", files_per_trigger=n).awaitTermination()
    return lists.newest_events_of(spark, f"{base}/checkpoint")


def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blended lists kept by upsert: one current list per request after all micro-batches."""
    fx = Fixture(spark, sf_dir)
    base = fx.folder("stream-upsert")
    n = _write_source(fx.online_events, f"{base}/source", "ts")
    recs, top, similar, events, requests = _static(fx, base)
    store = lists.ListStore(spark, f"{base}/lists")
    lists.run_list_refresh(spark, f"{base}/source", store, f"{base}/checkpoint", recs, top, similar, events, requests,
                           files_per_trigger=n).awaitTermination()
    return store.lists()


def _static(fx: Fixture, base: str) -> list[DataFrame]:
    """The static sides as written tables, clustered by user or item, as the build's outputs are."""
    by = {"recs": "user_id", "similar": "item_id_1", "events": "user_id", "requests": "user_id"}
    return [write_stage(df, f"{base}/static/{name}", range_by=[by[name]] if name in by else None)
            for name, df in (("recs", fx.nation_recs), ("top", fx.top_popular), ("similar", fx.similar),
                             ("events", fx.events), ("requests", fx.requests))]


def q_stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    base = fx.folder("stream-clean")
    n = _write_source(fx.interactions, f"{base}/source", "started_at")
    q = online.run_clean(spark, f"{base}/source", f"{base}/sink", f"{base}/checkpoint", fx.tracks, files_per_trigger=n)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/sink").select("user_id", "track_id", "started_at")


STREAM_QUERIES = {
    "stream_last_events": q_stream_last_events,
    "stream_blended": q_stream_blended,
    "stream_clean": q_stream_clean,
    "stream_state_read": q_stream_state_read,
    "stream_upsert": q_stream_upsert,
}

STREAM_ORACLES = {
    "stream_last_events": "WITH " + BASE + "\nSELECT user_id, pos, item_id, ts, event_id FROM last_events",
    # only users with online events have streaming state, hence a refreshed list
    "stream_blended": "WITH " + BASE + "\nSELECT request_id, user_id, pos, item_id FROM blended_list "
                      "WHERE user_id IN (SELECT user_id FROM online)",
    "stream_state_read": "WITH " + BASE + "\nSELECT user_id, pos, item_id, ts, event_id FROM last_events",
    "stream_upsert": "WITH " + BASE + "\nSELECT request_id, user_id, pos, item_id FROM blended_list "
                     "WHERE user_id IN (SELECT user_id FROM online)",
    "stream_clean": "WITH " + BASE + "\nSELECT user_id, track_id, started_at FROM clean",
}
