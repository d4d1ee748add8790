"""Online events as Structured Streaming jobs.

T1 keeps, per user, the newest ``n`` online events in keyed state
(``applyInPandasWithState``): one state row per user, bounded by ``n``, checkpointed with
the query so a restarted query resumes where it stopped. The newest-first order is by
``(ts, event_id)``, so the state does not depend on how events are split into
micro-batches, and batch (:func:`cadenza.operators.serving.last_events`) and stream agree.

T2 refreshes the blended lists of the users whose state changed in a micro-batch
(``foreachBatch``: the changed users' state joined with the static recommendation tables).

T3 runs the batch cleaning function on a streaming DataFrame (stateless filter plus a
stream–static semi join).

Sinks are Parquet folders with one ``batch_id=N`` sub-folder per micro-batch, overwritten
when a batch is re-delivered after a failure. Batch ids only grow within a query, also when
a user's state was dropped meanwhile, so a reader takes each user's rows of the highest one
(:func:`latest_per_user`). A user whose list became empty gets one row with null ``pos``
there, which hides the older list. :func:`compact` folds a sink's batches into one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cadenza.functions.joins import growing
from cadenza.operators import serving
from cadenza.operators.clean import clean_interactions
from cadenza.session import ship_package
from cadenza.sources.tables import INTERACTIONS, ONLINE_EVENTS

STATE_SCHEMA = "items array<int>, ts array<timestamp_ntz>, event_ids array<bigint>"
LATEST_SCHEMA = "user_id int, items array<int>, ts array<timestamp_ntz>, event_ids array<bigint>"


def _age(event: tuple) -> tuple:
    """Order of events by ``(ts, event_id)``; those without a time are the oldest."""
    ts, event_id = event[:2]
    return ts is not None, ts or dt.datetime.min, event_id


def _keep_newest(n: int, idle_ms: int | None = None):
    def update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # idle user: drop its state, emit nothing
            state.remove()
            return
        # plain lists: a frame, or a sort of one, for every user would cost more than all else
        events: list[tuple] = []
        for pdf in batches:
            events.extend(zip(pdf["ts"].to_numpy().astype("datetime64[us]").tolist(), pdf["event_id"].tolist(), pdf["item_id"].tolist()))
        if state.exists:
            items, ts, ids = state.get
            events.extend(zip(ts, ids, items))
        newest = sorted(events, key=_age, reverse=True)[:n]
        items, ts, ids = [int(e[2]) for e in newest], [e[0] for e in newest], [int(e[1]) for e in newest]
        state.update((items, ts, ids))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame({"user_id": [int(key[0])], "items": [items], "ts": [ts], "event_ids": [ids]})
    return update


def _partial_newest(n: int):
    """The newest ``n`` events of each user within every Arrow batch (map-side pre-limit).

    A user holding a large share of a micro-batch reaches the keyed state with at most
    ``n`` rows per Arrow batch instead of all of its rows. Nothing is carried from one batch
    to the next, so a task holds one Arrow batch.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            newest = pdf.sort_values(["ts", "event_id"], ascending=False, kind="mergesort")
            yield newest.groupby("user_id", sort=False).head(n)
    return run


EVENT_COLUMNS = "user_id int, item_id int, ts timestamp_ntz, event_id bigint"


def latest_events_state(online_stream: DataFrame, n: int = serving.ONLINE_KEEP,
                        idle_timeout_ms: int | None = None) -> DataFrame:
    """Streaming DataFrame of ``user_id, items, ts, event_ids`` (newest first),
    one row per user whose state changed in the micro-batch (update mode).

    State is at most ``n`` events per user. ``idle_timeout_ms`` drops the state of users
    without events for that long (processing time), bounding the number of users kept.
    """
    ship_package(online_stream.sparkSession)
    timeout = GroupStateTimeout.NoTimeout if idle_timeout_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return (online_stream.select("user_id", "item_id", "ts", "event_id")
            .mapInPandas(_partial_newest(n), EVENT_COLUMNS)
            .groupBy("user_id")
            .applyInPandasWithState(_keep_newest(n, idle_timeout_ms), LATEST_SCHEMA, STATE_SCHEMA, "update",
                                    timeout))


def state_as_list(state_rows: DataFrame) -> DataFrame:
    """State rows as ``user_id, pos, item_id, ts, event_id`` (pos 1 = newest)."""
    zipped = state_rows.select("user_id", F.posexplode(F.arrays_zip("items", "ts", "event_ids")).alias("p", "e"))
    return zipped.select("user_id", (F.col("p") + 1).cast("int").alias("pos"),
                         F.col("e.items").alias("item_id"), F.col("e.ts").alias("ts"),
                         F.col("e.event_ids").alias("event_id"))


def latest_per_user(sink: DataFrame, order_col: str = "batch_id") -> DataFrame:
    """Each user's rows of its highest batch, without those that only say that a list is empty."""
    top = sink.groupBy("user_id").agg(F.max(order_col).alias("_top"))
    rows = sink.join(growing(top), "user_id").filter(F.col(order_col) == F.col("_top")).drop("_top")
    return rows.filter(F.col("pos").isNotNull()) if "pos" in sink.columns else rows


def compact(spark: SparkSession, sink: str, dest: str) -> int | None:
    """Write each user's latest rows of ``sink`` as one batch below ``dest``, a sink of its own;
    returns that batch's number (none for an empty sink). Batches that arrive later may be
    written on there, as their numbers are higher."""
    rows = spark.read.parquet(sink)
    last = rows.agg(F.max("batch_id")).first()[0]
    if last is not None:
        _write_batch(latest_per_user(rows).drop("batch_id"), dest, last)
    return last


def _write_batch(df: DataFrame, sink: str, batch_id: int) -> None:
    """Idempotent micro-batch write: a re-delivered batch overwrites its own
    ``batch_id=N`` folder instead of appending duplicates (foreachBatch is at-least-once)."""
    df.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")


def read_online_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    return _stream(spark, path, ONLINE_EVENTS, files_per_trigger)


def read_interactions_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    return _stream(spark, path, INTERACTIONS, files_per_trigger)


def _stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None) -> DataFrame:
    """A file stream; without ``files_per_trigger`` a micro-batch takes all files that are there."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def run_last_events(spark: SparkSession, source: str, sink: str, checkpoint: str,
                    n: int = serving.ONLINE_KEEP, available_now: bool = True,
                    idle_timeout_ms: int | None = None, files_per_trigger: int | None = None):
    """Start T1: state rows written to ``sink`` (Parquet), one folder per micro-batch.

    An idle timeout needs a continuously running query: timeouts fire in micro-batches
    without data, so an ``availableNow`` query with one would never end.
    """
    if idle_timeout_ms is not None and available_now:
        raise ValueError("idle_timeout_ms needs a continuous trigger (available_now=False)")
    state = latest_events_state(read_online_stream(spark, source, files_per_trigger), n, idle_timeout_ms)

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, sink, batch_id)

    writer = state.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update")
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


PUSHED_USERS = 10_000  # ids that a micro-batch pushes into the static scans; beyond, only their range


def of_users(table: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of ``table`` (clustered by user) that belong to ``users``: the ids, or for more than
    ``PUSHED_USERS`` of them their range, are pushed into the scan, and a semi join is exact."""
    ids = users.select("user_id").distinct()
    few = [r.user_id for r in ids.limit(PUSHED_USERS + 1).collect()]
    if len(few) <= PUSHED_USERS:
        return table.filter(F.col("user_id").isin(few) if few else F.lit(False))
    low, high = ids.agg(F.min("user_id"), F.max("user_id")).first()
    return table.filter(F.col("user_id").between(low, high)).join(ids, "user_id", "left_semi")


def run_blended_refresh(spark: SparkSession, source: str, sink: str, checkpoint: str, recs: DataFrame,
                        top: DataFrame, similar: DataFrame, events: DataFrame, requests: DataFrame,
                        available_now: bool = True, files_per_trigger: int | None = None):
    """Start T2: per micro-batch, blended lists of the users whose online state changed.

    The changed users' newest events come from the state rows of the batch; offline lists,
    similar items and history are static tables (pass written tables clustered by user, e.g.
    the build's outputs, of which a micro-batch reads the changed users' parts). Output rows
    are ``request_id, user_id, pos, item_id``; a changed user without any gets one row of nulls.
    """
    state = latest_events_state(read_online_stream(spark, source, files_per_trigger))

    def refresh(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # the stateful plan runs once per micro-batch
        try:
            changed = batch.select("user_id")
            req, own, past = (of_users(t, changed) for t in (requests, recs, events))
            blended = serving.blended_recs(req, own, top, state_as_list(batch), similar, past)
            rows = changed.join(blended, "user_id", "left").select("request_id", "user_id", "pos", "item_id")
            _write_batch(rows, sink, batch_id)
        finally:
            batch.unpersist()

    writer = state.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).outputMode("update")
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def run_clean(spark: SparkSession, source: str, sink: str, checkpoint: str, tracks: DataFrame,
              available_now: bool = True, files_per_trigger: int | None = None):
    """Start T3: streaming cleaning into a Parquet sink (append, exactly-once file sink)."""
    cleaned = clean_interactions(read_interactions_stream(spark, source, files_per_trigger), tracks)
    writer = (cleaned.writeStream.format("parquet").option("path", sink)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
