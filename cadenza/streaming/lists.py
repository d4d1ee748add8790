"""Refreshed lists that replace the old ones, and state that is read where it lies.

:class:`ListStore` holds one current list per user in a Parquet folder partitioned by
``bucket``, a hash of the user. A micro-batch replaces the lists of its users: only their buckets
are read, merged and overwritten (dynamic partition overwrite), so its cost follows the users
that changed, and a reader needs no rule to tell current rows from old ones.

A batch is delivered at least once. Its merged buckets are first written to a folder of their own
below ``_merged`` and only then over the current ones. If it is delivered again, a finished merge of
that batch is written over as it is: the merge is never taken from buckets that the batch
itself has half replaced, so a second delivery changes nothing. Merges of earlier batches
are deleted once a later batch is merged.

:func:`newest_events_of` reads the keyed state of a stopped or running query from its
checkpoint through the state data source, as of its last committed batch, without any sink.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators import serving
from cadenza.streaming import online

BUCKETS = 64
LISTS = "request_id bigint, user_id int, pos int, item_id int"


class ListStore:
    """``request_id, user_id, pos, item_id`` below ``path``, one current list per request of a user."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucket(self):
        return F.pmod(F.xxhash64("user_id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _hadoop(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def read(self) -> DataFrame:
        """All current lists."""
        return self._current().select("request_id", "user_id", "pos", "item_id")

    def _current(self) -> DataFrame:
        where, store = self._hadoop(f"{self.path}/current")
        if not store.exists(where):
            return self.spark.createDataFrame([], f"{LISTS}, bucket int")
        return self.spark.read.schema(f"{LISTS}, bucket int").parquet(f"{self.path}/current")

    def upsert(self, users: DataFrame, lists: DataFrame, batch_id: int) -> None:
        """Put ``lists`` in the place of all lists of ``users`` (a user without new rows loses the old ones)."""
        merged = f"{self.path}/_merged/batch_id={batch_id}"
        done, store = self._hadoop(f"{merged}/_SUCCESS")
        if not store.exists(done):
            changed = users.select("user_id").distinct().select("user_id", self._bucket())
            touched = [r.bucket for r in changed.select("bucket").distinct().collect()]  # at most ``buckets``
            kept = (self._current().where(F.col("bucket").isin(touched) if touched else F.lit(False))
                    .join(changed.select("user_id"), "user_id", "left_anti"))
            new = lists.select("request_id", "user_id", "pos", "item_id", self._bucket())
            # a touched bucket that ends up empty still has to be overwritten: it keeps one row of nulls
            marks = self.spark.createDataFrame([(b,) for b in touched], "bucket int").select(
                *(F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in LISTS.split(", "))), "bucket")
            rows = kept.select(*marks.columns).unionByName(new).unionByName(marks)
            rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(merged)
            self._forget(batch_id)
        rows = self.spark.read.schema(f"{LISTS}, bucket int").parquet(merged)
        (rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(f"{self.path}/current"))

    def _forget(self, batch_id: int) -> None:
        where, store = self._hadoop(f"{self.path}/_merged")
        for entry in store.listStatus(where):
            if int(entry.getPath().getName().partition("=")[2]) < batch_id:
                store.delete(entry.getPath(), True)

    def lists(self) -> DataFrame:
        """The current lists without the null rows that mark emptied buckets."""
        return self.read().where(F.col("user_id").isNotNull())


def run_list_refresh(spark: SparkSession, source: str, store: ListStore, checkpoint: str, recs: DataFrame, top: DataFrame,
                     similar: DataFrame, events: DataFrame, requests: DataFrame, available_now: bool = True,
                     files_per_trigger: int | None = None):
    """Start T2 with :class:`ListStore` as its sink: the static tables are as in
    :func:`cadenza.streaming.online.run_blended_refresh`. The changed users' newest items are
    pushed into ``similar`` as their ids are into the other tables."""
    state = online.latest_events_state(online.read_online_stream(spark, source, files_per_trigger))

    def refresh(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            changed = batch.select("user_id")
            req, own, past = (online.of_users(t, changed) for t in (requests, recs, events))
            recent = online.state_as_list(batch)
            near = of_items(similar, recent.where(F.col("pos") <= serving.RECENT_FOR_ONLINE).select("item_id"))
            store.upsert(changed, serving.blended_recs(req, own, top, recent, near, past), batch_id)
        finally:
            batch.unpersist()

    writer = state.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).outputMode("update")
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def of_items(similar: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``similar`` whose first item is among ``items``: pushed into the scan like the users' ids."""
    renamed = similar.withColumnRenamed("item_id_1", "user_id")
    return online.of_users(renamed, items.select(F.col("item_id").alias("user_id"))).withColumnRenamed("user_id", "item_id_1")


def newest_events_of(spark: SparkSession, checkpoint: str, users: DataFrame | None = None) -> DataFrame:
    """``user_id, pos, item_id, ts, event_id``, newest first, from the state that the query of
    :func:`cadenza.streaming.online.latest_events_state` keeps below ``checkpoint``; of all users or of ``users``."""
    try:
        state = spark.read.format("statestore").load(checkpoint)
    except PySparkException as problem:
        raise ValueError(f"no committed state below {checkpoint}") from problem
    group = "value.groupState" if "groupState" in state.schema["value"].dataType.names else "value"
    rows = state.select(F.col("key.user_id").alias("user_id"), *(F.col(f"{group}.{c}").alias(c) for c in ("items", "ts", "event_ids")))
    if users is not None:
        rows = rows.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return online.state_as_list(rows)
