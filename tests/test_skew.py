"""Hot keys: one user and one item each hold a third of all rows.

Results must stay exact, and the plans must reduce the hot key map-side before its
shuffle (partial aggregation, partial WindowGroupLimit) instead of sending all of its rows
to one task.
"""

import datetime as dt
import re

from pyspark.sql import functions as F

from cadenza.operators import popularity, serving
from cadenza.sources import tables as T
from helpers import reqs


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_events(spark, n=3000):
    base = dt.datetime(2000, 1, 1)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        user = 1 if hot else 2 + i % 97
        item = 7 if (i % 3 == 1) else 100 + i % 53
        rows.append((user, item, base + dt.timedelta(seconds=i)))
    return spark.createDataFrame(rows, T.EVENTS).repartition(8)


def test_hot_item_popularity_exact_and_pre_aggregated(spark):
    ev = _hot_events(spark)
    got = {r.item_id: (r.plays, r.users) for r in popularity.item_popularity(ev).collect()}
    exp = {r.item_id: (r.p, r.u) for r in ev.groupBy("item_id").agg(
        F.count("started_at").alias("p"), F.count_distinct("user_id").alias("u")).collect()}
    assert got == exp
    plan = _plan(popularity.item_popularity(ev))
    # (item, user) groups are shuffled on both keys before the per-item aggregation
    assert re.search(r"hashpartitioning\(item_id#\d+, user_id#\d+", plan)
    # …and each task folds a hot item into one partial row before the per-item shuffle
    assert re.search(r"partial_sum\(c#\d+L?\), partial_count\(user_id", plan)


def test_hot_user_last_events_limited_before_shuffle(spark):
    ev = _hot_events(spark).select("user_id", "item_id", F.col("started_at").alias("ts"),
                                   F.monotonically_increasing_id().alias("event_id"))
    last = serving.last_events(ev)
    plan = _plan(last)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    per_user = {r.user_id: r.n for r in last.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_user[1] == 10 and max(per_user.values()) == 10


def test_hot_user_history_filter_exact(spark):
    ev = _hot_events(spark)
    req = reqs(spark, [(1, 5), (2, 5)])
    seen = serving.seen_items(ev, req)
    exp = ev.filter(F.col("user_id").isin(1, 2)).select("user_id", "item_id").distinct()
    assert seen.exceptAll(exp).count() == 0 and exp.exceptAll(seen).count() == 0
    # a task folds its repeated pairs before they are shuffled on both keys
    assert re.search(r"Exchange hashpartitioning\(user_id#\d+, item_id#\d+.*\n.*HashAggregate\(keys=\[user_id#\d+, item_id#\d+\]", _plan(seen))


def test_hot_user_stream_pre_limit_keeps_n_rows_of_a_batch():
    import pandas as pd
    from cadenza.streaming.online import _partial_newest
    pdf = pd.DataFrame({"user_id": [1] * 500 + [2] * 3, "item_id": 5, "ts": pd.date_range("2024", periods=503, freq="s"),
                        "event_id": range(503)})
    out = list(_partial_newest(10)(iter([pdf, pdf])))
    assert [len(o) for o in out] == [13, 13] and set(out[0][out[0].user_id == 1].event_id) == set(range(490, 500))


def test_growing_sides_are_not_broadcast_by_their_file_size(spark, tmp_path):
    """Lists that Parquet stores in a few KB are not taken for a few KB of memory; lists stay the same."""
    recs = spark.range(4000).select((F.col("id") / 50).cast("int").alias("user_id"), (F.col("id") % 50).cast("int").alias("item_id"),
                                    F.lit(0.5).alias("score"), (F.col("id") % 50 + 1).cast("int").alias("rank"))
    tables = {"recs": recs, "top": spark.createDataFrame([(7, 1, 1.0)], "item_id int, rank int, score double"),
              "events": spark.createDataFrame([(0, 0), (79, 1)], "user_id int, item_id int"),
              "requests": spark.range(80).select("id", F.col("id").cast("int").alias("user_id"), F.lit(2).alias("k")).toDF("request_id", "user_id", "k")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
    t = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in tables}
    got = serving.offline_recs(t["requests"], t["recs"], t["top"], t["events"])
    bits = serving.offline_recs(t["requests"], t["recs"], t["top"], t["events"], bitmaps=serving.seen_bitmaps(t["events"], t["requests"]))
    near = spark.createDataFrame([(0, 1, 5)], "user_id int, pos int, item_id int")
    similar = spark.createDataFrame([(5, 9, 0.9, 1)], "item_id_1 int, item_id_2 int, score double, rank int")
    blended = serving.blended_recs(t["requests"], t["recs"], t["top"], near, similar, t["events"])
    for df in (got, bits, blended):
        big = [line for line in _plan(df).splitlines() if "BroadcastHashJoin" in line and ("user_id" in line or "request_id" in line)]
        assert not big, big
    rows = {(r.user_id, r.pos): r.item_id for r in got.collect()}
    assert len(rows) == 160 and rows[(0, 1)] == 1 and rows[(79, 2)] == 2 and rows == {(r.user_id, r.pos): r.item_id for r in bits.collect()}
    assert {r.pos: r.item_id for r in blended.collect() if r.user_id == 0} == {1: 1, 2: 9}
