"""Streaming state and cleaning equal their batch counterparts."""

from cadenza.operators import serving
from cadenza.streaming import queries as sq
from conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_stream_last_events_equals_batch(spark, fx):
    cols = ["user_id", "pos", "item_id", "ts", "event_id"]
    stream = sq.q_stream_last_events(spark, SF_SMALL)
    assert _rows(stream, cols) == _rows(serving.last_events(fx.online_events), cols)


def test_stream_clean_equals_batch(spark, fx):
    cols = ["user_id", "track_id", "started_at"]
    assert _rows(sq.q_stream_clean(spark, SF_SMALL), cols) == _rows(fx.clean, cols)


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["request_id", "user_id", "pos", "item_id"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stream_state_with_idle_timeout_still_equals_batch(spark, fx):
    import time
    import uuid
    from cadenza.session import checkpoint_dir
    from cadenza.streaming import online
    base = f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex[:8]}"
    fx.online_events.repartitionByRange(3, "ts").write.parquet(f"{base}/src")
    q = online.run_last_events(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", available_now=False,
                               idle_timeout_ms=3_600_000)
    expected = fx.online_events.count()
    # timeouts keep no-data batches running; progress is reported after a batch's sink
    # write, so waiting for all input rows to be counted is enough
    try:
        deadline = time.time() + 240
        while sum(p["numInputRows"] for p in q.recentProgress) < expected and time.time() < deadline:
            time.sleep(1)
    finally:
        q.stop()
    got = online.state_as_list(online.latest_per_user(spark.read.parquet(f"{base}/sink")))
    cols = ["user_id", "pos", "item_id", "ts", "event_id"]
    assert _rows(got, cols) == _rows(serving.last_events(fx.online_events), cols)


def _until(done, seconds=120):
    import time
    end = time.time() + seconds
    while not done() and time.time() < end:
        time.sleep(0.5)
    assert done()


def _events(spark, rows):
    from helpers import ts
    return spark.createDataFrame([(u, i, ts(1, n), n) for u, i, n in rows], "user_id int, item_id int, ts timestamp_ntz, event_id bigint")


def _folder(spark):
    import uuid
    from cadenza.session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex[:8]}"


def test_a_timeout_that_fires_starts_the_user_anew(spark):
    """After the state was dropped, the next event's list is the latest one, without the old events."""
    from cadenza.streaming import online
    base = _folder(spark)
    _events(spark, [(1, 10, 1), (1, 11, 2), (2, 50, 3)]).coalesce(1).write.parquet(f"{base}/src")
    q = online.run_last_events(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", available_now=False, idle_timeout_ms=1000)
    removed = lambda: sum(o.numRowsRemoved for p in q.recentProgress for o in p.stateOperators)
    try:
        _until(lambda: removed() >= 2)
        _events(spark, [(1, 12, 9)]).coalesce(1).write.mode("append").parquet(f"{base}/src")
        _until(lambda: sum(p["numInputRows"] for p in q.recentProgress) >= 4)
    finally:
        q.stop()
    got = online.state_as_list(online.latest_per_user(spark.read.parquet(f"{base}/sink")))
    assert _rows(got, ["user_id", "pos", "item_id"]) == [(1, 1, 12), (2, 1, 50)]


def test_an_emptied_list_replaces_the_old_one(spark):
    from cadenza.streaming import online
    from helpers import reqs, ts
    base = _folder(spark)
    recs = spark.createDataFrame([], "user_id int, item_id int, score double")
    top = spark.createDataFrame([], "item_id int, rank int, score double")
    similar = spark.createDataFrame([(10, 70, 0.9), (11, 80, 0.9), (11, 81, 0.8)], "item_id_1 int, item_id_2 int, score double")
    history = spark.createDataFrame([(1, 70, ts(1))], "user_id int, item_id int, started_at timestamp_ntz")
    asked = reqs(spark, [(1, 5), (2, 5)])

    def run(rows):
        _events(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/src")
        online.run_blended_refresh(spark, f"{base}/src", f"{base}/sink", f"{base}/ckpt", recs, top, similar, history, asked).awaitTermination()
        return _rows(online.latest_per_user(spark.read.parquet(f"{base}/sink")), ["request_id", "user_id", "pos", "item_id"])

    both = [(1, 2, 1, 80), (1, 2, 2, 81)]
    assert run([(1, 11, 1), (2, 11, 2)]) == [(0, 1, 1, 80), (0, 1, 2, 81), *both]
    assert run([(1, 10, 3), (1, 10, 4), (1, 10, 5)]) == both  # 10 leads to 70 alone, which user 1 has played
    assert online.compact(spark, f"{base}/sink", f"{base}/small") == 1
    assert _rows(online.latest_per_user(spark.read.parquet(f"{base}/small")), ["request_id", "user_id", "pos", "item_id"]) == both


def test_static_reads_push_the_changed_users(spark, fx):
    from cadenza.streaming import online
    users = spark.createDataFrame([(3,), (9,)], "user_id int")
    plan = online.of_users(fx.events, users)._jdf.queryExecution().executedPlan().toString()
    assert "In(user_id, [3,9])" in plan
    assert online.of_users(fx.events, users.where("false")).count() == 0


def test_ranges_are_pushed_beyond_the_bound(spark, fx, monkeypatch):
    from cadenza.streaming import online
    monkeypatch.setattr(online, "PUSHED_USERS", 1)
    users = spark.createDataFrame([(3,), (9,)], "user_id int")
    got = online.of_users(fx.events, users)
    assert "GreaterThanOrEqual(user_id,3)" in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == fx.events.where("user_id in (3, 9)").count()


def test_state_of_many_users_is_kept_without_frames(spark, monkeypatch):
    """A user's state costs no sort or join of frames; equal times go by event id, events without a time are oldest."""
    import pandas as pd
    from cadenza.streaming import online
    from helpers import ts

    class State:
        hasTimedOut, exists, get = False, True, ([7, 8], [ts(2), ts(1)], [70, 80])

        def update(self, value):
            self.got = value

    state = State()
    batch = pd.DataFrame({"user_id": [5] * 4, "item_id": [1, 2, 3, 4], "ts": pd.to_datetime([ts(1), ts(2), ts(3), None]), "event_id": [81, 69, 1, 99]})
    monkeypatch.setattr(pd, "concat", None)
    monkeypatch.setattr(pd.DataFrame, "sort_values", None)
    out = list(online._keep_newest(5)((5,), iter([batch]), state))
    assert state.got == ([3, 7, 2, 1, 8], [ts(3), ts(2), ts(2), ts(1), ts(1)], [1, 70, 69, 81, 80])
    assert out[0].to_dict("records") == [{"user_id": 5, "items": state.got[0], "ts": state.got[1], "event_ids": state.got[2]}]
    state.get = ([], [], [])
    list(online._keep_newest(5)((5,), iter([batch]), state))
    assert state.got[0] == [3, 2, 1, 4] and state.got[1][-1] is None
