"""Serving: blend golden from the recorded service log, hand rows, properties."""

import datetime as dt

from pyspark.sql import functions as F

from cadenza.operators import serving
from cadenza.sources import tables as T
from helpers import lists, reqs, ts

# The recorded offline, online and blended lists of the original service
# for one user with k = 10 (its test log, lines 12-14), and the offline list of line 5.
LOG_OFFLINE = [986, 694683, 18820599, 1703893, 24327639, 679169, 24327922, 220499, 25062866, 861]
LOG_ONLINE = [544273, 2160949, 3180, 2450303, 3401735, 28132335, 28965492, 2409938, 359439, 34694610]
LOG_BLENDED = [986, 544273, 694683, 2160949, 18820599, 3180, 1703893, 2450303, 24327639, 3401735]

LIST = "request_id bigint, user_id int, pos int, item_id int"


def _as_rows(user, items):
    return [(0, user, i + 1, x) for i, x in enumerate(items)]


def _blend(spark, offline, online, k):
    off = spark.createDataFrame(_as_rows(1, offline), LIST)
    on = spark.createDataFrame(_as_rows(1, online), LIST)
    req = reqs(spark, [(1, k)])
    return lists(serving.blend(off, on, req)).get(1, [])


def _blend_arrays(spark, offline, online, k):
    df = spark.createDataFrame([(offline, online)], "o array<int>, n array<int>")
    return df.select(serving.blend_arrays(F.col("o"), F.col("n"), k).alias("b")).first()["b"]


def test_blend_golden_from_log(spark):
    assert _blend(spark, LOG_OFFLINE, LOG_ONLINE, 10) == LOG_BLENDED
    assert _blend_arrays(spark, LOG_OFFLINE, LOG_ONLINE, 10) == LOG_BLENDED


def test_blend_empty_online_is_offline(spark):
    assert _blend(spark, LOG_OFFLINE, [], 10) == LOG_OFFLINE
    assert _blend_arrays(spark, LOG_OFFLINE, [], 10) == LOG_OFFLINE


def test_blend_unequal_and_overlapping(spark):
    assert _blend(spark, [1, 2, 3, 4], [2, 9], 10) == [1, 2, 9, 3, 4]
    assert _blend_arrays(spark, [1, 2, 3, 4], [2, 9], 10) == [1, 2, 9, 3, 4]


def test_blend_online_longer(spark):
    assert _blend(spark, [1], [7, 8, 9], 3) == [1, 7, 8]
    assert _blend_arrays(spark, [1], [7, 8, 9], 3) == [1, 7, 8]


def _online_setup(spark):
    # 12 online events of user 1, with repeats; item ids increase with time
    base = dt.datetime(2024, 1, 1)
    items = [50, 51, 52, 50, 53, 54, 55, 56, 57, 58, 59, 58]
    online = spark.createDataFrame([(1, it, base + dt.timedelta(minutes=i), i) for i, it in enumerate(items)],
                                   T.ONLINE_EVENTS)
    return items, online


def test_last_events_keeps_ten_newest_with_repeats(spark):
    items, online = _online_setup(spark)
    got = lists(serving.last_events(online))[1]
    assert got == list(reversed(items))[:10]
    assert got.count(58) == 2


def test_online_uses_three_newest_and_seen_rule(spark):
    items, online = _online_setup(spark)
    # newest three events: 58, 59, 58 → neighbours of 58 then 59
    similar = spark.createDataFrame(
        [(58, 100, 0.9), (58, 50, 0.8), (58, 101, 0.7), (59, 102, 0.9), (59, 100, 0.5), (57, 999, 0.9)],
        "item_id_1 int, item_id_2 int, score double")
    history = spark.createDataFrame([(1, 101, ts(1))], T.EVENTS)
    req = reqs(spark, [(1, 10)])
    recent = serving.last_events(online)
    got = lists(serving.online_recs(req, recent, similar, history))[1]
    # 50 is an older online event (not among the newest 3) and not in history → kept (D5);
    # 101 is in history → removed; 100 appears twice → first occurrence; 999 belongs to an old event
    assert got == [100, 50, 102]


def test_online_without_events_is_empty(spark):
    _, online = _online_setup(spark)
    similar = spark.createDataFrame([(58, 100, 0.9)], "item_id_1 int, item_id_2 int, score double")
    history = spark.createDataFrame([], T.EVENTS)
    req = reqs(spark, [(2, 10)])
    assert serving.online_recs(req, serving.last_events(online), similar, history).count() == 0


def test_offline_overfetch_can_return_empty(spark):
    recs = spark.createDataFrame([(1, i, 1.0 - i / 10) for i in range(1, 6)], "user_id int, item_id int, score double")
    history = spark.createDataFrame([(1, i, ts(1)) for i in range(1, 5)], T.EVENTS)
    top = spark.createDataFrame([(9, 1)], "item_id int, rank int").withColumn("score", F.lit(1.0))
    req = reqs(spark, [(1, 2)])
    # k=2 → only the first 4 are fetched, all seen; the fifth is never looked at
    assert serving.offline_recs(req, recs, top, history).count() == 0


def test_offline_falls_back_to_popular_in_rank_order(spark):
    recs = spark.createDataFrame([(1, 5, 0.9)], "user_id int, item_id int, score double")
    top = spark.createDataFrame([(30, 3, 0.1), (10, 1, 0.5), (20, 2, 0.4), (40, 5, 0.0)],
                                "item_id int, rank int, score double")
    history = spark.createDataFrame([(2, 20, ts(1))], T.EVENTS)
    req = reqs(spark, [(1, 3), (2, 3)])
    got = lists(serving.offline_recs(req, recs, top, history))
    assert got[1] == [5]
    assert got[2] == [10, 30, 40]  # 20 seen; gap in ranks does not matter
    counts = {r["source"]: r["requests"] for r in serving.served_source_counts(req, recs, top).collect()}
    assert counts == {"personal": 1, "default": 1}


def test_served_lists_properties(spark, fx):
    from cadenza.plans.queries import QUERIES
    from conftest import SF_SMALL
    seen = fx.events.select("user_id", "item_id").distinct()
    for name in ("offline_recs", "online_recs", "blended_recs"):
        df = QUERIES[name](spark, SF_SMALL).cache()
        stats = df.join(fx.requests.select("request_id", "k"), "request_id").groupBy("request_id").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("item_id").alias("d"), F.max("pos").alias("m"),
            F.min("pos").alias("lo"), F.first("k").alias("k")).collect()
        assert stats, name
        for r in stats:
            assert r["n"] == r["d"] == r["m"] and r["lo"] == 1 and r["n"] <= (r["k"] or 100), (name, r)
        if name != "blended_recs":
            assert df.join(seen, ["user_id", "item_id"]).count() == 0, name
        df.unpersist()


def test_offline_can_exclude_recent_online_items(spark):
    recs = spark.createDataFrame([(1, i, 1.0 - i / 10) for i in range(1, 6)], "user_id int, item_id int, score double")
    top = spark.createDataFrame([(9, 1, 1.0)], "item_id int, rank int, score double")
    history = spark.createDataFrame([], T.EVENTS)
    req = reqs(spark, [(1, 3)])
    online_seen = spark.createDataFrame([(1, 2)], "user_id int, item_id int")
    assert lists(serving.offline_recs(req, recs, top, history))[1] == [1, 2, 3]
    assert lists(serving.offline_recs(req, recs, top, history, extra_seen=online_seen))[1] == [1, 3, 4]


def test_requests_with_k_below_one_fail(spark):
    import pytest
    recs = spark.createDataFrame([(1, 5, 0.9)], "user_id int, item_id int, score double")
    top = spark.createDataFrame([(9, 1, 1.0)], "item_id int, rank int, score double")
    history = spark.createDataFrame([], T.EVENTS)
    bad = reqs(spark, [(1, 0)])
    with pytest.raises(Exception, match="k must be >= 1"):
        serving.offline_recs(bad, recs, top, history).collect()


def by_request(df):
    return lists(df, "request_id")


def test_every_request_of_a_user_is_answered_on_its_own(spark):
    recs = spark.createDataFrame([(1, i, 1.0 - i / 100) for i in range(1, 61)], "user_id int, item_id int, score double")
    top = spark.createDataFrame([(i, i, 0.1) for i in range(1, 101)], "item_id int, rank int, score double")
    history = spark.createDataFrame([(1, 2, ts(1))], T.EVENTS)
    recent = spark.createDataFrame([(1, 1, 500, ts(2), 7)], "user_id int, pos int, item_id int, ts timestamp_ntz, event_id bigint")
    similar = spark.createDataFrame([(500, 600 + i, 1.0 - i / 10) for i in range(1, 9)], "item_id_1 int, item_id_2 int, score double")
    asked = reqs(spark, [(1, 3), (1, 5), (1, None), (2, 2), (2, None)])
    off = by_request(serving.offline_recs(asked, recs, top, history))
    assert off[0] == [1, 3, 4] and off[1] == [1, 3, 4, 5, 6] and off[2] == [i for i in range(1, 61) if i != 2]
    assert off[3] == [1, 2] and off[4] == list(range(1, 101))  # no k: 100
    on = by_request(serving.online_recs(asked, recent, similar, history))
    assert on == {0: [601, 602, 603], 1: [601, 602, 603, 604, 605], 2: [600 + i for i in range(1, 9)]}
    both = by_request(serving.blended_recs(asked, recs, top, recent, similar, history))
    assert both[0] == [1, 601, 3] and both[1] == [1, 601, 3, 602, 4] and both[3] == [1, 2] and len(both[4]) == 100


def test_stored_rank_is_the_order(spark):
    recs = spark.createDataFrame([(1, 5, 0.5, 2), (1, 9, 0.5, 1)], "user_id int, item_id int, score double, rank int")
    assert [r.item_id for r in serving.personal_lists(recs).orderBy("pos").collect()] == [9, 5]
