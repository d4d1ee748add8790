"""Stage manifests, bucketed history, replaced lists, state read from a checkpoint, one-pass evaluation."""

import json
import os

import pytest
from helpers import reqs, ts
from pyspark.sql import functions as F

from cadenza.operators import metrics, popularity, ranker, serving
from cadenza.sources import footers
from cadenza.sources.bucketed import history_buckets, open_bucketed, save_bucketed
from cadenza.sources.stages import StageStore
from cadenza.sources.tables import write_stage
from cadenza.streaming import lists, online


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def run_stages(spark, base, source, least):
    store = StageStore(spark, base)
    rows = store.stage("rows", lambda: spark.read.parquet(source), paths=[source])
    big = store.stage("big", lambda: rows.where(F.col("id") >= least), after=["rows"], params={"least": least})
    odd = store.stage("odd", lambda: rows.where("id % 2 = 1"), after=["rows"])
    store.stage("sum", lambda: big.agg(F.sum("id").alias("s")), after=["big"])
    return dict(store.actions), spark.read.parquet(store.folder("sum")).first().s, odd.count()


def test_exactly_the_stages_behind_a_change_are_rebuilt(spark, tmp_path):
    base, source = f"file://{tmp_path}/base", f"file://{tmp_path}/source"
    write_stage(spark.range(10), source)
    all_built = dict.fromkeys(("rows", "big", "odd", "sum"), "built")
    assert run_stages(spark, base, source, 5) == (all_built, 35, 5)
    assert run_stages(spark, base, source, 5) == (dict.fromkeys(all_built, "reused"), 35, 5)
    assert run_stages(spark, base, source, 8) == ({"rows": "reused", "big": "built", "odd": "reused", "sum": "built"}, 17, 5)
    write_stage(spark.range(12), source)
    assert run_stages(spark, base, source, 8) == (all_built, 38, 6)


def test_an_unfinished_stage_is_built_again(spark, tmp_path):
    base, source = str(tmp_path / "base"), str(tmp_path / "source")
    write_stage(spark.range(4), source)
    run_stages(spark, base, source, 1)

    def fails():
        raise RuntimeError("lost")

    store = StageStore(spark, base)
    with pytest.raises(RuntimeError):
        store.stage("rows", fails, paths=[source], params={"other": 1})
    assert not os.path.exists(f"{base}/_manifests/rows.json")
    assert run_stages(spark, base, source, 1)[0] == {"rows": "built", "big": "reused", "odd": "reused", "sum": "reused"}
    assert json.load(open(f"{base}/_manifests/big.json"))["params"] == {"least": 1}


def test_bucketed_history_is_joined_in_place(spark, fx, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        history = save_bucketed(fx.events, "history_in_place", f"file://{tmp_path}/history", 8)
        got = serving.offline_recs(fx.requests, fx.nation_recs, fx.top_popular, history, whole_history=True)
        plan = _plan(got)
        lines = plan.split("\n")
        scan = next(i for i, line in enumerate(lines) if "history_in_place" in line or "Bucketed: true" in line)
        depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
        above = []  # the operators between the scan and the join
        for line in reversed(lines[:scan]):
            if depth(line) < depth(lines[scan]) and (not above or depth(line) < depth(above[-1])):
                above.append(line)
                if "Join" in line:
                    break
        assert "Join" in above[-1] and not any("Exchange" in line for line in above)
        same = serving.offline_recs(fx.requests, fx.nation_recs, fx.top_popular, fx.events)
        assert got.exceptAll(same).isEmpty() and same.exceptAll(got).isEmpty()
        again = open_bucketed(spark, "history_again", f"file://{tmp_path}/history", "user_id int, item_id int, started_at timestamp_ntz", 8)
        assert again.count() == fx.events.count()
        assert len([f for f in os.listdir(tmp_path / "history") if f.endswith(".parquet")]) <= 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS history_in_place")
        spark.sql("DROP TABLE IF EXISTS history_again")


def test_history_buckets():
    assert [history_buckets(n) for n in (0, 40_000_000, 41_000_000, 10**10)] == [8, 8, 16, 2048]


ROWS = "request_id bigint, user_id int, pos int, item_id int"


def test_lists_are_replaced_and_redelivery_changes_nothing(spark, tmp_path):
    store = lists.ListStore(spark, f"file://{tmp_path}/lists", buckets=3)
    users = lambda *ids: spark.createDataFrame([(i,) for i in ids], "user_id int")
    rows = lambda *r: spark.createDataFrame(list(r), ROWS)
    now = lambda: sorted(map(tuple, store.lists().collect()))
    assert now() == []
    store.upsert(users(1, 2, 3, 4), rows((1, 1, 1, 10), (1, 1, 2, 11), (2, 2, 1, 20), (3, 3, 1, 30), (4, 4, 1, 40)), 0)
    store.upsert(users(2, 3), rows((2, 2, 1, 21), (2, 2, 2, 22)), 1)  # user 3 has no list any more
    expect = [(1, 1, 1, 10), (1, 1, 2, 11), (2, 2, 1, 21), (2, 2, 2, 22), (4, 4, 1, 40)]
    assert now() == expect
    store.upsert(users(2, 3), rows((2, 2, 1, 21), (2, 2, 2, 22)), 1)
    assert now() == expect
    store.upsert(users(1, 2, 3, 4), rows(), 2)
    assert now() == []
    assert sorted(os.listdir(tmp_path / "lists" / "_merged")) == ["batch_id=2"]


def test_half_replaced_buckets_are_repaired_by_the_finished_merge(spark, tmp_path):
    store = lists.ListStore(spark, f"file://{tmp_path}/lists", buckets=2)
    users = spark.createDataFrame([(i,) for i in range(1, 9)], "user_id int")
    rows = spark.createDataFrame([(i, i, 1, i * 10) for i in range(1, 9)], ROWS)
    store.upsert(users, rows, 0)
    store.upsert(users.where("user_id = 1"), rows.where("user_id = 1").withColumn("item_id", F.lit(7)), 1)
    expect = sorted(map(tuple, store.lists().collect()))
    lost = next(d for d in os.listdir(tmp_path / "lists" / "current") if d.startswith("bucket="))
    for name in os.listdir(tmp_path / "lists" / "current" / lost):  # as if the overwrite had stopped half-way
        os.remove(tmp_path / "lists" / "current" / lost / name)
    touched = [d for d in os.listdir(tmp_path / "lists" / "_merged" / "batch_id=1") if d.startswith("bucket=")]
    store.upsert(users.where("user_id = 1"), rows.where("false"), 1)
    if lost in touched:
        assert sorted(map(tuple, store.lists().collect())) == expect


def test_state_is_read_from_the_checkpoint(spark, tmp_path):
    source, check = str(tmp_path / "source"), str(tmp_path / "check")
    schema = "user_id int, item_id int, ts timestamp_ntz, event_id bigint"
    first = [(u, 10 * u + n, ts(1, n), 100 * u + n) for u in (1, 2) for n in range(12)]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(source)
    online.run_last_events(spark, source, str(tmp_path / "sink"), check).awaitTermination()
    spark.createDataFrame([(2, 99, ts(2), 999), (3, 1, ts(2), 1000)], schema).coalesce(1).write.mode("append").parquet(source)
    online.run_last_events(spark, source, str(tmp_path / "sink"), check).awaitTermination()
    got = lists.newest_events_of(spark, check)
    expect = serving.last_events(spark.read.parquet(source))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect.select(got.columns).collect()))
    one = lists.newest_events_of(spark, check, spark.createDataFrame([(2,), (2,), (5,)], "user_id int"))
    assert [r.item_id for r in one.orderBy("pos").collect()] == [99, *range(31, 22, -1)]
    with pytest.raises(ValueError):
        lists.newest_events_of(spark, str(tmp_path / "nothing"))


def test_one_pass_evaluation_equals_set_by_set(spark, fx):
    sets = {"popular": popularity.popular_as_recs(fx.top_popular, fx.test_users),
            "nation": fx.nation_recs,
            "strangers": spark.createDataFrame([(-1, 5, 1.0), (-1, 6, 0.5)], "user_id int, item_id int, score double"),
            "none": spark.createDataFrame([], "user_id int, item_id int, score double")}
    got = {r.model: r for r in metrics.evaluate_many(sets, fx.train, fx.test, fx.items).collect()}
    assert set(got) == set(sets)
    for name, recs in sets.items():
        pr = metrics.precision_recall(metrics.binary_relevance(fx.train, fx.test, recs)).first()
        expect = (pr.precision, pr.recall, metrics.coverage(recs, fx.items).first().coverage, metrics.novelty(recs, fx.train).first().novelty)
        for a, b in zip((got[name].precision, got[name].recall, got[name].coverage, got[name].novelty), expect):
            assert (a is None and b is None) or abs(a - b) < 1e-12, (name, got[name], expect)


def test_evaluation_reads_plays_once_for_all_sets(spark, fx):
    sets = {f"m{i}": fx.nation_recs for i in range(3)}
    plan = _plan(metrics.evaluate_many(sets, fx.train, fx.test, fx.items))
    one = _plan(metrics.evaluate("m", fx.nation_recs, fx.train, fx.test, fx.items))
    assert plan.count("/events-") == one.count("/events-")


def test_saved_trees_give_the_models_probability(spark, fx, tmp_path):
    cands = ranker.build_candidates(fx.nation_recs, fx.train)
    users = cands.select("user_id").distinct()
    model = ranker.fit_ranker(cands, users, max_iter=5, depth=3)
    ranker.save_ranker(model, str(tmp_path / "ranker"))
    scored = ranker.score_by_trees(cands, ranker.tree_table(str(tmp_path / "ranker"), spark), depth=3)
    ranked = ranker.rank_candidates(model, cands, users, n=10_000).select("user_id", "item_id", F.col("score").alias("p"))
    both = scored.join(ranked, ["user_id", "item_id"])
    assert both.count() == cands.count()
    assert both.agg(F.max(F.abs(F.col("score") - F.col("p")))).first()[0] < 1e-12
    fell = ranker.losses(model, cands, users)
    assert len(fell) == 5 and fell[-1] < fell[0]


def test_trees_are_walked_once_for_candidates_alike(spark, fx, tmp_path):
    cands = ranker.build_candidates(fx.nation_recs, fx.train)
    model = ranker.fit_ranker(cands, cands.select("user_id").distinct(), max_iter=3, depth=2)
    ranker.save_ranker(model, str(tmp_path / "ranker"))
    scored = ranker.score_by_trees(cands.unionByName(cands), ranker.tree_table(str(tmp_path / "ranker"), spark), depth=2)
    assert "lambdafunction((x" not in _plan(scored) and "nodes" not in _plan(scored)  # scores of cells, not trees, meet the candidates
    assert scored.count() == 2 * cands.count()
    odd = spark.createDataFrame([(1, 1, None, None, 2), (2, 1, float("nan"), 10**9, 2), (3, 1, -1e300, 0, 0)],
                                "user_id int, item_id int, als_score double, tracks_played_by_user bigint, item_plays bigint")
    got = {r.user_id: r.score for r in ranker.score_by_trees(odd, ranker.tree_table(str(tmp_path / "ranker"), spark), depth=2).collect()}
    assert got.keys() == {1, 2, 3} and all(0 < p < 1 for p in got.values()) and got[1] == got[2]


def test_requests_of_a_bucketed_history_keep_extra_exclusions(spark):
    recs = spark.createDataFrame([(1, i, 1.0 / i, i) for i in range(1, 7)], "user_id int, item_id int, score double, rank int")
    top = spark.createDataFrame([(9, 1, 1.0)], "item_id int, rank int, score double")
    events = spark.createDataFrame([(1, 1), (1, 1), (2, 2)], "user_id int, item_id int")
    extra = spark.createDataFrame([(1, 3)], "user_id int, item_id int")
    got = [serving.offline_recs(reqs(spark, [(1, 3)]), recs, top, events, extra, whole_history=w).orderBy("pos").collect() for w in (False, True)]
    assert [r.item_id for r in got[0]] == [r.item_id for r in got[1]] == [2, 4, 5]


def test_counts_and_bounds_come_from_footers(spark, fx, tmp_path):
    path = str(tmp_path / "plays")
    rows = fx.events.select("user_id", F.when(F.col("item_id") > 5, F.col("item_id")).alias("item_id"), F.to_date("started_at").alias("day"))
    write_stage(rows.repartition(5), path)
    got = footers.footer_summary(spark, path, ["user_id", "item_id", "day"]).first()
    cols = [f(c) for c in ("user_id", "item_id", "day") for f in (F.count, F.min, F.max)]
    assert tuple(got) == tuple(rows.agg(F.count(F.lit(1)), *cols).first())
    with footers.settings(spark, footers.V2_PUSHDOWN):
        plan = _plan(footers.footer_plan(spark, path, ["user_id"]))
    assert "PushedAggregation: [COUNT(*), COUNT(user_id), MIN(user_id), MAX(user_id)]" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    with pytest.raises(ValueError, match="started_at"):
        write_stage(fx.events, path)
        footers.footer_summary(spark, path, ["started_at"])


def test_bitmaps_hide_what_pairs_hide(spark, fx):
    events = spark.createDataFrame([(1, 5), (1, 5), (1, 40_000), (1, 65_536), (2, 32_768), (2, 7)], "user_id int, item_id int")
    bits = serving.seen_bitmaps(events)
    assert bits.count() == 3  # user 1 has items of two buckets
    cands = spark.createDataFrame([(u, i, p) for u in (1, 2, 3) for p, i in enumerate([5, 7, 32_767, 32_768, 40_000, 65_535, 65_536])],
                                  "user_id int, item_id int, pos int")
    left = lambda df: sorted(map(tuple, df.collect()))
    assert left(serving.filter_seen_bits(cands, bits)) == left(serving.filter_seen(cands, events).select(*cands.columns))
    by_bits = serving.offline_recs(fx.requests, fx.nation_recs, fx.top_popular, fx.events, bitmaps=serving.seen_bitmaps(fx.events, fx.requests))
    by_pairs = serving.offline_recs(fx.requests, fx.nation_recs, fx.top_popular, fx.events)
    assert by_bits.exceptAll(by_pairs).isEmpty() and by_pairs.exceptAll(by_bits).isEmpty()
