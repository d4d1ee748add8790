"""The batch build writes every artifact; ``ignore`` mode reuses them."""

import os
import tempfile

from cadenza.plans.build import build_recommendations
from cadenza.sources.fixtures import SPLIT_INSTANT
from cadenza.sources.tables import read_metrics_csv


def test_build_writes_all_stages_and_reuses(spark, fx):
    out = tempfile.mkdtemp(prefix="cadenza-build-test-")
    small = {"als_params": {"rank": 8, "max_iter": 3}, "ranker_params": {"max_iter": 3, "depth": 3}}
    stages = build_recommendations(spark, fx.tracks, fx.catalog_names, fx.interactions, out,
                                   split=SPLIT_INSTANT, **small)
    for name in ("interactions_clean", "items", "events", "top_popular", "personal_als", "similar",
                 "recommendations", "metrics_summary"):
        assert os.path.exists(os.path.join(out, name)), name
    assert stages["events"].count() == fx.events.count()
    summary = {r.model: r for r in read_metrics_csv(spark, f"{out}/metrics_summary").collect()}
    assert set(summary) == {"Top popular", "Personal ALS", "Final ranked"}
    for r in summary.values():
        for v in (r.precision, r.recall, r.coverage, r.novelty):
            assert 0.0 <= v <= 1.0
    def files():
        return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(out) for f in names}

    before = files()
    again = build_recommendations(spark, fx.tracks, fx.catalog_names, fx.interactions, out, split=SPLIT_INSTANT,
                                  mode="ignore", **small)
    assert files() == before  # the model too
    assert set(again) == set(stages) and again["metrics_summary"].count() == 3
    # a build that didn't end is no build: everything is made anew
    spark.createDataFrame([("building",)], "state string").write.mode("overwrite").parquet(f"{out}/build_state")
    build_recommendations(spark, fx.tracks, fx.catalog_names, fx.interactions, out, split=SPLIT_INSTANT, mode="ignore", **small)
    after = files()
    assert not {f for f in before if f.endswith(".parquet")} & set(after)


def test_reuse_rebuilds_what_is_behind_a_change(spark, fx, tmp_path):
    import datetime as dt
    import json

    inputs = {"tracks": f"{tmp_path}/tracks", "catalog_names": f"{tmp_path}/names", "interactions": f"{tmp_path}/plays"}
    for name, df in (("tracks", fx.tracks), ("catalog_names", fx.catalog_names), ("interactions", fx.interactions)):
        df.write.parquet(inputs[name])
    out = f"{tmp_path}/out"

    def run(split=SPLIT_INSTANT, **ranker):
        raw = [spark.read.parquet(inputs[n]) for n in ("tracks", "catalog_names", "interactions")]
        build_recommendations(spark, *raw, out, split=split, mode="reuse", inputs=inputs,
                              als_params={"rank": 4, "max_iter": 1}, ranker_params={"max_iter": 2, "depth": 2, **ranker})
        return {os.path.relpath(os.path.join(d, f), f"{out}/_manifests")[:-5]: os.path.getmtime(os.path.join(d, f))
                for d, _, names in os.walk(f"{out}/_manifests") for f in names if f.endswith(".json")}

    first = run()
    assert set(first) == {"interactions_clean", "items", "events", "top_popular", "models/als", "personal_als", "similar",
                          "candidates", "models/ranker", "recommendations", "metrics_summary"}
    changed = lambda a, b: {n for n in b if a[n] != b[n]}
    second = run()
    assert changed(first, second) == set()
    third = run(depth=3)
    assert changed(second, third) == {"models/ranker", "recommendations", "metrics_summary"}
    fourth = run(SPLIT_INSTANT - dt.timedelta(days=30), depth=3)
    assert changed(third, fourth) == set(first) - {"interactions_clean", "items", "events"}
    assert json.load(open(f"{out}/_manifests/top_popular.json"))["params"] == {"split": str(SPLIT_INSTANT - dt.timedelta(days=30))}


def test_tables_under_text_ids_give_the_same_lists(spark, fx, tmp_path):
    from pyspark.sql import functions as F

    from cadenza.operators import catalog, clean, ids, popularity
    from cadenza.plans.build import with_dense_ids

    inputs = {n: f"{tmp_path}/{n}" for n in ("tracks", "catalog_names", "interactions")}
    track = lambda c: F.format_string("t%09d", c)
    fx.tracks.withColumn("track_id", track("track_id")).write.parquet(inputs["tracks"])
    fx.catalog_names.withColumn("id", F.when(F.col("type") == "track", track("id")).otherwise(F.col("id").cast("string"))).write.parquet(inputs["catalog_names"])
    (fx.interactions.withColumn("track_id", track("track_id")).withColumn("user_id", F.col("user_id") + F.lit(10**15))
     .write.parquet(inputs["interactions"]))
    tracks, names, plays = with_dense_ids(spark, *(spark.read.parquet(p) for p in inputs.values()), f"{tmp_path}/out", inputs)
    assert plays.count() == fx.interactions.count() and dict(plays.dtypes)["user_id"] == "int"
    items = catalog.build_items(tracks, names)
    train, _ = clean.time_split(clean.prepare_events(clean.clean_interactions(plays, tracks), items), SPLIT_INSTANT)
    index = spark.read.parquet(f"{tmp_path}/out/ids/tracks")
    got = ids.decode(popularity.top_popular(train, items), index, "item_id", "track")
    want = fx.top_popular.withColumn("track", track("item_id"))
    cols = ["track", "plays", "users", "rank", "name", "genres"]
    assert [tuple(r) for r in got.select(cols).orderBy("rank").collect()] == [tuple(r) for r in want.select(cols).orderBy("rank").collect()]


def test_serve_answers_requests_from_built_artifacts(spark, fx):
    from pyspark.sql import functions as F

    from cadenza.operators import serving
    from cadenza.plans.serve import serve
    out = tempfile.mkdtemp(prefix="cadenza-serve-test-")
    small = {"als_params": {"rank": 8, "max_iter": 3}, "ranker_params": {"max_iter": 3, "depth": 3}}
    build_recommendations(spark, fx.tracks, fx.catalog_names, fx.interactions, f"{out}/built",
                          split=SPLIT_INSTANT, **small)
    recent = serving.last_events(fx.online_events)
    res = serve(spark, f"{out}/built", fx.requests, recent, f"{out}/answers")
    n_requests = fx.requests.count()
    counts = {r.source: r.requests for r in res["source_counts"].collect()}
    assert sum(counts.values()) == n_requests
    for name in ("offline", "online", "blended"):
        stats = res[name].groupBy("request_id").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("m")).collect()
        assert all(r.n == r.m <= 100 for r in stats), name
    assert res["offline"].select("user_id").distinct().count() > 0
    import pytest
    with pytest.raises(ValueError, match="unique"):
        serve(spark, f"{out}/built", fx.requests.union(fx.requests), recent, f"{out}/twice")


def test_jobs_set_their_session(spark, fx):
    from cadenza.session import job_session
    keys = ["spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        job = job_session("t", ["/root/testdata/sf0.001/lineitem.parquet", "/root/testdata/sf0.001/orders.parquet"],
                          shuffle_per_input_byte=1e5)
        assert job.conf.get("spark.sql.session.timeZone") == "UTC"
        assert int(job.conf.get("spark.sql.shuffle.partitions")) > 2 * spark.sparkContext.defaultParallelism
        assert "RocksDB" in job.conf.get("spark.sql.streaming.stateStore.providerClass")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
