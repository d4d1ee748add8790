"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Each builds its inputs with :class:`cadenza.sources.fixtures.Fixture` from the driver's
Parquet tables and runs the library's operator over the whole tables. List answers are
returned as rows ``(request_id, user_id, pos, item_id)`` so that their order is compared; doubles are
rounded to 6 decimals, as in the SQL oracles of :mod:`cadenza.plans.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.operators import catalog, clean, metrics, popularity, profile, serving
from cadenza.sources.fixtures import Fixture

QueryFn = Callable[[SparkSession, str], DataFrame]
ROUND = 6


def rounded(df: DataFrame, digits: int = ROUND) -> DataFrame:
    """Round every double column (the oracle side does the same)."""
    return df.select([F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                      else F.col(f.name) for f in df.schema.fields])


def q_clean_interactions(spark, sf_dir):
    return Fixture(spark, sf_dir).clean


def q_null_counts(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return profile.null_counts({"tracks": fx.tracks, "catalog_names": fx.catalog_names,
                                "interactions": fx.interactions})


def q_row_counts(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return profile.row_counts({"tracks": fx.tracks, "catalog_names": fx.catalog_names,
                               "interactions": fx.interactions, "interactions_clean": fx.clean,
                               "items": fx.items, "events": fx.events, "train": fx.train, "test": fx.test})


def q_plays_per_track(spark, sf_dir):
    return profile.plays_per_track(Fixture(spark, sf_dir).clean)


def q_catalog_type_counts(spark, sf_dir):
    return profile.type_counts(Fixture(spark, sf_dir).catalog_names)


def q_plays_per_user(spark, sf_dir):
    return profile.plays_per_user(Fixture(spark, sf_dir).clean)


def q_plays_summary(spark, sf_dir):
    return rounded(profile.describe(profile.plays_per_user(Fixture(spark, sf_dir).clean), "tracks_played"))


def q_plays_histogram(spark, sf_dir):
    return rounded(profile.histogram(profile.plays_per_user(Fixture(spark, sf_dir).clean), "tracks_played"))


def q_top_tracks(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return profile.top_tracks(fx.clean, fx.catalog_names)


def q_top_genres(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return profile.top_genres(fx.tracks, fx.clean, fx.catalog_names)


def q_unplayed_tracks(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return rounded(profile.unplayed_tracks(fx.tracks, fx.clean))


def q_build_items(spark, sf_dir):
    return catalog.flatten_items(Fixture(spark, sf_dir).items)


def q_events(spark, sf_dir):
    return Fixture(spark, sf_dir).events


def q_time_split_ranges(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return clean.split_ranges(fx.train, fx.test)


def q_top_popular(spark, sf_dir):
    top = Fixture(spark, sf_dir).top_popular
    lists = [F.array_join(c, "|").alias(c) for c in ("genres", "artists", "albums")]
    return rounded(top.select("item_id", "plays", "users", "rank", "name", *lists, "score"))


def q_popular_recs_for_test_users(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return rounded(popularity.popular_as_recs(fx.top_popular, fx.test_users))


def q_interaction_weights(spark, sf_dir):
    from cadenza.operators.cf import interaction_weights
    return interaction_weights(Fixture(spark, sf_dir).train)


def q_ranking_candidates(spark, sf_dir):
    from cadenza.operators.ranker import build_candidates
    fx = Fixture(spark, sf_dir)
    return rounded(build_candidates(fx.nation_recs, fx.train))


def q_sampled_users_count(spark, sf_dir):
    from cadenza.operators.ranker import build_candidates, sample_users
    fx = Fixture(spark, sf_dir)
    users = build_candidates(fx.nation_recs, fx.train).select("user_id").distinct()
    return sample_users(users).agg(F.count(F.lit(1)).alias("users"))


def q_rank_topk(spark, sf_dir):
    return rounded(metrics.top_k(Fixture(spark, sf_dir).nation_recs, metrics.EVAL_K))


def q_binary_relevance(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return rounded(metrics.binary_relevance(fx.train, fx.test, fx.nation_recs))


def q_precision_recall(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return rounded(metrics.precision_recall(metrics.binary_relevance(fx.train, fx.test, fx.nation_recs)))


def q_novelty(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return rounded(metrics.novelty(fx.nation_recs, fx.train))


def q_coverage(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return rounded(metrics.coverage(fx.nation_recs, fx.items))


def q_evaluate_popular(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    recs = popularity.popular_as_recs(fx.top_popular, fx.test_users)
    return rounded(metrics.evaluate("Top popular", recs, fx.train, fx.test, fx.items))


def q_last_events(spark, sf_dir):
    return serving.last_events(Fixture(spark, sf_dir).online_events)


def q_seen_items(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return serving.seen_items(fx.events, fx.requests)


def q_similar_topk_embeddings(spark, sf_dir):
    return rounded(Fixture(spark, sf_dir).similar)


def q_similar_lsh_recall(spark, sf_dir):
    """Approximate against exact neighbours of all vectors: 0.9 of the pairs found or not, and
    how many items have fewer neighbours than the exact search gives them."""
    from cadenza.operators.similar import similar_items_lsh
    fx = Fixture(spark, sf_dir)
    exact = fx.stored("exact", fx.similar)
    found = fx.stored("lsh", similar_items_lsh(fx.embeddings))
    hits = exact.join(found.select("item_id_1", "item_id_2", F.lit(1).alias("hit")), ["item_id_1", "item_id_2"], "left")
    got = found.groupBy("item_id_1").agg(F.count(F.lit(1)).alias("got"))
    short = (exact.groupBy("item_id_1").agg(F.count(F.lit(1)).alias("n")).join(got, "item_id_1", "left")
             .where(F.coalesce("got", F.lit(0)) < F.col("n")))
    rows = [hits.agg(F.avg(F.coalesce("hit", F.lit(0))).alias("r")).select(
                F.lit("recall_at_least_0.9").alias("check_name"), (F.col("r") >= 0.9).cast("double").alias("value")),
            short.agg(F.lit("short_items").alias("check_name"), F.count(F.lit(1)).cast("double").alias("value"))]
    return rows[0].unionByName(rows[1])


def q_offline_recs(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return serving.offline_recs(fx.requests, fx.nation_recs, fx.top_popular, fx.events)


def q_online_recs(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    recent = serving.last_events(fx.online_events)
    return serving.online_recs(fx.requests, recent, fx.similar, fx.events)


def q_blended_recs(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    recent = serving.last_events(fx.online_events)
    return serving.blended_recs(fx.requests, fx.nation_recs, fx.top_popular, recent, fx.similar, fx.events)


def q_served_source_counts(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return serving.served_source_counts(fx.requests, fx.nation_recs, fx.top_popular)


QUERIES: dict[str, QueryFn] = {
    "clean_interactions": q_clean_interactions,
    "null_counts": q_null_counts,
    "row_counts": q_row_counts,
    "catalog_type_counts": q_catalog_type_counts,
    "plays_per_track": q_plays_per_track,
    "plays_per_user": q_plays_per_user,
    "plays_summary": q_plays_summary,
    "plays_histogram": q_plays_histogram,
    "top_tracks": q_top_tracks,
    "top_genres": q_top_genres,
    "unplayed_tracks": q_unplayed_tracks,
    "build_items": q_build_items,
    "events": q_events,
    "time_split_ranges": q_time_split_ranges,
    "top_popular": q_top_popular,
    "popular_recs_for_test_users": q_popular_recs_for_test_users,
    "interaction_weights": q_interaction_weights,
    "ranking_candidates": q_ranking_candidates,
    "sampled_users_count": q_sampled_users_count,
    "rank_topk": q_rank_topk,
    "binary_relevance": q_binary_relevance,
    "precision_recall": q_precision_recall,
    "novelty": q_novelty,
    "coverage": q_coverage,
    "evaluate_popular": q_evaluate_popular,
    "last_events": q_last_events,
    "seen_items": q_seen_items,
    "similar_topk_embeddings": q_similar_topk_embeddings,
    "similar_lsh_recall": q_similar_lsh_recall,
    "offline_recs": q_offline_recs,
    "online_recs": q_online_recs,
    "blended_recs": q_blended_recs,
    "served_source_counts": q_served_source_counts,
}
