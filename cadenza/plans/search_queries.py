"""Registered queries of searches with an index, dense ids and bucketed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators import ids, ivf, serving, topn
from cadenza.plans.oracles import BASE, ORACLES
from cadenza.plans.queries import rounded
from cadenza.sources.bucketed import history_buckets, save_bucketed
from cadenza.sources.fixtures import Fixture
from cadenza.sources.footers import footer_summary
from cadenza.sources.tables import write_stage

LARGE_CATALOGUE = 1_000_000  # the size whose number of cells the index query is run with
POPULARITIES = 7


def q_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten items of largest inner product for every vector, exactly; items are the vectors shortened
    by popularity (1 / (1 + id % 7)), so that their norms differ as trained factors' do."""
    vectors = Fixture(spark, sf_dir).embeddings
    users = vectors.select(F.col("item_id").alias("user_id"), F.col("vector").cast("array<double>").alias("vector"))
    items = vectors.select("item_id", F.transform(F.col("vector").cast("array<double>"), lambda x: x / (1 + F.col("item_id") % POPULARITIES)).alias("vector"))
    return rounded(topn.top_inner_products(users, items, 10, chunk=128, block=512).recs)


def q_similar_ivf_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index with the cells of a catalogue of a million (at most one for two vectors): whether
    the ids divisible by 50 find 0.9 of their true neighbours among all rows, how many rows are
    indexed, and how many items got fewer neighbours than there are others to find."""
    vectors = Fixture(spark, sf_dir).embeddings
    n = vectors.count()
    found, measured = ivf.similar_items_ivf(vectors, cells=min(ivf.default_cells(LARGE_CATALOGUE), n // 2))
    found = ivf.stored(found, "found")
    truth = measured["truth"].select("item_id_1", "item_id_2", F.lit(1).alias("true"))
    hit = truth.join(found.select("item_id_1", "item_id_2", F.lit(1).alias("hit")), ["item_id_1", "item_id_2"], "left")
    indexed = measured["index"].select((F.length("ids") / 4).alias("n"))
    short = found.groupBy("item_id_1").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < min(10, n - 1))
    value = lambda df, name, col: df.agg(F.coalesce(col, F.lit(0)).cast("double").alias("value")).select(F.lit(name).alias("check_name"), "value")
    return (value(hit, "recall_at_least_0.9", (F.avg(F.coalesce("hit", F.lit(0))) >= 0.9).cast("int"))
            .unionByName(value(hit, "true_pairs", F.count(F.lit(1))))
            .unionByName(value(indexed, "indexed", F.sum("n")))
            .unionByName(value(short, "short_items", F.count(F.lit(1)))))


def q_dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of users named by strings and of items numbered beyond INT, and every play under its codes."""
    train = Fixture(spark, sf_dir).train.select(F.concat(F.lit("u-"), F.col("user_id")).alias("user_id"),
                                                (F.col("item_id") * F.lit(10**12)).alias("item_id"))
    coded, users, items = ids.encoded_pairs(train)
    plays = coded.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("plays"))
    back = ids.decode(ids.decode(plays, users, "user_id", "user"), items, "item_id", "item")
    return back.select(F.col("user_id").alias("user_code"), "user", F.col("item_id").alias("item_code"), "item", "plays")


def q_offline_recs_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offline lists against a history in a bucketed table, which the anti join reads without moving it."""
    fx = Fixture(spark, sf_dir)
    path = fx.folder("history")
    history = save_bucketed(fx.events, "history_" + path.rsplit("-", 1)[1], path, history_buckets(fx.events.count()))
    return serving.offline_recs(fx.requests, fx.nation_recs, fx.top_popular, history, whole_history=True)


def q_offline_recs_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offline lists with the requesting users' history as stored bitmaps, a bit per seen item."""
    fx = Fixture(spark, sf_dir)
    bits = fx.stored("seen-bits", serving.seen_bitmaps(fx.events, fx.requests))
    return serving.offline_recs(fx.requests, fx.nation_recs, fx.top_popular, fx.events, bitmaps=bits)


def q_footer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, ids and days (as text) of the stored events, from the footers of their files."""
    fx = Fixture(spark, sf_dir)
    path = fx.folder("events-by-day")
    write_stage(fx.events.select("user_id", "item_id", F.to_date("started_at").alias("day")), path)
    found = footer_summary(spark, path, ["user_id", "item_id", "day"])
    return found.withColumns({c: F.col(c).cast("string") for c in ("day_min", "day_max")})


SEARCH_QUERIES = {
    "top_inner_products": q_top_inner_products,
    "similar_ivf_recall": q_similar_ivf_recall,
    "dense_ids": q_dense_ids,
    "offline_recs_bucketed": q_offline_recs_bucketed,
    "offline_recs_bitmaps": q_offline_recs_bitmaps,
    "footer_summary": q_footer_summary,
}

SEARCH_ORACLES = {
    "top_inner_products": """
WITH v AS (SELECT CAST(vec_id AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
scored AS (
  SELECT u.id AS user_id, i.id AS item_id, list_inner_product(u.x, i.x) / (1 + i.id % 7) AS score FROM v u, v i)
SELECT user_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM scored)
WHERE rank <= 10""",
    "similar_ivf_recall": """
SELECT 'recall_at_least_0.9' AS check_name, CAST(1 AS DOUBLE) AS value
UNION ALL SELECT 'true_pairs', CAST(count(*) * (SELECT least(10, count(*) - 1) FROM embeddings) AS DOUBLE) FROM embeddings WHERE vec_id % 50 = 0
UNION ALL SELECT 'indexed', CAST(count(*) AS DOUBLE) FROM embeddings
UNION ALL SELECT 'short_items', CAST(0 AS DOUBLE)""",
    "dense_ids": "WITH " + BASE + """,
own AS (SELECT 'u-' || user_id AS u, CAST(item_id AS BIGINT) * 1000000000000 AS i FROM train),
user_codes AS (SELECT u, row_number() OVER (ORDER BY u) - 1 AS code FROM (SELECT DISTINCT u FROM own)),
item_codes AS (SELECT i, row_number() OVER (ORDER BY i) - 1 AS code FROM (SELECT DISTINCT i FROM own))
SELECT CAST(user_codes.code AS INTEGER) AS user_code, own.u AS "user", CAST(item_codes.code AS INTEGER) AS item_code, own.i AS item, count(*) AS plays
FROM own JOIN user_codes ON user_codes.u = own.u JOIN item_codes ON item_codes.i = own.i GROUP BY ALL""",
    "offline_recs_bucketed": ORACLES["offline_recs"],
    "offline_recs_bitmaps": ORACLES["offline_recs"],
    "footer_summary": "WITH " + BASE + """
SELECT count(*) AS rows, """ + ", ".join(f"count({c}) AS {c}_nonnull, min({c}) AS {c}_min, max({c}) AS {c}_max" for c in ("user_id", "item_id")) + """,
  count(day) AS day_nonnull, CAST(min(day) AS VARCHAR) AS day_min, CAST(max(day) AS VARCHAR) AS day_max
FROM (SELECT user_id, item_id, CAST(started_at AS DATE) AS day FROM play_events)""",
}
