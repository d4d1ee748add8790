"""Registered model queries (ALS, ranker, full evaluation) and their contracts.

Model outputs depend on floating-point training, so the lists themselves have no SQL oracle
(the driver checks them rows-only). What does not depend on the numbers does: the contract
queries state, as ``(check_name, value)`` rows, how many rows, users and ranks a result must
have and that nothing breaks its rules, and the metrics of the popular list by value.

Models and their lists are stages of one store per application and input folder, with a
manifest of the input files and parameters (:mod:`cadenza.sources.stages`): queries over the same
files share one fit, and files or parameters that changed lead to a new one.
"""

from __future__ import annotations

import hashlib

from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.functions.joins import growing
from cadenza.operators import cf, ids, metrics, popularity, ranker
from cadenza.operators.similar import similar_items
from cadenza.plans.oracles import BASE, POPULAR
from cadenza.plans.queries import rounded
from cadenza.session import checkpoint_dir
from cadenza.sources.fixtures import Fixture
from cadenza.sources.stages import StageStore
from cadenza.sources.tables import preview, read_metrics_csv, write_metrics_csv, write_stage


def model_store(fx: Fixture) -> StageStore:
    """The application's stages for one input folder, below the shared checkpoint folder."""
    key = hashlib.sha256(fx.sf_dir.encode()).hexdigest()[:12]
    return StageStore(fx.spark, f"{checkpoint_dir(fx.spark).rstrip('/')}/models-{fx.spark.sparkContext.applicationId}-{key}")


def _inputs(fx: Fixture) -> list[str]:
    return [f"{fx.sf_dir.rstrip('/')}/{name}.parquet" for name in ("lineitem", "orders", "part", "supplier", "customer")]


def _save(model, path: str) -> None:
    model.write().overwrite().save(path)


def _als(fx: Fixture, store: StageStore) -> ALSModel:
    store.stage("als", lambda: cf.fit_als(cf.interaction_weights(fx.train)), paths=_inputs(fx), write=_save,
                params={"rank": cf.ALS_RANK, "iterations": cf.ALS_ITERATIONS, "split": fx.split})
    return ALSModel.load(store.folder("als"))


def _personal(fx: Fixture, store: StageStore) -> DataFrame:
    model = _als(fx, store)
    return store.stage("personal", lambda: cf.personal_recs(model), after=["als"], params={"n": cf.PERSONAL_N})


def _similar(fx: Fixture, store: StageStore) -> DataFrame:
    model = _als(fx, store)
    return store.stage("similar", lambda: similar_items(cf.item_vectors(model, fx.train)), after=["als"])


def _final(fx: Fixture, store: StageStore) -> tuple[DataFrame, object, DataFrame]:
    """Final lists, the fitted ranker and its candidates."""
    personal = _personal(fx, store)
    cands = store.stage("candidates", lambda: ranker.build_candidates(personal, fx.train), after=["personal"])
    store.stage("ranker", lambda: ranker.fit_ranker(cands, ranker.sample_users(cands.select("user_id").distinct())),
                after=["candidates"], write=_save, params={"trees": ranker.GBT_ITERATIONS, "depth": ranker.GBT_DEPTH})
    model = ranker.load_ranker(store.folder("ranker"))
    return store.stage("final", lambda: ranker.rank_candidates(model, cands, fx.test_users), after=["ranker"]), model, cands


def q_als_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return rounded(_personal(fx, model_store(fx)))


def q_als_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return rounded(_similar(fx, model_store(fx)))


def q_ranker_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    return rounded(_final(fx, model_store(fx))[0])


def _sets(fx: Fixture, personal: DataFrame, final: DataFrame) -> dict[str, DataFrame]:
    return {"Top popular": popularity.popular_as_recs(fx.top_popular, fx.test_users),
            "Personal ALS": personal, "Final ranked": final}


def q_evaluate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixture(spark, sf_dir)
    store = model_store(fx)
    return rounded(metrics.evaluate_many(_sets(fx, _personal(fx, store), _final(fx, store)[0]), fx.train, fx.test, fx.items))


def checks(df: DataFrame, **values: Column) -> DataFrame:
    """One aggregate per name, as ``(check_name, value)`` rows."""
    wide = df.agg(*[F.coalesce(v, F.lit(0)).cast("double").alias(n) for n, v in values.items()])
    return wide.unpivot([], list(values), "check_name", "value")


def list_checks(lists: DataFrame, owner: str, item: str, known_items: DataFrame, prefix: str) -> DataFrame:
    """Rows, owners, ranks that are not 1, 2, ..., scores that rise, items unknown to train, repeated items.

    The window brings an owner's rows together, so what is distinct among them is counted there and an owner
    is one row after that; items meet the known ones as one row each."""
    order = Window.partitionBy(owner).orderBy("rank")
    rows = lists.withColumn("n", F.row_number().over(order)).withColumn("before", F.lag("score").over(order))
    wrong = lambda c: F.sum(F.when(c, 1).otherwise(0))
    owners = rows.groupBy(owner).agg(
        F.count(F.lit(1)).alias("rows"), wrong(F.col("rank") != F.col("n")).alias("bad_ranks"),
        wrong(F.col("score") > F.col("before")).alias("rising_scores"), F.count_distinct(item).alias("items"))
    distinct = F.when(F.col(owner).isNotNull(), F.col("items")).otherwise(0)
    known = known_items.select(F.col("item_id").alias(item)).distinct().withColumn("known", F.lit(True))
    uses = lists.groupBy(item).agg(F.count(F.lit(1)).alias("uses")).join(growing(known), item, "left")
    out = checks(owners, rows=F.sum("rows"), owners=F.count(owner), bad_ranks=F.sum("bad_ranks"), rising_scores=F.sum("rising_scores"),
                 repeated=F.sum(F.col("rows") - distinct)).unionByName(
        checks(uses, unknown_items=F.sum(F.when(F.col("known").isNull(), F.col("uses")).otherwise(0))))
    return out.select(F.concat(F.lit(prefix), "check_name").alias("check_name"), "value")


def rows_apart(one: DataFrame, other: DataFrame) -> DataFrame:
    """``n``: how often rows come in one of two frames of the same columns beyond the other. Each frame is read once."""
    both = one.withColumn("side", F.lit(1)).union(other.withColumn("side", F.lit(-1)))
    return both.groupBy(*one.columns).agg(F.abs(F.sum("side")).alias("n")).select("n")


def q_als_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal lists: 50 items for every trained user. Similar items: 10 others for every trained item."""
    fx = Fixture(spark, sf_dir)
    store = model_store(fx)
    similar = _similar(fx, store)
    selves = checks(similar, self_pairs=F.sum(F.when(F.col("item_id_1") == F.col("item_id_2"), 1).otherwise(0)))
    return (list_checks(_personal(fx, store), "user_id", "item_id", fx.train, "personal_")
            .unionByName(list_checks(similar, "item_id_1", "item_id_2", fx.train, "similar_")).unionByName(selves))


def q_ranker_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final lists, a reloaded ranker against the fitted one, and the evaluation read back from CSV:
    the popular list's metrics by value, the others within their bounds."""
    fx = Fixture(spark, sf_dir)
    store = model_store(fx)
    personal = _personal(fx, store)
    final, model, cands = _final(fx, store)
    path = fx.folder("ranker")
    ranker.save_ranker(model, path)
    again = ranker.rank_candidates(ranker.load_ranker(path), cands, fx.test_users)
    differ = checks(rows_apart(final, again), reloaded_differs=F.sum("n"))
    csv = fx.folder("metrics")
    write_metrics_csv(metrics.evaluate_many(_sets(fx, personal, final), fx.train, fx.test, fx.items), csv)
    back = read_metrics_csv(spark, csv)
    names = ["precision", "recall", "coverage", "novelty"]
    popular = back.where("model = 'Top popular'").unpivot([], names, "check_name", "value").select(
        F.concat(F.lit("popular_"), "check_name").alias("check_name"), F.round("value", 6).alias("value"))
    out_of_bounds = F.sum(F.when(F.least(*names).isNull() | (F.least(*names) < 0) | (F.greatest(*names) > 1), 1).otherwise(0))
    return (list_checks(final, "user_id", "item_id", fx.train, "final_").unionByName(differ).unionByName(popular)
            .unionByName(checks(back, models=F.count(F.lit(1)), out_of_bounds=out_of_bounds)))


def q_als_normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained users, and those whose factors miss the last half-step's least-squares solution by 0.001 or more."""
    fx = Fixture(spark, sf_dir)
    gaps = cf.normal_equations(_als(fx, model_store(fx)), cf.interaction_weights(fx.train))
    return checks(gaps, users=F.count(F.lit(1)), unsolved=F.sum(F.when(F.col("residual") < 1e-3, 0).otherwise(1)))


def q_als_topn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pruned search against the full product of the factor tables: users, ranks, and ranks whose
    score differs (lists may swap items whose scores differ by less than single precision shows)."""
    fx = Fixture(spark, sf_dir)
    model = _als(fx, model_store(fx))
    found = cf.personal_search(model).recs.select("user_id", "rank", "score")
    full = cf.full_recs(model).select("user_id", "rank", F.col("score").alias("expected"))
    both = found.join(full, ["user_id", "rank"], "full_outer")
    near = F.abs(F.col("score") - F.col("expected")) <= 1e-5 * F.greatest(F.lit(1.0), F.abs("expected"))
    return checks(both, users=F.count_distinct("user_id"), ranks=F.count(F.lit(1)),
                  different=F.sum(F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1)))


def q_als_any_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ALS on users named by strings and items by numbers beyond INT, through dense codes and back,
    against ALS on the same plays under their INT ids (through codes too): lists, and ranks that differ."""
    fx = Fixture(spark, sf_dir)
    train = fx.stored("train", fx.train)
    named = train.select(F.format_string("user %012d", "user_id").alias("user_id"),
                         (F.col("item_id") * F.lit(10**12)).alias("item_id"), "started_at")

    def lists(events, prefix):
        coded, users, items = ids.encoded_pairs(events)
        recs = fx.stored("coded-recs", cf.personal_recs(cf.fit_als(cf.interaction_weights(coded))))
        return ids.decode(ids.decode(recs, users, "user_id"), items, "item_id").select(
            "user_id", "rank", F.col("item_id").alias(f"{prefix}_item"), F.col("score").alias(f"{prefix}_score"))

    plain = lists(train, "plain")
    other = lists(named, "other").withColumn("user_id", F.regexp_extract("user_id", r"(\d+)$", 1).cast("int"))
    both = plain.join(other, ["user_id", "rank"], "full_outer")
    same = (F.abs(F.col("plain_score") - F.col("other_score")) < 1e-3) & F.col("other_item").isNotNull()
    return checks(both, users=F.count_distinct("user_id"), ranks=F.count(F.lit(1)),
                  unknown_items=F.sum(F.when(F.col("other_item") % F.lit(10**12) == 0, 0).otherwise(1)),
                  different=F.sum(F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)))


def q_ranker_by_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate scored by SQL functions from the saved trees against the model's probability,
    and whether the log loss of the training rows fell."""
    fx = Fixture(spark, sf_dir)
    store = model_store(fx)
    _, model, cands = _final(fx, store)
    by_trees = ranker.score_by_trees(cands, ranker.tree_table(store.folder("ranker"), spark))
    feats = cands.select("user_id", "item_id", *[F.col(c).cast("double").alias(c) for c in ranker.FEATURES])
    by_model = model.transform(feats).select("user_id", "item_id", vector_to_array("probability")[1].alias("p"))
    gap = F.abs(F.col("score") - F.col("p"))
    loss = ranker.losses(model, cands, ranker.sample_users(cands.select("user_id").distinct()))
    return checks(by_trees.join(by_model, ["user_id", "item_id"], "full_outer"), candidates=F.count(F.lit(1)),
                  different=F.sum(F.when(F.coalesce(gap < 1e-9, F.lit(False)), 0).otherwise(1))).unionByName(
        spark.createDataFrame([("loss_fell", float(loss[-1] < loss[0]))], "check_name string, value double"))


def q_stage_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four stages, each behind another, run four times: anew, unchanged, with another parameter of the third,
    with other files behind the first. One row per run and stage, with what was done and how many rows it holds."""
    fx = Fixture(spark, sf_dir)
    base, source = fx.folder("manifest"), fx.folder("source")
    write_stage(fx.interactions, source)

    def run(least: int) -> list:
        store = StageStore(spark, base)
        plays = store.stage("plays", lambda: spark.read.parquet(source), paths=[source])
        users = store.stage("users", lambda: plays.groupBy("user_id").count(), after=["plays"])
        busy = store.stage("busy", lambda: users.where(F.col("count") >= least), after=["users"], params={"least": least})
        tracks = store.stage("tracks", lambda: plays.select("track_id").distinct(), after=["plays"])
        rows = {"plays": plays.count(), "users": users.count(), "busy": busy.count(), "tracks": tracks.count()}
        return [(name, did, float(rows[name])) for name, did in store.actions]

    out = [(1, *r) for r in run(10)] + [(2, *r) for r in run(10)] + [(3, *r) for r in run(20)]
    write_stage(fx.interactions.where(F.col("track_seq") > 1), source)
    out += [(4, *r) for r in run(20)]
    return spark.createDataFrame(out, "run int, stage string, action string, value double")


def q_final_rank_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final order on a score without training that ties a lot: plays of the item, in tens."""
    fx = Fixture(spark, sf_dir)
    cands = ranker.build_candidates(fx.nation_recs, fx.train)
    return rounded(ranker.final_ranks(cands.withColumn("score", F.floor(F.col("item_plays") / 10).cast("double"))))


def q_sampled_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the users with candidates: how many, how many different, how many of them known."""
    fx = Fixture(spark, sf_dir)
    users = fx.nation_recs.select("user_id").distinct()
    sample = fx.stored("sample", ranker.sample_users(users, users.count() // 3))
    return checks(sample.join(users.withColumn("known", F.lit(1)), "user_id", "left"), users=F.count(F.lit(1)),
                  distinct_users=F.count_distinct("user_id"), known=F.sum("known"))


def q_stage_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored stage: kept as it is by mode ``ignore``, replaced by ``overwrite``, previewed."""
    fx = Fixture(spark, sf_dir)
    path = fx.folder("reuse")
    first = write_stage(fx.events, path).count()
    kept = write_stage(fx.test, path, mode="ignore").count()
    shown = preview(spark.read.parquet(path), 5).count()
    replaced = write_stage(fx.test, path).count()
    return spark.createDataFrame([("first", float(first)), ("kept", float(kept)), ("preview", float(shown)),
                                  ("replaced", float(replaced))], "check_name string, value double")


MODEL_QUERIES = {
    "als_personal": q_als_personal,
    "als_similar": q_als_similar,
    "ranker_recommendations": q_ranker_recommendations,
    "evaluate_all": q_evaluate_all,
    "als_contract": q_als_contract,
    "ranker_contract": q_ranker_contract,
    "als_normal_equations": q_als_normal_equations,
    "als_topn_exact": q_als_topn_exact,
    "als_any_ids": q_als_any_ids,
    "ranker_by_trees": q_ranker_by_trees,
    "stage_manifest": q_stage_manifest,
    "final_rank_ties": q_final_rank_ties,
    "sampled_users": q_sampled_users,
    "stage_reuse": q_stage_reuse,
}


def _rows(*pairs: tuple[str, str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{n}' AS check_name, CAST(({e}) AS DOUBLE) AS value" for n, e in pairs)


def _list_rows(prefix: str, owner: str, n: str) -> list[tuple[str, str]]:
    return [(f"{prefix}rows", f"SELECT count(DISTINCT {owner}) * ({n}) FROM train"),
            (f"{prefix}owners", f"SELECT count(DISTINCT {owner}) FROM train"),
            *((f"{prefix}{c}", "0") for c in ("bad_ranks", "rising_scores", "unknown_items", "repeated"))]


N_ITEMS = "(SELECT count(DISTINCT item_id) FROM train)"
SERVED = "SELECT DISTINCT user_id FROM test WHERE user_id IN (SELECT user_id FROM train)"
MODEL_ORACLES = {
    "als_contract": "WITH " + BASE + _rows(*_list_rows("personal_", "user_id", f"least(50, {N_ITEMS})"),
                                           *_list_rows("similar_", "item_id", f"least(10, {N_ITEMS} - 1)"), ("self_pairs", "0")),
    "ranker_contract": "WITH " + BASE + "," + POPULAR + _rows(
        ("final_rows", f"SELECT count(*) * least(50, {N_ITEMS}) FROM ({SERVED})"), ("final_owners", f"SELECT count(*) FROM ({SERVED})"),
        *((f"final_{c}", "0") for c in ("bad_ranks", "rising_scores", "unknown_items", "repeated")), ("reloaded_differs", "0"),
        ("popular_precision", "SELECT round(precision, 6) FROM p_pr_summary"), ("popular_recall", "SELECT round(recall, 6) FROM p_pr_summary"),
        ("popular_coverage", "SELECT round(coverage, 6) FROM p_coverage"), ("popular_novelty", "SELECT round(novelty, 6) FROM p_novelty"),
        ("models", "3"), ("out_of_bounds", "0")),
    "als_normal_equations": "WITH " + BASE + _rows(("users", "SELECT count(DISTINCT user_id) FROM train"), ("unsolved", "0")),
    "als_topn_exact": "WITH " + BASE + _rows(
        ("users", "SELECT count(DISTINCT user_id) FROM train"),
        ("ranks", f"SELECT count(DISTINCT user_id) * least(50, {N_ITEMS}) FROM train"), ("different", "0")),
    "als_any_ids": "WITH " + BASE + _rows(
        ("users", "SELECT count(DISTINCT user_id) FROM train"),
        ("ranks", f"SELECT count(DISTINCT user_id) * least(50, {N_ITEMS}) FROM train"), ("unknown_items", "0"), ("different", "0")),
    "ranker_by_trees": "WITH " + BASE + _rows(
        ("candidates", f"SELECT count(DISTINCT user_id) * least(50, {N_ITEMS}) FROM train"), ("different", "0"), ("loss_fell", "1")),
    "stage_manifest": "WITH " + BASE + """,
sampled AS (SELECT 1 AS sample, * FROM interactions UNION ALL SELECT 2, * FROM interactions WHERE track_seq > 1),
users AS (SELECT sample, user_id, count(*) AS n FROM sampled GROUP BY ALL),
sizes AS (
  SELECT sample, 'plays' AS stage, 0 AS min_n, count(*) AS value FROM sampled GROUP BY ALL
  UNION ALL SELECT sample, 'users', 0, count(*) FROM users GROUP BY ALL
  UNION ALL SELECT sample, 'busy', min_n, count(*) FILTER (WHERE n >= min_n) FROM users, (VALUES (10), (20)) v(min_n) GROUP BY ALL
  UNION ALL SELECT sample, 'tracks', 0, count(DISTINCT track_id) FROM sampled GROUP BY ALL)
SELECT CAST(run AS INTEGER) AS run, d.stage, action, CAST(value AS DOUBLE) AS value
FROM (VALUES (1, 1, 10), (2, 1, 10), (3, 1, 20), (4, 2, 20)) r(run, sample, at_least)
JOIN sizes s USING (sample)
JOIN (VALUES (1, 'plays', 'built'), (1, 'users', 'built'), (1, 'busy', 'built'), (1, 'tracks', 'built'),
             (2, 'plays', 'reused'), (2, 'users', 'reused'), (2, 'busy', 'reused'), (2, 'tracks', 'reused'),
             (3, 'plays', 'reused'), (3, 'users', 'reused'), (3, 'busy', 'built'), (3, 'tracks', 'reused'),
             (4, 'plays', 'built'), (4, 'users', 'built'), (4, 'busy', 'built'), (4, 'tracks', 'built')) d(run, stage, action)
USING (run, stage) WHERE s.min_n IN (0, at_least)""",
    "final_rank_ties": "WITH " + BASE + """
SELECT user_id, item_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT r.user_id, r.item_id, CAST(p.n // 10 AS DOUBLE) AS score,
         row_number() OVER (PARTITION BY r.user_id ORDER BY p.n // 10 DESC, r.score DESC, r.item_id) AS rank
  FROM nation_recs r JOIN (SELECT item_id, count(*) AS n FROM train GROUP BY 1) p ON p.item_id = r.item_id)
WHERE rank <= 50""",
    "sampled_users": "WITH " + BASE + _rows(*((c, "SELECT count(DISTINCT user_id) // 3 FROM nation_recs")
                                              for c in ("users", "distinct_users", "known"))),
    "stage_reuse": "WITH " + BASE + _rows(("first", "SELECT count(*) FROM play_events"), ("kept", "SELECT count(*) FROM play_events"),
                                          ("preview", "SELECT least(5, count(*)) FROM play_events"), ("replaced", "SELECT count(*) FROM test")),
}
