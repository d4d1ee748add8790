"""Similar items, sampling, ALS and ranker: brute force on small fixtures, bounds, determinism."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import cf, ranker
from cadenza.operators.similar import similar_items, similar_items_lsh


def _brute_force(vectors: dict[int, np.ndarray], k: int) -> dict[int, list[int]]:
    ids = sorted(vectors)
    mat = np.stack([vectors[i] / np.linalg.norm(vectors[i]) for i in ids])
    sims = mat @ mat.T
    out = {}
    for a, i in enumerate(ids):
        cands = sorted(((-sims[a, b], j) for b, j in enumerate(ids) if j != i))
        out[i] = [j for _, j in cands[:k]]
    return out


@pytest.mark.parametrize("block_size", [64, 2048])
def test_similar_items_blocked_equals_brute_force(spark, fx, block_size):
    emb = fx.embeddings.toPandas()
    vectors = {int(r.item_id): np.asarray(r.vector, dtype=np.float64) for r in emb.itertuples()}
    expected = _brute_force(vectors, 10)
    got_df = similar_items(fx.embeddings, k=10, block_size=block_size)
    got: dict[int, list[int]] = {}
    for r in got_df.orderBy("item_id_1", "rank").collect():
        got.setdefault(r.item_id_1, []).append(r.item_id_2)
    assert got == expected
    assert got_df.filter(F.col("item_id_1") == F.col("item_id_2")).count() == 0


def test_similar_items_skips_zero_vectors_and_keeps_ties(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [3.0, 0.0]), (4, [0.0, 0.0]), (5, [0.0, 1.0])],
                               "item_id int, vector array<double>")
    got = {(r.item_id_1, r.rank): r.item_id_2 for r in similar_items(df, k=1, block_size=1).collect()}
    assert got[(1, 1)] == 2 and got[(3, 1)] == 1  # exact ties → lower id
    assert all(a != 4 and b != 4 for (a, _), b in got.items())


def test_similar_items_in_many_tiles(spark, monkeypatch):
    """Several groups and lanes, repeated vectors, and blocks that stay empty."""
    from cadenza.operators import tiles
    monkeypatch.setattr(tiles, "TILE_ROWS", 20)
    monkeypatch.setattr(tiles, "LANE_ROWS", 30)
    monkeypatch.setattr(tiles, "PRODUCT", 200)
    rng = np.random.default_rng(5)
    rows = rng.integers(-3, 4, (150, 4)).astype(float)
    rows[rows.any(axis=1) == 0] = 1.0
    rows[40:70] = rows[3]  # 31 alike
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "item_id int, vector array<double>")
    got = similar_items(df, k=6, n_blocks=40)
    unit = rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    scores = {(r.item_id_1, r["rank"]): (r.item_id_2, r.score) for r in got.collect()}
    assert len(scores) == 150 * 6
    for i in range(150):
        own = unit @ unit[i]
        own[i] = -np.inf
        assert np.allclose([scores[i, n][1] for n in range(1, 7)], np.sort(own)[::-1][:6], atol=1e-12)
    assert [scores[45, n][0] for n in range(1, 7)] == [3, 40, 41, 42, 43, 44]


def test_copies_of_blocks_follow_the_cores_and_a_tile_is_bounded():
    """Six times the items: copies grow by less than half, where every block met every other before."""
    from cadenza.operators import tiles
    copies = []
    for n in (100_000, 600_000):
        groups, lanes = tiles.shape(n, n // 1024, n, n // 1024, 12)
        assert n / groups <= tiles.TILE_ROWS and n / lanes <= tiles.LANE_ROWS and groups * lanes >= 24
        copies.append(groups + lanes)
    assert copies[1] <= 1.5 * copies[0] <= 24


def test_sample_users_exact_size_and_deterministic(spark):
    users = spark.range(5000).select(F.col("id").cast("int").alias("user_id"))
    a = ranker.sample_users(users, n=1234, seed=42)
    b = ranker.sample_users(users, n=1234, seed=42)
    ids_a = sorted(r.user_id for r in a.collect())
    assert len(ids_a) == 1234 == len(set(ids_a))
    assert ids_a == sorted(r.user_id for r in b.collect())
    assert ranker.sample_users(users, n=10_000).count() == 5000


def test_als_personal_bounds_and_determinism(spark, fx):
    weights = cf.interaction_weights(fx.train)
    model = cf.fit_als(weights, rank=8, max_iter=3)
    recs = cf.personal_recs(model, n=5).cache()
    stats = recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("m")).collect()
    assert all(r.n == r.m <= 5 for r in stats)
    train_users = weights.select("user_id").distinct().count()
    assert len(stats) == train_users
    again = cf.personal_recs(cf.fit_als(weights, rank=8, max_iter=3), n=5)
    assert again.select("user_id", "item_id").exceptAll(recs.select("user_id", "item_id")).count() == 0


def test_ranker_ties_prefer_higher_als_score(spark):
    # trained on constant features, the trees cannot split: every input gets one probability
    schema = ("user_id int, item_id int, als_score double, target int, "
              "tracks_played_by_user bigint, item_plays bigint")
    flat = spark.createDataFrame([(u, i, 1.0, i % 2, 5, 5) for u in range(1, 4) for i in range(1, 7)], schema)
    model = ranker.fit_ranker(flat, flat.select("user_id").distinct(), max_iter=2, depth=2)
    users = flat.select("user_id").distinct()
    varied = flat.withColumn("als_score", F.col("item_id").cast("double"))
    ranked = ranker.rank_candidates(model, varied, users, n=6)
    assert len({r.score for r in ranked.collect()}) == 1
    for u in range(1, 4):
        order = [r.item_id for r in ranked.filter(F.col("user_id") == u).orderBy("rank").collect()]
        assert order == [6, 5, 4, 3, 2, 1]  # equal score → higher ALS score first
    same = ranker.rank_candidates(model, flat, users, n=2)
    assert sorted(r.item_id for r in same.collect()) == [1, 1, 1, 2, 2, 2]  # then lower item id


def _leaves(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_rows_apart_counts_rows_and_reads_each_side_once(spark, tmp_path):
    from cadenza.plans.model_queries import rows_apart
    schema = "user_id int, score double"
    one = spark.createDataFrame([(1, 1.0), (1, 1.0), (1, None), (None, 2.0), (3, 3.0)], schema)
    other = spark.createDataFrame([(1, 1.0), (1, None), (None, 2.0), (3, 3.5), (4, None), (4, None)], schema)
    frames = []
    for name, df in (("one", one), ("other", other)):
        df.write.parquet(f"{tmp_path}/{name}")
        frames.append(spark.read.parquet(f"{tmp_path}/{name}"))
    one, other = frames
    apart = one.exceptAll(other).unionByName(other.exceptAll(one))
    assert rows_apart(one, other).agg(F.sum("n")).first()[0] == apart.count() == 5
    assert rows_apart(one, one).agg(F.sum("n")).first()[0] == 0
    assert _leaves(rows_apart(one, other)) == 2 < _leaves(apart)


def test_list_checks_by_value_without_copies_of_the_rows(spark):
    """Null owners and items, repeats, gaps in the ranks, rising scores: what an owner repeats is counted
    among its own rows, not by an expanded copy of all rows for every distinct count."""
    from cadenza.plans.model_queries import list_checks
    schema = "user_id int, item_id int, score double, rank int"
    df = spark.createDataFrame([(1, 10, 3.0, 1), (1, 11, 4.0, 2), (1, 11, 1.0, 4), (2, None, 1.0, 1), (2, 12, 1.0, 2),
                                (None, 10, 1.0, 1), (None, 10, 1.0, 2), (3, 99, None, 1), (3, 99, 5.0, 2)], schema)
    known = spark.createDataFrame([(10,), (11,), (11,), (12,)], "item_id int")
    out = list_checks(df, "user_id", "item_id", known, "x_")
    assert {r.check_name: r.value for r in out.collect()} == {
        "x_rows": 9.0, "x_owners": 3.0, "x_bad_ranks": 1.0, "x_rising_scores": 1.0, "x_unknown_items": 3.0, "x_repeated": 5.0}
    assert "gid#" not in out._jdf.queryExecution().optimizedPlan().toString()  # Spark's number of such a copy
    empty = list_checks(df.where("false"), "user_id", "item_id", known, "x_")
    assert {r.value for r in empty.collect()} == {0.0} and empty.count() == 6


def test_repeated_vectors_give_k_rows_each(spark):
    n, k = 5000, 3
    same = spark.range(n).selectExpr("int(id) item_id", "array(float(1), float(2)) vector")
    for got in (similar_items(same, k=k, block_size=2048), similar_items_lsh(same, k=k, most=1000, tables=2)):
        rows = got.groupBy("item_id_1").agg(F.count(F.lit(1)).alias("n")).collect()
        assert len(rows) == n and all(r.n == k for r in rows)
    first = similar_items(same, k=k, block_size=2048).where("item_id_1 = 4000").orderBy("rank").collect()
    assert [r.item_id_2 for r in first] == [0, 1, 2]  # of equal scores the lower ids


def test_lsh_recall_zero_vectors_and_double_elements(spark, fx):
    exact = {(r.item_id_1, r.item_id_2) for r in similar_items(fx.embeddings, k=5).collect()}
    approx = similar_items_lsh(fx.embeddings, k=5, bucket=128, tables=24)
    got = {(r.item_id_1, r.item_id_2) for r in approx.collect()}
    assert len(got & exact) / len(exact) >= 0.9 and all(a != b for a, b in got)
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [2.0, 0.1])], "item_id int, vector array<double>")
    assert {(r.item_id_1, r.item_id_2) for r in similar_items_lsh(df, k=2).collect()} <= {(1, 3), (3, 1)}
    assert similar_items_lsh(df.where("false"), k=2).count() == 0 == similar_items(df.where("false"), k=2).count()


def test_lsh_compares_all_of_a_crowded_bucket(spark):
    """A dense third of the catalogue in one bucket per table, far above ``most``: nothing is lost."""
    rng = np.random.default_rng(7)
    dense = rng.normal(size=16) + 0.01 * rng.normal(size=(400, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([dense, rng.normal(size=(800, 16))]))]
    df = spark.createDataFrame(rows, "item_id int, vector array<double>")
    pairs = lambda found: {(r.item_id_1, r.item_id_2) for r in found.where("item_id_1 < 400").collect()}
    exact = pairs(similar_items(df, k=5))
    for tables in (2, 12):  # 12 tables hold more pairs than the catalogue: the exact search
        assert len(pairs(similar_items_lsh(df, k=5, tables=tables, bucket=150, most=100)) & exact) >= 0.9 * len(exact)


@pytest.mark.parametrize("bits", [8, 11])
def test_lsh_finds_pairs_of_the_documented_cosine(spark, bits):
    """Recall for ids divisible by 50 with the bits of 100,000 and 1 M items, on pairs of cosine 0.8."""
    rng = np.random.default_rng(11)
    a, b = rng.normal(size=(2, 1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    near = 0.8 * a + 0.6 * b / np.linalg.norm(b, axis=1, keepdims=True)
    v = np.stack([a, near], axis=1).reshape(-1, 64)  # 2i and 2i + 1 are neighbours
    df = spark.createDataFrame([(i, [float(x) for x in y]) for i, y in enumerate(v)], "item_id int, vector array<double>")
    found = {(r.item_id_1, r.item_id_2) for r in similar_items_lsh(df, k=1, bits=bits).collect()}
    queries = range(0, len(v), 50)
    scores = v[queries] @ v.T
    scores[np.arange(len(queries)), queries] = -1
    exact = set(zip(queries, scores.argmax(axis=1).tolist()))
    print(f"bits {bits}: queries {len(exact & found)} of {len(exact)}; all", sum((2 * i, 2 * i + 1) in found for i in range(1500)), "of 1500")
    assert exact == {(i, i + 1) for i in queries} and len(exact & found) >= 0.85 * len(exact)
    assert sum((2 * i, 2 * i + 1) in found for i in range(1500)) >= 0.88 * 1500


def test_als_blocks_follow_the_ids_not_the_cluster(spark):
    few = spark.range(1000).selectExpr("int(id % 50) user_id", "int(id % 7) item_id", "1L plays")
    users, items = cf.als_blocks(few, ids_per_block=10, most=16)
    assert users in (8, 9, 10, 16) and items <= users <= 16 and cf.als_blocks(few, ids_per_block=1, most=12) == (12, max(8, 7))


def test_item_popularity_approx_close_to_exact(spark, fx):
    from cadenza.operators.popularity import item_popularity
    exact = {r.item_id: r.users for r in item_popularity(fx.train).collect()}
    approx = {r.item_id: r.users for r in item_popularity(fx.train, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[i] - exact[i]) <= max(1, 0.05 * exact[i]) for i in exact)


def _plays(spark, users=40, items=25):
    rows = [(u, i, ((u * 37 + i * 11) % 97) / 9.0, int((u * 5 + i * 3) % 7 < 3), 3 + u % 9, 1 + i * i % 31) for u in range(users) for i in range(items)]
    return spark.createDataFrame(rows, "user_id int, item_id int, als_score double, target int, tracks_played_by_user bigint, item_plays bigint")


def test_ranker_fits_weighted_cells_as_it_fits_rows(spark):
    cands = _plays(spark)
    users = cands.select("user_id").distinct()
    params = {"max_iter": 6, "depth": 4}
    own, rows = ranker.fit_ranker(cands, users, **params), ranker.training_rows(cands, users)
    plain = ranker.ranker_pipeline(**params).fit(rows)
    assert ranker.model_thresholds(own) and not own.stages[1].isSet("weightCol") and own.stages[1].getMaxBins() == 32
    assembler, gbt = plain.stages
    expected = gbt.evaluateEachIteration(assembler.transform(rows))
    assert np.allclose(ranker.losses(own, cands, users), expected, atol=1e-9, rtol=0)
    assert np.allclose(ranker.losses(plain, cands, users), expected, atol=1e-12, rtol=0)
    twice = ranker.fit_ranker(cands.unionByName(cands), users, **params)  # rows count as often as they come
    assert np.allclose(ranker.losses(twice, cands, users), expected, atol=1e-9, rtol=0)
    by_row = plain.transform(cands.select("user_id", "item_id", *[F.col(c).cast("double").alias(c) for c in ranker.FEATURES])).select(
        "user_id", "item_id", ranker.vector_to_array("probability")[1].alias("p"))
    ranked = ranker.rank_candidates(plain, cands, users, n=10_000)
    both = ranked.join(by_row, ["user_id", "item_id"])
    assert both.count() == 1000 and both.where("score != p").count() == 0


def test_training_thresholds_are_spark_mls(spark):
    rng = np.random.default_rng(3)
    for rows in (4_000, 25_000):  # all of them, a sample
        drawn = zip(range(rows), rng.normal(size=rows).tolist(), rng.integers(0, 3, rows).tolist(), rng.poisson(20, rows).tolist(), rng.integers(0, 2, rows).tolist())
        cands = spark.createDataFrame([(u % 50, u, s, t, p, q) for u, s, p, q, t in drawn],
                                      "user_id int, item_id int, als_score double, target int, tracks_played_by_user bigint, item_plays bigint")
        data = ranker.stored(ranker.training_rows(cands, cands.select("user_id").distinct()), "rows").repartition(1)
        splits = ranker.training_splits(data, rows, 32, ranker.SEED)
        plain = ranker.ranker_pipeline(max_iter=12, depth=6).fit(data)
        used = ranker.model_thresholds(plain)
        assert [len(s) for s in splits] == [31, 2, len(splits[2])] and len(splits[2]) <= 31
        assert all(u and set(u) <= set(s) for u, s in zip(used, splits))


def test_places_of_values_and_refused_features(spark):
    values = spark.createDataFrame([(None,), (float("nan"),), (-1.0,), (0.5,), (0.6,), (99.0,)], "x double")
    for thresholds in ([], [0.5], [i / 2 for i in range(9)], [i / 2 for i in range(100)]):
        got = [r.n for r in values.select(ranker.place(F.col("x"), thresholds).alias("n")).collect()]
        least = lambda v: sum(not v <= t for t in thresholds)
        assert got == [len(thresholds), len(thresholds), least(-1.0), least(0.5), least(0.6), least(99.0)]
    cands = _plays(spark, 6, 6)
    users = cands.select("user_id").distinct()
    model = ranker.fit_ranker(cands, users, max_iter=2, depth=2)
    odd = cands.withColumn("als_score", F.when(F.col("item_id") == 3, F.lit(float("nan"))).otherwise(F.col("als_score")))
    with pytest.raises(ValueError, match="null or NaN"):
        ranker.fit_ranker(odd, users, max_iter=2, depth=2)
    with pytest.raises(Exception, match="null or NaN"):
        ranker.rank_candidates(model, odd, users).collect()
