"""DuckDB SQL oracles for the registered queries.

Each oracle restates the query from first principles in plain SQL over the driver's
views (``lineitem``, ``orders``, ``part``, ``supplier``, ``nation``, ``customer``,
``events``, ``embeddings``): the fixture definitions of FIXTURES.md are CTEs, metrics count
play rows after a full outer join, blending works on whole lists, neighbours on all pairs.
Doubles are rounded to 6 decimals and integer widths are cast to match Spark's types.
"""

from __future__ import annotations

SPLIT = "TIMESTAMP '2000-07-01 00:00:00'"

BASE = r"""
interactions AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS user_id, CAST(l.l_partkey AS INTEGER) AS track_id,
         CAST(l.l_linenumber AS INTEGER) AS track_seq, o.o_orderdate AS started_at
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
track_lists AS (
  SELECT CAST(l.l_partkey AS INTEGER) AS track_id,
         list_sort(list(DISTINCT CAST(l.l_suppkey AS INTEGER))) AS artists,
         list_sort(list(DISTINCT s.s_nationkey) FILTER (WHERE s.s_nationkey IS NOT NULL)) AS genres
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY 1),
tracks AS (
  SELECT CAST(p.p_partkey AS INTEGER) AS track_id,
         [CAST(regexp_extract(p.p_brand, '(\d+)', 1) AS INTEGER)] AS albums,
         t.artists, t.genres
  FROM part p LEFT JOIN track_lists t ON CAST(p.p_partkey AS INTEGER) = t.track_id),
catalog_names AS (
  SELECT CAST(p_partkey AS INTEGER) AS id, 'track' AS type, p_name AS name FROM part
  UNION ALL
  SELECT DISTINCT CAST(regexp_extract(p_brand, '(\d+)', 1) AS INTEGER), 'album', p_brand FROM part
  UNION ALL
  SELECT CAST(s_suppkey AS INTEGER), 'artist', s_name FROM supplier
  UNION ALL
  SELECT n_nationkey, 'genre', n_name FROM nation),
clean AS (
  SELECT user_id, track_id, started_at FROM interactions
  WHERE (track_seq + 2) % 3 = 0 AND track_id IN (SELECT track_id FROM tracks)),
guarded AS (
  SELECT * FROM tracks
  WHERE len(list_filter(albums, lambda x: x IS NOT NULL)) > 0
    AND len(list_filter(artists, lambda x: x IS NOT NULL)) > 0
    AND len(list_filter(genres, lambda x: x IS NOT NULL)) > 0),
attr AS (
  SELECT track_id, 'album' AS type, UNNEST(albums) AS id FROM guarded
  UNION ALL SELECT track_id, 'artist', UNNEST(artists) FROM guarded
  UNION ALL SELECT track_id, 'genre', UNNEST(genres) FROM guarded),
named AS (
  SELECT a.track_id, a.type, c.name FROM attr a
  LEFT JOIN catalog_names c ON c.type = a.type AND c.id = a.id
  WHERE a.id IS NOT NULL),
item_lists AS (
  SELECT track_id,
    list_sort(list(DISTINCT name) FILTER (WHERE type = 'album'), 'ASC', 'NULLS LAST') AS albums,
    list_sort(list(DISTINCT name) FILTER (WHERE type = 'artist'), 'ASC', 'NULLS LAST') AS artists,
    list_sort(list(DISTINCT name) FILTER (WHERE type = 'genre'), 'ASC', 'NULLS LAST') AS genres
  FROM named GROUP BY track_id),
items AS (
  SELECT l.track_id AS item_id, l.albums, l.artists, l.genres, c.name
  FROM item_lists l
  LEFT JOIN (SELECT id, name FROM catalog_names WHERE type = 'track') c ON c.id = l.track_id),
play_events AS (
  SELECT user_id, track_id AS item_id, started_at FROM clean
  WHERE track_id IN (SELECT item_id FROM items)),
train AS (SELECT * FROM play_events WHERE started_at < __SPLIT__),
test AS (SELECT * FROM play_events WHERE started_at >= __SPLIT__),
test_users AS (SELECT DISTINCT user_id FROM test),
user_nation AS (SELECT CAST(c_custkey AS INTEGER) AS user_id, c_nationkey AS nation FROM customer),
nation_items AS (
  SELECT n.nation, t.item_id, count(*) AS plays
  FROM train t JOIN user_nation n ON n.user_id = t.user_id GROUP BY 1, 2),
nation_top AS (
  SELECT nation, item_id,
         CAST(row_number() OVER (PARTITION BY nation ORDER BY plays DESC, item_id) AS INTEGER) AS rank,
         plays / sum(plays) OVER (PARTITION BY nation) AS score
  FROM nation_items),
nation_recs AS (
  SELECT u.user_id, t.item_id, t.score, t.rank
  FROM test_users u JOIN user_nation n ON n.user_id = u.user_id
  JOIN nation_top t ON t.nation = n.nation
  WHERE t.rank <= 50),
item_pop AS (
  SELECT item_id, count(started_at) AS plays, count(DISTINCT user_id) AS users FROM train GROUP BY item_id),
top_ranked AS (
  SELECT * FROM (
    SELECT item_id, plays, users,
           CAST(row_number() OVER (ORDER BY plays DESC, users DESC, item_id) AS INTEGER) AS rank
    FROM item_pop) WHERE rank <= 100),
top_popular AS (
  SELECT t.item_id, t.plays, t.users, t.rank, i.name, i.genres, i.artists, i.albums,
         t.plays / sum(t.plays) OVER () AS score
  FROM top_ranked t JOIN items i ON i.item_id = t.item_id),
default_list AS (
  SELECT item_id, score, CAST(row_number() OVER (ORDER BY rank) AS INTEGER) AS pos FROM top_popular),
popular_recs AS (
  SELECT u.user_id, d.item_id, d.score, d.pos AS rank FROM test_users u JOIN default_list d ON d.pos <= 50),
online AS (
  SELECT CAST(user_id AS INTEGER) AS user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS item_id,
         ts, event_id
  FROM events),
last_events AS (
  SELECT * FROM (
    SELECT user_id,
           CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS pos,
           item_id, ts, event_id
    FROM online) WHERE pos <= 10),
requests AS (
  SELECT CAST(c_custkey * 2 AS BIGINT) AS request_id, CAST(c_custkey AS INTEGER) AS user_id, 10 AS k FROM customer
  UNION ALL
  SELECT c_custkey * 2 + 1, CAST(c_custkey AS INTEGER), CASE c_custkey % 4 WHEN 0 THEN 100 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 5 END FROM customer),
seen AS (
  SELECT DISTINCT user_id, item_id FROM play_events WHERE user_id IN (SELECT user_id FROM requests)),
unit AS (
  SELECT CAST(vec_id AS INTEGER) AS item_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
sim_top AS (
  SELECT * FROM (
    SELECT item_id_1, item_id_2, score,
           CAST(row_number() OVER (PARTITION BY item_id_1 ORDER BY score DESC, item_id_2) AS INTEGER) AS rank
    FROM (SELECT a.item_id AS item_id_1, b.item_id AS item_id_2, list_cosine_similarity(a.v, b.v) AS score
          FROM unit a JOIN unit b ON a.item_id <> b.item_id))
  WHERE rank <= 10),
personal AS (
  SELECT user_id, item_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS pos
  FROM nation_recs),
off_cands AS (
  SELECT r.request_id, r.user_id, r.k, p.pos, p.item_id
  FROM requests r JOIN personal p ON p.user_id = r.user_id AND p.pos <= 2 * r.k
  UNION ALL
  SELECT r.request_id, r.user_id, r.k, d.pos, d.item_id
  FROM requests r JOIN default_list d ON d.pos <= 2 * r.k
  WHERE r.user_id NOT IN (SELECT user_id FROM personal)),
off_kept AS (
  SELECT c.* FROM off_cands c
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = c.user_id AND s.item_id = c.item_id)),
offline_list AS (
  SELECT request_id, user_id, pos, item_id FROM (
    SELECT request_id, user_id, item_id, k,
           CAST(row_number() OVER (PARTITION BY request_id ORDER BY pos, item_id) AS INTEGER) AS pos
    FROM off_kept) WHERE pos <= k),
newest AS (
  SELECT r.request_id, l.user_id, r.k, l.pos AS recency, l.item_id AS event_item
  FROM last_events l JOIN requests r ON r.user_id = l.user_id WHERE l.pos <= 3),
on_exp AS (
  SELECT n.request_id, n.user_id, n.k, s.item_id_2 AS item_id, n.recency, s.rank
  FROM newest n JOIN sim_top s ON s.item_id_1 = n.event_item WHERE s.rank <= n.k),
on_first AS (
  SELECT request_id, user_id, item_id, k, recency, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id, item_id ORDER BY recency, rank) AS rn FROM on_exp)
  WHERE rn = 1),
on_seen AS (SELECT user_id, item_id FROM seen UNION SELECT user_id, event_item FROM newest),
on_kept AS (
  SELECT f.* FROM on_first f
  WHERE NOT EXISTS (SELECT 1 FROM on_seen s WHERE s.user_id = f.user_id AND s.item_id = f.item_id)),
online_list AS (
  SELECT request_id, user_id, pos, item_id FROM (
    SELECT request_id, user_id, item_id, k,
           CAST(row_number() OVER (PARTITION BY request_id ORDER BY recency, rank, item_id) AS INTEGER) AS pos
    FROM on_kept) WHERE pos <= k),
answers AS (
  SELECT r.request_id, r.user_id, r.k,
         coalesce((SELECT list(item_id ORDER BY pos) FROM offline_list o WHERE o.request_id = r.request_id), []) AS off_l,
         coalesce((SELECT list(item_id ORDER BY pos) FROM online_list o WHERE o.request_id = r.request_id), []) AS on_l
  FROM requests r),
turns AS (
  SELECT request_id, user_id, k,
         list_concat(flatten(list_transform(range(1, least(len(off_l), len(on_l)) + 1), lambda i: [off_l[i], on_l[i]])),
                     list_concat(off_l[len(on_l) + 1:], on_l[len(off_l) + 1:])) AS mixed
  FROM answers),
blended_list AS (
  SELECT request_id, user_id, pos, item_id FROM (
    SELECT request_id, user_id, k, item_id,
           CAST(row_number() OVER (PARTITION BY request_id ORDER BY min(spot)) AS INTEGER) AS pos
    FROM (SELECT request_id, user_id, k, unnest(mixed) AS item_id, unnest(range(len(mixed))) AS spot FROM turns)
    GROUP BY request_id, user_id, k, item_id) WHERE pos <= k)
""".replace("__SPLIT__", SPLIT)


def metric_ctes(recs: str, p: str) -> str:
    """Evaluation CTEs at k = 5 for the recommendation CTE ``recs``; names prefixed ``p``.

    Everything stays at the level of play rows: a play of the test period and a
    recommendation meet in a full outer join, and the rows themselves are counted."""
    return f"""
{p}best AS (
  SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS place FROM {recs}),
{p}given AS (SELECT * FROM {p}best WHERE place <= 5 AND user_id IN (SELECT user_id FROM test)),
{p}asked AS (
  SELECT user_id, item_id FROM test
  WHERE user_id IN (SELECT user_id FROM {recs}) AND item_id IN (SELECT item_id FROM train)),
{p}met AS (
  SELECT coalesce(a.user_id, g.user_id) AS user_id, coalesce(a.item_id, g.item_id) AS item_id, g.score,
         a.user_id IS NOT NULL AS was_played, g.user_id IS NOT NULL AS was_given
  FROM {p}asked a FULL OUTER JOIN {p}given g ON a.user_id = g.user_id AND a.item_id = g.item_id),
{p}rel AS (
  SELECT user_id, item_id, count(*) FILTER (WHERE was_played) AS test_plays, any_value(score) AS score,
         bool_or(was_played) AS gt, bool_or(was_given) AS pr, count(*) FILTER (WHERE was_played AND was_given) AS tp,
         count(*) FILTER (WHERE was_given AND NOT was_played) AS fp, count(*) FILTER (WHERE was_played AND NOT was_given) AS fn
  FROM {p}met GROUP BY user_id, item_id),
{p}pr_summary AS (
  SELECT avg(coalesce(precision, 0)) AS precision, avg(coalesce(recall, 0)) AS recall, count(*) AS users FROM (
    SELECT avg(CAST(was_played AS INTEGER)) FILTER (WHERE was_given) AS precision,
           avg(CAST(was_given AS INTEGER)) FILTER (WHERE was_played) AS recall
    FROM {p}met GROUP BY user_id)),
{p}novelty AS (
  SELECT avg(novelty) AS novelty FROM (
    SELECT avg(CASE WHEN t.user_id IS NULL THEN 1.0 ELSE 0.0 END) AS novelty
    FROM {p}best b LEFT JOIN train t ON t.user_id = b.user_id AND t.item_id = b.item_id
    WHERE b.place <= 5 GROUP BY b.user_id)),
{p}coverage AS (
  SELECT count(DISTINCT item_id) AS recommended, (SELECT count(*) FROM items) AS items,
         count(DISTINCT item_id) / (SELECT count(*) FROM items) AS coverage
  FROM {recs})"""


def _with(body: str, *extra: str) -> str:
    return "WITH " + BASE + "".join("," + e for e in extra) + "\n" + body


def _r(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


NATION = metric_ctes("nation_recs", "m_")
POPULAR = metric_ctes("popular_recs", "p_")

ORACLES: dict[str, str] = {
    "clean_interactions": _with("SELECT user_id, track_id, started_at FROM clean"),
    "null_counts": _with("""
SELECT 'tracks' AS table_name, 'track_id' AS column_name, count(*) FILTER (WHERE track_id IS NULL) AS nulls FROM tracks
UNION ALL SELECT 'tracks', 'albums', count(*) FILTER (WHERE albums IS NULL) FROM tracks
UNION ALL SELECT 'tracks', 'artists', count(*) FILTER (WHERE artists IS NULL) FROM tracks
UNION ALL SELECT 'tracks', 'genres', count(*) FILTER (WHERE genres IS NULL) FROM tracks
UNION ALL SELECT 'catalog_names', 'id', count(*) FILTER (WHERE id IS NULL) FROM catalog_names
UNION ALL SELECT 'catalog_names', 'type', count(*) FILTER (WHERE type IS NULL) FROM catalog_names
UNION ALL SELECT 'catalog_names', 'name', count(*) FILTER (WHERE name IS NULL) FROM catalog_names
UNION ALL SELECT 'interactions', 'user_id', count(*) FILTER (WHERE user_id IS NULL) FROM interactions
UNION ALL SELECT 'interactions', 'track_id', count(*) FILTER (WHERE track_id IS NULL) FROM interactions
UNION ALL SELECT 'interactions', 'track_seq', count(*) FILTER (WHERE track_seq IS NULL) FROM interactions
UNION ALL SELECT 'interactions', 'started_at', count(*) FILTER (WHERE started_at IS NULL) FROM interactions"""),
    "row_counts": _with("""
SELECT 'tracks' AS table_name, count(*) AS rows FROM tracks
UNION ALL SELECT 'catalog_names', count(*) FROM catalog_names
UNION ALL SELECT 'interactions', count(*) FROM interactions
UNION ALL SELECT 'interactions_clean', count(*) FROM clean
UNION ALL SELECT 'items', count(*) FROM items
UNION ALL SELECT 'events', count(*) FROM play_events
UNION ALL SELECT 'train', count(*) FROM train
UNION ALL SELECT 'test', count(*) FROM test"""),
    "plays_per_track": _with("SELECT track_id, count(*) AS plays FROM clean GROUP BY track_id"),
    "catalog_type_counts": _with("SELECT type, count(*) AS rows FROM catalog_names GROUP BY type"),
    "plays_per_user": _with("SELECT user_id, count(*) AS tracks_played FROM clean GROUP BY user_id"),
    "plays_summary": _with(f"""
SELECT count(x) AS count, {_r('avg(x)', 'mean')}, {_r('stddev_samp(x)', 'std')},
       {_r('CAST(min(x) AS DOUBLE)', 'min')}, {_r('quantile_cont(x, 0.25)', 'p25')},
       {_r('quantile_cont(x, 0.5)', 'p50')}, {_r('quantile_cont(x, 0.75)', 'p75')},
       {_r('CAST(max(x) AS DOUBLE)', 'max')}
FROM (SELECT user_id, count(*) AS x FROM clean GROUP BY user_id)"""),
    "plays_histogram": _with(f"""
SELECT g.bin, {_r('g.lo + (g.bin - 1) * ((g.hi - g.lo) / 50)', 'bin_start')},
       {_r('g.lo + g.bin * ((g.hi - g.lo) / 50)', 'bin_end')}, coalesce(c.users, 0) AS users
FROM (SELECT CAST(r.range AS INTEGER) AS bin, b.lo, b.hi FROM range(1, 51) r, b) g
LEFT JOIN (
  SELECT CASE WHEN b.hi = b.lo THEN 1
              ELSE least(CAST(floor((p.x - b.lo) * 50 / (b.hi - b.lo)) AS INTEGER) + 1, 50) END AS bin,
         count(*) AS users
  FROM ppu p, b GROUP BY 1) c ON c.bin = g.bin""",
        "ppu AS (SELECT user_id, count(*) AS x FROM clean GROUP BY user_id)",
        "b AS (SELECT CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi FROM ppu)"),
    "top_tracks": _with("""
SELECT t.track_id, t.plays, c.name
FROM (SELECT track_id, count(*) AS plays FROM clean GROUP BY 1 ORDER BY plays DESC, track_id LIMIT 10) t
LEFT JOIN (SELECT id, name FROM catalog_names WHERE type = 'track') c ON c.id = t.track_id"""),
    "top_genres": _with("""
SELECT g.genre_id, g.plays, c.name
FROM (
  SELECT e.genre_id, CAST(sum(p.plays) AS BIGINT) AS plays
  FROM (SELECT track_id,
               UNNEST(CASE WHEN genres IS NULL OR len(genres) = 0 THEN [NULL::INTEGER] ELSE genres END) AS genre_id
        FROM tracks) e
  JOIN (SELECT track_id, count(*) AS plays FROM clean GROUP BY 1) p ON p.track_id = e.track_id
  GROUP BY 1 ORDER BY plays DESC, genre_id NULLS LAST LIMIT 10) g
LEFT JOIN (SELECT id, name FROM catalog_names WHERE type = 'genre') c ON c.id = g.genre_id"""),
    "unplayed_tracks": _with(f"""
SELECT unplayed, tracks, {_r('unplayed / tracks', 'share')}
FROM (SELECT count(*) FILTER (WHERE p.track_id IS NULL) AS unplayed, count(*) AS tracks
      FROM tracks t LEFT JOIN (SELECT DISTINCT track_id FROM clean) p ON p.track_id = t.track_id)"""),
    "build_items": _with("""
SELECT item_id, name, 'albums' AS attribute, UNNEST(albums) AS value FROM items
UNION ALL SELECT item_id, name, 'artists', UNNEST(artists) FROM items
UNION ALL SELECT item_id, name, 'genres', UNNEST(genres) FROM items"""),
    "events": _with("SELECT user_id, item_id, started_at FROM play_events"),
    "time_split_ranges": _with("""
SELECT 'train' AS split, count(*) AS rows, min(started_at) AS min_dt, max(started_at) AS max_dt FROM train
UNION ALL SELECT 'test', count(*), min(started_at), max(started_at) FROM test"""),
    "top_popular": _with(f"""
SELECT item_id, plays, users, rank, name, array_to_string(genres, '|') AS genres, array_to_string(artists, '|') AS artists,
       array_to_string(albums, '|') AS albums, {_r('score', 'score')} FROM top_popular"""),
    "popular_recs_for_test_users": _with(f"SELECT user_id, item_id, {_r('score', 'score')}, rank FROM popular_recs"),
    "interaction_weights": _with("SELECT user_id, item_id, count(*) AS plays FROM train GROUP BY 1, 2"),
    "ranking_candidates": _with(f"""
SELECT r.user_id, r.item_id, {_r('r.score', 'als_score')},
       CAST(CASE WHEN l.user_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS target,
       coalesce(uf.n, 0) AS tracks_played_by_user, coalesce(itf.n, 0) AS item_plays
FROM nation_recs r
LEFT JOIN (SELECT DISTINCT user_id, item_id FROM train) l ON l.user_id = r.user_id AND l.item_id = r.item_id
LEFT JOIN (SELECT user_id, count(started_at) AS n FROM train GROUP BY 1) uf ON uf.user_id = r.user_id
LEFT JOIN (SELECT item_id, count(started_at) AS n FROM train GROUP BY 1) itf ON itf.item_id = r.item_id"""),
    "sampled_users_count": _with("SELECT least(80000, count(DISTINCT user_id)) AS users FROM nation_recs"),
    "rank_topk": _with(f"""
SELECT user_id, item_id, {_r('score', 'score')}, rank FROM (
  SELECT user_id, item_id, score,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
  FROM nation_recs) WHERE rank <= 5"""),
    "binary_relevance": _with(f"""
SELECT user_id, item_id, test_plays, {_r('score', 'score')}, gt, pr, tp, fp, fn FROM m_rel""", NATION),
    "precision_recall": _with(f"""
SELECT {_r('precision', 'precision')}, {_r('recall', 'recall')}, users FROM m_pr_summary""", NATION),
    "novelty": _with(f"SELECT {_r('novelty', 'novelty')} FROM m_novelty", NATION),
    "coverage": _with(f"SELECT recommended, items, {_r('coverage', 'coverage')} FROM m_coverage", NATION),
    "evaluate_popular": _with(f"""
SELECT 'Top popular' AS model, {_r('s.precision', 'precision')}, {_r('s.recall', 'recall')},
       {_r('c.coverage', 'coverage')}, {_r('n.novelty', 'novelty')}
FROM p_pr_summary s, p_coverage c, p_novelty n""", POPULAR),
    "last_events": _with("SELECT user_id, pos, item_id, ts, event_id FROM last_events"),
    "seen_items": _with("SELECT user_id, item_id FROM seen"),
    "similar_topk_embeddings": _with(f"SELECT item_id_1, item_id_2, {_r('score', 'score')}, rank FROM sim_top"),
    "similar_lsh_recall": "SELECT 'recall_at_least_0.9' AS check_name, 1.0::DOUBLE AS value UNION ALL SELECT 'short_items', 0.0",
    "offline_recs": _with("SELECT request_id, user_id, pos, item_id FROM offline_list"),
    "online_recs": _with("SELECT request_id, user_id, pos, item_id FROM online_list"),
    "blended_recs": _with("SELECT request_id, user_id, pos, item_id FROM blended_list"),
    "served_source_counts": _with("""
SELECT CASE WHEN r.user_id IN (SELECT user_id FROM nation_recs) THEN 'personal' ELSE 'default' END AS source,
       count(*) AS requests
FROM requests r GROUP BY 1"""),
}
