"""Serving as batch jobs: offline, online and blended lists for many requests at once
(V1-V3 V5 F4 F5 U3 U4 J13 J14 W9 A20).

A request is a row ``(request_id, user_id, k)``; a list answer is rows ``(request_id, user_id,
pos, item_id)`` with ``pos`` dense from 1, so list order is data, never row order. A user may
ask any number of times, with any k; every request is answered on its own, a request without
k by ``DEFAULT_K`` items. One job answers every request: the history is read once per list
for all requests together (identical history subplans of the offline and online lists can
be reused by AQE), instead of one lookup per request. ``request_id`` must be unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.columns import blend_arrays  # noqa: F401  (array twin of blend)
from cadenza.functions.joins import growing
from cadenza.operators.metrics import rank_recs
from cadenza.operators.popularity import default_list

# Fixed values of the original service: 100 items if a request names no k; over-fetch 2k offline items before the history
# filter; online lists come from the 3 newest online events; a user keeps 10 online events.
OVERFETCH = 2
RECENT_FOR_ONLINE = 3
ONLINE_KEEP = 10
DEFAULT_K = 100

def checked_requests(requests: DataFrame) -> DataFrame:
    """``request_id, user_id, k``: a missing k is ``DEFAULT_K``, one below 1 fails the job."""
    k = F.coalesce(F.col("k"), F.lit(DEFAULT_K))
    return requests.select("request_id", "user_id", F.when(k >= 1, k).otherwise(
        F.raise_error(F.lit("request k must be >= 1"))).cast("int").alias("k"))


def seen_items(events: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Distinct ``(user_id, item_id)`` of the history, optionally only for ``users``.

    The semi join on requested users runs before the de-duplication, and the
    de-duplication is partially done map-side, so the shuffle carries each pair once per task.
    """
    pairs = events.select("user_id", "item_id")
    if users is not None:
        pairs = pairs.join(growing(users.select("user_id")), "user_id", "left_semi")
    return pairs.distinct()


def filter_seen(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """List minus set with order kept: anti join on ``(user_id, item_id)``; ``pos`` untouched."""
    return candidates.join(growing(seen), ["user_id", "item_id"], "left_anti")


def seen_bitmaps(events: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """The history as bitmaps (U4 V5): ``user_id, bucket, bits``, one row per user and 32,768 consecutive
    item ids, a bit for each seen item. Built by a partial aggregate before the shuffle, so a
    user's plays travel as one row per task and bucket however many they are."""
    pairs = events.select("user_id", "item_id")
    if users is not None:
        pairs = pairs.join(growing(users.select("user_id")), "user_id", "left_semi")
    return pairs.groupBy("user_id", F.bitmap_bucket_number("item_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("item_id")).alias("bits"))


def filter_seen_bits(candidates: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """:func:`filter_seen` by testing a bit: a left join on (user, bucket) with at most one row each."""
    place = candidates.withColumn("bucket", F.bitmap_bucket_number("item_id"))
    byte = "cast(conv(hex(substring(bits, cast(bitmap_bit_position(item_id) div 8 as int) + 1, 1)), 16, 10) as int)"
    seen = F.coalesce(F.expr(f"(shiftright({byte}, cast(bitmap_bit_position(item_id) % 8 as int)) & 1) = 1"), F.lit(False))
    return place.join(growing(bitmaps), ["user_id", "bucket"], "left").where(~seen).select(*candidates.columns)


def renumber(candidates: DataFrame, order_col: str = "pos", k_col: str | None = "k") -> DataFrame:
    """Dense positions 1.. in ``order_col`` order per request, cut to the per-row ``k``.

    The window is partitioned by request and holds at most the request's candidates.
    """
    w = Window.partitionBy("request_id").orderBy(F.col(order_col), F.col("item_id"))
    out = candidates.withColumn("_pos", F.row_number().over(w))
    if k_col is not None:
        out = out.filter(F.col("_pos") <= F.col(k_col))
    return out.select("request_id", "user_id", F.col("_pos").alias("pos"), "item_id")


def personal_lists(recs: DataFrame) -> DataFrame:
    """Per-user list of personal recommendations, score descending (ties: lower item id); the
    stored ``rank`` is that order, where the table has it."""
    ranked = recs if "rank" in recs.columns else rank_recs(recs.select("user_id", "item_id", "score"))
    return ranked.select("user_id", F.col("rank").alias("pos"), "item_id")


def offline_candidates(requests: DataFrame, recs: DataFrame, top: DataFrame,
                       overfetch: int = OVERFETCH) -> DataFrame:
    """First ``overfetch·k`` entries of the personal list, else of the default list.

    Columns ``request_id, user_id, k, pos, item_id, source``. Only requesting users' personal
    rows are read on. One left join of requests with personal lists decides the source: a
    user without personal rows keeps one null row and is expanded to default positions
    ``1..overfetch·k``, joined on ``pos`` with the default list.
    """
    req = checked_requests(requests)
    mine = recs.join(growing(req.select("user_id").distinct()), "user_id", "left_semi")
    personal = personal_lists(mine).withColumnRenamed("user_id", "p_user")
    joined = req.join(growing(personal), (req.user_id == personal.p_user)
                      & (personal.pos <= F.col("k") * overfetch), "left")
    from_personal = (joined.filter(F.col("item_id").isNotNull())
                     .select("request_id", "user_id", "k", "pos", "item_id", F.lit("personal").alias("source")))
    fallback = (joined.filter(F.col("item_id").isNull())
                .select("request_id", "user_id", "k", F.explode(F.sequence(F.lit(1), F.col("k") * overfetch)).alias("pos")))
    default = default_list(top).select("pos", "item_id")  # a table of the caller's size: no forced broadcast
    from_default = fallback.join(default, "pos").select("request_id", "user_id", "k", "pos", "item_id",
                                                        F.lit("default").alias("source"))
    return from_personal.unionByName(from_default)


def offline_recs(requests: DataFrame, recs: DataFrame, top: DataFrame, events: DataFrame,
                 extra_seen: DataFrame | None = None, overfetch: int = OVERFETCH, whole_history: bool = False, bitmaps: DataFrame | None = None) -> DataFrame:
    """Personal list (else the popular one), first ``2k`` entries, minus history, first ``k``.

    Only the 2k prefix is fetched, so fewer than k items may remain after the filter, as in
    the original. ``extra_seen`` (``user_id, item_id``) adds exclusions, e.g. recent online
    items; by default only the offline history is excluded.

    ``whole_history`` joins ``events`` as they are, neither cut to the requesting users nor made
    distinct: for a table bucketed by (user_id, item_id), which then is read in place while only the
    candidates are shuffled. ``bitmaps`` (:func:`seen_bitmaps`) take the place of ``events``.
    """
    cands = offline_candidates(requests, recs, top, overfetch)
    if bitmaps is not None:
        cands = filter_seen_bits(cands, bitmaps)
        return renumber(cands if extra_seen is None else filter_seen(cands, extra_seen.select("user_id", "item_id")))
    if whole_history:
        cands = filter_seen(cands, events.select("user_id", "item_id"))
        return renumber(cands if extra_seen is None else filter_seen(cands, extra_seen.select("user_id", "item_id")))
    seen = seen_items(events, requests)
    if extra_seen is not None:
        seen = seen.unionByName(extra_seen.select("user_id", "item_id"))
    return renumber(filter_seen(cands, seen))


def served_source_counts(requests: DataFrame, recs: DataFrame, top: DataFrame) -> DataFrame:
    """How many requests were answered from personal lists and how many from the default."""
    req = requests.select("user_id")
    has_personal = recs.select("user_id").distinct().withColumn("personal", F.lit(True))
    flagged = req.join(growing(has_personal), "user_id", "left")
    src = F.when(F.col("personal"), F.lit("personal")).otherwise(F.lit("default"))
    return flagged.groupBy(src.alias("source")).agg(F.count(F.lit(1)).alias("requests"))


def last_events(online: DataFrame, n: int = ONLINE_KEEP) -> DataFrame:
    """Newest ``n`` online events per user, newest first, repeats kept:
    ``user_id, pos, item_id, ts, event_id``. Order is ``(ts, event_id)`` descending."""
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return (online.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= n)
            .select("user_id", "pos", "item_id", "ts", "event_id"))


def similar_lists(similar: DataFrame) -> DataFrame:
    """``item_id_1, rank, item_id_2``: neighbours by score descending (ties: lower id)."""
    if "rank" in similar.columns:
        return similar.select("item_id_1", "rank", "item_id_2")
    w = Window.partitionBy("item_id_1").orderBy(F.desc("score"), F.asc("item_id_2"))
    return similar.select("item_id_1", "item_id_2", F.row_number().over(w).alias("rank"))


def online_recs(requests: DataFrame, recent: DataFrame, similar: DataFrame, events: DataFrame,
                n_recent: int = RECENT_FOR_ONLINE) -> DataFrame:
    """Similar items of the user's ``n_recent`` newest online events, concatenated in
    recency order (within one event's list: by similarity), first occurrence kept, minus
    history and minus those events' items, first ``k``.

    ``recent`` holds ``user_id, pos, item_id`` with pos 1 = newest (e.g. :func:`last_events`
    or the streaming state). The list order is the pair ``(recency, neighbour rank)``;
    de-duplication keeps its minimum per item, so no per-user loop is needed.
    """
    req = checked_requests(requests)
    newest = (recent.filter(F.col("pos") <= n_recent).join(growing(req), "user_id")
              .select("request_id", "user_id", "k", F.col("pos").alias("recency"), F.col("item_id").alias("event_item")))
    sims = similar_lists(similar)
    expanded = (newest.join(sims, newest.event_item == sims.item_id_1)
                .filter(F.col("rank") <= F.col("k"))
                .select("request_id", "user_id", "k", F.col("item_id_2").alias("item_id"),
                        F.struct(F.col("recency"), F.col("rank")).alias("order")))
    first = expanded.groupBy("request_id", "user_id", "k", "item_id").agg(F.min("order").alias("order"))
    seen = seen_items(events, requests).unionByName(
        newest.select("user_id", F.col("event_item").alias("item_id")))
    kept = filter_seen(first, seen)
    return renumber(kept, order_col="order")


def blend(offline: DataFrame, online: DataFrame, requests: DataFrame) -> DataFrame:
    """Interleave two ranked lists per request: offline on even slots, online on odd ones for
    the first ``m = min(len)`` entries of each, then the rest of the longer list; first
    occurrence of each item kept; cut to the request's ``k``.

    Position arithmetic (0-based index ``i`` in its own list, ``src`` 0 offline / 1 online):
    ``i < m → 2i + src``; ``i ≥ m → i + m``. The lengths come from a window partitioned by
    request, which holds at most the request's 2k list entries.
    """
    both = (offline.select("request_id", "user_id", "pos", "item_id", F.lit(0).alias("src"))
            .unionByName(online.select("request_id", "user_id", "pos", "item_id", F.lit(1).alias("src"))))
    w = Window.partitionBy("request_id")
    i = F.col("pos") - 1
    m = F.least(F.count(F.when(F.col("src") == 0, 1)).over(w), F.count(F.when(F.col("src") == 1, 1)).over(w))
    slots = both.withColumn("slot", F.when(i < m, 2 * i + F.col("src")).otherwise(i + m))
    first = slots.groupBy("request_id", "user_id", "item_id").agg(F.min("slot").alias("slot"))
    with_k = first.join(growing(checked_requests(requests).select("request_id", "k")), "request_id")
    return renumber(with_k, order_col="slot")


def blended_recs(requests: DataFrame, recs: DataFrame, top: DataFrame, recent: DataFrame,
                 similar: DataFrame, events: DataFrame) -> DataFrame:
    """Offline and online lists with the same ``k``, blended."""
    off = offline_recs(requests, recs, top, events)
    on = online_recs(requests, recent, similar, events)
    return blend(off, on, requests)


