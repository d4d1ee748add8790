"""Item catalog: named attribute lists per track.

The original explodes albums × artists × genres per track, drops rows with a null id and
collects the distinct names of each list. Its result only depends on the three id sets
(the product is empty iff one set is empty, and each projection of the product is the
set itself), so this build explodes the three lists side by side instead of multiplying
them: row count grows with |A|+|R|+|G| instead of |A|·|R|·|G|, and one name join and one
aggregation serve all three lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.joins import growing

# Entity types of the catalog and the list column holding each one.
LIST_TYPES = (("albums", "album"), ("artists", "artist"), ("genres", "genre"))
TRACK_TYPE = "track"


def catalog_slice(catalog_names: DataFrame, type_: str, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """Rows of one entity type as ``(id_col, name_col)``."""
    return (catalog_names.filter(F.col("type") == type_)
            .select(F.col("id").alias(id_col), F.col("name").alias(name_col)))


def _has_id(list_col: str) -> Column:
    # null list → null → row filtered out, as is an empty list or one holding only nulls
    return F.exists(F.col(list_col), lambda x: x.isNotNull())


def _listed() -> Column:
    return _has_id("albums") & _has_id("artists") & _has_id("genres")


def item_ids(tracks: DataFrame) -> DataFrame:
    """``item_id`` of the tracks that :func:`build_items` keeps, without building their lists."""
    return tracks.filter(_listed()).select(F.col("track_id").alias("item_id"))


def _tagger(type_: str):
    # one-argument lambda: ``transform`` passes (element, index) to two-argument ones
    return lambda x: F.struct(F.lit(type_).alias("type"), x.cast("int").alias("id"))


def build_items(tracks: DataFrame, catalog_names: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """``item_id, albums, artists, genres, name`` — lists of names, unknown ids kept as one null.

    Tracks lacking a non-null id in any of the three lists vanish, as in the original.
    ``drop_unknown=True`` removes null names from the lists instead of keeping one.

    Plan: one explode of all three lists into ``(track_id, type, id)``, one left join with
    the non-track part of the catalog on ``(type, id)`` (small: broadcast by AQE when its
    measured size allows; a hot genre id on the large side is split by AQE's skew join),
    one aggregation by ``track_id``, one left join with track names.
    """
    guarded = tracks.filter(_listed())
    tagged = F.concat(*[F.transform(F.col(list_col), _tagger(type_)) for list_col, type_ in LIST_TYPES])
    long = (guarded.select("track_id", F.explode(tagged).alias("e"))
            .select("track_id", F.col("e.type").alias("type"), F.col("e.id").alias("id"))
            .filter(F.col("id").isNotNull()))
    attr_names = catalog_names.filter(F.col("type").isin([t for _, t in LIST_TYPES])).select("type", "id", "name")
    named = long.join(attr_names, ["type", "id"], "left")

    def names_of(type_: str) -> Column:
        value = F.when(F.col("type") == type_, F.struct(F.col("name").alias("v")))
        collected = F.transform(F.collect_list(value), lambda s: s["v"])
        if drop_unknown:
            collected = F.filter(collected, lambda x: x.isNotNull())
        return F.array_sort(F.array_distinct(collected))

    lists = named.groupBy("track_id").agg(*[names_of(t).alias(c) for c, t in LIST_TYPES])
    track_names = catalog_slice(catalog_names, TRACK_TYPE, "track_id", "name")
    return (lists.join(growing(track_names), "track_id", "left")
            .select(F.col("track_id").alias("item_id"), "albums", "artists", "genres", "name"))


def flatten_items(items: DataFrame) -> DataFrame:
    """Items as ``(item_id, name, attribute, value)`` rows — a list-free form for comparisons."""
    parts = [items.select("item_id", "name", F.lit(c).alias("attribute"), F.explode(c).alias("value"))
             for c, _ in LIST_TYPES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
