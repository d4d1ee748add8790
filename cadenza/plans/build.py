"""The batch build: raw tables → every recommendation artifact, written to one base URI.

Stages (each a DataFrame function from :mod:`cadenza.operators`, each written once and read
back, which also cuts the lineage for the next stage):

  interactions_clean  clean + sub-sample + known tracks            (S4 P3 J1)
  items               named attribute lists                        (F2 A6 J3)
  events              clean plays of catalogued items, clustered by user (J2 P9)
  top_popular         top 100 of train                              (W1 J6 P14)
  personal_als        ALS top 50 per user                           (M1 M2)
  similar             cosine top 10 over ALS item factors           (M3)
  recommendations     GBT re-ranking of ALS candidates, test users  (M4-M7)
  models/als, ranker  Spark ML models                               (M1 M6)
  metrics_summary     CSV, one row per recommendation set           (E5 S10)

The base may be any Hadoop URI (``s3a://``, ``abfss://``, ``hdfs://``, ``file:/``): the
DataFrame writer is the upload (S9). Reuse (S8): ``mode="ignore"`` takes a finished build as a whole and
touches nothing; where none is finished, and with ``"overwrite"``, everything is rebuilt.
``"reuse"`` compares every stage's manifest (:mod:`cadenza.sources.stages`): the files of the
raw tables, the split and the models' parameters; the stages behind a change are rebuilt, the others kept.
``build_state`` says whether a build ended, so that artifacts of different builds never meet.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators import catalog, cf, clean, ids, metrics, popularity, ranker
from cadenza.operators.similar import similar_items
from cadenza.session import job_session
from cadenza.sources.stages import StageStore
from cadenza.sources.tables import (CATALOG_NAMES, INTERACTIONS, TRACKS, conform, read_metrics_csv, read_table,
                                    write_metrics_csv, write_stage)

# Fixed value of the original pipeline: the global split instant.
REFERENCE_SPLIT = dt.datetime(2022, 12, 16)


STAGES = ("interactions_clean", "items", "events", "top_popular", "personal_als", "similar", "recommendations")


def finished(spark: SparkSession, base: str) -> bool:
    """Whether ``base`` holds a build that ran to its end."""
    try:
        return spark.read.parquet(f"{base}/build_state").first()["state"] == "finished"
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def artifacts(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Scans of everything that a finished build has written, by name."""
    return {**{name: spark.read.parquet(f"{base}/{name}") for name in STAGES},
            "metrics_summary": read_metrics_csv(spark, f"{base}/metrics_summary")}


def _save(model, path: str) -> None:
    model.write().overwrite().save(path)


def build_recommendations(spark: SparkSession, tracks: DataFrame, catalog_names: DataFrame,
                          interactions: DataFrame, out: str, split: dt.datetime = REFERENCE_SPLIT,
                          mode: str = "overwrite", als_params: dict | None = None,
                          ranker_params: dict | None = None, similar_block: int | None = None,
                          inputs: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Run every stage; returns scans of the written artifacts by name. ``inputs`` names the folders
    that ``tracks``, ``catalog_names`` and ``interactions`` were read from; ``mode="reuse"`` needs them."""
    base = out.rstrip("/")
    if mode not in ("overwrite", "ignore", "reuse"):
        raise ValueError("mode is overwrite, ignore or reuse")
    if mode == "reuse" and not inputs:
        raise ValueError("mode reuse needs the folders of the inputs")
    if mode == "ignore" and finished(spark, base):
        return artifacts(spark, base)

    store = StageStore(spark, base, fresh=mode != "reuse")
    paths = lambda *names: [inputs[n] for n in names] if inputs else []
    put = store.stage
    write_stage(spark.createDataFrame([("building",)], "state string"), f"{base}/build_state")

    plays = put("interactions_clean", lambda: clean.clean_interactions(interactions, tracks), paths=paths("interactions", "tracks"))
    items = put("items", lambda: catalog.build_items(tracks, catalog_names), paths=paths("tracks", "catalog_names"))
    events = put("events", lambda: clean.prepare_events(plays, items), after=["interactions_clean", "items"], range_by=["user_id"])
    train, test = clean.time_split(events, split)
    test_users = test.select("user_id").distinct()
    when = {"split": split}

    top = put("top_popular", lambda: popularity.top_popular(train, items), after=["events", "items"], params=when)
    put("models/als", lambda: cf.fit_als(cf.interaction_weights(train), **(als_params or {})), after=["events"],
        params={**when, "als": als_params}, write=_save)
    model = ALSModel.load(store.folder("models/als"))
    personal = put("personal_als", lambda: cf.personal_recs(model), after=["models/als"])
    sim_kw = {"block_size": similar_block} if similar_block else {}
    put("similar", lambda: similar_items(cf.item_vectors(model, train), **sim_kw), after=["models/als"])

    cands = put("candidates", lambda: ranker.build_candidates(personal, train), after=["personal_als"], params=when)
    put("models/ranker", lambda: ranker.fit_ranker(cands, ranker.sample_users(cands.select("user_id").distinct()), **(ranker_params or {})),
        after=["candidates"], params={"ranker": ranker_params}, write=_save)
    rank_model = ranker.load_ranker(store.folder("models/ranker"))
    recs = put("recommendations", lambda: ranker.rank_candidates(rank_model, cands, test_users), after=["models/ranker"],
               params=when, range_by=["user_id"])

    put("metrics_summary", lambda: metrics.evaluate_many(
        {"Top popular": popularity.popular_as_recs(top, test_users), "Personal ALS": personal, "Final ranked": recs}, train, test, items),
        after=["top_popular", "personal_als", "recommendations"], params=when, write=write_metrics_csv)
    write_stage(spark.createDataFrame([("finished",)], "state string"), f"{base}/build_state")
    return artifacts(spark, base)


def with_dense_ids(spark: SparkSession, tracks: DataFrame, catalog_names: DataFrame, interactions: DataFrame,
                   out: str, inputs: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The raw tables with INT codes for users and tracks named by ids of any type (J7). The indexes are
    stages ``ids/users`` and ``ids/tracks`` of ``out`` (``id, code``), by which :func:`cadenza.operators.ids.decode`
    turns any artifact's codes back. Ids of albums, artists and genres are INT, or text of an INT."""
    store = StageStore(spark, out.rstrip("/"))
    users = store.stage("ids/users", lambda: ids.dense_index(interactions, "user_id"), paths=[inputs["interactions"]])
    named = (tracks.select("track_id").unionByName(interactions.select("track_id"))
             .unionByName(catalog_names.where("type = 'track'").select(F.col("id").cast(tracks.schema["track_id"].dataType).alias("track_id"))))
    items = store.stage("ids/tracks", lambda: ids.dense_index(named, "track_id"), paths=list(inputs.values()))
    is_track = F.col("type") == "track"
    names = (ids.encode(catalog_names.where(is_track), items, "id").select("id", "type", "name")
             .unionByName(catalog_names.where(~is_track).select(F.col("id").cast("int").alias("id"), "type", "name")))
    plays = ids.encode(ids.encode(interactions, users, "user_id"), items, "track_id")
    return tuple(conform(df, schema) for df, schema in (
        (ids.encode(tracks, items, "track_id"), TRACKS), (names, CATALOG_NAMES), (plays, INTERACTIONS)))


def main() -> None:
    parser = argparse.ArgumentParser(description="Build all recommendation artifacts.")
    parser.add_argument("--tracks", required=True)
    parser.add_argument("--catalog-names", required=True)
    parser.add_argument("--interactions", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--split", default=REFERENCE_SPLIT.isoformat())
    parser.add_argument("--mode", default="overwrite", choices=["overwrite", "ignore", "reuse"])
    parser.add_argument("--any-ids", action="store_true", help="users and tracks are named by BIGINT or text: encode them")
    args = parser.parse_args()
    inputs = {"tracks": args.tracks, "catalog_names": args.catalog_names, "interactions": args.interactions}
    spark = job_session("cadenza-build", list(inputs.values()))
    if args.any_ids:
        raw = with_dense_ids(spark, *(read_table(spark, p) for p in inputs.values()), args.out, inputs)
    else:
        raw = [read_table(spark, p, schema) for p, schema in zip(inputs.values(), (TRACKS, CATALOG_NAMES, INTERACTIONS))]
    build_recommendations(spark, *raw, args.out, split=dt.datetime.fromisoformat(args.split), mode=args.mode, inputs=inputs)


if __name__ == "__main__":
    main()
