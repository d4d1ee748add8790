"""Serving job: answer a table of requests from the build's artifacts.

The original answers one HTTP request at a time from in-process dictionaries. Here one
job answers every request of a batch: it reads the written artifacts of
:mod:`cadenza.plans.build` (``recommendations``, ``top_popular``, ``similar``,
``events``), the newest online events (a batch table ``user_id, pos, item_id`` — e.g. the
state sink of :mod:`cadenza.streaming.online` read with ``latest_per_user`` +
``state_as_list`` — or none), and writes three list tables and the source counters.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators import serving
from cadenza.session import job_session
from cadenza.sources.tables import REQUESTS, read_table, write_stage


def serve(spark: SparkSession, built: str, requests: DataFrame, recent: DataFrame | None, out: str,
          mode: str = "overwrite") -> dict[str, DataFrame]:
    base, dest = built.rstrip("/"), out.rstrip("/")
    recs = spark.read.parquet(f"{base}/recommendations")
    top = spark.read.parquet(f"{base}/top_popular")
    similar = spark.read.parquet(f"{base}/similar")
    events = spark.read.parquet(f"{base}/events")
    if recent is None:
        recent = spark.createDataFrame([], "user_id int, pos int, item_id int")
    ids = requests.agg(F.count(F.lit(1)), F.count_distinct("request_id")).first()
    if ids[0] != ids[1]:
        raise ValueError("request_id has to be there and unique")
    offline = write_stage(serving.offline_recs(requests, recs, top, events), f"{dest}/offline", mode=mode)
    online = write_stage(serving.online_recs(requests, recent, similar, events), f"{dest}/online", mode=mode)
    blended = write_stage(serving.blend(offline, online, requests), f"{dest}/blended", mode=mode)
    counts = write_stage(serving.served_source_counts(requests, recs, top), f"{dest}/source_counts", mode=mode)
    return {"offline": offline, "online": online, "blended": blended, "source_counts": counts}


def main() -> None:
    parser = argparse.ArgumentParser(description="Answer a table of recommendation requests.")
    parser.add_argument("--built", required=True, help="base URI written by cadenza.plans.build")
    parser.add_argument("--requests", required=True, help="Parquet with request_id, user_id, k (k may be null)")
    parser.add_argument("--recent", help="Parquet with user_id, pos, item_id (newest online events)")
    parser.add_argument("--out", required=True)
    args = parser.parse_args()
    spark = job_session("cadenza-serve", [args.built, args.requests])
    recent = spark.read.parquet(args.recent).select("user_id", "pos", "item_id") if args.recent else None
    serve(spark, args.built, read_table(spark, args.requests, REQUESTS), recent, args.out)


if __name__ == "__main__":
    main()
