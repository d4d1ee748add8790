"""Scans are pruned to the columns in use, and filters reach the Parquet reader."""

import tempfile

from cadenza.operators import clean
from cadenza.sources.fixtures import SPLIT_INSTANT
from cadenza.sources.tables import EVENTS, read_table, write_stage


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_reads_only_needed_columns(spark, fx):
    plan = _plan(fx.clean)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_time_split_pushed_into_parquet_scan(spark, fx):
    path = tempfile.mkdtemp(prefix="cadenza-events-") + "/events"
    write_stage(fx.events, path, sort_within=["user_id"])
    train, test = clean.time_split(read_table(spark, path, EVENTS), SPLIT_INSTANT)
    assert "LessThan(started_at" in _plan(train)
    assert "GreaterThanOrEqual(started_at" in _plan(test)
    assert train.count() + test.count() == fx.events.count()


def test_history_lookup_pushes_user_filter(spark, fx):
    from pyspark.sql import functions as F
    path = tempfile.mkdtemp(prefix="cadenza-events-") + "/events"
    write_stage(fx.events, path, sort_within=["user_id"])
    one_user = read_table(spark, path, EVENTS).filter(F.col("user_id") == 4).select("item_id")
    plan = _plan(one_user)
    assert "EqualTo(user_id,4)" in plan and "ReadSchema: struct<user_id:int,item_id:int>" in plan


def test_registered_queries_push_the_split_into_the_stored_scan(spark):
    from cadenza.plans.queries import QUERIES
    plan = _plan(QUERIES["interaction_weights"](spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [IsNotNull(started_at), LessThan(started_at" in plan
    assert "ReadSchema: struct<user_id:int,item_id:int,started_at:timestamp_ntz>" in plan


def test_user_clustered_files_are_skipped(spark, fx):
    """Range-partitioned files hold disjoint users, so statistics rule out all but one or two files."""
    import pyarrow.parquet as pq
    import glob
    path = tempfile.mkdtemp(prefix="cadenza-events-") + "/events"
    write_stage(fx.events, path, range_by=["user_id"])
    spans = []
    for f in glob.glob(f"{path}/part-*.parquet"):
        stats = [g.column(0).statistics for g in (pq.ParquetFile(f).metadata.row_group(i) for i in range(pq.ParquetFile(f).num_row_groups))]
        spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
