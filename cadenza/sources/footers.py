"""Counts, minima and maxima from Parquet footers.

Every Parquet file ends in row counts and column statistics. Through the DataSource V2 reader, with
aggregate push-down on, Spark answers ``count``, ``min`` and ``max`` from these without reading a
single page, so the cost follows the number of files, not the number of rows. That reader is
chosen by session settings, which :func:`settings` sets only while the plan is made and run.

Columns of integer, floating point, date and boolean type have exact statistics; strings,
decimals and timestamps don't (they may be cut or left out), and asking for them fails here
rather than scanning a table unnoticed.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

V2_PUSHDOWN = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a block, as they were before it afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def footer_plan(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """One row: ``rows``, and ``<column>_nonnull, _min, _max`` of each column. Plan and run it inside :func:`settings`."""
    df = spark.read.parquet(path)
    inexact = [c for c in columns if not isinstance(df.schema[c].dataType, EXACT)]
    if inexact:
        raise ValueError(f"no exact statistics for {inexact}")
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[f(c).alias(f"{c}_{name}") for c in columns for f, name in ((F.count, "nonnull"), (F.min, "min"), (F.max, "max"))])


def footer_summary(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The row of :func:`footer_plan`; raises if the scan would have to read rows."""
    with settings(spark, V2_PUSHDOWN):
        plan = footer_plan(spark, path, columns)
        shown = plan._jdf.queryExecution().executedPlan().toString()
        if "PushedAggregation: [COUNT" not in shown:
            raise RuntimeError(f"the reader does not answer these from footers:\n{shown}")
        rows = plan.collect()
        schema = plan.schema
    return spark.createDataFrame(rows, schema)
