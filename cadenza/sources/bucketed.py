"""Catalog tables bucketed by join keys.

A history that is bucketed and sorted by ``(user_id, item_id)`` once is joined many times without moving: the
anti join of a batch of candidates then shuffles only the candidates, into the history's
buckets. The rows are dealt out by the same hash before they are written, so a bucket is one
file and a write has as many files as buckets.

The table's files lie at ``path`` (any URI). A catalog that lives with the session forgets the
table's layout, so :func:`open_bucketed` declares it again over the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HISTORY_KEYS = ["user_id", "item_id"]


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int, keys: list[str] = HISTORY_KEYS) -> DataFrame:
    """Write ``df`` as the bucketed table ``table`` at ``path``, replacing both, and return its scan."""
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, table: str, path: str, columns: str, buckets: int, keys: list[str] = HISTORY_KEYS) -> DataFrame:
    """Declare files written by :func:`save_bucketed` in this session's catalog (``columns``: DDL)."""
    names = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet OPTIONS (path '{path}') "
              f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS")
    return spark.table(table)


def history_buckets(rows: int, rows_per_bucket: int = 5_000_000, least: int = 8) -> int:
    """Buckets of about ``rows_per_bucket`` rows; a power of two, so that a later doubling splits each in two."""
    return max(least, 1 << max(0, -(-rows // rows_per_bucket) - 1).bit_length())
