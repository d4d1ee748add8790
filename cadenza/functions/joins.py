"""How a join meets a side that grows with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame


def growing(side: DataFrame) -> DataFrame:
    """``side`` of a join, never broadcast. Before a query runs, Spark takes a scan to be as large as its
    files, and Parquet writes ids and lists that repeat in a fraction of what they need in memory:
    30 M rows of recommendations are a few MB of files but 2 GB on the driver."""
    return side.hint("merge")
