"""Declared schemas of the recommendation tables, typed reads, and stage writes.

Every table the library consumes or produces has a declared ``StructType`` here.
Reads go through :func:`read_table`, which selects only the declared columns (so the
Parquet scan is pruned to them) and narrows types with ANSI casts: an id that does not
fit in INT raises instead of wrapping, as the strict casts of the original pipeline do.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT, BIGINT, DOUBLE, STRING = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
TS = T.TimestampNTZType()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


TRACKS = _schema(("track_id", INT), ("albums", T.ArrayType(INT)), ("artists", T.ArrayType(INT)),
                 ("genres", T.ArrayType(INT)))
CATALOG_NAMES = _schema(("id", INT), ("type", STRING), ("name", STRING))
INTERACTIONS = _schema(("user_id", INT), ("track_id", INT), ("track_seq", INT), ("started_at", TS))
INTERACTIONS_CLEAN = _schema(("user_id", INT), ("track_id", INT), ("started_at", TS))
ITEMS = _schema(("item_id", INT), ("albums", T.ArrayType(STRING)), ("artists", T.ArrayType(STRING)),
                ("genres", T.ArrayType(STRING)), ("name", STRING))
EVENTS = _schema(("user_id", INT), ("item_id", INT), ("started_at", TS))
RECS = _schema(("user_id", INT), ("item_id", INT), ("score", DOUBLE), ("rank", INT))
SIMILAR = _schema(("item_id_1", INT), ("item_id_2", INT), ("score", DOUBLE), ("rank", INT))
TOP_POPULAR = _schema(("item_id", INT), ("plays", BIGINT), ("users", BIGINT), ("rank", INT),
                      ("name", STRING), ("genres", T.ArrayType(STRING)),
                      ("artists", T.ArrayType(STRING)), ("albums", T.ArrayType(STRING)),
                      ("score", DOUBLE))
ONLINE_EVENTS = _schema(("user_id", INT), ("item_id", INT), ("ts", TS), ("event_id", BIGINT))
REQUESTS = _schema(("request_id", BIGINT), ("user_id", INT), ("k", INT))
METRICS = _schema(("model", STRING), ("precision", DOUBLE), ("recall", DOUBLE),
                  ("coverage", DOUBLE), ("novelty", DOUBLE))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in order, cast to the declared types.

    Missing columns raise a clear error; extra columns are pruned (and with them the scan).
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; with a schema, only its columns are read and they are cast to it."""
    df = spark.read.parquet(path)
    return conform(df, schema) if schema is not None else df


def write_stage(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                sort_within: list[str] | None = None, range_by: list[str] | None = None) -> DataFrame:
    """Materialise one stage as Parquet and return a scan of what was written.

    ``mode="ignore"`` reuses an existing result (the explicit form of "skip if the file is
    there"); ``"overwrite"`` always rebuilds, so a stale result is never picked up silently.
    ``range_by`` deals the rows out by ranges of these columns and sorts them, so that each
    file holds few of their values and a pushed filter on them skips whole files through
    Parquet statistics; ``sort_within`` only clusters rows inside each file.
    """
    if range_by:
        df, sort_within = df.repartitionByRange(*range_by), range_by
    writer_df = df.sortWithinPartitions(*sort_within) if sort_within else df
    writer = writer_df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_removed(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries that run within remove their shuffle files when they end. Otherwise these stay until the driver
    happens to collect its garbage, and the disk holds the shuffles of many stages at a time."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows, in no particular order (a look at the data, not a top-k)."""
    return df.limit(n)


def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    """Metrics summary as CSV with a header, one row per model (the model name first)."""
    conform(metrics, METRICS).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).option("header", True).csv(path)
