"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by whatever file system ``sf_dir`` names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return the scan of it.

    Cuts lineage: later stages read files that every executor reaches, so a lost executor
    costs at most the tasks it was running.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 32 << 20  # texts reach Python in Arrow batches of this size, or smaller ones if so set


def on_workers(spark: SparkSession) -> None:
    """Make the package importable in the Python workers, and their Arrow batches small enough
    for texts: the limit of the session is lowered to BATCH_BYTES, never raised."""
    ship_package(spark)
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(limit).rstrip("b"))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(limit, str(BATCH_BYTES))


def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The Arrow batches of one task; what was freed on the way is given back at its end."""
    yield from batches
    give_back()


def give_back() -> None:
    """Return freed memory to the system. A worker runs many tasks of many stages, and what its
    allocators keep would add up to the executor's limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """The evaluation quarter: crc32 of the id as text, modulo 4, is 2 (null ids: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, led by as many underscores as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of whole rows whose ``column`` holds about ``max_bytes`` at most.

    Bounds the working memory of a vectorised step: a run has more than ``max_bytes`` only
    if a single text does.
    """
    if not batch.num_rows:
        return
    size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    run = np.cumsum(size.astype(np.int64)) // max_bytes
    cuts = np.flatnonzero(np.diff(run)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def ragged(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions of the runs ``starts[i] .. starts[i] + lengths[i]`` laid end to end."""
    total = int(lengths.sum())
    kind = np.int32 if total + int(starts.max(initial=0)) + int(lengths.max(initial=0)) < 1 << 31 else np.int64
    at = np.arange(total, dtype=kind)
    at += np.repeat((starts - (np.cumsum(lengths) - lengths)).astype(kind), lengths)
    return at
