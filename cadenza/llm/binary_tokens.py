"""Token-ID binary output: flat unsigned integer files with 64-bit document offsets.

Layout below one folder, a shard per range of document ids::

    shard-00007.bin    token ids, little-endian uint16 (uint32 for ids above 65535)
    shard-00007.off    n_docs + 1 little-endian int64 offsets into the shard, in ids
    shard-00007.doc    n_docs little-endian int64 document ids (null: the smallest int64)
    manifest/          Parquet: shard, dtype, n_docs, n_tokens, doc_base, token_base

Read in shard order the ``.bin`` files are one sequence of ids; ``token_base`` (a prefix sum
over the shards' counts) places a shard in it. Readers memory-map the files where they lie
on a mounted path and read them whole otherwise.

Spark sorts and deals out the rows (one range shuffle of the texts); a task encodes its
range and writes its shard under a temporary name, which is renamed when complete. A task
that is run again after a lost executor writes the same bytes to the same name.

Defined cases: a null text counts as empty and holds the end id alone; rows that share a
doc_id are kept in order of their text; an empty table gives an empty manifest; other
columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import on_workers, scratch, slices, table, task
from cadenza.llm.tokens import SLICE, encoder

MANIFEST = "shard int, dtype string, n_docs long, n_tokens long"
NO_ID = np.iinfo(np.int64).min


def arrow_uri(folder: str) -> str:
    """``folder`` as Arrow's file systems name it: Hadoop's S3 schemes are its ``s3``; a bare path is a file."""
    scheme, colon, rest = folder.partition(":")
    if not colon or "/" in scheme:
        return f"file://{folder}"
    return f"s3:{rest}" if scheme in ("s3a", "s3n") else folder


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(arrow_uri(folder))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None, shards: int | None = None,
                      doc_id: str = "doc_id", text: str = "text", slice_bytes: int = 2 * SLICE) -> DataFrame:
    """Encode every text, write the files described above, return the manifest.

    A task encodes about ``slice_bytes`` of texts at once.

    ``shards`` defaults to the session's shuffle partitions. The driver holds one manifest
    row per shard and nothing else.
    """
    spark = docs.sparkSession
    on_workers(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    largest = max(encoder(tokenizer).largest_id, end_id or 0)
    dtype = "uint16" if largest < 1 << 16 else "uint32"

    def write(batches):
        shard = TaskContext.get().partitionId()
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        name, mine = f"{root}/shard-{shard:05d}", uuid.uuid4().hex
        n_docs = n_tokens = 0
        out: dict = {}
        for batch in task(batches):
            for part in slices(batch, "text", slice_bytes):
                if not out:
                    out = {k: store.open_output_stream(f"{root}/.{mine}.{k}") for k in ("bin", "off", "doc")}
                    out["off"].write(np.zeros(1, "<i8").tobytes())
                ids, offsets = encoder(tokenizer).encode(part.column("text"), end_id)
                out["bin"].write(ids.astype("<u2" if dtype == "uint16" else "<u4").tobytes())
                out["off"].write((offsets[1:] + n_tokens).astype("<i8").tobytes())
                out["doc"].write(part.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
                                 .astype("<i8").tobytes())
                n_docs, n_tokens = n_docs + part.num_rows, n_tokens + len(ids)
        for kind, stream in out.items():
            stream.close()
            store.move(f"{root}/.{mine}.{kind}", f"{name}.{kind}")
        if out:
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "dtype": [dtype], "n_docs": [n_docs], "n_tokens": [n_tokens]})

    rows = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
            .mapInArrow(write, MANIFEST).collect())
    rows = sorted(rows, key=lambda r: r.shard)
    docs_base = np.cumsum([0, *(r.n_docs for r in rows)]).tolist()
    base = np.cumsum([0, *(r.n_tokens for r in rows)]).tolist()
    manifest = spark.createDataFrame([(*r, docs_base[i], base[i]) for i, r in enumerate(rows)],
                                     f"{MANIFEST}, doc_base long, token_base long")
    manifest.coalesce(1).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def open_flat(store: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A flat file as an array: memory-mapped on a mounted path, read whole elsewhere."""
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if store.get_file_info(path).size else np.empty(0, dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document, from the files: doc_id, doc_no, start, n_tokens, ids_crc32 [, ids].

    ``start`` counts the ids of all documents before it; ``ids`` (asked for with
    ``with_ids``) are the bytes of the little-endian uint32 ids; ``ids_crc32`` is their
    crc32. A task reads one shard at a time and emits a bounded number of rows at once.
    """
    on_workers(spark)
    manifest = spark.read.parquet(f"{folder}/manifest")
    schema = "doc_id long, doc_no long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def read(batches):
        store, root = _store(folder)
        for batch in batches:
            for r in batch.to_pylist():
                name = f"{root}/shard-{r['shard']:05d}"
                ids = open_flat(store, f"{name}.bin", "<u2" if r["dtype"] == "uint16" else "<u4")
                offsets, doc = open_flat(store, f"{name}.off", "<i8"), open_flat(store, f"{name}.doc", "<i8")
                for at in range(0, r["n_docs"], 1000):
                    off = np.asarray(offsets[at:at + 1001])
                    raw = [ids[a:b].astype("<u4").tobytes() for a, b in zip(off[:-1], off[1:])]
                    own = np.asarray(doc[at:at + 1000])
                    cols = {"doc_id": pa.array(own, mask=own == NO_ID),
                            "doc_no": pa.array(r["doc_base"] + at + np.arange(len(own))),
                            "start": pa.array(r["token_base"] + off[:-1]), "n_tokens": pa.array(np.diff(off)),
                            "ids_crc32": pa.array([zlib.crc32(b) for b in raw], pa.int64())}
                    yield pa.RecordBatch.from_pydict(cols | ({"ids": raw} if with_ids else {}))

    return manifest.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))).mapInArrow(read, schema)


def op5_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the file format and back: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    folder = scratch(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
