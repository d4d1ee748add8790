"""Importance resampling towards a target distribution, over hashed n-grams.

A text is lower-cased (A-Z) and every run of separators becomes one space; for each n, one
overlapped scan with the ``regex`` library (:func:`gram_pattern`: n words between boundary
lookarounds, ``finditer`` with ``overlapped=True``) then emits the n-grams as spans of the text itself.
All of it works on the text's UTF-8 bytes, as all separators are ASCII. A span's CRC-32 modulo ``buckets`` is its feature. With S features in all documents, s of
them in a bucket, and T and t those of the target, a bucket's gain is
``floor(1000 ln((t + 1) (S + buckets) / ((s + 1) (T + buckets))))``; a document's weight is the floored
mean gain of its features, and its score the weight plus Gumbel noise drawn from its id, so
that the highest scores are a sample without replacement in proportion to exp(weight / 1000).

How it runs: one pass over the texts writes every document's features to the shared folder
(2 bytes each); sums per bucket are taken by task before the shuffle, and the table of gains
has ``buckets`` numbers however large the input. Ranks come from a range sort of rows of
numbers: places inside the sorted partitions plus the prefix sums of the partitions' sizes.

Defined cases: a null text has no words; a document without features has weight 0; a null
doc_id draws its noise as the empty string; equal scores go to the smaller doc_id (null
last), and rows that share score and id to either one, one rank each; an empty target or an
empty table of documents gives gains of an empty count; texts are scanned whole; columns to
carry along are named and keep their names, all others are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import free_name, on_workers, slices, staged, table, task

GRAMS, BUCKETS = 2, 10_000
MIN_WORDS, PERCENT, SEED = 20, 25, 7
SLICE = 2 << 20
#: ASCII letters in lower case, digits as they are, the rest of ASCII as spaces.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b > 127 else 32 for b in range(256))


@functools.lru_cache(maxsize=None)
def gram_pattern(n: int):
    """``n`` words with single spaces between, from a word's begin to a word's end."""
    import regex

    return regex.compile(rb"(?<![^ ])[^ ]++" + rb"(?: [^ ]++)" * (n - 1) + rb"(?![^ ])")


def collapsed(text: bytes) -> bytes:
    """Lower-cased words with single spaces between."""
    return b" ".join(text.translate(WORD_BYTES).split())


def features(text: bytes, grams: int, buckets: int) -> np.ndarray:
    """The buckets of all 1- to ``grams``-word spans of a collapsed text, sorted."""
    import regex

    span = regex.Match.group
    found = [np.fromiter(map(zlib.crc32, map(span, gram_pattern(n).finditer(text, overlapped=True))), np.uint32)
             for n in range(1, grams + 1)]
    return np.sort(np.concatenate(found) % np.uint32(buckets))


def feature_rows(docs: DataFrame, text: str, carry: list[str], grams: int, buckets: int) -> DataFrame:
    """``carry`` columns, ``words``, ``features`` and ``found``: the sorted buckets of a whole text as bytes."""
    on_workers(docs.sparkSession)
    dtype = _dtype(buckets)
    body = free_name(docs, "body")
    rows = docs.select(*carry, F.col(text).alias(body))
    own = [free_name(docs, n) for n in ("words", "features", "found")]
    schema = T.StructType([*rows.schema.fields[:-1], *(T.StructField(n, t) for n, t in zip(own, (T.LongType(), T.LongType(), T.BinaryType())))])

    def run(batches):
        for batch in task(batches):
            for part in slices(batch, body, SLICE):
                texts = [collapsed(t) for t in part.column(body).fill_null("").cast(pa.binary()).to_pylist()]
                found = [features(t, grams, buckets) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in carry), pa.array([t.count(b" ") + 1 if t else 0 for t in texts], pa.int64()),
                    pa.array(list(map(len, found)), pa.int64()), pa.array([f.astype(dtype).tobytes() for f in found], pa.binary())],
                    schema.names)

    return rows.mapInArrow(run, schema)


def _dtype(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(rows: DataFrame, found: str, buckets: int) -> np.ndarray:
    """Features per bucket over all rows: ``buckets`` sums, by task and then over the tasks."""
    dtype = _dtype(buckets)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in task(batches):
            for part in slices(batch, found):
                total += np.bincount(np.frombuffer(b"".join(part.column(found).to_pylist()), dtype), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int64()), "n": pa.array(total[some])})

    sums = rows.select(found).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def gains(counts: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored, of every bucket."""
    n = len(counts)
    all_s, all_t = float(counts.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * all_s / ((float(s) + 1) * all_t)))
                     for s, t in zip(counts.tolist(), target.tolist())], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise in thousandths, floored, from the first 32 bits of a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance_ranks(docs: DataFrame, target: DataFrame, carry: tuple[str, ...] = (), doc_id: str = "doc_id", text: str = "text",
                     target_text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
                     percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """``doc_id`` and the ``carry`` columns of every row, with ``n_features, weight, score, rank``.

    Of the N rows with at least ``min_words`` words the floor(percent * N / 100) highest scores
    are drawn and ranked 1, 2, ...; the rank of all others is null.
    """
    clash = {c.lower() for c in carry} & {"doc_id", "n_features", "weight", "score", "rank"}
    if clash:
        raise ValueError(f"columns to carry have the result's names: {sorted(clash)}")
    key = free_name(docs, "key")
    rows = staged(feature_rows(docs.withColumn(key, F.col(doc_id).cast("long")), text, [key, *carry], grams, buckets), "features")
    words, n, found = rows.columns[-3:]
    wanted = feature_rows(target.select(F.col(target_text).alias("text")), "text", [], grams, buckets)
    gain = gains(bucket_counts(rows, found, buckets), bucket_counts(wanted, "found", buckets))
    dtype = _dtype(buckets)
    scored_schema = T.StructType([T.StructField("doc_id", T.LongType()), *(rows.schema[c] for c in carry),
                                  *(T.StructField(c, T.LongType()) for c in ("words_", "n_features", "weight", "score"))])

    def score(batches):
        for batch in task(batches):
            for part in slices(batch, found):
                sums = [int(gain[np.frombuffer(b, dtype)].sum()) for b in part.column(found).to_pylist()]
                weight = [s // k if k else 0 for s, k in zip(sums, part.column(n).to_pylist())]
                scores = [w + noise(seed, i) for w, i in zip(weight, part.column(key).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(key), *(part.column(c) for c in carry), part.column(words), part.column(n),
                                                  pa.array(weight, pa.int64()), pa.array(scores, pa.int64())], scored_schema.names)

    scored = rows.mapInArrow(score, scored_schema).withColumn("far", F.col("words_") < min_words)
    order = [F.asc("far"), F.desc("score"), F.asc_nulls_last("doc_id")]
    spread = F.xxhash64(F.monotonically_increasing_id())  # equal rows fall on many partitions
    placed = staged(scored.withColumn("spread", spread).repartitionByRange(*order, "spread")
                    .sortWithinPartitions(*order, "spread").withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # a row per shuffle partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    drawn = placed.where(~F.col("far")).count() * percent // 100
    rank = F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return (placed.withColumn("part", part).join(F.broadcast(base), "part")
            .select("doc_id", *carry, "n_features", "weight", "score",
                    F.when(~F.col("far") & (rank <= drawn), rank).alias("rank")))


def importance_sample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, whole, in no particular order (:func:`importance_ranks`)."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    for option in ("doc_id", "text"):
        options[option] = names[options.get(option, option)]
    ranks = importance_ranks(own, target, carry=tuple(names.values()), **options)
    return ranks.where(F.col("rank").isNotNull()).select(*(F.col(n).alias(c) for c, n in names.items()))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all documents drawn towards the benchmark texts; every document's score."""
    return importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
