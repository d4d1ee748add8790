"""Nearest neighbours by cosine similarity.

Exact all-pairs top-k, done as a blocked matrix product on the executors:

1. Items are hashed into ``nb`` blocks of about ``block_size`` rows (ids are unique, so
   blocks are even and bounded); zero vectors are skipped. A block is packed into one row of
   binary columns: ids, and vectors in the element type they came in (4 bytes a float).
2. Blocks meet in tiles (:mod:`cadenza.operators.tiles`): a group of blocks as queries, a lane of
   blocks as rows, multiplied block by block in double precision. Queries carry their k best along,
   of equal scores the lower ids, so repeated vectors add no rows.
3. A window partitioned by item (at most k rows a lane) keeps the final top k.

Work is ``O(n²·d)`` as for any exact method; data moved is a copy of the items for every group and
lane, whose numbers follow the cores. :func:`similar_items_lsh` is the approximate escape for
catalogues where the quadratic cost is too high.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.operators import tiles
from cadenza.operators.tiles import OUT_SCHEMA, list_rows, packed_bytes, top, top_k_per_item
from cadenza.session import ship_package

# Fixed value of the original pipeline: 10 neighbours per item (11 fetched with itself).
SIMILAR_K = 10
DEFAULT_BLOCK = 1024
STRIPE = 512
COSINE, RECALL = 0.8, 0.9  # the approximate search finds pairs of this cosine with this probability

PACKED = "block int, ids binary, vectors binary"


def _merge(best: tuple[np.ndarray, np.ndarray] | None, new: tuple[np.ndarray, np.ndarray], k: int):
    """The k best of two per-row lists, of equal scores the lower ids."""
    if best is None:
        return new
    scores, ids = (np.concatenate(x, axis=1) for x in zip(best, new))
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)


def _block(row, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids (ascending) and unit vectors of a packed block."""
    ids = np.frombuffer(row.ids, "<i4")
    v = np.frombuffer(row.vectors, dtype).reshape(len(ids), -1).astype(np.float64)
    order = np.argsort(ids, kind="stable")
    return ids[order], (v / np.sqrt((v * v).sum(axis=1, keepdims=True)))[order]


def _pair_topk(k: int, dtype: str):
    def run(pdf):
        blocks = [_block(r, dtype) for r in pdf.sort_values("block").itertuples()]
        ids_l, left = blocks[0]
        ids_r, right = blocks[-1]
        same, out, columns = len(blocks) == 1, [], None
        for at in range(0, len(ids_l), STRIPE):
            own = ids_l[at:at + STRIPE]
            s = left[at:at + STRIPE] @ right.T
            if same:
                s[np.arange(len(own)), at + np.arange(len(own))] = -np.inf
            else:
                columns = _merge(columns, top(np.ascontiguousarray(s.T), own, k), k)
            out.append(list_rows(own, *top(s, ids_r, k)))
        if columns is not None:
            out.append(list_rows(ids_r, *columns))
        return pd.concat(out, ignore_index=True)
    return run


def _pack(dtype: str):
    def run(key, pdf):
        ids, vectors = pdf["item_id"].to_numpy("<i4"), np.stack(pdf["v"].to_numpy()).astype(dtype)
        return pd.DataFrame({"block": [key[0]], "ids": [ids.tobytes()], "vectors": [vectors.tobytes()]})
    return run


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """``item_id, v`` of the items whose vector has a length, and numpy's name of its element type."""
    rows = vectors.select(F.col(id_col).cast("int").alias("item_id"), F.col(vec_col).alias("v"))
    element = rows.schema["v"].dataType.elementType
    return rows.filter(F.exists("v", lambda x: x != 0)), "<f4" if isinstance(element, T.FloatType) else "<f8"


def similar_items(vectors: DataFrame, k: int = SIMILAR_K, block_size: int = DEFAULT_BLOCK,
                  id_col: str = "item_id", vec_col: str = "vector", n_blocks: int | None = None) -> DataFrame:
    """Exact cosine top ``k`` neighbours of every item, self excluded:
    ``item_id_1, item_id_2, score, rank``.

    ``n_blocks`` defaults to ``ceil(count / block_size)``. There is one count action.
    """
    ship_package(vectors.sparkSession)
    usable, dtype = _usable(vectors, id_col, vec_col)
    n = usable.count()
    if n_blocks is None:
        n_blocks = max(1, math.ceil(n / block_size))

    def pack(key, pdf):
        ids, packed = packed_bytes(pdf, dtype)
        return pd.DataFrame({"block": [key[0]], "ids": [ids], "vectors": [packed]})

    packed = (usable.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).cast("int"))
              .groupBy("block").applyInPandas(pack, PACKED))
    groups, lanes = tiles.shape(n, n_blocks, n, n_blocks, vectors.sparkSession.sparkContext.defaultParallelism)
    return tiles.nearest(packed, packed, k, dtype, groups, lanes, same_blocks=True)


def _own_or_pair(run):
    def group(key, pdf):
        if key[0] != key[1] and len(pdf) < 2:  # the other block of the pair holds no item
            return pd.DataFrame({"item_id_1": pd.Series([], dtype="int32"), "item_id_2": pd.Series([], dtype="int32"),
                                 "score": pd.Series([], dtype="float64")})
        return run(pdf)
    return group


def hyperplane_bits(n: int, bucket: int) -> int:
    """Bits that split ``n`` items into buckets of about ``bucket``."""
    return max(1, math.ceil(math.log2(max(2.0, n / bucket))))


def tables_for(bits: int, cosine: float = COSINE, recall: float = RECALL) -> int:
    """Tables of ``bits`` hyperplanes in which a pair of that cosine shares some bucket with
    probability ``recall``: it shares one with ``(1 - angle / pi) ** bits``. At least 12."""
    together = (1 - math.acos(cosine) / math.pi) ** bits
    return max(12, math.ceil(math.log(1 - recall) / math.log1p(-together)))


def similar_items_lsh(vectors: DataFrame, k: int = SIMILAR_K, tables: int | None = None, bucket: int = 512, most: int = 4096,
                      seed: int = 42, id_col: str = "item_id", vec_col: str = "vector", bits: int | None = None) -> DataFrame:
    """Approximate neighbours by random-hyperplane LSH, in the columns of :func:`similar_items`.

    An item has one bucket in each of ``tables`` tables: the sides of some hyperplanes its
    vector lies on, as many as split the catalogue into buckets of about ``bucket`` items. In
    a bucket, all items are compared: as one block, or above ``most`` items (a dense cluster,
    repeated vectors) as blocks of about ``most`` in the ordered pairs of :func:`similar_items`,
    so a task stays bounded and no pair is lost. Where these buckets hold more pairs than the
    whole catalogue, the exact search costs less and is taken.

    The number of tables follows the bits (:func:`tables_for`): at every size a pair of cosine
    0.8 is found with probability 0.9 (over the draw of the planes), a closer one with more.
    That takes 12 tables up to 7 bits, 28 at 11 (1 M items) and 71 at 15 (10 M); work and data
    grow as ``n · tables``. Pairs that share a bucket in no table are missed, mostly such of lower
    cosine, so items without near neighbours may have fewer than ``k``. ``bits`` and ``tables``
    can be given, to measure recall as of a larger catalogue.
    """
    ship_package(vectors.sparkSession)
    usable, dtype = _usable(vectors, id_col, vec_col)
    n, d = usable.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    bits = bits or hyperplane_bits(n, bucket)
    tables = tables or tables_for(bits)
    planes = np.random.default_rng(seed).normal(size=(d or 1, tables * bits))

    def place(batches):
        for pdf in batches:
            side = np.stack(pdf["v"].to_numpy()).astype(np.float64) @ planes > 0 if len(pdf) else np.zeros((0, tables * bits), bool)
            for t in range(tables):
                key = side[:, t * bits:(t + 1) * bits] @ (1 << np.arange(bits, dtype=np.int64))
                yield pdf.assign(key=key * tables + t)

    vector = usable.schema["v"].dataType.simpleString()
    placed = usable.mapInPandas(place, f"item_id int, v {vector}, key long")
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    crowded = sizes.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0.0
    if crowded > n * n:
        return similar_items(vectors, k, id_col=id_col, vec_col=vec_col)
    pack, topk = _pack(dtype), _pair_topk(k, dtype)
    if not crowded:
        found = placed.groupBy("key").applyInPandas(lambda key, pdf: topk(pack((0,), pdf)), OUT_SCHEMA)
        return top_k_per_item(found.dropDuplicates(["item_id_1", "item_id_2"]), k)
    parts = F.ceil(F.coalesce("n", F.lit(1)) / most).cast("int")
    parted = placed.join(sizes, "key", "left").select(
        "key", parts.alias("parts"), F.pmod(F.xxhash64("item_id"), parts).cast("int").alias("block"), "item_id", "v")
    packed = parted.groupBy("key", "parts", "block").applyInPandas(
        lambda key, pdf: pack((key[2],), pdf).assign(key=key[0], parts=key[1]), f"{PACKED}, key long, parts int")
    routed = packed.select("key", "block", "ids", "vectors", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        "key", "block", "ids", "vectors", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
    found = routed.groupBy("a", "b", "key").applyInPandas(_own_or_pair(topk), OUT_SCHEMA)
    return top_k_per_item(found.dropDuplicates(["item_id_1", "item_id_2"]), k)
