"""Approximate neighbours from an inverted index of cells, with measured recall.

:func:`fit_cells` places cell centres by k-means (Spark ML, cosine distance) on a sample of about
``SAMPLE_PER_CELL`` vectors a cell; :func:`build_index` then puts every vector, sampled or not, into the
cell of its nearest centre. A query looks into the ``probes`` cells whose centres are
nearest to it and compares itself exactly with all vectors there.

How many probes it takes is measured, not assumed: :func:`calibrated_probes` finds the true
neighbours of a query set by comparing it with every row (in packed blocks), looks up at which
place in a query's order of cells each true neighbour's cell comes, and takes the least
number of probes that reaches the wanted recall. That is one exact pass for the query set
and no trial searches.

Cells are packed in blocks of about ``BLOCK`` vectors, so a cell that holds a third of all vectors
becomes many bounded blocks, and none is left out. A query moves with one bit per cell that says whether
it looks there, not once per probe: queries and cells meet in tiles (:mod:`cadenza.operators.tiles`),
whose number follows the cores, so data moved grows as the rows do, whatever the probes are.

Ids are INT; rows with a null vector, or one of length zero, have no cosine and are left out.
Scores are cosines in double precision, of equal ones the lower id goes first.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators import tiles
from cadenza.operators.numbering import stored
from cadenza.operators.similar import PACKED, SIMILAR_K, STRIPE, _usable
from cadenza.operators.tiles import QUERY_BLOCK, packed_bytes
from cadenza.session import ship_package

SAMPLE_PER_CELL = 64
BLOCK = 4096
ITERATIONS = 10
RECALL = 0.9
SIDE = "cell int, part int, ids binary, vectors binary"
PROBING = f"{PACKED}, probed binary"


def default_cells(n: int) -> int:
    """About the square root of the number of vectors: cells and vectors a cell are balanced."""
    return max(1, math.isqrt(n))


def fit_cells(vectors: DataFrame, cells: int, seed: int = 42, id_col: str = "item_id", vec_col: str = "vector") -> np.ndarray:
    """Unit centres (cells x d; fewer where the data has fewer different directions), from the vectors
    whose ids hash below a bound: about ``SAMPLE_PER_CELL`` a cell, so their number follows the cells, not the rows."""
    usable, _ = _usable(vectors, id_col, vec_col)
    n = usable.count()
    if not n:
        return np.zeros((1, 1))
    share = cells * SAMPLE_PER_CELL / n
    sample = usable.where(F.pmod(F.xxhash64("item_id", F.lit(seed)), F.lit(1 << 40)) < int(min(1.0, share) * (1 << 40)))
    sample = stored(sample.select(array_to_vector(F.col("v").cast("array<double>")).alias("features")), "cell-sample")
    model = KMeans(k=cells, seed=seed, maxIter=ITERATIONS, initMode="random", distanceMeasure="cosine").fit(sample)
    centres = np.array(model.clusterCenters())
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)


def cell_order(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The cells of every vector, nearest first, of equally near ones the lower number."""
    return np.argsort(-(vectors @ centres.T), axis=1, kind="stable")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def in_cells(usable: DataFrame, centres: np.ndarray, probes: int = 1) -> DataFrame:
    """``item_id, v, cell``: every row once for each of its ``probes`` nearest cells."""
    shared = usable.sparkSession.sparkContext.broadcast(centres)

    def place(batches):
        for pdf in batches:
            for at in range(0, len(pdf), STRIPE):
                own = pdf.iloc[at:at + STRIPE]
                cells = cell_order(_matrix(own["v"]), shared.value)[:, :probes]
                yield own.loc[own.index.repeat(cells.shape[1])].assign(cell=cells.ravel().astype("int32"))

    return usable.mapInPandas(place, f"item_id int, v {usable.schema['v'].dataType.simpleString()}, cell int")


def packed(placed: DataFrame, dtype: str, block: int = BLOCK) -> DataFrame:
    """``cell, part, ids, vectors``: each cell's rows in parts of about ``block``, dealt out by a hash. What
    is broadcast is a number per cell."""
    size = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))

    def pack(key, pdf):
        ids, vectors = packed_bytes(pdf, dtype)
        return pd.DataFrame({"cell": [key[0]], "part": [key[1]], "ids": [ids], "vectors": [vectors]})

    parted = placed.join(F.broadcast(size), "cell").withColumn("part", F.pmod(F.xxhash64("item_id"), F.col("parts")).cast("int"))
    return parted.groupBy("cell", "part").applyInPandas(pack, SIDE)


def build_index(vectors: DataFrame, centres: np.ndarray, id_col: str = "item_id", vec_col: str = "vector") -> DataFrame:
    """Every vector in its cell, packed; write it to search it more than once."""
    usable, dtype = _usable(vectors, id_col, vec_col)
    ship_package(vectors.sparkSession)
    return packed(in_cells(usable, centres), dtype)


def probing(usable: DataFrame, dtype: str, blocks: int, centres: np.ndarray | None = None, probes: int = 1) -> DataFrame:
    """``block, ids, vectors, probed``: queries in blocks dealt out by a hash; ``probed`` has a bit for each
    cell, set for a query's ``probes`` nearest (none without ``centres``: such a query looks everywhere)."""
    shared = usable.sparkSession.sparkContext.broadcast(centres)

    def pack(key, pdf):
        pdf, cells, bits = pdf.sort_values("item_id", kind="stable"), shared.value, None
        ids, vectors = packed_bytes(pdf, dtype)
        if cells is not None:
            looks = np.zeros((len(pdf), len(cells)), bool)
            for at in range(0, len(pdf), STRIPE):
                near = cell_order(_matrix(pdf["v"].iloc[at:at + STRIPE]), cells)[:, :probes]
                np.put_along_axis(looks[at:at + STRIPE], near, True, axis=1)
            bits = np.packbits(looks, axis=1).tobytes()
        return pd.DataFrame({"block": [key[0]], "ids": [ids], "vectors": [vectors], "probed": [bits]})

    return (usable.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
            .groupBy("block").applyInPandas(pack, PROBING))


def compared(queries: DataFrame, rows: DataFrame, k: int, dtype: str, centres: np.ndarray | None = None, probes: int = 1) -> DataFrame:
    """The k best of packed ``rows`` (``cell, part, ids, vectors``) for every query (``item_id, v``), among those
    in its ``probes`` nearest cells, or among all without ``centres``. ``rows`` are read several times."""
    n, (n_rows, row_blocks) = queries.count(), rows.agg(F.coalesce(F.sum(F.length("ids") / 4), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(1, math.ceil(n / QUERY_BLOCK))
    groups, lanes = tiles.shape(n, blocks, int(n_rows), row_blocks, queries.sparkSession.sparkContext.defaultParallelism)
    dealt = rows.select("ids", "vectors", "cell", F.pmod(F.xxhash64("cell", "part"), F.lit(1 << 30)).cast("int").alias("block"))
    return tiles.nearest(probing(queries, dtype, blocks, centres, probes), dealt, k, dtype, groups, lanes)


def exact_neighbours(queries: DataFrame, vectors: DataFrame, k: int = SIMILAR_K, id_col: str = "item_id",
                     vec_col: str = "vector") -> DataFrame:
    """The true k nearest of every query among all rows: the same comparison, looking everywhere."""
    ship_package(vectors.sparkSession)
    asked, _ = _usable(queries, id_col, vec_col)
    rows, dtype = _usable(vectors, id_col, vec_col)
    return compared(asked, stored(packed(rows.withColumn("cell", F.lit(0)), dtype), "rows"), k, dtype)


def search(index: DataFrame, queries: DataFrame, centres: np.ndarray, probes: int, k: int = SIMILAR_K,
           id_col: str = "item_id", vec_col: str = "vector") -> DataFrame:
    """``item_id_1, item_id_2, score, rank``: the k nearest that are found in ``probes`` cells of each query.
    ``queries`` have the element type of the indexed vectors."""
    ship_package(queries.sparkSession)
    usable, dtype = _usable(queries, id_col, vec_col)
    return compared(usable, index, k, dtype, centres, probes)


def probe_places(truth: DataFrame, queries: DataFrame, vectors: DataFrame, centres: np.ndarray, id_col: str = "item_id",
                 vec_col: str = "vector") -> DataFrame:
    """``truth`` (item_id_1, item_id_2) with ``place``: where the second's cell comes, from 1, in the first's order of cells."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)
    asked, _ = _usable(queries, id_col, vec_col)
    rows, _ = _usable(vectors, id_col, vec_col)
    cells = in_cells(rows.join(truth.select(F.col("item_id_2").alias("item_id")).distinct(), "item_id", "left_semi"), centres)
    pairs = (truth.select("item_id_1", "item_id_2").join(cells.select(F.col("item_id").alias("item_id_2"), "cell"), "item_id_2")
             .join(asked.select(F.col("item_id").alias("item_id_1"), "v"), "item_id_1"))

    def place(batches):
        for pdf in batches:
            for at in range(0, len(pdf), STRIPE):
                own = pdf.iloc[at:at + STRIPE]
                order = cell_order(_matrix(own["v"]), shared.value)
                found = (order == own["cell"].to_numpy()[:, None]).argmax(axis=1) + 1
                yield own[["item_id_1", "item_id_2"]].assign(place=found.astype("int32"))

    return pairs.mapInPandas(place, "item_id_1 int, item_id_2 int, place int")


def calibrated_probes(places: DataFrame, recall: float = RECALL) -> int:
    """The least number of probes that finds ``recall`` of the pairs of :func:`probe_places`."""
    counts = sorted((r["place"], r["count"]) for r in places.groupBy("place").count().collect())  # a row per cell, at most
    wanted, got = recall * sum(n for _, n in counts), 0
    for place, n in counts:
        got += n
        if got >= wanted - 1e-9:
            return place
    return 1


def similar_items_ivf(vectors: DataFrame, k: int = SIMILAR_K, cells: int | None = None, recall: float = RECALL, every: int = 50,
                      seed: int = 42, id_col: str = "item_id", vec_col: str = "vector") -> tuple[DataFrame, dict]:
    """Approximate neighbours of all rows, and what was measured: cells, probes, and the queries and
    true pairs they were calibrated on (rows whose id is divisible by ``every``, against all rows)."""
    n = vectors.count()
    centres = fit_cells(vectors, min(cells or default_cells(n), max(1, n)), seed, id_col, vec_col)
    index = stored(build_index(vectors, centres, id_col, vec_col), "index")
    asked = vectors.where(F.col(id_col) % every == 0)
    truth = stored(exact_neighbours(asked, vectors, k, id_col, vec_col), "truth")
    places = stored(probe_places(truth, asked, vectors, centres, id_col, vec_col), "places")
    probes = calibrated_probes(places, recall)
    found = search(index, vectors, centres, probes, k, id_col, vec_col)
    return found, {"cells": len(centres), "probes": probes, "true_pairs": places.count(), "index": index, "truth": truth}
