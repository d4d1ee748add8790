"""The k nearest rows of many queries by cosine, in tiles.

Queries and rows come packed, some hundreds to thousands a block. Blocks of queries are dealt into
groups, blocks of rows into lanes, and a tile, a group with a lane, is one stream of rows: the
group's queries, which stay in memory, then the lane's blocks one after the other. A block is
multiplied with the queries that look into it (all of them, or those whose ``probed`` bits hold its
cell), and as every query keeps its k best so far, only the few scores that reach its worst are looked
at further. A window ranks the lists of the lanes.

Data moved is a copy of the queries and of their lists for every lane, and of the rows for every group. Lanes
and groups follow the cores; only above ``TILE_ROWS`` queries a group the groups grow with the
queries, so that a tile's memory is bounded. Of equal scores the lower ids are kept.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OUT_SCHEMA = "item_id_1 int, item_id_2 int, score double"
QUERY_BLOCK = 1024
TILE_ROWS = 1 << 16     # queries of a tile, about, at most
LANE_ROWS = 1 << 18     # rows of a tile, about, at most
PRODUCT = 1 << 19       # scores in memory at once
PAIRS = 1 << 15         # single pairs scored at once
CROWD = 4               # candidates a list place, above which a query's scores are searched whole
TILES_PER_CORE = 3


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of every row, scores and ids, of equal scores those further left."""
    if scores.shape[1] <= k:
        return scores, np.broadcast_to(ids, scores.shape)
    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    better, tied = scores > kth, scores == kth
    room = k - better.sum(axis=1)
    crowded = np.flatnonzero(tied.sum(axis=1) > room)
    tied[crowded] &= np.cumsum(tied[crowded], axis=1) <= room[crowded, None]
    _, cols = np.nonzero(better | tied)
    cols = cols.reshape(len(scores), k)
    return np.take_along_axis(scores, cols, axis=1), np.take_along_axis(np.broadcast_to(ids, scores.shape), cols, axis=1)


def list_rows(owner: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> pd.DataFrame:
    out = pd.DataFrame({"item_id_1": np.repeat(owner, scores.shape[1]).astype("int32"), "item_id_2": ids.ravel().astype("int32"),
                        "score": scores.ravel().astype("float64")})
    return out[np.isfinite(out["score"])]


def packed_bytes(pdf: pd.DataFrame, dtype: str) -> tuple[bytes, bytes]:
    """Ids and vectors of ``item_id, v`` rows, by ascending id."""
    pdf = pdf.sort_values("item_id", kind="stable")
    return pdf["item_id"].to_numpy("<i4").tobytes(), np.stack(pdf["v"].to_numpy()).astype(dtype).tobytes()


def unit_vectors(ids: bytes, vectors: bytes, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and double precision vectors of length 1 of a packed block."""
    ids = np.frombuffer(ids, "<i4")
    v = np.frombuffer(vectors, dtype).reshape(len(ids), -1).astype(np.float64)
    return ids, v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def top_k_per_item(pairs: DataFrame, k: int) -> DataFrame:
    """``item_id_1, item_id_2, score, rank``: per item, score descending, ties lower id first."""
    w = Window.partitionBy("item_id_1").orderBy(F.desc("score"), F.asc("item_id_2"))
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


class Tile:
    """A group's queries and their k best rows so far."""

    def __init__(self, k: int, dtype: str, same_blocks: bool):
        self.k, self.dtype, self.same_blocks, self.parts, self.ids = k, dtype, same_blocks, [], None

    def add(self, part) -> None:
        self.parts.append(part)

    def _begin(self) -> None:
        sides = [unit_vectors(p.ids, p.vectors, self.dtype) for p in self.parts]
        self.ids, self.units = (np.concatenate(x) for x in zip(*sides))
        self.first = dict(zip((p.block for p in self.parts), np.cumsum([0] + [len(i) for i, _ in sides])))
        self.coarse, self.probed = self.units.astype(np.float32), None
        if self.parts[0].probed is not None:
            self.probed = np.concatenate([np.frombuffer(p.probed, np.uint8).reshape(len(i), -1) for p, (i, _) in zip(self.parts, sides)])
        self.parts = []
        self.scores = np.full((len(self.ids), self.k), -np.inf)
        self.found = np.full((len(self.ids), self.k), np.iinfo(np.int32).max, "<i4")

    def _merge(self, own: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[own], scores], axis=1), np.concatenate([self.found[own], ids], axis=1)
        order = np.lexsort((ids, -scores), axis=1)[:, :self.k]
        self.scores[own], self.found[own] = np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)

    def _hide_selves(self, own: np.ndarray, table: np.ndarray, block: int, ids: np.ndarray, hidden) -> None:
        """No query finds itself: its own place where queries and rows are the same blocks, else its id."""
        if self.same_blocks:
            if block in self.first:
                at = own - self.first[block]
                here = np.flatnonzero((at >= 0) & (at < len(ids)))
                table[here, at[here]] = hidden
            return
        low, high = (np.searchsorted(ids, self.ids[own], side) for side in ("left", "right"))
        while len(here := np.flatnonzero(low < high)):
            table[here, low[here]] = hidden
            low = low + 1

    def _exact(self, own: np.ndarray, units: np.ndarray, col: np.ndarray) -> np.ndarray:
        """Scores of single pairs: the same for equal vectors, wherever they lie."""
        return np.concatenate([np.einsum("ij,ij->i", self.units[own[at:at + PAIRS]], units[col[at:at + PAIRS]])
                               for at in range(0, len(own), PAIRS)])

    def compare(self, row) -> None:
        """Products in single precision tell which pairs may reach a query's worst score, within
        the error they can have; those are scored in double precision."""
        if self.ids is None:
            self._begin()
        ids, units = unit_vectors(row.ids, row.vectors, self.dtype)
        coarse, error = units.astype(np.float32), (units.shape[1] + 16) * 2.0 ** -23
        asking = np.arange(len(self.ids)) if self.probed is None else np.flatnonzero(self.probed[:, row.cell >> 3] >> (7 - row.cell % 8) & 1)
        stripe = max(1, PRODUCT // len(ids))
        for at in range(0, len(asking), stripe):
            own = asking[at:at + stripe]
            hits = self.coarse[own] @ coarse.T >= (self.scores[own, -1:] - error).astype(np.float32)
            self._hide_selves(own, hits, row.block, ids, False)
            counts = np.count_nonzero(hits, axis=1)
            many = own[counts > CROWD * self.k]
            if len(many):
                scores = self.units[many] @ units.T
                self._hide_selves(many, scores, row.block, ids, -np.inf)
                _, col = top(scores, np.arange(len(ids)), self.k)
                exact = self._exact(np.repeat(many, self.k), units, col.ravel())
                self._merge(many, exact.reshape(-1, self.k), ids[col])
            few = np.flatnonzero((counts > 0) & (counts <= CROWD * self.k))
            if len(few):
                line, col = np.nonzero(hits[few])
                n = counts[few]
                place = np.arange(len(line)) - np.repeat(np.cumsum(n) - n, n)
                near, near_ids = np.full((len(few), n.max()), -np.inf), np.zeros((len(few), n.max()), "<i4")
                near[line, place], near_ids[line, place] = self._exact(own[few[line]], units, col), ids[col]
                self._merge(own[few], near, near_ids)

    def lists(self):
        if self.ids is not None:
            for at in range(0, len(self.ids), PRODUCT // self.k):
                piece = slice(at, at + PRODUCT // self.k)
                yield list_rows(self.ids[piece], self.scores[piece], self.found[piece])


def _stream(k: int, dtype: str, same_blocks: bool):
    """Rows of tiles, each one's queries first, as the lists of their queries."""
    def run(batches):
        number, tile = None, None
        for pdf in batches:
            for row in pdf.itertuples():
                if row.tile != number:
                    if tile is not None:
                        yield from tile.lists()
                    number, tile = row.tile, Tile(k, dtype, same_blocks)
                if not row.is_row:
                    tile.add(row)
                elif tile.parts or tile.ids is not None:  # else a group without queries
                    tile.compare(row)
        if tile is not None:
            yield from tile.lists()
    return run


def shape(queries: int, query_blocks: int, rows: int, row_blocks: int, cores: int) -> tuple[int, int]:
    """Groups and lanes: about ``TILES_PER_CORE`` tiles a core, fewer where there are fewer blocks; more
    groups than lanes, as queries move with their lists."""
    tiles = TILES_PER_CORE * cores
    lanes = max(1, min(row_blocks, max(round(math.sqrt(tiles / 2)), math.ceil(rows / LANE_ROWS))))
    groups = max(1, min(query_blocks, max(math.ceil(tiles / lanes), math.ceil(queries / TILE_ROWS))))
    return groups, max(lanes, min(row_blocks, math.ceil(tiles / groups)))


def nearest(queries: DataFrame, rows: DataFrame, k: int, dtype: str, groups: int, lanes: int, same_blocks: bool = False) -> DataFrame:
    """``item_id_1, item_id_2, score, rank`` of packed ``queries`` (block, ids, vectors, and where they look
    into some cells only: probed) among packed ``rows`` (block, ids, vectors, cell). With ``same_blocks`` both
    sides are one table, and a row of it is the query of the same block and place."""
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    probed = F.col("probed") if "probed" in queries.columns else F.lit(None).cast("binary")
    cell = F.col("cell") if "cell" in rows.columns else F.lit(0)
    asked = queries.select("block", "ids", "vectors", probed.alias("probed"), F.lit(0).alias("cell"), F.lit(False).alias("is_row"),
                           each(lanes).alias("other")).withColumn("tile", F.pmod("block", F.lit(groups)) * lanes + F.col("other"))
    held = rows.select("block", "ids", "vectors", F.lit(None).cast("binary").alias("probed"), cell.alias("cell"), F.lit(True).alias("is_row"),
                       each(groups).alias("other")).withColumn("tile", F.col("other") * lanes + F.pmod("block", F.lit(lanes)))
    sides = asked.unionByName(held).drop("other")
    found = (sides.repartitionById(groups * lanes, F.col("tile")).sortWithinPartitions("tile", "is_row", "block")
             .mapInPandas(_stream(k, dtype, same_blocks), OUT_SCHEMA))
    return top_k_per_item(found, k)
