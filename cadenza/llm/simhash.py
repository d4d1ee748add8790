"""SimHash near-duplicates: 64-bit fingerprints linked within a few bits, found with a
pivot distance table.

Fingerprint. A text is lower-cased in A-Z and split into words at ASCII white space; every
four-word shingle, repeats included, is hashed with XXH64 (seed 42); a bit of the fingerprint
is 1 if it is set in over half of the hashes. A text with fewer words is one shingle; a text
without words has fingerprint zero and is linked like any other.

Search. Only distinct fingerprints are compared. Fingerprints that differ in at most ``bits``
of 64 agree on at least ``blocks - bits`` of any ``blocks`` blocks, so every such pair meets
in a group keyed by some choice of that many block values; the number of blocks follows from
the number of fingerprints, so that a group holds a handful on average. In a group the pivot
table decides: the Hamming distances of each fingerprint to ``PIVOTS`` reference fingerprints
are computed once, a pair is discarded when any coordinate differs by more than ``bits`` (the
triangle inequality makes that safe), and survivors are verified by their own distance.

A group above ``TILE`` fingerprints is split into blocks, and each pair of blocks is a group
of its own: exact, and bounded in memory. Tasks return a spanning forest of the links they
find, never all pairs, and components are joined up over these.

Defined cases: a null text counts as empty; rows that share a doc_id are documents of their
own with that id; a null doc_id takes part in linking but can only be a component's id if no
other is there; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import free_name, on_workers, slices, staged, table, task
from cadenza.llm.components import connected_components

SEED = 42
PIVOTS = 24
TILE = 2048
GROUP = 4.0     # fingerprints expected in a group, at most
ROWS = 200_000  # rows of groups that a task works on at once, besides one unfinished group


def fingerprint(text: str | None, words: int = 4) -> int:
    """The 64-bit fingerprint of one whole text."""
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return 0
    joined = b" ".join(own)
    digest = xxhash.xxh64_intdigest
    if len(own) < words:
        return digest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in own])
    starts = np.concatenate([[0], ends[:-1]])[:len(own) - words + 1].tolist()
    ends = (ends[words - 1:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):  # bounds the bit matrix of a very long text
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)])),
                        np.dtype("<u8"))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, doc_id: str = "doc_id", text: str = "text", **longs: Column) -> DataFrame:
    """``doc_id, fp`` of every row (``fp``: the fingerprint's 64 bits as a signed long), and the
    ``longs`` by name."""
    on_workers(docs.sparkSession)
    names = list(longs)

    def run(batches):
        for batch in task(batches):
            for part in slices(batch, "text"):
                fp = np.fromiter((fingerprint(t.as_py(), words) for t in part.column("text")), np.uint64, part.num_rows)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "fp": pa.array(fp.view(np.int64))}
                                                 | {c: part.column(c) for c in names})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       *(v.alias(c) for c, v in longs.items()))
    return rows.mapInArrow(run, "doc_id long, fp long" + "".join(f", {c} long" for c in names))


def block_bounds(blocks: int) -> list[int]:
    return [round(64 * i / blocks) for i in range(blocks + 1)]


def blocks_for(n: int, bits: int) -> int:
    """The fewest blocks whose groups are expected to hold GROUP of ``n`` random fingerprints at most."""
    blocks = bits + 1
    while n / 2.0 ** (64 * (blocks - bits) / blocks) > GROUP and blocks < 3 * bits + 3:
        blocks += 1
    return blocks


def group_keys(fp: np.ndarray, blocks: int, bits: int) -> np.ndarray:
    """A hash of (choice of blocks, their values) for every choice: an array (choices, len(fp))."""
    cut = block_bounds(blocks)
    mask = [np.uint64(((1 << (b - a)) - 1) << a) for a, b in zip(cut[:-1], cut[1:])]
    keys = []
    for i, choice in enumerate(combinations(range(blocks), blocks - bits)):
        kept = fp & np.bitwise_or.reduce([mask[c] for c in choice])
        h = (kept ^ np.uint64(0x9E3779B97F4A7C15 * (i + 1) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        keys.append((h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB))
    return np.array(keys)


def pivots(n: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: fixed by rule, evenly random."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, n, dtype=np.uint64, endpoint=False)


def links_in_groups(group: np.ndarray, side: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of all linked pairs within runs of equal ``group``.

    Pairs are visited by their distance in the run, all runs at once. ``side`` is 0 for a
    whole group; in a pair of blocks (1 and 2) only pairs across the two are asked for.
    """
    coordinates = [np.bitwise_count(fp ^ p).astype(np.int8) for p in pivots()]
    found_i, found_j = [], []
    i = np.arange(len(fp) - 1)
    for lag in range(1, len(fp)):
        i = i[i + lag < len(fp)]
        i = i[group[i] == group[i + lag]]
        if not len(i):
            break
        a = i[(side[i] == 0) | (side[i] != side[i + lag])]
        for c in coordinates:  # the largest coordinate difference, one coordinate after the other
            if not len(a):
                break
            a = a[np.abs(c[a] - c[a + lag]) <= bits]
        a = a[np.bitwise_count(fp[a] ^ fp[a + lag]) <= bits]
        found_i.append(a)
        found_j.append(a + lag)
    none = [np.empty(0, np.int64)]
    return np.concatenate(found_i or none), np.concatenate(found_j or none)


def forest(fp: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (fingerprint, smallest fingerprint it reaches) of the links (i, j)."""
    values, at = np.unique(fp[np.concatenate([i, j])], return_inverse=True)
    a, b = at[:len(i)], at[len(i):]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def link_edges(distinct: DataFrame, bits: int, n: int) -> DataFrame:
    """Edges (a, b) whose components are those of all links within ``bits`` among the distinct ``fp``."""
    blocks = blocks_for(n, bits)

    def spread(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            keys = group_keys(fp, blocks, bits)
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys.ravel().view(np.int64)),
                                              "fp": pa.array(np.tile(fp.view(np.int64), len(keys)))})

    def search(batches):
        held: list[pa.Table] = []
        rows = 0

        def links(t: pa.Table):
            if t.num_rows < 2:
                return
            key, i, j, side = (t.column(c).to_numpy() for c in ("key", "i", "j", "side"))
            group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))])
            fp = t.column("fp").to_numpy().view(np.uint64)
            a, b = forest(fp, *links_in_groups(group, side, fp, bits))
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows >= ROWS:
                t = pa.concat_tables(held).combine_chunks()
                own = [t.column(c).to_numpy() for c in ("key", "i", "j")]
                whole = int(np.flatnonzero(np.logical_or.reduce([c != c[-1] for c in own]))[-1:].sum() + 1) if any(
                    c[0] != c[-1] for c in own) else 0
                yield from links(t.slice(0, whole))
                held, rows = [t.slice(whole)], t.num_rows - whole
        if held:
            yield from links(pa.concat_tables(held).combine_chunks())

    rows = distinct.mapInArrow(spread, "key long, fp long")
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > TILE)
    parts = F.coalesce(F.ceil(F.col("n") / F.lit(TILE)), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(F.lit(7), "fp"), parts).cast("int")
    tiles = (rows.join(sizes, "key", "left")
             .select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
             .select("key", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1)
                     .otherwise(2).alias("side")))
    order = ["key", "i", "j"]
    return tiles.repartition(*order).sortWithinPartitions(*order).mapInArrow(search, "a long, b long")


def components(rows: DataFrame, first: Column, bits: int) -> DataFrame:
    """``fp, first_id, root`` of every distinct fingerprint: ``first`` aggregated over its rows, and
    the fingerprint that names its component of links within ``bits`` bits."""
    distinct = staged(rows.groupBy("fp").agg(first.alias("first_id")), "distinct")
    edges = staged(link_edges(distinct.select("fp"), bits, distinct.count()), "links")
    roots = staged(connected_components(edges), "roots")
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, bits: int = 4, words: int = 4, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the component of links within ``bits`` bits,
    named by its smallest doc_id."""
    rows = staged(fingerprints(docs, words, doc_id, text), "fingerprints")
    nodes = components(rows, F.min("doc_id"), bits)
    named = nodes.join(nodes.groupBy("root").agg(F.min("first_id").alias("component_id")), "root")
    return rows.join(named.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprint and component, links at 4 bits or fewer."""
    found = near_duplicates(table(spark, sf_dir, "documents"), bits=4, words=4)
    return found.select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, bits: int = 4, words: int = 4) -> DataFrame:
    """``docs`` with one row of each component: the one of its smallest doc_id, null ids last (of
    rows that share that id, the one whose columns hash lowest, maps as JSON).

    Rows are told apart by a number of their own, not by doc_id, which may be null or repeat
    in other components. It is written with them, so that both reads see the same numbers.
    """
    row = free_name(docs, "row")
    hashed = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema.fields]
    own = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    rows = staged(fingerprints(own, words, row=F.col(row), digest=F.xxhash64(*hashed)), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "row")
    keep = components(rows, F.min(first), bits).groupBy("root").agg(F.min("first_id").alias("first_id"))
    return own.join(keep.select(F.col("first_id.row").alias(row)), row, "left_semi").select(*docs.columns)
