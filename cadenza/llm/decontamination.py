"""Benchmark decontamination by greedy string tiling.

A document leaks a benchmark item if tiles of the item cover enough of it, in whatever order
the document has them. Texts are compared as lower-cased words (runs of letters and digits).

1. Seeds. A document and an item are compared only if they share a seed: ``shortest``
   consecutive words (the whole item, if it has fewer). Every longer match begins with one.
2. Tiling. On the words of the document that its seeds with the item cover, matches are
   searched by a running Karp-Rabin hash, longest first: all unmarked stretches of the
   search length are hashed, equal ones verified and grown to maximal matches, and these
   are marked from the longest down unless a mark is in the way. A search length is repeated
   until it marks nothing and then halved, down to ``shortest``.
3. Coverage. The share of the item's words under marks, at least ``coverage`` for a leak.

A benchmark whose seeds number at most ``BROADCAST_SEEDS`` (counted, not assumed) goes to the
tasks as a table, and every document is judged where it lies without any shuffle. A larger one
is joined by its seeds: distinct (document, item) pairs that share a seed, then one tiling
per pair; a seed that very many documents have is an ordinary skewed join.

Defined cases: null and empty texts and items, or ones without a word, leak nothing; an item
that repeats is an item of its own; items with a null id are compared and reported with it;
repeated documents each get their verdict; empty tables give empty results; extra columns of the
documents are kept.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import free_name, on_workers, slices, staged, table, task

SHORTEST = 5
COVERAGE = 0.6
BROADCAST_SEEDS = 2_000_000
LEAK = "array<struct<item_id: long, item_words: int, covered: int, tiles: array<struct<doc_word: int, item_word: int, words: int>>>>"
LEAK_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("item_words", pa.int32()), ("covered", pa.int32()),
                                 ("tiles", pa.list_(pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()),
                                                               ("words", pa.int32())])))]))
words_of = re.compile(r"[^\W_]+").findall
BASE, MODULUS = 1_000_003, (1 << 61) - 1


def stretches(marked: list[bool], tokens: list[int]) -> list[tuple[int, int]]:
    """Runs (start, end) of unmarked tokens; negative tokens part runs too."""
    out, start = [], None
    for i, (m, t) in enumerate(zip(marked, tokens)):
        if m or t < 0:
            if start is not None:
                out.append((start, i))
                start = None
        elif start is None:
            start = i
    return out + [(start, len(tokens))] * (start is not None)


def rolling(tokens: list[int], start: int, end: int, size: int):
    """(position, Karp-Rabin hash) of every ``size`` tokens within start .. end."""
    if end - start < size:
        return
    out = pow(BASE, size - 1, MODULUS)
    h = 0
    for t in tokens[start:start + size]:
        h = (h * BASE + t + 1) % MODULUS
    yield start, h
    for i in range(start + size, end):
        h = ((h - (tokens[i - size] + 1) * out) * BASE + tokens[i] + 1) % MODULUS
        yield i - size + 1, h


def greedy_tiles(a: list[int], b: list[int], shortest: int) -> list[tuple[int, int, int]]:
    """Non-overlapping matches (position in a, position in b, length) of at least ``shortest``
    tokens, longest first. Negative tokens match nothing."""
    marks = [False] * len(a), [False] * len(b)
    tiles: list[tuple[int, int, int]] = []
    size = max((e - s for s, e in stretches(marks[1], b)), default=0)
    while size >= shortest:
        places = defaultdict(list)
        for s, e in stretches(marks[1], b):
            for at, h in rolling(b, s, e, size):
                places[h].append(at)
        found = []
        for s, e in stretches(marks[0], a):
            for i, h in rolling(a, s, e, size):
                for j in places.get(h, ()):
                    if i and j and a[i - 1] == b[j - 1] and not (marks[0][i - 1] or marks[1][j - 1]) and a[i - 1] >= 0:
                        continue  # part of the match that began one token before
                    n = 0
                    while (i + n < e and j + n < len(b) and a[i + n] == b[j + n] and not marks[1][j + n]):
                        n += 1
                    if n >= size:
                        found.append((n, i, j))
        marked = len(tiles)
        for n, i, j in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if not (any(marks[0][i:i + n]) or any(marks[1][j:j + n])):
                marks[0][i:i + n], marks[1][j:j + n] = [True] * n, [True] * n
                tiles.append((i, j, n))
        if len(tiles) > marked:
            continue  # what the new marks left of longer matches may still be this long
        size = max(shortest, size // 2) if size > shortest else 0
    return tiles


def seed_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive tokens; positions whose run holds a negative token get 0."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, ok = np.zeros(n, np.uint64), np.ones(n, bool)
    for j in range(size):
        part = tokens[j:j + n]
        ok &= part >= 0
        h = (h ^ (part.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return np.where(ok, np.maximum(h, np.uint64(1)), np.uint64(0))


class Items:
    """A benchmark as token ids of its own vocabulary, with an index of its seeds."""

    def __init__(self, rows: list[tuple[int | None, str | None]], shortest: int = SHORTEST, coverage: float = COVERAGE):
        self.shortest, self.coverage = shortest, coverage
        self.vocabulary: dict[str, int] = {}
        self.ids, self.tokens = [], []
        by_size: dict[int, list[tuple[np.ndarray, int]]] = defaultdict(list)
        for item_id, text in rows:
            words = words_of((text or "").lower())
            if not words:
                continue
            tokens = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            size = min(shortest, len(tokens))
            by_size[size].append((np.unique(seed_hashes(np.array(tokens), size)), len(self.ids)))
            self.ids.append(item_id)
            self.tokens.append(tokens)
        self.seeds = {}  # seed size -> (sorted hashes, item of each)
        for size, own in by_size.items():
            h = np.concatenate([x for x, _ in own])
            item = np.concatenate([np.full(len(x), i) for x, i in own])
            order = np.argsort(h, kind="stable")
            self.seeds[size] = h[order], item[order]

    def leak(self, item: int, doc: np.ndarray, hits: np.ndarray) -> dict | None:
        """Tiles of ``item`` on the tokens of ``doc`` that its seed ``hits`` (positions) cover, if enough."""
        own = self.tokens[item]
        size = min(self.shortest, len(own))
        within = np.unique((hits[:, None] + np.arange(size)).ravel())
        part = np.concatenate([[0], np.cumsum(np.diff(within) > 1)])  # a gap before each new run
        at = np.arange(len(within)) + part
        tokens = np.full(at[-1] + 1, -1)
        tokens[at] = doc[within]
        place = np.zeros(at[-1] + 1, np.int64)
        place[at] = within
        tiles = greedy_tiles(tokens.tolist(), own, size)
        covered = sum(n for _, _, n in tiles)
        if covered < self.coverage * len(own):
            return None
        return {"item_id": self.ids[item], "item_words": len(own), "covered": covered,
                "tiles": [{"doc_word": int(place[i]), "item_word": j, "words": n} for i, j, n in sorted(tiles)]}

    def leaks(self, texts: list[str | None]) -> list[list[dict]]:
        """For each text its leaked items. All texts are searched for seeds at once."""
        get = self.vocabulary.get
        tokens: list[int] = []
        starts = []
        for t in texts:
            starts.append(len(tokens))
            tokens.extend(map(get, words_of((t or "").lower()), repeat(-1)))
            tokens.append(-1)
        ids, first = np.array(tokens, np.int64), np.array(starts, np.int64)
        out: list[list[dict]] = [[] for _ in texts]
        for size, (seeds, item) in self.seeds.items():
            h = seed_hashes(ids, size)
            at = np.flatnonzero(h)
            low, high = np.searchsorted(seeds, h[at], "left"), np.searchsorted(seeds, h[at], "right")
            at, low, n = at[high > low], low[high > low], (high - low)[high > low]
            hit = np.repeat(at, n)
            which = item[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            doc = np.searchsorted(first, hit, "right") - 1
            order = np.lexsort((hit, which, doc))
            hit, which, doc = hit[order], which[order], doc[order]
            new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(which, prepend=-1) != 0))
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(hit)]):
                d = int(doc[a])
                found = self.leak(int(which[a]), ids[first[d]:], hit[a:b] - first[d])
                if found:
                    out[d].append(found)
        return out


def benchmark_seeds(benchmark: DataFrame, shortest: int) -> DataFrame:
    """``item_id, text, seed`` rows of the distinct seeds (words joined by blanks) of every item."""
    return _seed_rows(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), "item_id", shortest, True)


def _seed_rows(df: DataFrame, key: str, shortest: int, whole_if_short: bool, sizes: list[int] | None = None) -> DataFrame:
    def run(batches):
        for batch in batches:
            for k, t in zip(batch.column(key).to_pylist(), batch.column("text").to_pylist()):
                w = words_of((t or "").lower())
                use = [min(shortest, len(w))] if whole_if_short else sizes
                seeds = list({" ".join(w[i:i + s]) for s in use if s for i in range(len(w) - s + 1)})
                for at in range(0, len(seeds), 100_000):
                    own = seeds[at:at + 100_000]
                    yield pa.RecordBatch.from_pydict({key: pa.array([k] * len(own), pa.int64()), "seed": own})

    return df.select(key, "text").mapInArrow(run, f"{key} long, seed string")


def with_leaks(docs: DataFrame, benchmark: DataFrame, out: str = "leaks", shortest: int = SHORTEST,
               coverage: float = COVERAGE, text: str = "text", broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """``docs`` with ``out``: an array of the leaked items (item_id, item_words, covered, tiles)."""
    spark = docs.sparkSession
    on_workers(spark)
    if out in docs.columns:
        raise ValueError(f"documents already have a column {out!r}")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"[^\p{L}\p{N}]+"))  # at least the words of the item
    if (items.agg(F.sum(words)).first()[0] or 0) <= broadcast_seeds:
        shared = spark.sparkContext.broadcast(Items([tuple(r) for r in items.collect()], shortest, coverage))

        def judge(batches):
            for batch in task(batches):
                for part in slices(batch, text):
                    leaks = pa.array(shared.value.leaks(part.column(text).to_pylist()), LEAK_ARROW)
                    yield pa.RecordBatch.from_arrays([*part.columns, leaks], names=[*part.schema.names, out])

        return docs.mapInArrow(judge, T.StructType([*docs.schema.fields, T.StructField(out, T.DataType.fromDDL(LEAK))]))

    items = staged(items.withColumn("_item", F.monotonically_increasing_id()), "items")
    texts = staged(docs.select(F.col(text).alias("text")).where("text is not null").distinct()
                   .withColumn("_doc", F.monotonically_increasing_id()), "texts")
    item_seeds = staged(_seed_rows(items, "_item", shortest, True), "item-seeds")
    sizes = [r[0] for r in item_seeds.select(F.size(F.split("seed", " "))).distinct().collect()]
    doc_seeds = _seed_rows(texts, "_doc", shortest, False, sizes)
    pairs = staged(doc_seeds.join(item_seeds, "seed").select("_doc", "_item").distinct(), "pairs")
    both = (pairs.join(items.select("_item", "item_id", F.col("text").alias("item")), "_item")
            .join(texts, "_doc").select("_doc", "item_id", "item", "text"))

    def tile(batches):
        for batch in batches:
            for r in batch.to_pylist():
                for found in Items([(r["item_id"], r["item"])], shortest, coverage).leaks([r["text"]])[0]:
                    yield pa.RecordBatch.from_arrays([pa.array([r["_doc"]]), pa.array([[found]], LEAK_ARROW)], names=["_doc", "leaks"])

    found = both.mapInArrow(tile, f"_doc long, leaks {LEAK}").groupBy("_doc").agg(F.flatten(F.collect_list("leaks")).alias(out))
    found = found.join(texts, "_doc").select(F.col("text").alias("_text"), out)
    joined = docs.join(found, docs[text] == found["_text"], "left")
    return joined.select(*[docs[c] for c in docs.columns], F.coalesce(out, F.array().cast(LEAK)).alias(out))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per (document, leaked item): doc_id, item_id, item_words, covered, coverage, n_tiles, longest, tiles."""
    rows = with_leaks(docs.select("doc_id", "text"), benchmark, "leaks", **options)
    rows = rows.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
    return rows.select("doc_id", "item_id", "item_words", "covered", (F.col("covered") / F.col("item_words")).alias("coverage"),
                       F.size("tiles").alias("n_tiles"), F.array_max("tiles.words").alias("longest"), "tiles")


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without those that leak an item."""
    out = free_name(docs, "leaks")
    return with_leaks(docs, benchmark, out, **options).where(F.size(out) == 0).drop(out)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that leaks a benchmark item, with the item and its coverage."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("tiles")
