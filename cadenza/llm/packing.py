"""Packing of tokenised documents into sequences, as a cutting-stock problem.

Documents are cut every ``length`` tokens; what remains of each is a piece of 1 to
``length`` tokens. Piece lengths, rounded up to the width of a length class, form a histogram of about
``CLASSES`` classes: the demands of a cutting-stock problem whose stock is the
sequence. Short pieces would lose much to that rounding, so as many of one exact length as a class
is wide are bundled: ten pieces of 7 tokens, at a width of 10, are one piece of class 7 and waste nothing. The driver solves its linear program over that histogram (whose size does not
depend on the data) by column generation: a basis of patterns, and a knapsack dynamic
program that prices the pattern to enter. The solution is rounded down, the few pieces left
over are packed by best fit on their classes, and Spark assigns pattern places to pieces:
a piece's rank within its class, in order of (doc_id, start), names its pattern, its
sequence and its place in it by arithmetic on a table of patterns.

What is shuffled are rows of a few numbers per piece: once by range to rank them (with ties
split by row, so that any class or repeated row spreads over tasks) and once by sequence to
add up offsets. Texts are read and encoded once, where they lie.

Defined cases: a null text counts as empty; with ``end_id`` an empty text has that one
token, without it no piece at all; repeated rows are packed each on its own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import on_workers, ragged, slices, staged, table, task
from cadenza.llm.tokens import SLICE, encoder

CLASSES = 400     # length classes of a sequence, about
GAP = 5e-4        # the linear program stops this close to a proven bound
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int | None, length: int, doc_id: str = "doc_id",
                 text: str = "text", with_ids: bool = False, slice_bytes: int = SLICE) -> DataFrame:
    """Encode every whole text and cut it every ``length`` tokens: PIECES, and with
    ``with_ids`` the bytes of each piece's little-endian uint32 ids in ``ids``. A task encodes
    about ``slice_bytes`` of texts at once."""
    on_workers(docs.sparkSession)

    def run(batches):
        for batch in task(batches):
            for part in slices(batch, "text", slice_bytes):
                ids, offsets = encoder(tokenizer).encode(part.column("text"), end_id)
                n = np.diff(offsets)
                cuts = -(-n // length)
                doc = np.repeat(np.arange(len(n)), cuts)
                start = ragged(cuts, np.zeros(len(n), np.int64)).astype(np.int64) * length
                size = np.minimum(length, n[doc] - start)
                at = offsets[doc] + start
                raw = [ids[a:b].astype("<u4").tobytes() for a, b in zip(at.tolist(), (at + size).tolist())]
                cols = {"doc_id": part.column("doc_id").take(pa.array(doc)), "start": pa.array(start),
                        "length": pa.array(size), "ids_crc32": pa.array([zlib.crc32(b) for b in raw], pa.int64()),
                        "doc_tokens": pa.array(n[doc])}
                yield pa.RecordBatch.from_pydict(cols | ({"ids": pa.array(raw, pa.binary())} if with_ids else {}))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, PIECES + ", ids binary" * with_ids)


def priced_pattern(value: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The knapsack: how many of each class (ascending ``size``) give the most ``value`` within capacity."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(size, np.arange(capacity + 1), side="right")
    for w in range(1, capacity + 1):
        best[w] = best[w - 1]
        if k := fitting[w]:
            gain = best[w - size[:k]] + value[:k]
            c = int(gain.argmax())
            if gain[c] > best[w] + 1e-12:
                best[w], took[w] = gain[c], c
    counts, w = np.zeros(len(size), np.int64), capacity
    while w > 0:
        if took[w] < 0:
            w -= 1
        else:
            counts[took[w]] += 1
            w -= size[took[w]]
    return float(best[capacity]), counts


def generate_columns(size: np.ndarray, demand: np.ndarray, capacity: int,
                     gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """The linear program min sum(x), patterns @ x = demand: basis patterns (columns) and x.

    Starts from one-class patterns. Two bounds from below are known: the room that all pieces
    take, and sum(x) / v with ``v`` the best priced value. The search ends when nothing prices
    above 1 or one of them is near.
    """
    room = demand @ size / capacity
    patterns = np.diag(capacity // size).astype(float)
    inverse, x = np.diag(1 / np.diag(patterns)), demand / np.diag(patterns)
    while True:
        price = inverse.sum(axis=0)
        v, column = priced_pattern(price, size, capacity)
        total = x.sum()
        if v <= 1 + 1e-7 or total - max(total / v, room) <= max(0.25, gap * total):
            return patterns, np.maximum(x, 0)
        u = inverse @ column
        ratio = np.where(u > 1e-9, x / np.where(u > 1e-9, u, 1), np.inf)
        leaves = int(ratio.argmin())
        step = ratio[leaves]
        x = np.maximum(x - step * u, 0)
        x[leaves] = step
        row = inverse[leaves] / u[leaves]
        inverse -= np.outer(u, row)
        inverse[leaves] = row
        patterns[:, leaves] = column


def best_fit(size: np.ndarray, counts: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns, one per sequence, for ``counts`` pieces of each class: largest first, tightest fit."""
    bins: list[np.ndarray] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    for c in np.argsort(-size, kind="stable"):
        for _ in range(int(counts[c])):
            room = next((r for r in range(int(size[c]), capacity + 1) if by_room[r]), None)
            if room is None:
                bins.append(np.zeros(len(size), np.int64))
                room, b = capacity, len(bins) - 1
            else:
                b = by_room[room].pop()
            bins[b][c] += 1
            by_room[room - int(size[c])].append(b)
    return bins


@dataclass
class Plan:
    """Where the r-th piece of a class goes. Segments (class by class, pattern by pattern)
    hold ``share`` consecutive ranks per sequence."""

    first: dict[int, int]   # class -> position of its rank 0 among all pieces
    end: np.ndarray         # segment ends in these positions
    start: np.ndarray
    share: np.ndarray       # pieces of the class in one sequence of the pattern
    sequence: np.ndarray    # first sequence of the pattern
    slot: np.ndarray        # places before the class within the sequence
    sequences: int

    def place(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = np.searchsorted(self.end, position, side="right")
        nth = position - self.start[s]
        return self.sequence[s] + nth // self.share[s], self.slot[s] + nth % self.share[s]


def plan_patterns(histogram: dict[int, int], capacity: int, gap: float = GAP) -> Plan:
    """Solve for the histogram {class: pieces}, round, and lay out the sequences."""
    size = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[c] for c in size.tolist()], np.int64)
    found, x = generate_columns(size, demand.astype(float), capacity, gap) if len(size) else (np.zeros((0, 0)), [])
    uses: dict[tuple, int] = {}
    left = demand.copy()
    for column, n in zip(np.rint(found.T).astype(np.int64), np.floor(np.asarray(x) + 1e-9).astype(np.int64)):
        n = min(int(n), int(min((left[c] // column[c] for c in np.flatnonzero(column)), default=0)))
        if n:
            uses[tuple(column.tolist())] = uses.get(tuple(column.tolist()), 0) + n
            left -= column * n
    for pattern in best_fit(size, left, capacity):
        uses[tuple(pattern.tolist())] = uses.get(tuple(pattern.tolist()), 0) + 1
    by_class: list[list[tuple[int, int, int, int]]] = [[] for _ in size]
    sequences = 0
    for pattern, n in uses.items():
        slot = 0
        for c in range(len(size) - 1, -1, -1):
            if pattern[c]:
                by_class[c].append((n * pattern[c], pattern[c], sequences, slot))
                slot += pattern[c]
        sequences += n
    flat = np.array([s for own in by_class for s in own], np.int64).reshape(-1, 4)
    end = np.cumsum(flat[:, 0])
    first = dict(zip(size.tolist(), np.concatenate([[0], np.cumsum(demand)]).tolist()))
    return Plan(first, end, end - flat[:, 0], flat[:, 1], flat[:, 2], flat[:, 3], sequences)


def ranked(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """``pieces`` with ``rank``: the row's 0-based place within its ``cls``, in order of ``keys``.

    Rows are dealt out by ranges of (class, keys, row) and sorted there, so a class of any
    size takes many tasks; ranks are a task's first rank of the class, a prefix sum over the
    (task, class) counts, plus the place within the task. Those counts are as many rows as
    there are tasks and classes together.
    """
    order = [F.col("cls"), *(F.col(k).asc_nulls_first() for k in keys), F.col("row")]
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(pieces.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(tasks, *order)
                    .sortWithinPartitions(*order)
                    .withColumn("task", F.spark_partition_id())
                    .withColumn("row", F.monotonically_increasing_id()), "ranked")
    firsts = placed.groupBy("task", "cls").agg(F.min("row").alias("first_row"), F.count("*").alias("n"))
    before = Window.partitionBy("cls").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select("task", "cls", "first_row", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (placed.join(F.broadcast(firsts), ["task", "cls"])
            .withColumn("rank", F.col("row") - F.col("first_row") + F.col("base")).drop("task", "row", "first_row", "base"))


@dataclass
class Classes:
    """From a piece's key and rank to its place among all pieces of a class of the linear program.

    Keys: the length class of a long piece; minus the exact length of a short one, of which each
    ``unit`` in rank order make a bundle, of class ``length``, and the rest are rounded up.
    Within a class long pieces come first, then bundles, then the rest, shortest first.
    """

    unit: int
    demand: dict[int, int]   # class -> pieces and bundles
    bundles: np.ndarray      # exact length -> bundles
    bundle_at: np.ndarray    # exact length -> place of its first bundle in class ``length``
    rest_at: np.ndarray      # exact length -> place of its first other piece in the class it is rounded up to

    def places(self, key: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, place in it, and place inside the bundle (0 without one)."""
        exact = np.maximum(-key, 0)
        whole = self.bundles[exact] * self.unit
        bundled = (key < 0) & (rank < whole)
        place = np.where(key > 0, rank, np.where(bundled, self.bundle_at[exact] + rank // self.unit, self.rest_at[exact] + rank - whole))
        cls = np.where(key > 0, key, np.where(bundled, exact, -(-exact // self.unit)))
        return cls, place, np.where(bundled, rank % self.unit, 0)


def bundled_classes(histogram: dict[int, int], unit: int, short: int) -> Classes:
    """The classes for a histogram {key: pieces}; lengths up to ``short`` are bundled."""
    demand = {k: n for k, n in histogram.items() if k > 0}
    bundles, bundle_at, rest_at = (np.zeros(short + 1, np.int64) for _ in range(3))
    for exact in range(1, short + 1):
        bundles[exact] = histogram.get(-exact, 0) // unit
        if bundles[exact]:
            bundle_at[exact] = demand.get(exact, 0)
            demand[exact] = demand.get(exact, 0) + int(bundles[exact])
    for exact in range(1, short + 1):
        rest = histogram.get(-exact, 0) - int(bundles[exact]) * unit
        if rest:
            cls = -(-exact // unit)
            rest_at[exact] = demand.get(cls, 0)
            demand[cls] = demand.get(cls, 0) + rest
    return Classes(unit, demand, bundles, bundle_at, rest_at)


def pack(pieces: DataFrame, length: int, classes: int = CLASSES, gap: float = GAP) -> DataFrame:
    """``pieces`` (columns doc_id, start, length and any others) with sequence_id and offset.

    Every row goes to exactly one place; a sequence's rows follow each other from offset 0
    without holes and hold ``length`` tokens at most.
    """
    spark = pieces.sparkSession
    on_workers(spark)
    unit = max(1, length // classes)  # tokens per class
    capacity = length // unit
    short = capacity // 2 if unit > 1 else 0  # two bundles at least fit a sequence
    rounded_up = F.least(F.ceil(F.col("length") / unit), F.lit(capacity)).cast("int")  # the longest pieces fill a sequence
    key = F.when(F.col("length") <= short, -F.col("length").cast("int")).otherwise(rounded_up)
    rows = staged(pieces.withColumn("cls", key), "pieces")
    own = bundled_classes({r.cls: r["count"] for r in rows.groupBy("cls").count().collect()}, unit, short)
    shared = spark.sparkContext.broadcast((own, plan_patterns(own.demand, capacity, gap)))
    fields = [f for f in rows.schema.fields if f.name != "cls"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "sequence_id long", "slot long"])

    def assign(batches):
        own, plan = shared.value
        for batch in batches:
            cls, place, inner = own.places(batch.column("cls").to_numpy().astype(np.int64), batch.column("rank").to_numpy())
            first = np.fromiter((plan.first[c] for c in cls.tolist()), np.int64, len(cls))
            sequence, slot = plan.place(first + place)
            kept = {f.name: batch.column(f.name) for f in fields}
            yield pa.RecordBatch.from_pydict(kept | {"sequence_id": pa.array(sequence), "slot": pa.array(slot * own.unit + inner)})

    placed = ranked(rows, ["doc_id", "start"]).mapInArrow(assign, schema)
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("slot")


def sequences(packed: DataFrame, length: int, pad_id: int) -> DataFrame:
    """The token sequences of pieces packed with their ``ids``: sequence_id, n_tokens, and
    ``ids`` (little-endian uint32, padded to ``length``). A group is one sequence of bounded size."""
    body = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(body, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
            .withColumn("ids", F.rpad("ids", F.lit(4 * length), F.lit(pad_id.to_bytes(4, "little")))))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    import public_tokenizers

    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2, 4096,
                          slice_bytes=2 * SLICE)
    return pack(pieces, 4096)
