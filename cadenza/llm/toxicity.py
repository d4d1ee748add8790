"""Toxicity of whole texts: bags of subword embeddings averaged into a linear softmax.

A word is the mean of the embeddings of its character n-grams (and of itself), all hashed
into one table, so a spelling never seen shares most of its vector with the ones that were.
A bag averages its distinct words over ``WINDOW`` places, empty places counting as zero, so
that neither a short text nor one word said over and over weighs more than a word among
others; a linear softmax maps it to (clean, toxic). Embeddings (from zero) and softmax are
trained jointly, in numpy, on a bounded sample of labelled rows.

A text is read in windows of ``WINDOW`` words, half overlapping, over its whole length, and
scores as its most toxic window; an empty text is one empty bag. Training follows the same
reading: the first rounds take a random window of each text, the later ones its most toxic
window under the model so far (in a clean text, the one that most needs to be learned as
clean). Classes are weighted so that toxic texts count at least half as much as clean ones.
A logistic curve turns logits into scores: fitted on every ``CALIBRATION``-th row, with logits
of a first training without these rows and the classes as frequent as among all labelled rows.

Because the model is linear after averaging, a word contributes one number; scoring a batch
computes that number once per distinct word and then sums, so it needs no shuffle and little
memory. The model is broadcast; its size is fixed by ``BUCKETS`` and ``DIMENSIONS``.

Defined cases: a null text counts as empty; labelled rows with null label or text are not
learned from; without labelled rows of both classes every score is 0; repeated rows each get
their score; an empty table gives an empty result; a null doc_id is not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import give_back, is_held_out, on_workers, ragged, slices, staged, table, task
from cadenza.llm.subwords import char_ngrams, distinct_words

BUCKETS, DIMENSIONS = 1 << 17, 8
SIZES = range(3, 7)
WINDOW = 32
THRESHOLD = 0.3
SAMPLE = {1: 2000, 0: 3500}  # labelled rows of each class that are learned from, at most
SAMPLE_CHARS = 6_000         # of a longer text so many code points are learned from (it is scored whole), in
SAMPLE_STRETCHES = 3         # so many stretches
HASH_BUCKETS = 4096
ROUNDS, RANDOM_ROUNDS, BATCH, RATE = 9, 3, 64, 0.3
DECAY = 1e-3                 # pull of the touched parameters towards zero
CALIBRATION = 5
STEPS = 600                  # at least so many batches are learned from, in more rounds if need be


@dataclass
class Model:
    embeddings: np.ndarray  # buckets x dimensions
    softmax: np.ndarray     # dimensions x 2
    bias: np.ndarray        # 2
    slope: float = 1.0      # of the curve from logits to scores
    shift: float = 0.0

    def score(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -60, 60)))

    def logits(self, texts: pa.Array) -> np.ndarray:
        words, codes, bounds = distinct_words(texts)
        return text_logits(word_values(words, self.leaning()), codes, bounds, float(self.bias[1] - self.bias[0]))

    def leaning(self) -> np.ndarray:
        """What each bucket adds to the toxic logit, against the clean one."""
        return self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0])


def window_bounds(bounds: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the windows of every text; an empty text has one empty window."""
    n = np.diff(bounds)
    step = window // 2
    count = np.maximum(1, -(-np.maximum(n - step, 0) // step))
    text = np.repeat(np.arange(len(n)), count)
    start = bounds[text] + step * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    return text, start, np.minimum(start + window, bounds[text + 1])


def window_members(codes: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """``(window, position)`` of the first occurrence of every distinct word within each window."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((codes, text))
    same = (codes[order[1:]] == codes[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    before = np.full(len(codes), -1)  # the word's last place in the same text
    before[order[1:][same]] = order[:-1][same]
    own, start, _ = window_bounds(bounds, window)
    first = np.searchsorted(own, np.arange(len(bounds) - 1))  # first window of each text
    last = np.append(first[1:], len(own)) - 1
    at = np.arange(len(codes))
    block = (at - bounds[text]) // (window // 2)
    out_w, out_p = [], []
    for back in (0, 1):  # a word stands in the window that begins with its half and in the one before
        w = first[text] + block - back
        ok = (block >= back) & (w <= last[text])
        ok[ok] = before[ok] < start[w[ok]]
        out_w.append(w[ok])
        out_p.append(at[ok])
    return np.concatenate(out_w), np.concatenate(out_p)


def word_values(words: list[str], leaning: np.ndarray) -> np.ndarray:
    """The toxic leaning of each word: the mean over its n-grams."""
    if not words:
        return np.zeros(0)
    bucket, word = char_ngrams(words, SIZES, len(leaning))
    n = np.bincount(word, minlength=len(words))
    return np.bincount(word, weights=leaning[bucket], minlength=len(words)) / np.maximum(n, 1)


def text_logits(values: np.ndarray, codes: np.ndarray, bounds: np.ndarray, bias: float) -> np.ndarray:
    """Every text's toxic logit: that of its most toxic window."""
    text, _, _ = window_bounds(bounds)
    member, place = window_members(codes, bounds)
    logits = bias + np.bincount(member, weights=values[codes[place]], minlength=len(text)) / WINDOW
    return np.maximum.reduceat(logits, np.flatnonzero(np.diff(text, prepend=-1)))


def calibrate(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that best gives ``y``, by Newton's method. Targets
    stay off 0 and 1 by what one more row of each class would say, so the curve stays finite."""
    n = np.array([(y == 0).sum(), (y == 1).sum()])
    target = np.where(y == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    x = np.stack([logits, np.ones_like(logits)], 1)
    curve = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -60, 60)))
        slope = x.T @ (weight * (p - target)) + 1e-3 * (curve - [1, 0])
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), slope)
        curve = curve - step * min(1.0, 5 / np.abs(step).max())
    return (float(curve[0]), float(curve[1])) if curve[0] > 0 else (1.0, 0.0)


def fit(texts: list[str], labels: list[int], seed: int = 0, frequency: dict[int, float] | None = None) -> Model:
    """The model of labelled texts; ``frequency`` weights the classes in its calibration."""
    y = np.array(labels, np.int64)
    kept = np.random.default_rng(seed).permutation(len(y))[::CALIBRATION]
    rest = np.setdiff1d(np.arange(len(y)), kept)
    if min(np.bincount(y[kept], minlength=2)) < 5:
        return train(texts, labels, seed)
    held = train([texts[i] for i in rest], y[rest].tolist(), seed)
    give_back()
    weight = np.ones(len(kept)) if frequency is None else np.array([frequency[c] / (y == c).sum() for c in (0, 1)])[y[kept]]
    model = train(texts, labels, seed)
    give_back()
    model.slope, model.shift = calibrate(held.logits(pa.array([texts[i] for i in kept], pa.string())), y[kept],
                                         weight * len(kept) / weight.sum())
    return model


def train(texts: list[str], labels: list[int], seed: int = 0) -> Model:
    """Embeddings and softmax from labelled texts, by Adagrad on weighted cross-entropy."""
    rng = np.random.default_rng(seed)
    model = Model(np.zeros((BUCKETS, DIMENSIONS)), rng.normal(0, 1, (DIMENSIONS, 2)), np.zeros(2))
    y = np.array(labels, np.int64)
    weight = np.where(y == 1, max(1.0, 0.5 * (y == 0).sum() / max(1, (y == 1).sum())), 1.0)
    words, codes, bounds = distinct_words(pa.array(texts, pa.string()))
    bucket, word = char_ngrams(words, SIZES, BUCKETS)
    bucket, grams = bucket[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))
    del word
    first = np.cumsum(grams) - grams
    text, _, _ = window_bounds(bounds)
    member, place = window_members(codes, bounds)
    order = np.argsort(member, kind="stable")
    member, said = member[order].astype(np.int32), codes[place[order]].astype(np.int32)
    held = np.bincount(member, minlength=len(text))
    del order, place, codes
    give_back()
    begin = np.cumsum(held) - held
    squares = [np.full_like(p, 1e-4) for p in (model.embeddings, model.softmax, model.bias)]

    batches = max(1, len(y) // BATCH)
    for r in range(max(ROUNDS, -(-STEPS // batches))):
        if r < RANDOM_ROUNDS:
            logits = rng.random(len(text))
        else:
            values = np.add.reduceat(model.leaning()[bucket], first) / grams  # every word has an n-gram
            logits = np.bincount(member, weights=values[said], minlength=len(text))
        top = np.lexsort((-logits, text))
        top = top[np.flatnonzero(np.diff(text[top], prepend=-1))]
        for part in np.array_split(rng.permutation(len(y)), batches):
            n = held[top[part]]
            bag = np.repeat(np.arange(len(part)), n)
            used, own = np.unique(said[ragged(n, begin[top[part]])], return_inverse=True)
            g = grams[used]
            flat = bucket[ragged(g, first[used])]
            of_word = np.repeat(np.arange(len(used)), g)
            share = np.zeros((len(part), DIMENSIONS))
            for d in range(DIMENSIONS):
                vector = np.bincount(of_word, weights=model.embeddings[flat, d], minlength=len(used)) / np.maximum(g, 1)
                share[:, d] = np.bincount(bag, weights=vector[own], minlength=len(part)) / WINDOW
            z = share @ model.softmax + model.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p *= weight[part, None]
            back = p @ model.softmax.T / WINDOW
            touched, at = np.unique(flat, return_inverse=True)
            grad = np.empty((len(touched), DIMENSIONS))
            for d in range(DIMENSIONS):
                per_word = np.bincount(own, weights=back[bag, d], minlength=len(used)) / np.maximum(g, 1)
                grad[:, d] = np.bincount(at, weights=per_word[of_word], minlength=len(touched))
            for value, square, rows, own_grad in ((model.embeddings, squares[0], touched, grad),
                                                  (model.softmax, squares[1], slice(None), share.T @ p),
                                                  (model.bias, squares[2], slice(None), p.sum(axis=0))):
                own_grad = own_grad + DECAY * value[rows]
                square[rows] += own_grad ** 2
                value[rows] -= RATE * own_grad / np.sqrt(square[rows])
    return model


def learned_labels(labels: DataFrame, sample: dict[int, int] = SAMPLE) -> DataFrame:
    """``doc_id, toxic`` of the labels that may be learned from."""
    return labels.where(~is_held_out() & F.col("toxic").isin(*sample)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> tuple[list[str], list[int]]:
    """Texts and labels to learn from: of each class as many labelled texts as ``sample`` names, those
    of up to SAMPLE_CHARS code points first, by lowest hash of (doc_id, text), outside the held-out
    quarter. Where these are too few, longer texts follow, as SAMPLE_STRETCHES stretches from anywhere in them. A
    row that is there many times is learned once.

    The hash that ends each class's share is found in a histogram of HASH_BUCKETS buckets; only the rows up to
    it reach the driver, at first as hashes."""
    own = learned_labels(labels, sample).distinct()
    key = F.xxhash64("doc_id", "text")
    known = docs.where(F.col("text").isNotNull()).select("doc_id", key.alias("h"), (F.char_length("text") > SAMPLE_CHARS).cast("int").alias("long"))
    bucket = F.col("long") * HASH_BUCKETS + F.pmod("h", F.lit(HASH_BUCKETS))
    rows = staged(known.join(own, "doc_id").select("toxic", bucket.cast("int").alias("bucket"), "h", "doc_id").distinct(), "labelled")
    counts = sorted((r.toxic, r.bucket, r["count"]) for r in rows.groupBy("toxic", "bucket").count().collect())
    wanted = F.lit(False)
    for toxic, quota in sample.items():
        got = 0
        for _, b, n in (c for c in counts if c[0] == toxic):
            last, got = b, got + n
            if got >= quota:
                break
        if got:
            wanted |= (F.col("toxic") == toxic) & (F.col("bucket") <= last)
    chosen = sorted(tuple(r) for r in rows.where(wanted).select("toxic", "bucket", "h", "doc_id").collect())
    chosen = [r for toxic, quota in sample.items() for r in [c for c in chosen if c[0] == toxic][:quota]]
    side = docs.sparkSession.createDataFrame([(t, h, i) for t, _, h, i in chosen], T.StructType([
        T.StructField("toxic", T.IntegerType()), T.StructField("h", T.LongType()), docs.schema["doc_id"]]))
    n = F.char_length("text")
    part = SAMPLE_CHARS // SAMPLE_STRETCHES
    stretch = lambda i: F.substring("text", (F.pmod(F.xxhash64("h", F.lit(i)), n - part) + 1).cast("int"), F.lit(part))
    text = F.when(n <= SAMPLE_CHARS, F.col("text")).otherwise(F.concat_ws(" ", *map(stretch, range(SAMPLE_STRETCHES))))
    found = (docs.select("doc_id", "text").join(F.broadcast(side), "doc_id").where(key == F.col("h"))
             .select("doc_id", "toxic", "h", text.alias("text")).dropDuplicates(["doc_id", "toxic", "h"]))
    rows = sorted((r.doc_id, r.toxic, r.text) for r in found.collect())
    return [text for _, _, text in rows], [toxic for _, toxic, _ in rows]


def with_toxicity(docs: DataFrame, model: Model | None, out: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with ``out`` (a new name): the toxicity of the whole text, 0 to 1."""
    spark = docs.sparkSession
    on_workers(spark)
    if out in docs.columns:
        raise ValueError(f"documents already have a column {out!r}")
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in task(batches):
            for part in slices(batch, text):
                score = np.zeros(part.num_rows) if model is None else model.score(model.logits(part.column(text)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*part.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def fitted(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model learned from ``labels`` (doc_id, toxic) of ``docs``; None without both classes."""
    texts, y = labelled_sample(docs, labels)
    if len(set(y)) < 2:
        return None
    return fit(texts, y, frequency={r.toxic: r["count"] for r in learned_labels(labels).groupBy("toxic").count().collect()})


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_toxicity(docs, fitted(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
