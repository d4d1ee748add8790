"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a language by forward-backward: its emission scores come from
hashed character n-grams of the marked word ``<word>`` (those with a mark are its affixes),
from the word itself and from a lexicon of words that one language owns in the training
sample; learned transitions carry context across words without evidence of their own, so
that text which switches languages is labelled stretch by stretch. A document's language has
the largest mean posterior over its words that hold a letter, and that mean is its score.

Training is numpy: Adagrad on the exact gradient of the conditional likelihood, on sequences
of stretches from labelled documents of different languages, so that transitions are learned
from switches whose places are known. It uses a bounded sample of labelled rows.

Inference runs where the texts lie, without a shuffle. Sequences are cut into blocks of
``BLOCK`` words: block transfer matrices are multiplied up for all blocks at once, then a scan
over each text's blocks gives the exact messages at block borders, then all blocks finish
at once. A text of any length is thus read whole, with vectorised work throughout.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is everything
if no row is labelled; labelled rows with a null text or language are not learned from; ties go to the
language that sorts first; repeated rows each get their row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import give_back, is_held_out, on_workers, slices, table, task
from cadenza.llm.subwords import char_ngrams, distinct_words

BUCKETS = 1 << 16
SIZES = range(2, 6)
SAMPLE = 300           # labelled rows of each language that are learned from, at most
SAMPLE_CHARS = 10_000  # of a longer text so many code points are learned from (it is labelled whole), in
SAMPLE_STRETCHES = 4   # so many stretches
SAMPLE_TOTAL = 60_000_000  # code points that are learned from, at most, shared by all languages alike
SLICE = 24 << 20       # bytes of text that are labelled at once, divided by the number of languages
BLOCK_NUMBERS = 12_000_000  # numbers in the transfer matrices of the texts that are labelled at once
SEQUENCE, STRETCH = 64, (4, 32)
STEPS, BATCH, RATE, DECAY = 300, 48, 0.2, 1e-4
OWNED, SEEN = 0.9, 3   # a lexicon word: so often in one language, so often in all
RUNS, RUN_SEEN = 1 << 21, 3  # buckets of three-letter runs, and how often a run is met to count as trained
BLOCK = 128
UNKNOWN = "und"


def has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray              # buckets x languages
    lexicon: dict[str, int]          # word -> the language that owns it
    lexicon_weights: np.ndarray      # owner x languages
    transitions: np.ndarray          # from x to
    start: np.ndarray
    trained: np.ndarray              # bits: the hashed three-letter runs that the training texts hold

    def supported(self, words: list[str]) -> np.ndarray:
        """Whether training has met every three-letter run of ``<word>``."""
        bucket, word = runs(words)
        out = np.ones(len(words), bool)
        out[word[np.unpackbits(self.trained, count=RUNS)[bucket] == 0]] = False
        return out

    def emissions(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores (words x languages) and whether each word holds a letter; others score zero."""
        letter = np.fromiter(map(has_letter, words), bool, len(words))
        out = np.zeros((len(words), len(self.languages)))
        if len(words):
            bucket, word = char_ngrams(words, SIZES, BUCKETS)
            for y in range(out.shape[1]):
                out[:, y] = np.bincount(word, weights=self.weights[bucket, y], minlength=len(words))
            out /= np.sqrt(np.maximum(np.bincount(word, minlength=len(words)), 1))[:, None]
            owner = np.fromiter((self.lexicon.get(w, -1) for w in words), np.int64, len(words))
            out[owner >= 0] += self.lexicon_weights[owner[owner >= 0]]
        out[~letter] = 0
        return out, letter


def runs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of the three-letter runs of every marked word."""
    bucket, word = char_ngrams(words, range(3, 4), RUNS)
    return bucket[:len(bucket) - len(words)], word[:len(word) - len(words)]  # the whole words come last


def trained_runs(words: list[str], times: np.ndarray) -> np.ndarray:
    """Bits of the runs that occur RUN_SEEN times at least, where word i occurs ``times[i]`` times."""
    bucket, word = runs(words)
    return np.packbits(np.bincount(bucket, weights=times[word], minlength=RUNS) >= RUN_SEEN)


def posteriors(scores: np.ndarray, bounds: np.ndarray, transitions: np.ndarray, start: np.ndarray,
               block: int = BLOCK) -> np.ndarray:
    """Forward-backward of many sequences laid end to end: P(label | sequence) of every position."""
    n, k = scores.shape
    out = np.zeros((n, k))
    if not n:
        return out
    a = np.exp(transitions - transitions.max())
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    length = np.diff(bounds)
    blocks = -(-length // block)
    head = np.cumsum(blocks) - blocks
    seq = np.repeat(np.arange(len(length)), blocks)
    nth = np.arange(len(seq)) - head[seq]
    begin = bounds[seq] + nth * block
    size = np.minimum(block, bounds[seq + 1] - begin)
    order = np.argsort(-size, kind="stable")  # the blocks that have a position t come first
    nth, begin, size = nth[order], begin[order], size[order]
    reach = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
    place = np.argsort(order)  # where the blocks of a sequence went

    # what a block does to the message that enters it: the product of its steps (no transition
    # leads to a sequence's first position)
    move = np.where((nth == 0)[:, None, None], np.eye(k), a) * e[begin][:, None, :]
    for t, m in enumerate(reach[1:], 1):
        step = (move[:m].reshape(-1, k) @ a).reshape(m, k, k) * e[begin[:m] + t][:, None, :]
        move[:m] = step / step.sum(axis=(1, 2), keepdims=True)
    enter = np.tile(np.exp(start - start.max()), (len(seq), 1))
    leave = np.ones((len(seq), k))
    deeper = [np.flatnonzero(blocks > d) for d in range(1, int(blocks.max()))]
    for d, own in enumerate(deeper):
        before, here = place[head[own] + d], place[head[own] + d + 1]
        message = np.einsum("nk,nkl->nl", enter[before], move[before])
        enter[here] = message / message.sum(axis=1, keepdims=True)
    for d, own in reversed(list(enumerate(deeper))):
        here, after = place[head[own] + d], place[head[own] + d + 1]
        message = np.einsum("nkl,nl->nk", move[after], leave[after])
        leave[here] = message / message.sum(axis=1, keepdims=True)

    alpha = []
    now = np.where((nth == 0)[:, None], enter, enter @ a) * e[begin]
    for t, m in enumerate(reach):
        now = now[:m] if not t else (now[:m] @ a) * e[begin[:m] + t]
        now = now / now.sum(axis=1, keepdims=True)
        alpha.append(now)
    for t in range(len(reach) - 1, -1, -1):
        m = reach[t]
        p = alpha.pop() * leave[:m]
        out[begin[:m] + t] = p / p.sum(axis=1, keepdims=True)
        back = (leave[:m] * e[begin[:m] + t]) @ a.T
        leave[:m] = back / back.sum(axis=1, keepdims=True)
    return out


def expected(scores: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sequences of one length (n, t, k): the posteriors and the expected transition counts (k, k)."""
    n, length, k = scores.shape
    a = np.exp(transitions - transitions.max())
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    alpha, beta = np.empty_like(e), np.ones_like(e)
    now = np.exp(start - start.max()) * e[:, 0]
    for t in range(length):
        now = now if not t else (now @ a) * e[:, t]
        alpha[:, t] = now = now / now.sum(axis=1, keepdims=True)
    for t in range(length - 1, 0, -1):
        back = (beta[:, t] * e[:, t]) @ a.T
        beta[:, t - 1] = back / back.sum(axis=1, keepdims=True)
    p = alpha * beta
    p /= p.sum(axis=2, keepdims=True)
    pairs = alpha[:, :-1, :, None] * a * (beta[:, 1:] * e[:, 1:])[:, :, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    return p, pairs.sum(axis=(0, 1))


def spliced(pools: list[list[np.ndarray]], n: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """``n`` sequences of SEQUENCE words from stretches of texts, a language drawn for each: (words, labels)."""
    words, labels = np.empty((n, SEQUENCE), np.int64), np.empty((n, SEQUENCE), np.int64)
    for i in range(n):
        at = 0
        while at < SEQUENCE:
            y = int(rng.integers(len(pools)))
            text = pools[y][int(rng.integers(len(pools[y])))]
            take = min(int(rng.integers(*STRETCH)), len(text), SEQUENCE - at)
            s = int(rng.integers(len(text) - take + 1))
            words[i, at:at + take], labels[i, at:at + take] = text[s:s + take], y
            at += take
    return words, labels


def fit(texts: list[str], labels: list[str], seed: int = 0) -> Model | None:
    """The model of labelled texts; None if none of them holds a letter."""
    rng = np.random.default_rng(seed)
    words, codes, bounds = distinct_words(pa.array(texts, pa.string()))
    letter = np.fromiter(map(has_letter, words), bool, len(words))
    told = [i for i in range(len(texts)) if letter[codes[bounds[i]:bounds[i + 1]]].any()]
    languages = sorted({labels[i] for i in told})
    if not languages:
        return None
    k = len(languages)
    number = {y: i for i, y in enumerate(languages)}
    pools: list[list[np.ndarray]] = [[] for _ in languages]
    counts: Counter = Counter()
    for i in told:
        own = codes[bounds[i]:bounds[i + 1]]
        pools[number[labels[i]]].append(own)
        counts.update((w, number[labels[i]]) for w in set(own.tolist()))
    texts_with = Counter()
    for (w, _), n in counts.items():
        texts_with[w] += n
    lexicon = {words[w]: y for (w, y), n in counts.items()
               if letter[w] and texts_with[w] >= SEEN and n >= OWNED * texts_with[w]}
    model = Model(languages, np.zeros((BUCKETS, k)), lexicon, np.zeros((k, k)), np.zeros((k, k)), np.zeros(k),
                  trained_runs(words, np.bincount(codes, minlength=len(words))))

    bucket, word = char_ngrams(words, SIZES, BUCKETS)
    bucket, grams = bucket[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))
    del word
    first = np.cumsum(grams) - grams
    owner = np.fromiter((lexicon.get(w, -1) for w in words), np.int64, len(words))
    parameters = [model.weights, model.lexicon_weights, model.transitions, model.start]
    squares = [np.full_like(p, 1e-3) for p in parameters]
    for _ in range(STEPS):
        said, y = spliced(pools, BATCH, rng)
        used, own = np.unique(said.ravel(), return_inverse=True)
        g = grams[used]
        flat = bucket[np.arange(g.sum()) + np.repeat(first[used] - (np.cumsum(g) - g), g)]
        of_word = np.repeat(np.arange(len(used)), g)
        norm = np.sqrt(np.maximum(g, 1))
        plain = letter[used]
        score = np.stack([np.bincount(of_word, weights=model.weights[flat, c], minlength=len(used)) for c in range(k)], 1)
        score /= norm[:, None]
        listed = owner[used] >= 0
        score[listed] += model.lexicon_weights[owner[used][listed]]
        score[~plain] = 0
        p, pairs = expected(score[own].reshape(BATCH, SEQUENCE, k), model.transitions, model.start)
        truth = np.eye(k)[y]
        delta = (p - truth).reshape(-1, k)
        per_word = np.stack([np.bincount(own, weights=delta[:, c], minlength=len(used)) for c in range(k)], 1)
        per_word[~plain] = 0
        touched, at = np.unique(flat, return_inverse=True)
        spread = (per_word / norm[:, None])[of_word]
        on_weights = np.stack([np.bincount(at, weights=spread[:, c], minlength=len(touched)) for c in range(k)], 1)
        on_lexicon = np.zeros((k, k))
        np.add.at(on_lexicon, owner[used][listed], per_word[listed])
        true_pairs = np.einsum("ntk,ntl->kl", truth[:, :-1], truth[:, 1:])
        grads = [on_weights, on_lexicon, pairs - true_pairs, (p[:, 0] - truth[:, 0]).sum(axis=0)]
        for value, square, grad, rows in zip(parameters, squares, grads, [touched, slice(None), slice(None), slice(None)]):
            grad = grad / BATCH + DECAY * value[rows]
            square[rows] += grad ** 2
            value[rows] -= RATE * grad / np.sqrt(square[rows])
    return model


def labelled_sample(docs: DataFrame, per_language: int = SAMPLE) -> tuple[list[str], list[str]]:
    """Texts and languages to learn from: of every language the rows whose ids hash lowest, outside
    the held-out quarter, ``per_language`` at most, or as many fewer as keep all of them
    together within SAMPLE_TOTAL code points. Texts above SAMPLE_CHARS give as many code points, in
    SAMPLE_STRETCHES stretches from anywhere in them."""
    fitting = docs.where(~is_held_out() & F.col("lang").isNotNull() & (F.trim("text") != ""))
    languages = max(1, fitting.select("lang").distinct().count())
    per_language = max(1, min(per_language, SAMPLE_TOTAL // (languages * SAMPLE_CHARS)))
    order = Window.partitionBy("lang").orderBy("h")
    chosen = (fitting.select("lang", F.xxhash64("doc_id").alias("h")).withColumn("nth", F.row_number().over(order))
              .where(F.col("nth") <= per_language).groupBy("lang").agg(F.max("h").alias("upto")))
    rows = fitting.join(F.broadcast(chosen), "lang").where(F.xxhash64("doc_id") <= F.col("upto"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), F.xxhash64("text"))
    n, part = F.char_length("text"), SAMPLE_CHARS // SAMPLE_STRETCHES
    stretch = lambda i: F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(i)), n - part) + 1).cast("int"), F.lit(part))
    text = F.when(n <= SAMPLE_CHARS, F.col("text")).otherwise(F.concat_ws(" ", *map(stretch, range(SAMPLE_STRETCHES))))
    rows = rows.select("lang", text.alias("text"), F.row_number().over(order).alias("nth")).where(F.col("nth") <= per_language)
    rows = sorted(rows.collect(), key=lambda r: (r.lang, r.nth))
    return [r.text for r in rows], [r.lang for r in rows]


def with_languages(docs: DataFrame, model: Model | None, words: bool = False, text: str = "text",
                   out: tuple[str, str, str] = ("lang_pred", "score", "labels"), evidence: str | None = None) -> DataFrame:
    """``docs`` with the language and its score in the first two of the ``out`` columns, and with
    ``words`` in the third array<struct<word, language, p>> of the lower-cased words in order.
    The names must be new to ``docs``.

    The score shares 1 among the learned languages, so it is high for a text in any other one, too.
    ``evidence`` names a column for the share of the words with a letter that training supports, all
    of whose three-letter runs it has met: low for a text in a language that was not learned,
    however many were."""
    spark = docs.sparkSession
    on_workers(spark)
    new = [*out[:2 + words], *([evidence] if evidence else [])]
    if set(new) & set(docs.columns):
        raise ValueError(f"documents already have one of {new}")
    shared = spark.sparkContext.broadcast(model)
    labels = "array<struct<word: string, language: string, p: double>>"

    def parts(batch, k):
        """Runs of rows that are labelled at once: the work holds k numbers a word and k * k a block."""
        rows = max(64, BLOCK_NUMBERS // (k * k))
        for part in slices(batch, text, max(1 << 16, min(2 << 20, SLICE // k))):
            yield from (part.slice(at, rows) for at in range(0, part.num_rows, rows))

    def run(batches):
        model = shared.value
        for batch in task(batches):
            for part in parts(batch, len(model.languages) if model else 1):
                n = part.num_rows
                names, score, share, own = [UNKNOWN] * n, np.zeros(n), np.zeros(n), [[]] * n
                if model is not None:
                    said, codes, bounds = distinct_words(part.column(text))
                    emission, letter = model.emissions(said)
                    p = posteriors(emission[codes], bounds, model.transitions, model.start)
                    votes = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p * letter[codes][:, None], axis=0)])
                    heard = np.concatenate([[0], np.cumsum(letter[codes])])
                    total = heard[bounds[1:]] - heard[bounds[:-1]]
                    if evidence:
                        met = np.concatenate([[0], np.cumsum((letter & model.supported(said))[codes])])
                        share = (met[bounds[1:]] - met[bounds[:-1]]) / np.maximum(total, 1)
                    mean = (votes[bounds[1:]] - votes[bounds[:-1]]) / np.maximum(total, 1)[:, None]
                    best = mean.argmax(axis=1)
                    names = [model.languages[b] if t else UNKNOWN for b, t in zip(best.tolist(), total.tolist())]
                    score = np.clip(np.where(total > 0, mean[np.arange(n), best], 0.0), 0, 1)
                    if words:
                        top = p.argmax(axis=1)
                        own = [[{"word": said[c], "language": model.languages[y], "p": float(q)} for c, y, q in
                                zip(codes[a:b].tolist(), top[a:b].tolist(), p[a:b].max(axis=1).tolist())]
                               for a, b in zip(bounds[:-1], bounds[1:])]
                columns = [*part.columns, pa.array(names, pa.string()), pa.array(score)]
                if words:
                    columns.append(pa.array(own, pa.list_(pa.struct([("word", pa.string()), ("language", pa.string()), ("p", pa.float64())]))))
                if evidence:
                    columns.append(pa.array(share))
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *new])

    fields = [T.StructField(out[0], T.StringType()), T.StructField(out[1], T.DoubleType())]
    if words:
        fields.append(T.StructField(out[2], T.DataType.fromDDL(labels)))
    if evidence:
        fields.append(T.StructField(evidence, T.DoubleType()))
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def fitted(docs: DataFrame) -> Model | None:
    """The model learned from the text and lang of ``docs`` outside the held-out quarter."""
    model = fit(*labelled_sample(docs))
    give_back()
    return model


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document: doc_id, held_out, lang_pred, score."""
    docs = table(spark, sf_dir, "documents")
    labelled = with_languages(docs.select("doc_id", "text"), fitted(docs))
    return labelled.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
