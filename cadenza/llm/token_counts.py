"""Token counts of whole texts under a unigram model, by dynamic programming shared in a trie.

A text's pre-tokens are its pieces between ASCII white space, each led by the word mark
``▁``. A worker keeps one trie of the distinct pre-tokens it has met. A node stands for
a prefix and holds the best forward score of segmenting that prefix into vocabulary pieces
and the number of tokens in that segmentation; the score is computed once, from the node's
ancestors, when the prefix is first met, and every pre-token that shares the prefix reuses
it. The node where a pre-token ends thereby holds the pre-token's count, the terminal count,
which is kept in a table by pre-token: one that was met before is looked up there and not walked
again. A text's count is the sum over its pre-tokens. No row leaves its task, so nothing is
shuffled.

The trie starts again when it outgrows ``TRIE_NODES``. The terminal counts of the generation before stay
within reach until then and move over when they are met, so a frequent pre-token is never
scored twice and only what was not met in a whole generation is forgotten.

Scores: the public vocabulary file lists its pieces by rank; the model is Zipf's law over
these ranks, log p(rank) = -log(rank) - log(sum of 1 / rank). A code point outside the
vocabulary scores ``UNKNOWN`` below the rarest piece and counts one token per UTF-8 byte.
Equal scores go to fewer tokens.

Defined cases: a null, empty or blank text has 0 pre-tokens and 0 tokens; repeated rows each
get their row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import on_workers, slices, table, task
from cadenza.llm.tokens import SLICE

MARK = "▁"
UNKNOWN = -10.0
TRIE_NODES = 600_000  # bound of a worker's trie
ENDING = 3            # code points by which the longest piece that may end somewhere is looked up


@functools.lru_cache(maxsize=2)
def zipf_scores(path: str) -> dict[str, float]:
    """Log probability of every ordinary piece of a sentencepiece file, by its rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    norm = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return {p: -math.log(r) - norm for r, p in enumerate(pieces, 1)}


class Trie:
    """Prefixes of the inserted pre-tokens with their best score and token count; counts by pre-token."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.unknown = min(scores.values(), default=0.0) + UNKNOWN
        self.longest: dict[str, int] = {}  # an ending of up to ENDING code points -> length of the longest piece with it
        for piece in scores:
            for ending in {piece[-n:] for n in range(1, ENDING + 1)}:
                self.longest[ending] = max(self.longest.get(ending, 0), len(piece))
        self.terminal: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.before, self.terminal = self.terminal, {}
        self.child: list[dict[str, int]] = [{}]
        self.best, self.tokens = [0.0], [0]

    def insert(self, word: str) -> int:
        """Tokens of ``word``; scores the prefixes not met before."""
        child, path, node = self.child, [0], 0
        for c in word:
            node = child[node].get(c)
            if node is None:
                break
            path.append(node)
        best, tokens, score, longest = self.best, self.tokens, self.scores.get, self.longest.get
        last = path[-1]
        for end in range(len(path), len(word) + 1):
            c = word[end - 1]
            s = score(c)
            if s is None:  # an unknown code point
                top, fewest = best[last] + self.unknown, tokens[last] + len(c.encode())
            else:
                top, fewest = best[last] + s, tokens[last] + 1
            # no piece that ends here is longer than this; without its last code points in a row, none but the short ones
            most = longest(word[max(0, end - ENDING):end], ENDING - 1)
            for start in range(end - 2, max(-1, end - most - 1), -1):
                s = score(word[start:end])
                if s is not None:
                    at = path[start]
                    s += best[at]
                    if s > top or (s == top and tokens[at] + 1 < fewest):
                        top, fewest = s, tokens[at] + 1
            node = len(best)
            best.append(top)
            tokens.append(fewest)
            child.append({})
            child[last][c] = node
            path.append(node)
            last = node
        return tokens[last]

    def count(self, word: str) -> int:
        known = self.terminal.get(word)
        if known is None:
            known = self.before.get(word)
            if known is None:
                known = self.insert(word)
            self.terminal[word] = known
        return known

    def counts(self, words: list[str]) -> np.ndarray:
        """Counts of many pre-tokens; the trie starts again where it has outgrown its bound."""
        if len(self.best) > TRIE_NODES or len(self.terminal) > TRIE_NODES:
            self.clear()
        return np.fromiter(map(self.count, words), np.int64, len(words))


@functools.lru_cache(maxsize=2)
def worker_trie(path: str) -> Trie:
    return Trie(zipf_scores(path))


def token_counts(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
                 slice_bytes: int = SLICE) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` of every row's whole text; ``vocabulary``: a sentencepiece file.
    A task splits about ``slice_bytes`` of texts at once."""
    on_workers(docs.sparkSession)

    def run(batches):
        trie = worker_trie(vocabulary)
        for batch in task(batches):
            for part in slices(batch, "text", slice_bytes):
                lists = pc.ascii_split_whitespace(part.column("text").fill_null(""))
                flat = lists.flatten().dictionary_encode()
                words = flat.dictionary.to_pylist()
                marked = trie.counts([MARK + w for w in words if w])
                size = np.zeros(len(words), np.int64)
                real = np.fromiter(map(bool, words), bool, len(words))
                size[real] = marked
                codes = flat.indices.to_numpy()
                bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
                total = [np.concatenate([[0], np.cumsum(x)])[bounds] for x in (real[codes], size[codes])]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"),
                                                  "n_pretokens": pa.array(np.diff(total[0])).cast(pa.int64()),
                                                  "n_tokens": pa.array(np.diff(total[1]))})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of all documents."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
