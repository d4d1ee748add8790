"""Byte-level BPE by a sentencepiece model that is written straight from a rank file.

A rank file lists byte strings and their merge ranks. :func:`model_bytes` turns it into a
serialised sentencepiece BPE model: each byte string becomes a piece, its bytes spelt as one
printable character each, scored by its negative rank, at the index of its rank, so the
model's ids are the ranks. Its normaliser is the identity, and it neither adds nor escapes
blanks. The library then merges, as the ranks ask for, the adjacent pair of the best piece
first, the leftmost of equal ones.

Encoding splits a whole text by the vocabulary's pattern and gives every match to the model
on its own; a match that is a piece itself is that piece. Distinct matches are encoded once
per worker. Decoding looks every id's piece up and maps its characters back to bytes. Both
work row by row: nothing is shuffled.

Defined cases: a null or empty text has no ids and decodes to no bytes; a null doc_id stays
null; repeated rows each get their row; an empty table gives an empty result; other columns
are ignored; a text of any length is encoded whole (an Arrow batch holds at least one text).
An id outside the vocabulary fails the decoding job.
"""

from __future__ import annotations

import base64
import functools
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import on_workers, slices, table, task

CACHED_WORDS = 500_000  # bound of a worker's table of encoded matches; it starts again beyond
CALL = 20_000           # matches given to the library at once

# Field numbers and codes of sentencepiece's model format (sentencepiece_model.proto).
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE, BPE, VOCAB_SIZE = 3, 2, 4
RULE_NAME, DUMMY_PREFIX, DROP_EXTRA_BLANKS, ESCAPE_BLANKS = 1, 3, 4, 5


def byte_characters() -> list[str]:
    """One printable character for each byte: itself where it is visible Latin-1, else one of
    the code points from 256 on, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line per piece, base64 and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised model of a vocabulary whose ranks are 0, 1, 2, ...; one more piece, the
    last, is the unknown one that the format wants and no byte string needs."""
    spell = byte_characters()
    pieces = sorted(ranks, key=ranks.__getitem__)
    if [ranks[p] for p in pieces] != list(range(len(pieces))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the ranks have to be 0, 1, 2, ... and to hold every single byte")
    out = [_message(PIECES, _message(PIECE_TEXT, "".join(spell[b] for b in piece).encode())
                    + _varint(PIECE_SCORE << 3 | 5) + struct.pack("<f", -rank) + _number(PIECE_TYPE, NORMAL))
           for rank, piece in enumerate(pieces)]
    out.append(_message(PIECES, _message(PIECE_TEXT, b"<unknown>") + _number(PIECE_TYPE, UNKNOWN)))
    out.append(_message(TRAINER, _number(MODEL_TYPE, BPE) + _number(VOCAB_SIZE, len(pieces) + 1)))
    out.append(_message(NORMALIZER, _message(RULE_NAME, b"identity") + _number(DUMMY_PREFIX, 0)
                        + _number(DROP_EXTRA_BLANKS, 0) + _number(ESCAPE_BLANKS, 0)))
    return b"".join(out)


class ByteBPE:
    """A worker's model: matches to ids, ids to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        spell = byte_characters()
        unspell = {c: b for b, c in enumerate(spell)}
        self.ranks, self.to_text = ranks, {b: c for b, c in enumerate(spell)}
        self.pieces = [bytes(map(unspell.__getitem__, self.model.id_to_piece(i))) for i in range(len(ranks))]
        self.known: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        """Encode matches not met before."""
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        new = list(words.difference(self.known))
        for at in range(0, len(new), CALL):
            raw = [w.encode() for w in new[at:at + CALL]]
            own = [self.ranks.get(b) for b in raw]
            rest = iter(self.model.encode([b.decode("latin-1").translate(self.to_text) for b, i in zip(raw, own) if i is None],
                                          num_threads=1))
            for word, i in zip(new[at:], own):
                self.known[word] = np.array(next(rest) if i is None else [i], "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Every text's ids, as little-endian unsigned 32-bit integers."""
        words = [self.split(t) for t in texts]
        self._learn(set().union(*words))
        return [b"".join(map(self.known.__getitem__, own)) for own in words]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def worker_model(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(read_ranks(path), pattern)


def encode(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row's whole text; ``ids`` are the bytes of little-endian
    unsigned 32-bit integers. ``vocabulary``: a rank file on every worker."""
    on_workers(docs.sparkSession)

    def run(batches):
        bpe = worker_model(vocabulary, pattern)
        for batch in task(batches):
            for part in slices(batch, "text"):
                ids = bpe.encode(part.column("text").fill_null("").to_pylist())
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"),
                                                  "n_tokens": pa.array([len(i) >> 2 for i in ids], pa.int64()), "ids": ids})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(tokens: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``tokens`` with ``decoded``, the bytes that its column ``ids`` stands for, in that column's place."""
    on_workers(tokens.sparkSession)
    schema = T.StructType([T.StructField(decoded, T.BinaryType()) if f.name == ids else f for f in tokens.schema.fields])

    def run(batches):
        bpe = worker_model(vocabulary, pattern)
        for batch in task(batches):
            for part in slices(batch, ids):
                own = pa.array([None if i is None else bpe.decode(i) for i in part.column(ids).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([own if n == ids else part.column(n) for n in part.schema.names], schema.names)

    return tokens.mapInArrow(run, schema)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the public byte-level vocabulary, and decoded again, as digests."""
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    tokens = encode(table(spark, sf_dir, "documents"), *vocabulary)
    back = decode(tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids"), *vocabulary)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
