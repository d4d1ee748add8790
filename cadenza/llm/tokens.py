"""Whole-text token ids with a public ``tokenizers`` file, encoding each distinct word once.

The file's pre-tokenizer drops white space and never makes a token across it, so the ids of
a text are the ids of its white-space separated pieces laid end to end. Pieces repeat a lot:
a batch is split and dictionary-encoded by Arrow, only distinct pieces unseen by this worker
go through the library, and the ids are gathered with numpy. Two rewritings that leave the
ids as they are make pieces repeat more: a blank between an ASCII letter and a comma or full
stop (the pre-tokenizer parts them anyway), and lower case in pieces wholly of ASCII where
the file's normalizer lower-cases (pieces that may hold a special token are left alone).
"""

from __future__ import annotations

import array
import functools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cadenza.llm.common import ragged

CACHED_PIECES = 600_000  # bound of the per-worker cache; it starts again beyond

CALL = 50_000            # pieces given to the library at once, which holds much for each
SLICE = 8 << 20          # bytes of text encoded at once by default: with more, fewer pieces are looked up


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file (kept while the worker lives)."""
    return Encoder(path)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces: dict[str, bytes] = {}
        self.by_piece, self.lower = drops_white_space(path), lower_cases(path)

    @property
    def largest_id(self) -> int:
        return max(self.tokenizer.get_vocab(with_added_tokens=True).values())

    def _bytes(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array.array("I", e.ids).tobytes() for e in encoded]

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: all ids as uint32 and the n + 1 text boundaries. Null: empty text.

        With ``end_id`` every text's ids are followed by it.
        """
        texts = texts.fill_null("")
        if self.by_piece:
            lists = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, "([A-Za-z])([,.])", r"\1 \2"))
            flat = lists.flatten().dictionary_encode()
            codes = flat.indices.to_numpy()
            distinct = flat.dictionary
            if self.lower:
                plain = pc.and_(pc.string_is_ascii(distinct), pc.invert(pc.match_substring(distinct, "<")))
                merged = pc.if_else(plain, pc.ascii_lower(distinct), distinct).dictionary_encode()
                distinct, codes = merged.dictionary, merged.indices.to_numpy()[codes]
            words = distinct.to_pylist()
            bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        else:
            words = texts.to_pylist()
            codes, bounds = np.arange(len(words)), np.arange(len(words) + 1)
        known = self._known(words)
        size = np.fromiter(map(len, known), np.int64, len(known)) >> 2
        table = np.frombuffer(b"".join(known), dtype=np.uint32)
        n = size[codes]
        ids = table[ragged(n, (np.cumsum(size) - size)[codes])]
        offsets = np.concatenate([[0], np.cumsum(n)])[bounds]
        if end_id is not None:
            ids = np.insert(ids, offsets[1:], end_id)
            offsets = offsets + np.arange(len(offsets))
        return ids, offsets

    def _known(self, words: list[str]) -> list[bytes]:
        if not self.by_piece:
            return self._bytes(words)
        if len(self.pieces) > CACHED_PIECES:
            self.pieces = {}
        new = [w for w in words if w not in self.pieces]
        for at in range(0, len(new), CALL):
            self.pieces.update(zip(new[at:at + CALL], self._bytes(new[at:at + CALL])))
        return list(map(self.pieces.__getitem__, words))


def lower_cases(path: str) -> bool:
    """Whether the file's normalizer lower-cases every text."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f).get("normalizer") or {}
    return any(r.get("type") == "Lowercase" for r in rules.get("normalizers") or [rules])


def drops_white_space(path: str) -> bool:
    """Whether the file's first pre-tokenizer keeps only matches without white space, and
    parts letters from commas and full stops."""
    with open(path, encoding="utf-8") as f:
        pre = json.load(f).get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    return (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
            and r"[\p{L}]+" in pattern and r"[^\s\p{L}" in pattern and r"\s" not in pattern.replace(r"[^\s\p{L}", ""))
