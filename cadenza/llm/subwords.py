"""Words of whole texts as codes into a batch's distinct words, and hashed character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def distinct_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``(words, codes, bounds)``: the distinct lower-cased words, every text's words as codes
    laid end to end, and the n + 1 text boundaries. Words part at white space and before a
    comma or full stop that follows an ASCII letter. Null: no word."""
    texts = pc.replace_substring_regex(pc.utf8_lower(texts.fill_null("")), "([a-z])([,.])", r"\1 \2")
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten().dictionary_encode()
    bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    words, codes = flat.dictionary.to_pylist(), flat.indices.to_numpy().astype(np.int64)
    if "" in words:  # what a blank at an end leaves
        real = np.flatnonzero(codes != words.index(""))
        bounds = np.searchsorted(real, bounds)
        codes = codes[real]
    return words, codes, bounds


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def char_ngrams(words: list[str], sizes: range, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bucket, word)``, as 32-bit numbers, of every n-gram of ``<word>`` for n in ``sizes`` and of the whole word."""
    marked = [f"<{w}>" for w in words]
    length = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(marked), dtype=np.int32), length)
    h = np.zeros(len(codes), np.uint64)
    out_b, out_w = [], []
    for n in range(1, max(sizes) + 1):
        h = _mix(h[:len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:] + np.uint64(n))
        if n in sizes:
            at = np.flatnonzero(word[:len(h)] == word[n - 1:])
            out_b.append((h[at] % np.uint64(buckets)).astype(np.int32))
            out_w.append(word[at])
    whole = np.add.reduceat(_mix(codes * np.uint64(0xD6E8FEB86659FD93) + (np.arange(len(codes)) - np.repeat(
        np.cumsum(length) - length, length)).astype(np.uint64)), np.cumsum(length) - length) if len(words) else h
    out_b.append((_mix(whole + np.uint64(99)) % np.uint64(buckets)).astype(np.int32))
    out_w.append(np.arange(len(words), dtype=np.int32))
    return np.concatenate(out_b), np.concatenate(out_w)
