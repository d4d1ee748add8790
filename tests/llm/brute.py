"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
import zlib

import xxhash


def winnowed(text, gram=12, window=16):
    """[(position, hash)] by the definition: window by window, rightmost smallest."""
    if not text:
        return []
    grams = [text[i:i + gram] for i in range(len(text) - gram + 1)] or [text]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) & ((1 << 33) - 1) for g in grams]
    out = set()
    for i in range(max(1, len(h) - window + 1)):
        own = h[i:i + window]
        out.add((i + max(j for j, x in enumerate(own) if x == min(own)), min(own)))
    return sorted(out)


def simhash(text, words=4):
    own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not own:
        return 0
    shingles = [" ".join(own[i:i + words]) for i in range(len(own) - words + 1)] or [" ".join(own)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(keys, linked):
    """Smallest index reachable, for each index, by trying all pairs."""
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if linked(keys[i], keys[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(keys))]


def tiling(a, b, shortest):
    """Lengths of greedy tiles, trying all pairs of positions for the longest match each time."""
    used_a, used_b, out = [False] * len(a), [False] * len(b), []
    while True:
        best = (shortest - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while (i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and a[i + n] >= 0
                       and not used_a[i + n] and not used_b[j + n]):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < shortest:
            return out
        used_a[i:i + n] = used_b[j:j + n] = [True] * n
        out.append(n)


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
