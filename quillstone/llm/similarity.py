"""String similarities and MinHash tuned from its collision curve."""

from __future__ import annotations

import math
import zlib

import numpy as np

PRIME = (1 << 61) - 1


def edit_distance(a: str, b: str, limit: int) -> int:
    """Damerau-Levenshtein distance (adjacent transpositions count once); limit + 1 when it is greater than limit."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    start = 0
    while start < len(a) and start < len(b) and a[start] == b[start]:
        start += 1
    a, b = a[start:], b[start:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    n, m = len(a), len(b)
    if not n or not m:
        return min(max(n, m), limit + 1)
    before, last = [0] * (m + 1), list(range(m + 1))
    for i in range(1, n + 1):
        now = [i] + [limit + 1] * m
        x, least = a[i - 1], i
        for j in range(max(1, i - limit), min(m, i + limit) + 1):
            y = b[j - 1]
            d = last[j - 1] + (x != y)
            if last[j] + 1 < d:
                d = last[j] + 1
            if now[j - 1] + 1 < d:
                d = now[j - 1] + 1
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] + 1 < d:
                d = before[j - 2] + 1
            now[j] = d
            if d < least:
                least = d
        if least > limit:
            return limit + 1
        before, last = last, now
    return min(last[m], limit + 1)


def token_similarity(a: str, b: str) -> float:
    """1 - distance / length, 0 when more than two edits (one, for words shorter than eight letters) apart."""
    longest = max(len(a), len(b))
    limit = 0 if longest < 4 else 1 if longest < 8 else 2
    d = edit_distance(a, b, limit)
    return 0.0 if d > limit else 1.0 - d / longest


def monge_elkan(a: list[str], b: list[str], sim=token_similarity) -> float:
    """Symmetric Monge-Elkan: the smaller of the two mean best similarities of the words."""
    if not a or not b:
        return 0.0
    one = lambda s, t: sum(max(sim(x, y) for y in t) for x in s) / len(s)
    return min(one(a, b), one(b, a))


def padded_qgrams(tokens: list[str], q: int = 3) -> set[str]:
    """q-grams of each word with q - 1 blanks on either side, so that beginnings and endings weigh more."""
    pad = " " * (q - 1)
    grams: set[str] = set()
    for t in tokens:
        s = f"{pad}{t}{pad}"
        grams.update(s[i : i + q] for i in range(len(s) - q + 1))
    return grams


def collision(similarity: float, bands: int, rows: int) -> float:
    """The chance that two sets of a Jaccard similarity share at least one band."""
    return 1.0 - (1.0 - similarity**rows) ** bands


def tune_bands(similarity: float, recall: float, max_hashes: int = 320) -> tuple[int, int]:
    """(bands, rows) with the steepest collision curve that still reaches `recall` at `similarity` within max_hashes."""
    best = (max_hashes, 1)
    for rows in range(1, 16):
        p = similarity**rows
        bands = math.ceil(math.log(1.0 - recall) / math.log(1.0 - p)) if p < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


class MinHasher:
    """Seeded MinHash signatures of string sets, cut into bands."""

    def __init__(self, bands: int, rows: int, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(1, 1 << 31, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 62, bands * rows, dtype=np.uint64)
        self.mix = rng.integers(1, 1 << 62, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, grams: set[str]) -> list[int]:
        """One 63-bit key for each band; an empty set has none."""
        if not grams:
            return []
        x = np.array([zlib.crc32(g.encode()) for g in grams], dtype=np.uint64)
        with np.errstate(over="ignore"):
            h = (x[:, None] * self.a + self.b) * np.uint64(0x9E3779B97F4A7C15)
            low = (h >> np.uint64(20)).min(axis=0).reshape(self.bands, self.rows)
            mixed = (low * self.mix).sum(axis=1, dtype=np.uint64)
            mixed ^= np.arange(self.bands, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (mixed >> np.uint64(1)).astype(np.int64).tolist()
