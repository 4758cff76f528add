"""Evaluation texts leaking into training text (problem 8): latent semantic retrieval, then alignment.

Passages of documents and of test items are TF-IDF vectors over hashed words. A distributed randomised SVD gives a
latent space; passages whose cosine with a passage of an item is high are candidates. Where their longest common
subsequence allows for it, candidates are aligned, and one is kept when a common run of words (with single words altered)
covers at least half of the item; a run with more words altered, a paraphrase, is kept when the item's answer follows it.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows
from quillstone.llm.similarity import edit_distance

#: Hashed words, dimensions of the latent space, words of a block; a passage is two neighbouring blocks.
DIMS, RANK, BLOCK = 1 << 14, 96, 24
#: The space is fitted on the passages of at most so many documents, chosen by a hash, and on all items; every passage is searched.
FIT_DOCUMENTS, HASH_STEPS = 4_000, 1 << 20
#: Latent cosine from which a passage is a candidate; its recall against brute force is measured in the tests.
CANDIDATE = 0.4
#: Share of an item's words that one run must cover.
SHARE = 0.5
#: Share of a run's words that must be the item's: only single words may be altered.
MATCHED = 0.85
#: The same for a run that the item's answer follows: a paraphrase.
PARAPHRASED = 0.7
#: Words behind a run among which the answer is looked for, besides its own.
AFTER = 4
#: Items searched at once.
ITEM_BLOCK = 4_096
SEED = 11

class _Signs(dict):
    """A translation that deletes every sign that is no letter, digit or blank; filled as characters come."""

    def __missing__(self, i: int):
        self[i] = found = None if unicodedata.category(chr(i))[0] in "PSM" else i
        return found


_SIGNS = _Signs()
_ASCII = {i: None for i in range(128) if unicodedata.category(chr(i))[0] in "PSM"}


def words_of(text: str) -> list[str]:
    """Words in lower case without any sign, so that layout, case and punctuation do not matter."""
    if text.isascii():
        return text.lower().translate(_ASCII).split()
    return unicodedata.normalize("NFKD", text).lower().translate(_SIGNS).split()


class Hasher(dict):
    """Words to hashed feature numbers, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = zlib.crc32(word.encode()) % DIMS
        return h

    def ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def blocks_of(n: int) -> list[int]:
    """First words of the blocks of a text of n words; a short rest joins the block before it."""
    return list(range(0, max(n - BLOCK // 2, 1), BLOCK)) if n else []


ARRAY = T.StructType([T.StructField("n", T.LongType()), T.StructField("payload", T.BinaryType())])


def _add_up(parts: DataFrame, dtype, shape: tuple) -> tuple[int, np.ndarray]:
    """The sum of the tasks' arrays of one fixed shape: added in groups on the executors, then a few on the driver."""

    def add(source: Iterator[tuple]) -> Iterator[tuple]:
        n, total = 0, None
        for k, payload in source:
            x = np.frombuffer(zlib.decompress(payload), dtype)
            total = x.copy() if total is None else total + x
            n += k
        if total is not None:
            yield n, zlib.compress(total.tobytes(), 1)

    few = map_rows(parts.repartition(4), ARRAY, add, batch=1)
    n, total = 0, np.zeros(shape, dtype)
    for k, payload in few.collect():
        n += k
        total += np.frombuffer(zlib.decompress(payload), dtype).reshape(shape)
    return n, total


def document_frequencies(documents: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents with words, and in how many of them each hashed word is: over all documents."""

    def rows(source):
        hasher, df, n = Hasher(), np.zeros(DIMS, np.int64), 0
        for (text,) in source:
            ids = hasher.ids(words_of(text or ""))
            if len(ids):
                df[np.unique(ids)] += 1
                n += 1
        if n:
            yield n, zlib.compress(df.tobytes(), 1)

    return _add_up(map_rows(documents.select("text"), ARRAY, rows, batch=1), np.int64, (DIMS,))


def _passages(ids: np.ndarray, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, weights) of unit length of each passage of a text."""
    starts = blocks_of(len(ids))
    for k in range(max(len(starts) - 1, 1) if starts else 0):
        end = starts[k + 2] if k + 2 < len(starts) else len(ids)
        u, n = np.unique(ids[starts[k] : end], return_counts=True)
        w = n * idf[u]
        yield u, w / (np.linalg.norm(w) or 1.0)


def latent_space(documents: DataFrame, n_documents: int, item_ids: list[np.ndarray], idf: np.ndarray, rank: int = RANK, fit_documents: int = FIT_DOCUMENTS) -> np.ndarray:
    """A DIMS x rank orthonormal basis: the leading right singular vectors of the passages' TF-IDF matrix.

    Randomised range finder: every task multiplies its rows A_p with a seeded random matrix and back, A_p' (A_p W); the
    sums are of fixed size. The items' passages are added with the same total weight as the corpus, so that the space
    holds what tells items apart, however large the corpus.
    """
    omega = np.random.default_rng(SEED).standard_normal((DIMS, rank + 16)).astype(np.float32)

    def sketch(texts: Iterator[np.ndarray]) -> tuple[int, np.ndarray]:
        total, n = np.zeros((DIMS, omega.shape[1]), np.float32), 0
        for ids in texts:
            for u, w in _passages(ids, idf):
                w = w.astype(np.float32)
                total[u] += w[:, None] * (w @ omega[u])
                n += 1
        return n, total

    def rows(source):
        hasher = Hasher()
        n, total = sketch(hasher.ids(words_of(text or "")) for (text,) in source)
        if n:
            yield n, zlib.compress(total.tobytes(), 1)

    # tasks hand on only what is below a hash threshold: 19 of 20 documents of the bound, so that chance does not pass it
    below = HASH_STEPS if n_documents <= fit_documents else int(HASH_STEPS * 0.95 * fit_documents / n_documents)
    sample = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASH_STEPS)) < below).select("text").repartition(4)
    n, corpus = _add_up(map_rows(sample, ARRAY, rows, batch=1), np.float32, (DIMS, omega.shape[1]))
    m, own = sketch(iter(item_ids))
    both = corpus / max(np.linalg.norm(corpus), 1e-9) * 0.5 + own / max(np.linalg.norm(own), 1e-9)
    u, _, _ = np.linalg.svd(both, full_matrices=False)
    return np.ascontiguousarray(u[:, :rank].astype(np.float32))


def same_word(a: str, b: str) -> bool:
    return a == b or len(a) > 3 and len(b) > 3 and a[0] == b[0] and edit_distance(a, b, 1) <= 1


class Target:
    """An item's words, prepared for alignment."""

    def __init__(self, words: list[str]):
        self.words = words
        self._places: dict[str, int] = {}
        self._starts: dict[str, list[str]] = {}
        for i, w in enumerate(words):
            if w not in self._places and len(w) > 3:
                self._starts.setdefault(w[0], []).append(w)
            self._places[w] = self._places.get(w, 0) | 1 << i
        self._masks: dict[str, int] = {}
        self._rows: dict[str, np.ndarray | None] = {}

    def mask(self, word: str) -> int:
        """A bit for each place where the item's word is this one; only when it is nowhere, for each place one slip away."""
        found = self._places.get(word)
        if found is None:
            found = self._masks.get(word)
        if found is None:
            if len(self._masks) > 5_000:
                self._masks.clear()
            found = 0
            for w in self._starts.get(word[0], ()):
                if abs(len(w) - len(word)) < 2 and same_word(word, w):
                    found |= self._places[w]
            self._masks[word] = found
        return found

    def row(self, word: str) -> np.ndarray | None:
        """1 where the item's word is this one (a slip in it does not matter), -1 elsewhere; None when it is nowhere."""
        if word not in self._rows:
            if len(self._rows) > 5_000:
                self._rows.clear()
            mask = self.mask(word)
            self._rows[word] = np.array([1 if mask >> i & 1 else -1 for i in range(len(self.words))], np.int16) if mask else None
        return self._rows[word]

    def most_matched(self, text: list[str]) -> int:
        """The most words that any alignment with the text can match: the longest common subsequence, by bits."""
        full = (1 << len(self.words)) - 1
        v = full
        for w in text:
            m = self.mask(w)
            if m:
                u = v & m
                v = (v + u | v - u) & full
        return len(self.words) - v.bit_count()

    def may_hold(self, text: list[str], matched: float) -> bool:
        """False only where no run that longest_run finds in the text matches so many words.

        A run scores above zero, so it has fewer words added than matched and spans less than twice the item: each lies
        whole in one of the windows.
        """
        step = 2 * len(self.words)
        return any(self.most_matched(text[i : i + 2 * step]) >= matched for i in range(0, max(len(text) - step, 1), step))


def longest_run(item: list[str] | Target, text: list[str], path: list | None = None) -> tuple[int, int, int, int, int]:
    """(item start, item end, text start, text end, words matched) of the best local alignment of two word lists.

    path, if given, receives (place in the text, whether matched) for each of the item's words of the run, in order.

    A word in common scores 1, one slip in a word too; an altered, added or dropped word costs 1, so a run goes on
    over single altered words but not over other text.
    """
    target = item if isinstance(item, Target) else Target(item)
    n = len(target.words)
    score = [target.row(w) for w in text]
    none = np.full(n, -1, np.int16)
    step = np.arange(n + 1, dtype=np.int16)
    h = np.zeros((len(text) + 1, n + 1), np.int16)
    t = np.empty(n + 1, np.int16)
    for j, s in enumerate(score):
        above, here = h[j], h[j + 1]
        t[0] = 0
        np.add(above[:-1], none if s is None else s, out=t[1:])
        np.subtract(above, 1, out=here)
        np.maximum(t, here, out=t)
        np.maximum(t, 0, out=t)
        t += step
        np.maximum.accumulate(t, out=here)
        here -= step
    j, i = divmod(int(h.argmax()), n + 1)
    end_i, end_j, matched = i, j, 0
    steps: list[tuple[int, bool]] = []
    while h[j, i] > 0:
        hit = i > 0 and j > 0 and score[j - 1] is not None and score[j - 1][i - 1] == 1
        if i and j and h[j, i] == h[j - 1, i - 1] + (1 if hit else -1):
            matched += hit
            i, j = i - 1, j - 1
            steps.append((j, hit))
        elif i and h[j, i] == h[j, i - 1] - 1:
            i -= 1
            steps.append((j, False))
        else:
            j -= 1
    if path is not None:
        path += steps[::-1]
    return i, end_i, j, end_j, matched


def part_of_run(path: list[tuple[int, bool]], least: int, share: float) -> tuple[int, int] | None:
    """(first, end) in path of its longest part of at least `least` words of which the given share is matched."""
    gain = np.concatenate([[0.0], np.cumsum([hit - share for _, hit in path])])
    for size in range(len(path), max(least, 1) - 1, -1):
        ahead = np.nonzero(gain[size:] - gain[:-size] >= -1e-9)[0]
        if len(ahead):
            return int(ahead[0]), int(ahead[0]) + size
    return None


def accepted_run(target: Target, text: list[str], least: int, answer: list[str]) -> tuple[int, int, int, bool] | None:
    """(words of the item, text start, text end, whether the answer follows) of a run that shows the leak, or None.

    The best alignment is tried first, or the longest acceptable part of it; where there is none, the text before and
    behind it is searched on, so that a long poor run hides no good one.
    """
    todo = [(0, len(text))]
    while todo:
        lo, hi = todo.pop()
        part = text[lo:hi]
        told = bool(answer) and answer[0] in part
        if not target.may_hold(part, (PARAPHRASED if told else MATCHED) * least):
            continue
        path: list[tuple[int, bool]] = []
        _, _, j0, j1, _ = longest_run(target, part, path)
        for share in (MATCHED, PARAPHRASED) if told else (MATCHED,):
            span = part_of_run(path, least, share)
            if span:
                start, end = lo + path[span[0]][0], lo + path[span[1] - 1][0] + 1
                after = text[end : end + AFTER + len(answer)]
                follows = bool(answer) and any(after[k : k + len(answer)] == answer for k in range(AFTER + 1))
                if share == MATCHED or follows:
                    return span[1] - span[0], start, end, follows
        if j1 > j0:
            todo += [(lo, lo + j0), (lo + j1, hi)]
    return None


class Items:
    """The items of a block with their passages in the latent space."""

    def __init__(self, rows: list[tuple], space: np.ndarray, idf: np.ndarray):
        self.ids = [r[0] for r in rows]
        self.words = [words_of(r[1] or "") for r in rows]
        self.answers = [words_of(r[2] or "") for r in rows]
        hasher = Hasher()
        of, vectors = [], []
        for k, words in enumerate(self.words):
            ids = hasher.ids(words)
            half = max(len(ids) // 2, 1)
            # the whole item, and runs of half its words
            spans = [(0, len(ids))] + [(s, s + half) for s in range(0, len(ids) - half + 1, max(half // 4, 1))]
            for s, e in spans:
                u, n = np.unique(ids[s:e], return_counts=True)
                w = n * idf[u]
                of.append(k)
                vectors.append((w / (np.linalg.norm(w) or 1.0)).astype(np.float32) @ space[u])
        self.targets = [Target(w) for w in self.words]
        self.of = np.array(of, np.int32)
        self.vectors = np.stack(vectors) if vectors else np.zeros((0, space.shape[1]), np.float32)


LEAKS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("share", T.DoubleType()),
        T.StructField("cosine", T.DoubleType()),
        T.StructField("first_word", T.IntegerType()),
        T.StructField("answer_follows", T.BooleanType()),
    ]
)


def leaks(documents: DataFrame, items: DataFrame, candidate: float = CANDIDATE, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, share, cosine, first_word, answer_follows): items of which a document holds the given share in one run.

    Every passage of every document is searched, in one narrow pass; items are taken in blocks of ITEM_BLOCK, so what a
    task holds is bounded. Null and empty texts match nothing; repeated documents are each reported.
    `answer_follows` tells whether the item's answer is named right after the run.
    """
    spark = documents.sparkSession
    n_items = items.count()
    n, df = document_frequencies(documents)
    idf = np.log((1.0 + n) / (1.0 + df)) + 0.1
    out = None
    for first in range(0, max(n_items, 1), ITEM_BLOCK):
        block = items.select("item_id", "text", "answer").orderBy("item_id").offset(first).limit(ITEM_BLOCK).collect()
        rows = [tuple(r) for r in block if r["text"] and words_of(r["text"])]
        if not rows:
            continue
        hasher = Hasher()
        space = latent_space(documents, n, [hasher.ids(words_of(r[1])) for r in rows], idf)
        known = Items(rows, space, idf)
        model = spark.sparkContext.broadcast((known, (space * idf[:, None]).astype(np.float32), (idf**2).astype(np.float32)))
        part = map_rows(documents.select(F.col("doc_id").cast("long"), "text"), LEAKS, _search(model, candidate, share))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], LEAKS)


def _search(model, candidate: float, share: float):
    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        known, table, squares = model.value
        hasher = Hasher()
        held: list[tuple[int, list[str], np.ndarray]] = []
        size = 0
        for doc, text in source:
            words = words_of(text or "")
            if words:
                held.append((doc, words, hasher.ids(words)))
                size += len(words)
            if size > 60_000:
                yield from _batch(held, known, table, squares, candidate, share)
                held, size = [], 0
        if held:
            yield from _batch(held, known, table, squares, candidate, share)

    return rows


def _batch(held, known: Items, table: np.ndarray, squares: np.ndarray, candidate: float, share: float) -> Iterator[tuple]:
    starts, owner, local = [], [], []
    base = 0
    for d, (_, words, ids) in enumerate(held):
        for s in blocks_of(len(ids)):
            starts.append(base + s)
            owner.append(d)
            local.append(s)
        base += len(ids)
    ids = np.concatenate([h[2] for h in held])
    sums = np.add.reduceat(table[ids], starts, axis=0)
    norms = np.add.reduceat(squares[ids], starts)
    owner_a = np.array(owner)
    paired = np.nonzero(owner_a[:-1] == owner_a[1:])[0]
    alone = np.nonzero(np.bincount(owner_a, minlength=len(held))[owner_a] == 1)[0]
    at = np.concatenate([paired, alone])
    vectors = np.concatenate([sums[paired] + sums[paired + 1], sums[alone]])
    length = np.sqrt(np.concatenate([norms[paired] + norms[paired + 1], norms[alone]]))
    near = (vectors / np.maximum(length, 1e-6)[:, None]) @ known.vectors.T
    hits = np.nonzero(near >= candidate)
    best: dict[tuple[int, int], dict[int, float]] = {}
    for p, q in zip(*hits):
        k, item = int(at[p]), int(known.of[q])
        places = best.setdefault((owner[k], item), {})
        places[local[k]] = max(places.get(local[k], 0.0), float(near[p, q]))
    for (d, item), places in best.items():
        doc, words, _ = held[d]
        target = known.targets[item]
        n = len(target.words)
        # neighbouring passages are aligned as one stretch of text
        stretches: list[list[int]] = []
        for s in sorted(places):
            lo, hi = max(s - n - 8, 0), min(s + 2 * BLOCK + n + 8, len(words))
            if stretches and lo <= stretches[-1][1]:
                stretches[-1][1] = hi
            else:
                stretches.append([lo, hi])
        found = None
        least = math.ceil(share * n)
        for lo, hi in stretches:
            # the answer is looked for behind the stretch too
            run = accepted_run(target, words[lo : hi + AFTER + len(known.answers[item])], least, known.answers[item])
            if run and (found is None or run[0] > found[0]):
                found = run[0], lo + run[1], run[3]
        if found:
            yield doc, known.ids[item], found[0] / n, max(places.values()), found[1], found[2]


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(documents, items).select("doc_id", "item_id")
