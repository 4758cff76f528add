"""Noise in text from scanned pages (problem 2): noisy-channel correction and repair into paragraphs.

One pass over all texts counts words, word pairs and page furniture; the counts live in sketches whose size follows the
number of different words and pairs up to a bound, so the model that tasks share does not grow with the corpus beyond it. A second pass labels the lines of each text and decodes its
body lines: candidate words come from a table of character confusions, and Viterbi picks the most likely line under
confusion probabilities times corpus bigrams.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows
from quillstone.session import cut

#: Counters at most in each of the two rows of a sketch. A sketch is folded to the smallest power of two that holds eight times the
#: occupied counters, LEAST_CELLS at least, so that a chance of 1 in 64 adds to a count until CELLS is reached; beyond,
#: a count is too high by at most 2 n / CELLS with a chance of 3 in 4 (n words or pairs counted). 256 MB together at most.
CELLS, LEAST_CELLS = 1 << 24, 1 << 16
SHARDS = 16
#: Distinct words, pairs or lines that a task counts before it hands them on; with it a worker's memory is bounded.
HELD = 500_000
#: A misreading is believed when the word it stands for is so many times as frequent as what is written.
RATIO = 12.0
#: Chance that a word is misread, and share of it that a word with signs inside keeps of its count.
MISREAD, SIGN_DISCOUNT = 1.0 / 30.0, 0.02
#: Absolute discount of word and pair counts: a slip and its few copies must not vouch for themselves.
DISCOUNT = 4
#: Words counted less often than this are looked at in a corpus of any size.
LEAST = 20
#: A line is page furniture when it is in this share of the scanned texts and mostly beside other furniture.
FURNITURE_SHARE, FURNITURE_BESIDE = 0.004, 0.35

# What a scanner writes for what stands on the page.
CONFUSIONS = {
    "@": "a", "|": "l i", "1": "l i", "0": "o", "5": "s", "$": "s", "9": "g", "6": "b", "8": "b", "3": "e", "c": "e", "cl": "d", "rn": "m", "nn": "m", "vv": "w", "ii": "u", "li": "h",
    "!": "l i", "o": "c e", "a": "o", "e": "c", "n": "u ri", "u": "n", "tl": "d", "ri": "n", "l": "i t", "i": "l", "h": "b", "m": "rn", "d": "cl", "w": "vv", "f": "t", "t": "f", "ni": "m", "in": "m", "lii": "hi", "ﬁ": "fi", "ﬂ": "fl",
}
# Letters written for digits.
DIGITS = {"B": "8", "S": "5", "O": "0", "o": "0", "l": "1", "I": "1", "|": "1", "Z": "2", "g": "9", "s": "5", "i": "1", "b": "6", "q": "9", "G": "6", "z": "2"}
# Marks that break a word at a line's end; the first may also belong to the word.
SOFT_MARKS = "­¬"
MARKS = "-‐‑" + SOFT_MARKS

_PAGE_NO = r"[\dlOISBZo|]{1,4}"
PAGE = re.compile(rf"^\s*(?:\S{{4}} {_PAGE_NO}|\S{{4}} {_PAGE_NO} \S{{2}} {_PAGE_NO}|{_PAGE_NO} ?/ ?{_PAGE_NO}|\[ ?{_PAGE_NO} ?\]|[-–] ?{_PAGE_NO} ?[-–]|[ivxlc1]{{1,7}}(?<!1)|Seite {_PAGE_NO})\s*$")
BARE = re.compile(r"^\s*(?=[lOISBZo|]*\d)[\dlOISBZo|]{1,4}\s*$")
_AMOUNT = r"[\dOlISB|][\dOlISB|.,]*\s?(?:mg|mcg|microgram|g|IU|mmol|mL|%|m9|rng|micr0gram)"
TITLE = re.compile(rf"^\f?\s*[^\W\d_][^\s.;:]*(?:\s[^\s.;:]+){{0,3}}?\s?{_AMOUNT}(?:\s?/\s?{_AMOUNT})*(?:\s\|\s\S+|\s{{2,}}\S+)?\s*$", re.I)
_AMOUNT_IN = re.compile(r"[\dOlISB|]\s?(?:mg|mcg|microgram|iu|mmol|g\b|ml|%|m9|rng|micr0gram)", re.I)
_DIGIT = re.compile(r"[0-9]")
_OUTER = re.compile(r"^[^\w@|$!%]+|[^\w@|$!%]+$")
_SIGNS = re.compile(r"[@|$!\dﬁﬂ]")
_LETTERS = re.compile(r"^[a-z]+$")


_DIGIT_WITHIN = re.compile(r"[a-z][0-9][a-z]")


def noisy(text: str) -> bool:
    """Traces of a scanner within a text: signs that words do not have, soft breaks, digits within words."""
    return "@" in text or "|" in text or any(mark in text for mark in MARKS[1:]) or _DIGIT_WITHIN.search(text) is not None


def page_line(line: str) -> bool:
    """A line that holds only a page's number."""
    return len(line) <= 24 and PAGE.match(line) is not None


def title_line(line: str) -> bool:
    """A line that starts a page: after a form feed, or a medicine's name and strength with nothing else."""
    return line[:1] == "\f" or len(line) < 110 and line[-1:] not in ".,;:" and _DIGIT.search(line) is not None and _AMOUNT_IN.search(line) is not None and TITLE.match(line) is not None


def may_be_furniture(line: str) -> bool:
    return 8 <= len(line) <= 80 and line[-1] not in ".,;"


def core(token: str) -> str:
    """A token without outer punctuation, in lower case."""
    return _OUTER.sub("", token).lower()


def _cells(word: str, cells: int = CELLS) -> tuple[int, int]:
    h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
    return h % cells, (h >> 32) % cells


def written_number(line: str) -> int:
    """The number of a bare number's line, letters read as the digits they stand for."""
    return int("".join(DIGITS.get(c, c) for c in line.strip()))


def fold_line(line: str) -> str:
    """A line as furniture is compared: no blanks, lower case, digits as 9, common misreadings undone."""
    s = re.sub(r"\s+", "", line).lower().replace("@", "a").replace("|", "l")
    s = re.sub(r"(?<=[a-z])[15](?=[a-z])|(?<=[a-z])0(?=[a-z])", lambda m: {"1": "i", "5": "s", "0": "o"}[m.group()], s)
    return re.sub(r"\d", "9", s)


#: Chunks of a product that are read by one task, in order; a product with very many is spread over tasks.
SEGMENT = 64


def segment(chunk_index: int | None) -> int:
    return -1 if chunk_index is None else chunk_index // SEGMENT


PASS = T.StructType(
    [
        T.StructField("what", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("m", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _pack(counts: dict[int, int]) -> bytes:
    index = np.fromiter(counts.keys(), np.uint32, len(counts))
    n = np.fromiter(counts.values(), np.uint32, len(counts))
    order = np.argsort(index)
    return zlib.compress(np.diff(index[order], prepend=np.uint32(0)).tobytes() + n[order].tobytes(), 1)


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(payload), np.uint32)
    half = len(both) // 2
    return np.cumsum(both[:half], dtype=np.uint64).astype(np.int64), both[half:]


def _sketch(counts: Counter) -> list[Counter]:
    """The counts of a task, as sparse counters by shard; both rows share the index space, the second after the first."""
    shards: list[Counter] = [Counter() for _ in range(SHARDS)]
    for word, n in counts.items():
        a, b = _cells(word)
        shards[a % SHARDS][a] += n
        b += CELLS
        shards[b % SHARDS][b] += n
    return shards


def learn(products: DataFrame, chunks: DataFrame) -> DataFrame:
    """Pass one over all texts: partial sketches of words and pairs, candidates of furniture, and each product's page style."""
    docs = products.where(F.col("document_text").isNotNull()).select(F.lit(None).cast("string"), F.lit(None).cast("long"), F.col("document_text").alias("text"))
    own = chunks.where(F.col("chunk_text").isNotNull()).select(F.col("product_id").cast("string").alias("id"), F.col("chunk_index").cast("long").alias("ci"), F.col("chunk_text").alias("text"))

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        words: Counter = Counter()
        pairs: Counter = Counter()
        line_all: Counter = Counter()
        line_beside: Counter = Counter()
        style: dict[tuple, list] = {}
        marked = 0
        for product, ci, text in source:
            lines = text.split("\n")
            page = [page_line(x) for x in lines]
            furniture = [p or title_line(x) for x, p in zip(lines, page)]
            any_mark = True in furniture
            marked += any_mark
            if product is not None:
                s = style.setdefault((product, segment(ci)), [0, 0])
                s[0] |= any_mark or not s[0] and noisy(text)
                s[1] |= True in page
            line_all.update(lines)
            if any_mark:
                for i, f in enumerate(furniture):
                    if f:
                        for x in lines[i - 1 : i] + lines[i + 1 : i + 2] if i else lines[1:2]:
                            if may_be_furniture(x):
                                line_beside[x] += 1
                tokens = [t for x, f in zip(lines, furniture) if not f for t in x.split()]
            else:
                tokens = text.split()
            words.update(tokens)
            pairs.update(zip(tokens, tokens[1:]))
            if len(pairs) > HELD or len(line_all) > HELD or len(words) > HELD:
                yield from flush(words, pairs)
                yield from flush_lines(line_all, line_beside)
                words, pairs, line_all, line_beside = Counter(), Counter(), Counter(), Counter()
        yield from flush(words, pairs)
        yield from flush_lines(line_all, line_beside)
        for (product, seg), (scanned, strong) in style.items():
            yield "style", product, seg, scanned, strong, None
        yield "texts", "", None, marked, 0, None

    def flush_lines(line_all: Counter, line_beside: Counter) -> Iterator[tuple]:
        # how often a line stands anywhere is counted in a sketch of its own, whichever task has seen it beside furniture
        for shard, part in enumerate(_sketch({x: n for x, n in line_all.items() if may_be_furniture(x)})):
            if part:
                yield "lines", "", shard, 0, 0, _pack(part)
        for x, m in line_beside.items():
            if not title_line(x) and not page_line(x):
                yield "line", f"{fold_line(x)}\n{x}", None, 0, m, None

    def flush(words: Counter, pairs: Counter) -> Iterator[tuple]:
        cores = {t: core(t) for t in words}
        folded: Counter = Counter()
        for t, n in words.items():
            if t[-1] not in MARKS and cores[t]:
                folded[cores[t]] += n
                if "-" in cores[t]:  # the first part of a word that keeps its mark
                    folded[cores[t].partition("-")[0] + "-"] += n
        both: Counter = Counter()
        for (a, b), n in pairs.items():
            if a[-1] not in ".;:" + MARKS and cores[a] and cores[b]:
                both[f"{cores[a]} {cores[b]}"] += n
        yield "total", "", None, sum(folded.values()), 0, None
        for what, counts in (("word", folded), ("pair", both)):
            for shard, part in enumerate(_sketch(counts)):
                if part:
                    yield what, "", shard, 0, 0, _pack(part)

    return cut(map_rows(own.unionByName(docs.toDF("id", "ci", "text")), PASS, rows, batch=2_000))


def _fold(parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The two rows of a sketch, one after the other, folded to the power of two that its occupied counters ask for."""
    occupied = max(sum(int((index < CELLS).sum()) for index, _ in parts), 1)
    cells = min(max(1 << (8 * occupied - 1).bit_length(), LEAST_CELLS), CELLS)
    table = np.zeros(2 * cells, np.uint64)
    for index, n in parts:
        np.add.at(table, index // CELLS * cells + index % cells, n)
    return np.minimum(table, 2**32 - 1).astype(np.uint32)


def _read(table: np.ndarray, word: str) -> int:
    """How often a word was counted: the lesser of its two counters."""
    cells = len(table) // 2
    a, b = _cells(word, cells)
    return int(min(table[a], table[cells + b]))


class Model:
    """The shared model: sketches of bounded size, the furniture lines (bounded by FURNITURE_SHARE) and the total."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray, total: int, furniture: frozenset[str]):
        self.words, self.pairs, self.total, self.furniture = words, pairs, max(total, 1), furniture
        self.shortest, self.longest = min(map(len, furniture), default=0), max(map(len, furniture), default=-9)
        self._n: dict[str, int] = {}

    def __reduce__(self):
        return Model, (self.words, self.pairs, self.total, self.furniture)

    @classmethod
    def gather(cls, learned: DataFrame) -> "Model":
        """Merges the partial sketches shard by shard on the executors; the driver gets at most the sketches' greatest size."""
        merged = T.StructType([T.StructField("what", T.StringType()), T.StructField("payload", T.BinaryType())])

        def merge(frame: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(2 * CELLS // SHARDS, np.uint64)
            for payload in frame["payload"]:
                index, n = _unpack(payload)
                total[index // SHARDS] += n
            at = np.nonzero(total)[0]
            shard = int(frame["shard"].iloc[0])
            counts = dict(zip((at * SHARDS + shard).tolist(), np.minimum(total[at], 2**32 - 1).astype(np.uint32).tolist()))
            return pd.DataFrame([(frame["what"].iloc[0], _pack(counts))], columns=["what", "payload"])

        parts: dict[str, list] = {"word": [], "pair": [], "lines": []}
        for what, payload in learned.where("payload is not null").groupBy("what", "shard").applyInPandas(merge, merged).collect():
            parts[what].append(_unpack(payload))
        arrays = {what: _fold(found) for what, found in parts.items()}
        total, marked = learned.where("what in ('total', 'texts')").agg(F.sum(F.when(F.col("what") == "total", F.col("n"))), F.sum(F.when(F.col("what") == "texts", F.col("n")))).first()
        often = max(3.0, FURNITURE_SHARE * (marked or 0))
        lines = learned.where("what = 'line'").groupBy("key").agg(F.sum("m").alias("m"))
        everywhere = learned.sparkSession.sparkContext.broadcast(arrays.pop("lines"))

        def counted(source: Iterator[tuple]) -> Iterator[tuple]:
            for key, m in source:
                folded, _, line = key.partition("\n")
                yield folded, _read(everywhere.value, line), m

        known = map_rows(lines.select("key", "m"), T.StructType([T.StructField("key", T.StringType()), T.StructField("n", T.LongType()), T.StructField("m", T.LongType())]), counted)
        known = known.groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
        furniture = [r["key"] for r in known.where((F.col("m") >= often) & (F.col("m") >= F.col("n") * FURNITURE_BESIDE)).collect()]
        return cls(arrays["word"], arrays["pair"], int(total or 0), frozenset(furniture))

    def n(self, word: str) -> int:
        """How often a word (or a pair, its words joined by a blank) was counted."""
        got = self._n.get(word)
        if got is None:
            got = self._n[word] = _read(self.pairs if " " in word else self.words, word)
            if len(self._n) > HELD:
                self._n.clear()
        return got


class Reader:
    """Labels and decodes the lines of one text after another with a model."""

    def __init__(self, model: Model):
        self.m = model
        self._words: dict[str, tuple] = {}
        self._look: dict[str, bool] = {}

    # ---- page furniture

    def is_furniture(self, line: str) -> bool:
        if title_line(line):
            return True
        if not self.m.shortest - 2 <= len(line) - line.count(" ") <= self.m.longest + 2 or line[-1] in ",;":
            return False
        k = fold_line(line)
        if k in self.m.furniture:
            return True
        from quillstone.llm.similarity import edit_distance

        return len(k) >= 10 and any(abs(len(k) - len(f)) <= 2 and edit_distance(k, f, 2) <= 2 for f in self.m.furniture)

    def labels(self, lines: list[str], strong: bool) -> list[str]:
        """'header', 'page_number', '' (body) or ' ' (blank) for each line of a scanned text."""
        out = []
        for x in lines:
            if not x.strip():
                out.append(" ")
            elif page_line(x):
                out.append("page_number")
            elif len(x) < 110 and self.is_furniture(x):
                out.append("header")
            else:
                out.append("?" if BARE.match(x) else "")
        open_numbers = [i for i, kind in enumerate(out) if kind == "?"]
        sure: list[bool] = []
        for i in open_numbers:
            above, below = out[i - 1] if i else "", out[i + 1] if i + 1 < len(out) else ""
            page = False
            if not strong:
                j = i - 1
                while j >= 0 and out[j] in (" ", "?", "table"):
                    j -= 1
                in_table = j >= 0 and (out[j] == "" and lines[j].rstrip().endswith(":") or out[j] != "" and self._table_before(lines, out, j))
                # a page ends with its number and the next one starts with its title
                beside = above == "header" and not title_line(lines[i - 1]) or below == "header" and (above != "header" or not in_table)
                page = beside and not (in_table and above != "header" and self._is_footer(lines[i + 1])) or not beside and not in_table and above not in ("?", "table")
            out[i] = "page_number" if page else "table"
            sure.append(page)
        if any(sure):
            for i, page in zip(open_numbers, self._in_sequence([(written_number(lines[i]), ok) for i, ok in zip(open_numbers, sure)])):
                edge = i == 0 or i == len(out) - 1 or out[i - 1].strip() != "" or out[i + 1].strip() != "" or lines[i - 1].strip() != "" and lines[i + 1].strip() != ""
                out[i] = "page_number" if page and (out[i] == "page_number" or edge) else "table"
        return ["" if k == "table" else k for k in out]

    @staticmethod
    def _in_sequence(numbers: list[tuple[int, bool]]) -> list[bool]:
        """Which of a text's bare numbers are its pages': the chain of rising numbers that holds most of the likely ones.

        A step of one is free, a page or two without a number cost a little; numbers unlike pages count little.
        """
        worth = [1.0 if ok else 0.1 for _, ok in numbers]
        best, back = list(worth), [-1] * len(numbers)
        last: dict[int, int] = {}
        for j, (v, _) in enumerate(numbers):
            for step, cost in ((1, 0.0), (2, 0.3), (3, 0.6), (4, 0.8)):
                i = last.get(v - step)
                if i is not None and best[i] + worth[j] - cost > best[j]:
                    best[j], back[j] = best[i] + worth[j] - cost, i
            if v not in last or best[j] >= best[last[v]]:
                last[v] = j
        j = max(range(len(numbers)), key=best.__getitem__)
        keep = [False] * len(numbers)
        while j >= 0:
            keep[j] = True
            j = back[j]
        return keep

    def _is_footer(self, line: str) -> bool:
        return not title_line(line)

    @staticmethod
    def _table_before(lines: list[str], out: list[str], j: int) -> bool:
        while j >= 0 and (out[j] in (" ", "table", "header", "page_number")):
            j -= 1
        return j >= 0 and lines[j].rstrip().endswith(":")

    # ---- words

    def candidates(self, word: str) -> list[tuple[str, int]]:
        """(word, position of the change) that one confusion, or the same one twice, makes of a written word."""
        found: dict[str, int] = {}
        for size in (1, 2, 3):
            for i in range(len(word) - size + 1):
                for true in CONFUSIONS.get(word[i : i + size], "").split():
                    c = word[:i] + true + word[i + size :]
                    found.setdefault(c, i)
                    if _SIGNS.search(c):
                        for j in range(len(c)):
                            if _SIGNS.match(c[j]):
                                for again in CONFUSIONS.get(c[j], "").split():
                                    found.setdefault(c[:j] + again + c[j + 1 :], i)
        return list(found.items())

    def known(self, token: str) -> tuple[float, list[tuple[str, float, int]]]:
        """(count of a token as written, candidates with their channel log-probability and place); memoised."""
        got = self._words.get(token)
        if got is not None:
            return got
        word = core(token)
        n, options = float(self.m.n(word)) if word else 0.0, []
        if word and n < max(self.m.total * 2e-4, LEAST):
            mixed = bool(_SIGNS.search(word)) and bool(re.search(r"[a-z]", word))
            numeral = re.sub(r"\W", "", _OUTER.sub("", token).replace("|", "l"))
            if mixed and re.search(r"\d", word) and len(numeral) <= 5 and all(c.isdigit() or c in DIGITS for c in numeral):
                digits = "".join(DIGITS.get(c, c) for c in _OUTER.sub("", token))
                if self.m.n(digits) >= RATIO * n / 4 and self.m.n(digits) > 0:
                    options.append((digits, math.log(MISREAD), 0))
            n = max(n - DISCOUNT, 0.3 * n)
            plain = bool(_LETTERS.match(word.replace("-", "").replace("/", "")))
            if (mixed and not word[0].isdigit() or plain) and len(word) > 2 or mixed and len(re.sub(r"[^a-z]", "", word)) >= 3:
                if mixed:
                    n *= SIGN_DISCOUNT
                for c, at in self.candidates(word):
                    if _SIGNS.search(c) and not self.m.n(c):
                        continue
                    if self.m.n(c) >= max(3.0, RATIO * n):
                        options.append((c, math.log(MISREAD), at))
            if plain and len(word) >= 6 and not options and n < max(self.m.total * 1e-5, LEAST / 2):
                for i in range(2, len(word) - 1):
                    both = self.m.n(f"{word[:i]} {word[i:]}")
                    if both >= max(5.0, RATIO * n):
                        options.append((f"{word[:i]} {word[i:]}", math.log(MISREAD), i))
        if len(self._words) > HELD // 2:
            self._words.clear()
        self._words[token] = n, options
        return n, options

    def _worth(self, token: str) -> bool:
        """Whether a token is rare or has candidates, so that its line must be decoded."""
        n, options = self.known(token)
        if len(self._look) > HELD // 2:
            self._look.clear()
        self._look[token] = found = bool(options) or n < max(self.m.total * 3e-5, LEAST)
        return found

    def _likelihood(self, before: str, word: str) -> float:
        """log P(word | before): bigram interpolated with unigram."""
        one = (self.m.n(word.split(" ")[0]) + 0.01) / self.m.total
        if not before:
            return math.log(one)
        left = self.m.n(before)
        pair = max(self.m.n(f"{before} {word.split(' ')[0]}") - DISCOUNT, 0)
        return math.log(0.6 * (pair / left if left else 0.0) + 0.4 * one)

    def decode(self, tokens: list[str]) -> list[tuple[str, int]] | None:
        """The most likely (word, number of tokens it stands for) of a line; None when that is the line as it stands.

        A pair of tokens may also be one word with a wrong gap. Viterbi over the candidates of each place.
        """
        look = self._look
        if not any([look[t] if t in look else self._worth(t) for t in tokens]):
            return None
        states: list[list[tuple[str, float]]] = []
        open_places = False
        infos = [self.known(t) for t in tokens]
        for t, (n, options) in zip(tokens, infos):
            here = [(core(t), 0.0)]
            if options:
                open_places = True
                here = [(core(t), math.log((n + 0.02) / (self.m.n(core(t)) + 0.01)))] + [(c, p) for c, p, _ in options]
            states.append(here)
        joins: dict[int, str] = {}
        rare = max(self.m.total * 3e-5, LEAST)
        for i in range(len(tokens) - 1):
            a, b = tokens[i], tokens[i + 1]
            if (infos[i][0] < rare or infos[i + 1][0] < rare) and a[-1:].isalpha() and b[:1].isalpha() and b[:1].islower():
                x, y = core(a), core(b)
                whole = self.m.n(x + y)
                if whole >= max(5.0, RATIO * max(self.m.n(f"{x} {y}") - DISCOUNT, 0.5)) and (self.m.n(x) < whole or self.m.n(y) < whole):
                    joins[i] = x + y
        if not open_places and not joins:
            return None
        # only the stretch from before the first open place to behind the last one can change
        places = [i for i, here in enumerate(states) if len(here) > 1] + [x for i in joins for x in (i, i + 1)]
        lo, hi = max(min(places) - 1, 0), min(max(places) + 2, len(tokens))
        front, back = [(core(t), 1) for t in tokens[:lo]], [(core(t), 1) for t in tokens[hi:]]
        tokens, states, joins = tokens[lo:hi], states[lo:hi], {i - lo: w for i, w in joins.items()}
        # layers[i]: for each word that may end before token i, its score and the words up to it
        layers: list[dict[str, tuple[float, list[tuple[str, int]]]]] = [{"": (0.0, [])}]
        for i, here in enumerate(states):
            now: dict[str, tuple[float, list[tuple[str, int]]]] = {}
            for before, (score, path) in layers[i].items():
                for w, p in here:
                    s = score + p + self._likelihood(before.split(" ")[-1], w)
                    if w not in now or s > now[w][0]:
                        now[w] = s, path + [(w, 1)]
            if i and i - 1 in joins:
                w = joins[i - 1]
                for before, (score, path) in layers[i - 1].items():
                    s = score + math.log(MISREAD) + self._likelihood(before.split(" ")[-1], w)
                    if w not in now or s > now[w][0]:
                        now[w] = s, path + [(w, 2)]
            layers.append(now)
        best = max(layers[-1].values(), key=lambda x: x[0])[1]
        return None if best == [(core(t), 1) for t in tokens] else front + best + back

    # ---- broken words

    def broken(self, left: str, mark: str, right: str | None) -> bool:
        """Whether the mark between left and right breaks a word and must vanish."""
        if mark in SOFT_MARKS:
            return True
        x = core(left)
        x = x.rpartition("-")[2] if "-" in x else x
        if right is None:
            return bool(x) and self.m.n(x) < max(self.m.total * 1e-6, 1) and not self.m.n(f"{x}-")
        y = core(right)
        y_first = y.partition("-")[0]
        joined, hyphened = self.m.n(x + y_first), max(self.m.n(f"{core(left)}-{y}"), self.m.n(f"{x}-{y_first}"), self.m.n(f"{core(left)}-{y_first}"))
        if joined != hyphened:
            return joined > hyphened
        if not joined:
            best = max((self.m.n(c) for c, _ in self.candidates(x + y_first)), default=0)
            best_h = max([self.m.n(f"{x}-{c}") for c, _ in self.candidates(y_first)] + [self.m.n(f"{c}-{y_first}") for c, _ in self.candidates(x)], default=0)
            if best != best_h:
                return best > best_h
        return not (self.m.n(x) and self.m.n(y_first))

    # ---- texts

    def _across(self, part: str, rest: str) -> tuple[str, str] | None:
        """The two parts of a broken word corrected, or None when the word is right as it stands."""
        whole = core(part + rest)
        _, options = self.known(part + rest)
        fits = [(self.m.n(c), c, at) for c, _, at in options if " " not in c]
        if not fits:
            return None
        _, word, at = max(fits)
        k = len(core(part)) + (len(word) - len(whole) if at < len(core(part)) else 0)
        return word[:k], word[k:]

    def read(self, lines: list[str], strong: bool, first: int, last: int) -> Iterator[tuple[int, str, list[str] | None, bool]]:
        """(index, label, corrected tokens or None, broken) of the lines first..last-1; label is as in `labels`.

        The last token of a broken line keeps its mark. A wrong character within a broken word is charged to the line it
        stands on.
        """
        kinds = self.labels(lines, strong)
        carried, carried_fix = "", None  # the part of a broken word that the line before left, and the right rest of it
        for i in range(len(lines)):
            if kinds[i]:
                if first <= i < last:
                    yield i, kinds[i], None, False
                continue
            mine = first <= i < last
            line = lines[i].rstrip()
            tokens = line.split()
            head, head_fix = (carried, carried_fix) if tokens else ("", None)
            carried, carried_fix = "", None
            mark = line[-1:] if len(line) > 1 and line[-1:] in MARKS and (line[-2:-1].isalnum() or line[-2:-1] in "@|") else ""
            cut_word, out, wrong = False, list(tokens), False
            lo, hi = 1 if head else 0, len(tokens)
            if head and head_fix is not None and head_fix != core(tokens[0]):
                out[0], wrong = respell(tokens[0], head_fix), True
            if mark and hi > lo:
                j = i + 1
                while j < len(lines) and kinds[j]:
                    j += 1
                part = tokens[-1][:-1]
                nxt = lines[j].split()[0] if j < len(lines) else None
                cut_word = self.broken(part, mark, nxt)
                if cut_word:
                    hi -= 1
                    carried = part
                    fixed = self._across(part, nxt) if nxt else None
                    if fixed:
                        carried_fix = fixed[1]
                        if fixed[0] != core(part):
                            out[-1], wrong = respell(part, fixed[0]) + mark, True
                    elif nxt is None and _SIGNS.search(core(part)) and re.search(r"[a-z]", core(part)):
                        wrong = True
            if not mine:
                continue
            body = tokens[lo:hi]
            kept = bool(mark and not cut_word and body)
            if kept:
                body[-1] = body[-1][:-1]
            decoded = self.decode(body) if body else None
            if decoded is not None:
                shown, k = [], 0
                for word, n in decoded:
                    token = "".join(body[k : k + n])
                    shown.append(token if core(token) == word and n == 1 else respell(token, word))
                    k += n
                if kept:
                    shown[-1] += mark
                out = out[:lo] + shown + out[hi:]
            yield i, "", out if decoded is not None or wrong else None, cut_word


FOUND = T.StructType(
    [T.StructField("field", T.StringType()), T.StructField("row_key", T.StringType()), T.StructField("line_no", T.IntegerType()), T.StructField("kind", T.StringType())]
)


def _context(own: list[str], before: str | None, after: str | None) -> tuple[list[str], int, int]:
    """A chunk's lines with those of its neighbours around them: a chunk repeats the last line of the one before."""
    lines, first = own, 0
    if before:
        b = before.split("\n")
        if b[-1] == own[0]:
            b.pop()
        lines, first = b + lines, len(b)
    if after:
        a = after.split("\n")
        lines = lines + (a[1:] if a[0] == own[-1] else a)
    return lines, first, first + len(own)


STREAM = T.StructType(
    [T.StructField("product_id", T.StringType()), T.StructField("seg", T.LongType()), T.StructField("ci", T.LongType()), T.StructField("row_key", T.StringType()), T.StructField("text", T.StringType()), T.StructField("style", T.LongType())]
)


def chunk_stream(chunks: DataFrame, learned: DataFrame) -> DataFrame:
    """The chunks of all products in reading order, each segment led by a row with the product's page style.

    One shuffle, on (product, segment of SEGMENT chunks); the chunks at a segment's ends go to both segments, so that
    each finds its neighbours. Tasks stream, whatever a product's number of chunks.
    """
    style = learned.where("what = 'style'")
    of = style.groupBy("key").agg(F.max("n").alias("scanned"), F.max("m").alias("strong"))
    lead = style.select("key", F.col("shard").cast("long").alias("seg")).distinct().join(of, "key")
    lead = lead.select(F.col("key").alias("product_id"), "seg", F.lit(None).cast("long").alias("ci"), F.lit(None).cast("string").alias("row_key"), F.lit(None).cast("string").alias("text"), (F.col("scanned") * 2 + F.col("strong")).cast("long").alias("style"))
    ci = F.col("chunk_index").cast("long")
    seg = F.floor(ci / SEGMENT)
    segs = F.when(ci.isNull(), F.array(F.lit(-1).cast("long"))).when((ci % SEGMENT == 0) & (ci > 0), F.array(seg, seg - 1)).when(ci % SEGMENT == SEGMENT - 1, F.array(seg, seg + 1)).otherwise(F.array(seg))
    rows = chunks.where(F.col("chunk_text").isNotNull()).select(
        F.col("product_id").cast("string").alias("product_id"), F.explode(segs.cast("array<bigint>")).alias("seg"), F.coalesce(ci, F.lit(-9).cast("long")).alias("ci"), F.col("id").cast("string").alias("row_key"), F.col("chunk_text").alias("text"), F.lit(None).cast("long").alias("style")
    )
    return lead.unionByName(rows).repartition("product_id", "seg").sortWithinPartitions("product_id", "seg", F.col("ci").asc_nulls_first(), "row_key")


def _read_stream(source: Iterator[tuple], reader: Reader) -> Iterator[tuple[str, list[str], list]]:
    """(row_key, lines, read lines) of the scanned chunks of a stream, a segment (SEGMENT chunks and one to either side) at a time."""
    where, style, held = None, 0, []
    for product, seg, ci, key, text, lead in source:
        if (product, seg) != where:
            if held:
                yield from _read_segment(held, where[1], style, reader)
            where, style, held = (product, seg), 0, []
        if text is None:
            style = lead
        elif held and held[-1][0] == ci and ci >= 0:
            held[-1][1].append((key, text))
        else:
            held.append((ci, [(key, text)]))
    if held:
        yield from _read_segment(held, where[1], style, reader)


def _read_segment(held: list[tuple[int, list[tuple[str, str]]]], seg: int, style: int, reader: Reader) -> Iterator[tuple[str, list[str], list]]:
    """Chunks that follow each other are read as the one text they were cut from, the repeated lines once.

    style: 2 for a product with traces of a scanner, plus 1 for one with page lines; without traces, known furniture tells.
    """
    if style < 2 and not any(reader.is_furniture(x) for _, rows in held for _, text in rows for x in text.split("\n") if x):
        return
    strong = bool(style & 1)
    runs: list[list] = []
    for ci, rows in held:
        if runs and ci >= 0 and runs[-1][-1][0] == ci - 1:
            runs[-1].append((ci, rows))
        else:
            runs.append([(ci, rows)])
    for run in runs:
        lines: list[str] = []
        places = []
        for ci, rows in run:
            own = rows[0][1].split("\n")
            first = len(lines)
            if lines and lines[-1] == own[0]:
                first -= 1
                lines += own[1:]
            else:
                lines += own
            places.append((ci, rows, own, first))
        read = {i: (i, *rest) for i, *rest in reader.read(lines, strong, 0, len(lines))}
        for k, (ci, rows, own, first) in enumerate(places):
            if ci >= 0 and ci // SEGMENT != seg:
                continue
            for key, text in rows:
                if text == rows[0][1]:
                    yield key, own, [(i, *read[first + i][1:]) for i in range(len(own))]
                else:  # the same chunk delivered with another text
                    mine = text.split("\n")
                    all_lines, lo, hi = _context(mine, run[k - 1][1][0][1] if k else None, run[k + 1][1][0][1] if k + 1 < len(run) else None)
                    yield key, mine, [(i - lo, *rest) for i, *rest in reader.read(all_lines, strong, lo, hi)]


def _own_style(text: str, lines: list[str], reader: Reader) -> tuple[bool, bool]:
    """(scanned, numbered by page lines) of a whole text."""
    strong = any(map(page_line, lines))
    return strong or noisy(text) or any(reader.is_furniture(x) for x in lines if x), strong


def damaged_lines(products: DataFrame, chunks: DataFrame) -> DataFrame:
    """(field, row_key, line_no, kind): the damaged lines of every text; texts without page furniture were not scanned.

    Whole documents are read in place, without a shuffle; chunks in the order of their product. Null and empty texts
    have no row; of rows delivered twice each line is reported once.
    """
    learned = learn(products, chunks)
    model = products.sparkSession.sparkContext.broadcast(Model.gather(learned))

    def kinds(read) -> Iterator[tuple[int, str]]:
        for i, kind, decoded, cut_word in read:
            if kind.strip():
                yield i + 1, kind
            elif not kind:
                if cut_word:
                    yield i + 1, "hyphen"
                if decoded is not None:
                    yield i + 1, "misread"

    def of_documents(source):
        reader = Reader(model.value)
        for key, text in source:
            lines = text.split("\n")
            scanned, strong = _own_style(text, lines, reader)
            if scanned:
                for no, kind in kinds(reader.read(lines, strong, 0, len(lines))):
                    yield "document_text", key, no, kind

    def of_chunks(source):
        last, seen = None, set()
        for key, _, read in _read_stream(source, Reader(model.value)):
            if key != last:
                last, seen = key, set()
            for case in kinds(read):
                if case not in seen:
                    seen.add(case)
                    yield "chunk_text", key, *case

    docs = products.where(F.col("document_text").isNotNull()).select(F.col("id").cast("string"), "document_text")
    return map_rows(docs, FOUND, of_documents).unionByName(map_rows(chunk_stream(chunks, learned), FOUND, of_chunks))


def found(products: DataFrame, chunks: DataFrame) -> DataFrame:
    return damaged_lines(products, chunks)


CLEAN = T.StructType([T.StructField("field", T.StringType()), T.StructField("row_key", T.StringType()), T.StructField("clean_text", T.StringType())])


def respell(token: str, word: str) -> str:
    """A decoded word in the dress (case and outer punctuation) of the token it replaces."""
    m = re.match(r"^([^\w@|$!%]*)(.*?)([^\w@|$!%]*)$", token, re.S)
    head, middle, tail = m.groups() if m else ("", token, "")
    if middle[:1].isupper():
        word = word.upper() if len(middle) > 1 and middle.isupper() else word[:1].upper() + word[1:]
    return head + word + tail


def paragraphs(lines: list[str], read) -> str:
    """A scanned text as whole paragraphs: furniture left out, broken words joined, misreadings corrected."""
    done: list[str] = []
    now, glue = "", " "
    for i, kind, corrected, cut_word in read:
        if kind == " ":
            if now and glue == " ":
                done.append(now)
                now = ""
            continue
        if kind:
            continue
        line = " ".join(corrected if corrected is not None else lines[i].split())
        now = now + glue + line if now else line
        glue = "" if now[-1:] in MARKS else " "
        if cut_word:
            now = now[:-1]
    if now:
        done.append(now)
    return "\n\n".join(done)


def cleaned(products: DataFrame, chunks: DataFrame) -> DataFrame:
    """(field, row_key, clean_text): every scanned text repaired into paragraphs, one row a text."""
    learned = learn(products, chunks)
    model = products.sparkSession.sparkContext.broadcast(Model.gather(learned))

    def of_documents(source):
        reader = Reader(model.value)
        for key, text in source:
            lines = text.split("\n")
            scanned, strong = _own_style(text, lines, reader)
            if scanned:
                yield "document_text", key, paragraphs(lines, reader.read(lines, strong, 0, len(lines)))

    def of_chunks(source):
        last = None
        for key, lines, read in _read_stream(source, Reader(model.value)):
            if key != last:
                last = key
                yield "chunk_text", key, paragraphs(lines, read)

    docs = products.where(F.col("document_text").isNotNull()).select(F.col("id").cast("string"), "document_text")
    return map_rows(docs, CLEAN, of_documents, batch=2_000).unionByName(map_rows(chunk_stream(chunks, learned), CLEAN, of_chunks, batch=2_000))
