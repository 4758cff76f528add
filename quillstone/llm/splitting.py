"""Splitting oversized items at natural boundaries (problem 10) by dynamic programming over boundary positions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows
from quillstone.llm.tokens import default_path, tokenizer

# Kinds of boundary, best first, with the penalty of cutting there.
KINDS = ("paragraph", "line", "sentence", "clause", "word", "token")
PENALTY = np.array([0.0, 0.15, 0.25, 0.6, 1.0, 4.0])
#: Weight of a piece's squared deviation from the even size (as a share of the limit), and cost of a piece.
IMBALANCE, PIECE = 2.0, 0.5

# Blanks, ends of sentences and clauses, and what may stand between such an end and the blank.
_BLANKS = np.array([9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288], np.uint32)
_STOPS, _COMMAS, _CLOSERS = (np.array([ord(c) for c in x], np.uint32) for x in (".!?…。！？", ",;:，；：", "\"'»”’)]"))


def boundary_kinds(text: str, starts: np.ndarray) -> np.ndarray:
    """The best kind of boundary (index into KINDS) at each token's start; a place within a character is none (99).

    Boundaries are runs of blanks: two line ends make a paragraph, one a line; else the sign before the run tells.
    """
    n = len(starts) - 1
    kind = np.full(n + 1, len(KINDS) - 1, np.int64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = np.isin(codes, _BLANKS)
    edge = np.diff(np.concatenate([[0], blank.astype(np.int8), [0]]))
    lo, hi = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    if len(lo):
        ends = np.concatenate([[0], np.cumsum(codes == 10)])
        lines = ends[hi] - ends[lo]
        before = codes[np.maximum(lo - 1, 0)]
        before = np.where(np.isin(before, _CLOSERS), codes[np.maximum(lo - 2, 0)], before)
        run = np.select([lines > 1, lines == 1, np.isin(before, _STOPS), np.isin(before, _COMMAS)], [0, 1, 2, 3], 4)
        # the first token that starts in the blank; after line ends also the one right behind it
        for place, which in ((lo, run), (hi[run < 2], run[run < 2])):
            at = np.searchsorted(starts, place)
            stop = hi if place is lo else place
            fits = (at <= n) & (starts[np.minimum(at, n)] <= stop)
            np.minimum.at(kind, at[fits], which[fits])
    inside = np.zeros(n + 1, bool)
    inside[1:] = starts[1:] == starts[:-1]
    kind[inside] = 99
    return kind


def split_positions(kind: np.ndarray, limit: int, overlap: int) -> list[int]:
    """Ends (token numbers) of the pieces of a text of len(kind) - 1 tokens; the last is its end.

    Minimises penalties of the cuts, squared deviations from the even size and the number of pieces over all boundaries
    of every kind, such that a piece with its overlap has at most `limit` tokens. A first solution offers finer kinds
    only where coarser ones leave a long stretch; boundaries that no solution as good can use are then ruled out by
    lower bounds, and the optimum over the rest is the optimum over all.
    """
    n = len(kind) - 1
    if n <= limit:
        return [n]
    # a piece may start up to so many tokens earlier, at the start of a character of several tokens
    torn = np.nonzero(kind == 99)[0]
    slack = int(np.diff(np.concatenate([[-1], np.nonzero(np.diff(torn) > 1)[0], [len(torn) - 1]])).max()) if len(torn) and overlap else 0
    room = max(limit - overlap - slack, 1)
    offered = kind <= 2
    inner = np.nonzero(offered[1:n])[0] + 1
    places = np.concatenate([[0], inner, [n]])
    for k in (3, 4, 5):
        gaps = np.nonzero(np.diff(places) > max(room // 2, 1))[0]
        if not len(gaps):
            break
        more = [np.nonzero(kind[places[g] + 1 : places[g + 1]] <= k)[0] + places[g] + 1 for g in gaps]
        places = np.unique(np.concatenate([places, *more]))
    if (np.diff(places) > room).any():  # characters of more tokens than a piece may have: cut anywhere
        return _cheapest(kind, np.arange(n + 1), limit, overlap, room)[1]
    cost, ends = _cheapest(kind, places, limit, overlap, room)
    if cost <= _least_with_another(kind, places, limit, room) + 1e-9:
        return ends
    # the bounds of many pieces add up, so that long texts need finer bins
    useful = _useful(kind, cost, limit, overlap, room, 12 if n <= 12 * _even(n, overlap, room) else 48)
    if np.isin(useful, places, assume_unique=True).all():
        return ends
    return _cheapest(kind, np.union1d(useful, places[[0, -1]]), limit, overlap, room)[1]


def _even(n: int, overlap: int, room: int) -> float:
    return (n - overlap) / np.ceil((n - overlap) / room)


def _cheapest(kind: np.ndarray, places: np.ndarray, limit: int, overlap: int, room: int) -> tuple[float, list[int]]:
    """(cost, ends) of the best pieces that are cut at places, which begin with 0 and end with the text's end."""
    even = _even(len(kind) - 1, overlap, room)
    cost = np.full(len(places), np.inf)
    back = np.zeros(len(places), np.int64)
    cost[0] = 0.0
    penalty = PENALTY[np.minimum(kind[places], len(KINDS) - 1)]
    penalty[-1] = 0.0
    reach = np.searchsorted(places, places - room)
    first_end = int(np.searchsorted(places, limit, side="right"))  # places that a first piece, without overlap, can end at
    scale = IMBALANCE / limit**2
    floats = places.astype(float)
    for i in range(1, len(places)):
        if i < first_end:
            cost[i], back[i] = scale * (floats[i] - even) ** 2, 0
        j0 = max(int(reach[i]), 1)
        if j0 < i:
            off = floats[i] - floats[j0:i]
            off -= even
            off *= off
            off *= scale
            off += cost[j0:i]
            b = int(off.argmin())
            if off[b] < cost[i]:
                cost[i], back[i] = off[b], j0 + b
        cost[i] += penalty[i] + PIECE
    ends, i = [], len(places) - 1
    while i > 0:
        ends.append(int(places[i]))
        i = int(back[i])
    return float(cost[-1]), ends[::-1]


def _least_with_another(kind: np.ndarray, places: np.ndarray, limit: int, room: int) -> float:
    """What pieces cost at least that are cut at a boundary besides places: the fewest pieces, the best such boundary, and
    the best penalties there are for the other cuts, without any deviation."""
    n = len(kind) - 1
    other = kind <= 5
    other[places] = False
    other[[0, n]] = False
    if not other.any():
        return np.inf
    another = PENALTY[kind[other].min()]
    pieces = -(-max(n - limit, 0) // room) + 1
    rest = np.sort(np.append(PENALTY[np.minimum(kind[places[1:-1]], 5)], np.full(pieces, another)))
    return pieces * PIECE + another + float(rest[: max(pieces - 2, 0)].sum())


def _useful(kind: np.ndarray, known: float, limit: int, overlap: int, room: int, fine: int) -> np.ndarray:
    """Boundaries that a solution of the known cost or less may cut at.

    Places are taken together in bins, `fine` to the greatest piece; a bin has the least penalty within it, and a piece between two bins the least
    deviation that any two places of them have. The cheapest ways from the start to a bin and from it to the end are
    then lower bounds for every solution that cuts in it.
    """
    n = len(kind) - 1
    even, scale = _even(n, overlap, room), IMBALANCE / limit**2
    size = max(room // fine, 1)
    penalty = np.full(-(-n // size) * size, np.inf)
    allowed = kind[1:n] <= 5
    penalty[1:n][allowed] = PENALTY[kind[1:n][allowed]]
    least = penalty.reshape(-1, size).min(axis=1)
    bins = len(least)
    low = np.arange(bins) * size
    high = low + size - 1
    off = lambda lo, hi: scale * np.maximum(np.maximum(lo - even, even - hi), 0.0) ** 2
    far = (room + size - 1) // size  # so many bins on, a piece may still end
    steps = np.arange(far, 0, -1) * size
    between = off(steps - size + 1, np.minimum(steps + size - 1, room))
    ahead = np.where(low <= limit, off(low, np.minimum(high, limit)), np.inf)
    for b in range(bins):
        back = min(b, far)
        if back:
            ahead[b] = min(ahead[b], (ahead[b - back : b] + between[far - back :]).min())
        ahead[b] += least[b] + PIECE
    behind = np.where(n - high <= room, off(n - high, np.minimum(n - low, room)) + PIECE, np.inf)
    onward = between[::-1]
    for b in range(bins - 2, -1, -1):
        on = min(bins - 1 - b, far)
        behind[b] = min(behind[b], (behind[b + 1 : b + 1 + on] + least[b + 1 : b + 1 + on] + onward[:on]).min() + PIECE)
    with np.errstate(invalid="ignore"):
        bound = np.repeat(np.where(np.isfinite(least), ahead - least, np.inf) + behind, size) + penalty
    return np.nonzero(bound <= known + 1e-9)[0]


def pieces_of(text: str, starts: np.ndarray, limit: int, overlap: int) -> list[tuple[int, int, int, int, str]]:
    """(first token, end token, first character, end character, kind of the cut at its end) of each piece.

    A piece starts `overlap` tokens before the end of the one before; if that falls within a character, the piece
    starts at the character's first token, so that no character is torn. An overlap that leaves less than half of the
    limit for new text is cut to that half, so that every piece goes on.
    """
    overlap = max(min(overlap, limit // 2), 0)
    kind = boundary_kinds(text, starts)
    ends = split_positions(kind, limit, overlap)
    out, first = [], 0
    for k, e in enumerate(ends):
        last = k == len(ends) - 1
        out.append((first, e, int(starts[first]), int(starts[e]), "end" if last else KINDS[min(kind[e], len(KINDS) - 1)]))
        first = max(e - overlap, 0)
        while first > 0 and kind[first] == 99:
            first -= 1
    return out


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece_no", T.IntegerType()),
        T.StructField("n_pieces", T.IntegerType()),
        T.StructField("max_tokens", T.IntegerType()),
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("shared_tokens", T.IntegerType()),
        T.StructField("first_char", T.IntegerType()),
        T.StructField("end_char", T.IntegerType()),
        T.StructField("cut", T.StringType()),
        T.StructField("piece", T.StringType()),
    ]
)


def pieces(documents: DataFrame, limits: DataFrame, path: str | None = None, whole: bool = False) -> DataFrame:
    """The pieces of every document longer than its type's limit (with whole=True also the others, as one piece).

    A document without a doc_type, or of a type that is not in limits, gets the limits of `other`. Sizes are token
    counts within the document's own tokenization. Narrow but for the broadcast of the limits (a fixed table, joined by
    Catalyst under its size threshold). Null and empty texts have no pieces,
    nor have documents without a limit of at least 1.
    Without a vocabulary there is no result (see tokens.default_path).
    """
    path = path or default_path()
    types = limits.groupBy(F.col("doc_type").alias("limit_type")).agg(F.min("max_tokens").alias("max_tokens"), F.min("overlap_tokens").alias("overlap_tokens"))
    known = documents.select("doc_id", "text", "doc_type").join(types.select(F.col("limit_type").alias("doc_type"), F.lit(True).alias("known")), "doc_type", "left")
    of = known.withColumn("limit_type", F.when(F.col("known"), F.col("doc_type")).otherwise(F.lit("other"))).join(types, "limit_type", "left")
    sized = of.select(F.col("doc_id").cast("long"), "text", F.col("max_tokens").cast("int"), F.col("overlap_tokens").cast("int"))

    def rows(source):
        t = tokenizer(path)
        for doc, text, limit, overlap in source:
            if not text or not limit or limit < 1:
                continue
            if not whole and len(text.encode()) <= limit:  # every token has a byte at least
                continue
            starts = t.starts(text)
            if len(starts) - 1 <= limit:
                if whole:
                    yield doc, 0, 1, limit, len(starts) - 1, 0, 0, len(text), "end", text
                continue
            found = pieces_of(text, starts, limit, overlap or 0)
            before = 0
            for k, (a, b, i, j, cut) in enumerate(found):
                yield doc, k, len(found), limit, b - a, before - a if k else 0, i, j, cut, text[i:j]
                before = b

    return map_rows(sized, PIECES, rows, batch=2_000)
