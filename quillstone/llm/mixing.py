"""Mixing sources to target weights (problem 9): min-cost flow over membership patterns, then a seeded draw."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quillstone.llm.tokens import default_path, with_sizes
from quillstone.session import cut

#: Buckets of the seeded order within a pattern; only buckets, never documents, are summed up in one place.
BUCKETS = 1_024
SEED = 2_024


class Flow:
    """Min-cost flow by successive shortest paths with potentials, on a graph of patterns and sources."""

    def __init__(self, n: int):
        self.edges: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.left: list[int] = []
        self.cost: list[int] = []

    def add(self, a: int, b: int, capacity: int, cost: int) -> int:
        for x, y, c, w in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.edges[x].append(len(self.to))
            self.to.append(y)
            self.left.append(c)
            self.cost.append(w)
        return len(self.to) - 2

    def run(self, s: int, t: int) -> int:
        n, total = len(self.edges), 0
        high = [0] * n
        while True:
            far, via = [float("inf")] * n, [-1] * n
            far[s] = 0
            heap = [(0, s)]
            while heap:
                d, x = heapq.heappop(heap)
                if d > far[x]:
                    continue
                for e in self.edges[x]:
                    y = self.to[e]
                    if self.left[e] > 0 and (nd := d + self.cost[e] + high[x] - high[y]) < far[y]:
                        far[y], via[y] = nd, e
                        heapq.heappush(heap, (nd, y))
            if via[t] < 0:
                return total
            for x in range(n):
                if far[x] < float("inf"):
                    high[x] += far[x]
            push, y = float("inf"), t
            while y != s:
                push = min(push, self.left[via[y]])
                y = self.to[via[y] ^ 1]
            y = t
            while y != s:
                self.left[via[y]] -= push
                self.left[via[y] ^ 1] += push
                y = self.to[via[y] ^ 1]
            total += push


def plan(patterns: dict[tuple[str, ...], int], targets: dict[str, tuple[float, int]], total: int | None = None) -> tuple[int, dict[tuple[str, ...], list[tuple[str, int]]]]:
    """(total, tokens that each pattern gives each of its sources).

    patterns: tokens of the distinct texts found in exactly these sources; targets: share and max_repeats of a source.
    Without a total, it is the largest that the sources with documents can fill alone within their caps. The r-th use
    of a text costs r - 1, so texts are repeated as evenly and as little as the quotas allow.
    """
    names = sorted(targets)
    if total is None:
        alone = {s: sum(n for p, n in patterns.items() if s in p) * targets[s][1] for s in names}
        fits = [alone[s] / targets[s][0] for s in names if alone[s] and targets[s][0] > 0]
        total = int(min(fits)) if fits else 0
    keys = sorted(patterns)
    # nodes: start, a node a pattern, a node a (pattern, source), a node a source, end
    links = [(p, s) for p in keys for s in p]
    n_pattern, n_link = 1, 1 + len(keys)
    n_source = n_link + len(links)
    flow = Flow(n_source + len(names) + 1)
    end = n_source + len(names)
    for i, p in enumerate(keys):
        for r in range(max(targets[s][1] for s in p)):
            flow.add(0, n_pattern + i, patterns[p], r)
    used = {}
    for j, (p, s) in enumerate(links):
        used[p, s] = flow.add(n_pattern + keys.index(p), n_link + j, patterns[p] * targets[s][1], 0)
        flow.add(n_link + j, n_source + names.index(s), patterns[p] * targets[s][1], 0)
    for k, s in enumerate(names):
        flow.add(n_source + k, end, int(targets[s][0] * total), 0)
    flow.run(0, end)
    given: dict[tuple[str, ...], list[tuple[str, int]]] = {}
    for (p, s), e in used.items():
        amount = flow.left[e ^ 1]
        if amount:
            given.setdefault(p, []).append((s, amount))
    return total, given


def source_key(column) -> F.Column:
    """Sources are equal but for case and outer blanks."""
    return F.lower(F.trim(column))


def units(documents: DataFrame, targets: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, pattern, n_tokens): one row for each distinct text of the targets' sources, with the sources that hold it.

    Copies of a text are one unit under its smallest doc_id, so that a copy cannot be used as a further repetition;
    their sources make up its membership pattern. Texts are compared by a 128-bit digest; null and empty texts are no units.
    Without a vocabulary there is no result (see tokens.default_path).
    """
    wanted = targets.select(source_key(F.col("source")).alias("source")).distinct()
    mine = documents.where(F.col("text").isNotNull() & (F.col("text") != "")).select(F.col("doc_id").cast("long").alias("doc_id"), source_key(F.col("source")).alias("source"), "text")
    kept = mine.join(wanted, "source", "left_semi").select("doc_id", "source", "text", F.xxhash64("text").alias("d1"), F.md5("text").alias("d2"))
    sizes = with_sizes(kept, "doc_id", "text", path or default_path())
    unit = kept.groupBy("d1", "d2").agg(F.min("doc_id").alias("doc_id"), F.sort_array(F.collect_set("source")).alias("sources"))
    return unit.join(sizes.groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens")), "doc_id").select("doc_id", F.array_join("sources", "\x1f").alias("pattern"), "n_tokens")


def mixture(documents: DataFrame, targets: DataFrame, path: str | None = None, total: int | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, source, times, n_tokens): the drawn documents, the source each is drawn for and how often.

    Only the patterns (bounded by the combinations of sources that occur) and their token sums reach the driver. A
    document's place on its pattern's line is the sum of tokens before it in a seeded order: sums by bucket first, then
    within a bucket, so that a pattern with a third of all rows is no single task. Copy k of a document is drawn for the
    source whose stretch of the line holds the document's place plus k times the pattern's length.
    """
    sized = cut(units(documents, targets, path))
    wanted = {r["source"]: (float(r["share"]), int(r["reps"])) for r in targets.groupBy(source_key(F.col("source")).alias("source")).agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("reps")).where("source is not null").collect()}
    patterns = {tuple(r["pattern"].split("\x1f")): int(r["n"]) for r in sized.groupBy("pattern").agg(F.sum("n_tokens").alias("n")).where("n > 0").collect()}
    _, given = plan(patterns, wanted, total)
    stretches = []
    for p, shares in given.items():
        a = 0
        for s, amount in shares:
            stretches.append(("\x1f".join(p), patterns[p], s, a, a + amount))
            a += amount
    spark = documents.sparkSession
    lines = spark.createDataFrame(stretches, "pattern string, length long, source string, lo long, hi long")
    order = F.xxhash64(F.lit(seed), "doc_id")
    placed = sized.withColumns({"h": order, "bucket": F.pmod(F.shiftright(order, 40), F.lit(BUCKETS))})
    by_bucket = placed.groupBy("pattern", "bucket").agg(F.sum("n_tokens").alias("n"))
    before = by_bucket.select("pattern", "bucket", (F.sum("n").over(Window.partitionBy("pattern").orderBy("bucket")) - F.col("n")).alias("base"))
    within = F.sum("n_tokens").over(Window.partitionBy("pattern", "bucket").orderBy("h", "doc_id")) - F.col("n_tokens")
    at = placed.withColumn("within", within).join(before, ["pattern", "bucket"]).select("doc_id", "pattern", "n_tokens", (F.col("base") + F.col("within")).alias("at"))
    # copies of place `at` that fall into [lo, hi): at + k * length
    first = F.greatest(F.ceil((F.col("lo") - F.col("at")) / F.col("length")), F.lit(0))
    last = F.ceil((F.col("hi") - F.col("at")) / F.col("length")) - 1
    drawn = at.join(lines, "pattern").withColumn("times", (last - first + 1).cast("int"))
    return drawn.where((F.col("times") > 0) & (F.col("n_tokens") > 0)).select("doc_id", "source", "times", "n_tokens")


def shares(documents: DataFrame, targets: DataFrame, path: str | None = None, total: int | None = None) -> DataFrame:
    """(source, target_share, max_repeats, drawn_documents, drawn_tokens, most_uses, actual_share) of each source of targets."""
    drawn = mixture(documents, targets, path, total)
    per = drawn.groupBy("source").agg(F.count("*").alias("drawn_documents"), F.sum(F.col("times") * F.col("n_tokens")).alias("drawn_tokens"), F.max("times").alias("most_uses"))
    want = targets.groupBy(source_key(F.col("source")).alias("source")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    tokens = F.coalesce("drawn_tokens", F.lit(0))
    joined = want.join(per, "source", "left")
    return joined.select(
        "source", "target_share", "max_repeats", F.coalesce("drawn_documents", F.lit(0)).alias("drawn_documents"), tokens.alias("drawn_tokens"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"),
        (tokens / F.greatest(F.sum(tokens).over(Window.partitionBy()), F.lit(1))).alias("actual_share"),
    )
