"""Clustering of matched pairs as distributed rounds; neither links nor components ever reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.session import cut


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b", "w").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))


def star_clusters(edges: DataFrame, rank: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Star clustering of an undirected weighted graph: (id, center), for every node that has an edge.

    edges: a, b, w with a != b, each pair once; rank: id, grade (greater grades become centres first; ties go to the
    greater number of neighbours, then to the smaller id). A node that outranks all its open neighbours becomes a
    centre; the open neighbours of new centres join the one they are most like. Each round is two aggregations
    whose partial sums are made before the shuffle, so a node with very many neighbours costs one row a task.
    The number of rounds is the longest chain of falling ranks, a few in practice; lineage is cut in each.
    """
    both = cut(_both_ways(edges))
    degree = both.groupBy(F.col("a").alias("id")).agg(F.count("*").alias("degree"))
    order = lambda p: F.struct(F.coalesce(F.col(f"{p}grade"), F.lit(0)).alias("g"), F.col(f"{p}degree").alias("d"), (-F.col(f"{p}id")).alias("i"))
    node = degree.join(rank.select("id", "grade"), "id", "left").select("id", order("").alias("o"))
    open_edges = cut(
        both.join(node.select(F.col("id").alias("a"), F.col("o").alias("oa")).hint("merge"), "a").join(node.select(F.col("id").alias("b"), F.col("o").alias("ob")).hint("merge"), "b")
    )
    done = None
    for _ in range(max_rounds):
        top = open_edges.groupBy("a").agg(F.max("ob").alias("best"), F.first("oa").alias("oa"))
        centers = top.where(F.col("oa") > F.col("best")).select(F.col("a").alias("id"))
        joined = open_edges.join(centers.select(F.col("id").alias("a")), "a", "left_semi")
        satellites = joined.groupBy(F.col("b").alias("id")).agg(F.max(F.struct("w", "oa", "a")).alias("m")).select("id", F.col("m.a").alias("center"))
        settled = cut(centers.select("id", F.col("id").alias("center")).unionByName(satellites))
        done = settled if done is None else done.unionByName(settled)
        gone = settled.select("id")
        left = open_edges.join(gone.select(F.col("id").alias("a")), "a", "left_anti").join(gone.select(F.col("id").alias("b")), "b", "left_anti")
        # a node whose neighbours have all joined other stars is a star of its own: its edges are gone, it gets no row
        open_edges = cut(left)
        if open_edges.isEmpty():
            break
    else:
        raise RuntimeError("star clustering did not settle")
    return done


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable, for every node with an edge; alternating large-star and small-star.

    Each round moves the edges of a node to its smallest neighbour, which settles in a number of rounds logarithmic
    in the number of nodes, whatever the components' size; a round's shuffle carries each edge once.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = None
    for _ in range(max_rounds):
        two = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = two.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = two.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        now = cut(small.where("a <> b").distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError("connected components did not settle")
    flat = now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    roots = flat.select(F.col("component").alias("id"), "component").distinct()
    return flat.unionByName(roots)


def pairs_within(members: DataFrame, cluster: str, value: str, a: str, b: str) -> DataFrame:
    """All pairs of different values of a cluster, the smaller first in binary order: an equi-join on the cluster.

    The result is itself that large; a hot cluster is split over tasks by salting one side and repeating the other.
    """
    salts = 8
    left = members.select(F.col(cluster).alias("_c"), F.col(value).alias(a), F.pmod(F.xxhash64(value), F.lit(salts)).alias("_s"))
    right = members.select(F.col(cluster).alias("_c"), F.col(value).alias(b)).withColumn("_s", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(salts)])))
    return left.join(right.hint("merge"), ["_c", "_s"]).where(F.col(a) < F.col(b)).select(a, b)
