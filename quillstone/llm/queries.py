"""Queries of the text and matching problems, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillstone.llm import addresses, leakage, linkage, mixing, names, scans, splitting
from quillstone.sources.catalog import Catalog

Query = Callable[[SparkSession, str], DataFrame]


def _on(table: str, f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, root: f(Catalog(spark, root).table(table))


def _linkage(f: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        tables = Catalog(spark, root)
        return f(tables.table("market_listings"), tables.table("products"), tables.table("regulatory_geography"))

    return run


def _documents(f: Callable[[DataFrame, DataFrame], DataFrame], other: str) -> Query:
    return lambda spark, root: f(Catalog(spark, root).table("documents"), Catalog(spark, root).table(other))


def _scans(f: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, root: f(Catalog(spark, root).table("products"), Catalog(spark, root).table("product_chunks"))


def queries() -> dict[str, Query]:
    return {
        "p1_found": _on("products", names.found),
        "p1_clusters": _on("products", names.clusters),
        "p2_found": _scans(scans.found),
        "p2_clean_text": _scans(scans.cleaned),
        "p5_found": _linkage(linkage.found),
        "p5_confidence": _linkage(linkage.linked),
        "p6_found": _on("products", addresses.found),
        "p6_clusters": _on("products", addresses.clusters),
        "p8_found": _documents(leakage.found, "eval_items"),
        "p8_leaks": _documents(leakage.leaks, "eval_items"),
        "p9_mixture": _documents(mixing.mixture, "mix_targets"),
        "p9_shares": _documents(mixing.shares, "mix_targets"),
        "p10_pieces": _documents(splitting.pieces, "split_limits"),
    }


def oracle_sql() -> dict[str, str]:
    return {}
