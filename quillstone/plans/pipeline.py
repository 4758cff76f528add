"""The whole flow as lazy DataFrames: promotion, text, extraction, repair; one write for each stage."""

from __future__ import annotations

import argparse
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import text as X
from quillstone.functions.mappers import au, sa, us
from quillstone.functions import jsonx
from quillstone.operators import fold, promote, repair
from quillstone.sources import documents as D
from quillstone.sources.catalog import Catalog
from quillstone.sources.snapshot import Snapshots

# The stages in their order, with the names by which each may be called.
STAGES = {"promote": ("promote", "a", "stage_a"), "text": ("text", "b", "stage_b"), "extract": ("extract", "ai", "c", "stage_c"), "repair": ("repair", "d", "stage_d")}
#: Mappers by register; each adds `columns` and `product_data`.
MAPPERS = {"SFDA": sa.extract, "TGA": au.extract, "FDA": us.extract}


def parse_stages(value: str | None) -> tuple[str, ...]:
    """Stages named in a comma-separated text, in canonical order; all of them for an empty text; an unknown one is an error."""
    names = {alias: stage for stage, aliases in STAGES.items() for alias in aliases}
    asked = [x.strip().lower() for x in (value or "").split(",") if x.strip()]
    if unknown := [x for x in asked if x != "all" and x not in names]:
        raise ValueError(f"unknown stages: {', '.join(unknown)}; known: {', '.join(STAGES)}")
    chosen = set(STAGES) if not asked or "all" in asked else {names[x] for x in asked}
    return tuple(s for s in STAGES if s in chosen)


@dataclass
class Config:
    root: str
    stages: tuple[str, ...] = tuple(STAGES)
    limit: int | None = None
    regulator: str | None = None
    output: str | None = None
    documents: str | None = None
    layer: Callable = D.PlainTextLayer
    recognizer: Callable = D.OfflineRecognizer
    merger: Callable = fold.OfflineMerger
    repairer: Callable = repair.OfflineRepairer
    excerpt_tokens: int = 1_800


def map_registers(products: DataFrame) -> DataFrame:
    """(id, regulator, the flat columns, product_data, provenance): every register's records by its mapper."""
    out = None
    for regulator, mapper in MAPPERS.items():
        part = mapper(products.where(F.col("regulator") == regulator).select("id", "regulator", "json_data"))
        part = part.select("id", "regulator", "columns.*", "product_data", "provenance")
        out = part if out is None else out.unionByName(part)
    return out


def _countries(geography: DataFrame) -> DataFrame:
    return geography.groupBy(F.col("id").alias("country_id")).agg(F.first("country_name").alias("country_name"))


def chunked(texts: DataFrame) -> DataFrame:
    """(product_id, chunk_index, chunk_text, char_count) of texts (product_id, text, country_name), cut to the part that matters."""
    cut = texts.select("product_id", F.posexplode(X.chunks(X.section_or_full(F.col("text"), F.col("country_name")))).alias("chunk_index", "chunk_text"))
    return cut.withColumn("char_count", F.length("chunk_text"))


def document_chunks(products: DataFrame, geography: DataFrame) -> DataFrame:
    """The chunks of the products' stored texts."""
    named = products.where(F.col("document_text").isNotNull()).join(_countries(geography), "country_id", "left")
    return chunked(named.select(F.col("id").alias("product_id"), F.col("document_text").alias("text"), "country_name"))


def read_texts(products: DataFrame, geography: DataFrame, files: DataFrame, folder: str, layer=D.PlainTextLayer, recognizer=D.OfflineRecognizer) -> DataFrame:
    """(product_id, text, country_name, pages, error): the selected documents of each product, read and joined in order.

    files (path, content) are those under `folder`; a document is met by its path below it. Files are read once,
    however many products name them; a document without a file has an error, and the others of its product count.
    """
    chosen = D.selected_documents(F.col("json_data"), F.col("source_url"), F.col("country_name"))
    asked = products.join(_countries(geography), "country_id", "left").select(F.col("id").alias("product_id"), "country_name", F.posexplode(chosen).alias("no", "d"))
    asked = asked.where("d.path is not null").select("product_id", "country_name", "no", F.col("d.path").alias("key"))
    key = F.regexp_replace("path", rf"^.*{re.escape(folder.rstrip('/').rpartition('/')[2])}/", "")
    wanted = files.withColumn("key", key).join(asked.select("key").distinct(), "key", "left_semi")
    read = D.read_documents(wanted.select(F.col("key").alias("path"), "content"), layer, recognizer).withColumnRenamed("path", "key")
    met = asked.join(read, "key", "left").withColumn("error", F.when(F.col("method").isNull() & F.col("error").isNull(), F.concat(F.lit("no file: "), "key")).otherwise(F.col("error")))
    parts = met.groupBy("product_id", "country_name").agg(  # two documents a product at most
        F.array_sort(F.collect_list(F.struct("no", "text"))).alias("texts"), F.sum("pages").cast("int").alias("pages"), F.array_join(F.sort_array(F.collect_set("error")), "; ").alias("error")
    )
    text = F.array_join(F.filter(F.transform("texts", lambda t: t["text"]), lambda t: t.isNotNull()), "\n\n")
    return parts.select("product_id", F.nullif(text, F.lit("")).alias("text"), "country_name", "pages", F.nullif("error", F.lit("")).alias("error"))


def fold_registers(products: DataFrame, chunks: DataFrame, merger=fold.OfflineMerger, excerpt_tokens: int = 1_800) -> DataFrame:
    """The records of registers without a mapper, folded excerpt by excerpt: their JSON units, then their chunks."""
    others = products.where(~F.coalesce(F.col("regulator").isin(*MAPPERS), F.lit(False)))
    units = jsonx.json_units(others.select("id", "json_data"), "id", "json_data", excerpt_tokens)
    own = chunks.join(others.select(F.col("id").alias("product_id")), "product_id", "left_semi")
    return fold.fold_products(fold.excerpts(own, units, others.where("json_data is null").select("id")), merger)


def run(spark: SparkSession, config: Config) -> dict[str, DataFrame]:
    """The results of the stages asked for, by name; written as snapshots when the config names an output."""
    t = Catalog(spark, config.root)
    t.require(["products", "regulatory_geography"])
    scope = lambda df: df.where(F.col("regulator") == config.regulator) if config.regulator else df
    cap = lambda df: df.orderBy("id").limit(config.limit) if config.limit else df
    products, results = scope(t.table("products")), {}
    if "promote" in config.stages:
        results["promote"] = cap(scope(promote.promote(t.table("drug_predicate_raw_records"), t.table("products"), t.table("source_country"), t.table("regulatory_geography"))))
    if "text" in config.stages:
        geography = t.table("regulatory_geography")
        if config.documents:
            files = D.read_binary(spark, config.documents)
            results["texts"] = read_texts(cap(products), geography, files, config.documents, config.layer, config.recognizer)
            results["text"] = chunked(results["texts"].where("text is not null"))
        else:
            results["text"] = document_chunks(cap(products), geography)
    if "extract" in config.stages:
        results["extract"] = map_registers(cap(products))
        chunks = results["text"] if "text" in results else t.table("product_chunks")
        results["fold"] = fold_registers(cap(products), chunks, config.merger, config.excerpt_tokens)
    if "repair" in config.stages:
        results["repair"] = repair.repaired(cap(products), config.repairer)
    if config.output:
        for name, df in results.items():
            Snapshots(spark, config.output, name).write(df)
    return results


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Runs the stages over the tables of a folder.")
    p.add_argument("root")
    p.add_argument("--stages", default="")
    p.add_argument("--limit", type=int)
    p.add_argument("--regulator")
    p.add_argument("--documents", help="folder of the documents; without it the stored texts are cut")
    p.add_argument("--output", help="folder of the snapshots; without it results are only counted")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("quillstone").getOrCreate()
    done = run(spark, Config(a.root, parse_stages(a.stages), a.limit, a.regulator, a.output, a.documents))
    for name, df in done.items():
        print(name, df.count())


if __name__ == "__main__":
    main()
