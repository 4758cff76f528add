"""Promotion of new raw records into products: dimension resolution, anti-join, first-wins insertion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.functions.jsonx import registration_number


def pending(raw: DataFrame, products: DataFrame, failed: DataFrame | None = None, after_id: int | None = None) -> DataFrame:
    """Raw records without a product: a left-anti join on the record's id, written as such so that it plans as one.

    failed: ids that are left out (null-safe, unlike NOT IN); after_id: a high-water mark of earlier runs.
    """
    df = raw if after_id is None else raw.where(F.col("id") > after_id)
    df = df.join(products.where(F.col("raw_record_id").isNotNull()).select(F.col("raw_record_id").alias("id")), "id", "left_anti")
    return df if failed is None else df.join(failed.select("id"), "id", "left_anti")


def pending_counts(raw: DataFrame, products: DataFrame, countries: DataFrame) -> DataFrame:
    """(country_name, pending) of the records that wait, by the source's country; unknown countries together as null."""
    named = pending(raw, products).join(countries.select(F.col("id").alias("country_id"), F.col("name").alias("country_name")), "country_id", "left")
    return named.groupBy("country_name").agg(F.count("*").alias("pending"))


def _key(column: Column) -> Column:
    return F.nullif(F.upper(F.trim(column)), F.lit(""))


def resolve_geography(countries: DataFrame, geography: DataFrame) -> DataFrame:
    """(country_id, geography_id, agency): each source country's geography, by code, else by name.

    Codes and names are compared trimmed and in capitals; among equal ones the smallest id counts. The match found is
    taken whole: a match by code without an agency is not completed from a match by name.
    """
    whole = F.struct(F.col("id").alias("id"), F.col("agency_acronym").alias("agency"))
    first = lambda column, key: geography.where(_key(F.col(column)).isNotNull()).groupBy(_key(F.col(column)).alias(key)).agg(F.min_by(whole, "id").alias(f"by_{key}"))
    keyed = countries.select(F.col("id").alias("country_id"), _key(F.col("code")).alias("code"), _key(F.col("name")).alias("name"))
    met = keyed.join(first("country_code", "code"), "code", "left").join(first("country_name", "name"), "name", "left")
    hit = F.coalesce("by_code", "by_name")
    return met.select("country_id", hit["id"].alias("geography_id"), hit["agency"].alias("agency"))


def project(raw: DataFrame, geography_of: DataFrame) -> DataFrame:
    """Raw records as product rows: stable id, geography, agency, first document, guessed registration number."""
    joined = raw.join(geography_of.withColumnRenamed("geography_id", "_geo"), "country_id", "left")
    return joined.select(
        F.md5(F.concat(F.lit("raw:"), F.col("id").cast("string"))).alias("id"), F.col("id").alias("raw_record_id"), F.col("name").alias("product_name"), F.col("_geo").alias("country_id"), F.col("agency").alias("regulator"),
        registration_number(F.col("json_data")).alias("registration_number"), F.try_element_at("document_url", F.lit(1)).alias("source_url"), "json_data",
    )


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by order; rows with a null in the key are all kept, as unique constraints let them be.

    A hot key costs one row a task: the partial maximum runs before the shuffle, no window sorts the group.
    """
    free = df.where(" or ".join(f"{k} is null" for k in keys))
    bound = df.where(" and ".join(f"{k} is not null" for k in keys))
    whole = F.struct(*[F.struct(*order).alias("_o")], *[F.col(c) for c in df.columns if c not in keys])
    best = bound.groupBy(*keys).agg(F.min_by(whole, F.struct(*order)).alias("_w"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_w.{c}").alias(c) for c in df.columns]).unionByName(free)


def insert_new(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """The rows that an insert which ignores conflicts would add: none whose record or (country, number) is there already."""
    unseen = rows.join(existing.select("raw_record_id").where("raw_record_id is not null"), "raw_record_id", "left_anti")
    taken = existing.where("country_id is not null and registration_number is not null").select("country_id", "registration_number")
    unseen = unseen.join(taken, ["country_id", "registration_number"], "left_anti")
    columns = rows.columns
    once = first_of(unseen, ["raw_record_id"], ["id"])
    return first_of(once, ["country_id", "registration_number"], ["raw_record_id"]).select(columns)


def promote(raw: DataFrame, products: DataFrame, countries: DataFrame, geography: DataFrame) -> DataFrame:
    """The product rows that promotion adds. A raw record delivered twice is promoted once (its latest crawl)."""
    latest = raw.groupBy("id").agg(F.max_by(F.struct("name", "country_id", "document_url", "json_data"), F.struct("crawled_at", "feed", "file_seq")).alias("r")).select("id", "r.*")
    return insert_new(project(pending(latest, products), resolve_geography(countries, geography)), products)


def running_number(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """df with a number from 0 within each group, in order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
