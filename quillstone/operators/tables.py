"""Writing as set operations on snapshots: replacement by key, guarded updates, deletions, differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with all rows of new's keys replaced by new's rows (delete and insert)."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def delete_where(df: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """df without the rows of the targets' keys."""
    return df.join(targets.select(key).distinct(), key, "left_anti")


def update(df: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """df with the columns set from changes where the change is not null; changes has a key once at most."""
    renamed = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(renamed, key, "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns])


def guard_unique(df: DataFrame, proposals: DataFrame, key: str, scope: str, value: str) -> DataFrame:
    """(key, value): each proposal's value, or null where another row holds it, or proposes it with a smaller key.

    The scope is compared null-safe: rows without a scope are rivals of each other. Rivals are found by an equi-join on
    (scope, value), pre-aggregated to the two smallest keys of each holder, so a value held by very many rows is cheap.
    """
    current = df.select(key, scope, value)
    wanted = proposals.select(key, F.col(value).alias("_want")).join(current.select(key, scope), key).where("_want is not null")
    held = current.where(F.col(value).isNotNull()).groupBy(scope, value).agg(F.min(key).alias("_a"), F.max(key).alias("_b"))
    met = wanted.join(held, wanted[scope].eqNullSafe(held[scope]) & (wanted["_want"] == held[value]), "left").select(wanted[key], wanted[scope], "_want", ((F.col("_a").isNotNull()) & ((F.col("_a") != wanted[key]) | (F.col("_b") != wanted[key]))).alias("_held"))
    first = met.where(~F.col("_held")).groupBy(scope, "_want").agg(F.min(key).alias("_first"))
    m = met.alias("m").join(first.alias("f"), F.col(f"m.{scope}").eqNullSafe(F.col(f"f.{scope}")) & (F.col("m._want") == F.col("f._want")), "left")
    return m.select(F.col(f"m.{key}").alias(key), F.when(~F.col("m._held") & (F.col("f._first") == F.col(f"m.{key}")), F.col("m._want")).alias(value))


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that are there more than once (a report; empty when the constraint holds). Null keys are exempt."""
    return df.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def union_merge(old: Column, new: Column) -> Column:
    """The distinct union of two arrays, the old one's items first; null counts as empty."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(old, none), F.coalesce(new, none)))


def diff_columns(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column_name, left_value, right_value): the cells that differ; a missing row differs in every column that is not null."""
    text = lambda df, c: F.to_json(F.struct(df[c].alias("v"))) if df.schema[c].dataType.typeName() in ("array", "struct", "map") else df[c].cast("string")
    a = left.select(key, *[text(left, c).alias(f"l_{c}") for c in columns])
    b = right.select(key, *[text(right, c).alias(f"r_{c}") for c in columns])
    both = a.join(b, key, "full")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"l_{c}").alias("left_value"), F.col(f"r_{c}").alias("right_value")) for c in columns])
    return both.select(key, F.explode(cells).alias("c")).select(key, "c.*").where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def diff_sets(left: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """(key, only_left, only_right): sorted items of an array column on one side only, where there are any."""
    none = F.array().cast("array<string>")
    both = left.select(key, F.col(column).alias("a")).join(right.select(key, F.col(column).alias("b")), key, "full").select(key, F.coalesce("a", none).alias("a"), F.coalesce("b", none).alias("b"))
    out = both.select(key, F.array_sort(F.array_except("a", "b")).alias("only_left"), F.array_sort(F.array_except("b", "a")).alias("only_right"))
    return out.where((F.size("only_left") > 0) | (F.size("only_right") > 0))


def coverage(df: DataFrame, document: str, keys: list[str]) -> DataFrame:
    """(key_name, present, filled): in how many documents a top-level key is there, and not null or empty."""
    at = lambda k: F.get_json_object(F.col(document), f"$.{k}")
    has = lambda k: F.array_contains(F.json_object_keys(document), k)
    sums = df.agg(*[F.coalesce(F.sum(has(k).cast("long")), F.lit(0)).alias(f"p_{k}") for k in keys], *[F.count(F.when(at(k).isNotNull() & ~at(k).isin("", "[]", "{}"), 1)).alias(f"f_{k}") for k in keys])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(f"p_{k}").alias("present"), F.col(f"f_{k}").alias("filled")) for k in keys])).alias("r")).select("r.*")
