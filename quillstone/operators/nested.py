"""Deeply nested records into flat related tables (problem 7).

Each JSON record is parsed once into path-value-ordinal triples. A triple belongs to the nearest enclosing array
element (its node), so grouping the triples by the node's path pattern and pivoting each group gives one flat table
per repeated ancestor, every row carrying its own node path and its parent's.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows

#: Keys of product_data that are arrays by contract, with the key that encloses them ("" = the record itself).
CONTRACT_ARRAYS = {"presentations": "", "active_ingredients": "presentations", "indications": "", "pivotal_evidence": "", "excipients": ""}

NODE, LEAF = "node", "leaf"

TRIPLES = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("pattern", T.StringType()),
        T.StructField("node_path", T.StringType()),
        T.StructField("parent_path", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def json_type(value) -> str:
    """The JSON type of a parsed value."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, str):
        return "string"
    if isinstance(value, dict):
        return "object"
    return "array" if isinstance(value, list) else "number"


def parse_json(text: str | None):
    """The parsed record, or None for null, empty or broken text. A record given as JSON text within a string is opened."""
    try:
        value = json.loads(text) if text else None
        return json.loads(value) if isinstance(value, str) else value
    except (ValueError, RecursionError):
        return None


def as_contract_array(value) -> list:
    """The array that a contract field stands for: a lone object is an array of one, JSON text is opened, null is empty."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except (ValueError, RecursionError):
            return []
    if value is None:
        return []
    items = value if isinstance(value, list) else [value]
    opened = []
    for item in items:
        if isinstance(item, str) and item.lstrip()[:1] == "{":
            try:
                item = json.loads(item)
            except (ValueError, RecursionError):
                pass
        opened.append(item)
    return opened


def _text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def triples_of(root, contract: dict[str, str] | None) -> Iterator[tuple]:
    """(kind, pattern, node_path, parent_path, ordinal, key, type, value) of one parsed record, in document order.

    Works on an explicit stack, so depth is bounded by memory only. kind `node` marks an object that is an array
    element; kind `leaf` is a scalar, an empty object or an array of scalars, with the key relative to its node.
    """
    if not isinstance(root, (dict, list)):
        return
    contract = contract or {}
    # value, path of the value, pattern, node path, node pattern, ordinal of the node, key within the node, enclosing key
    stack = [(root, "", "", "", "", 0, "", "")]
    while stack:
        value, path, pattern, node, node_pattern, ordinal, key, inside = stack.pop()
        if isinstance(value, dict):
            below = []
            for name, child in value.items():
                if contract.get(name) == inside and name in contract and child is not None:
                    child = as_contract_array(child)
                dot = "." if path else ""
                below.append((child, f"{path}{dot}{name}", f"{pattern}{dot}{name}", node, node_pattern, ordinal, f"{key}.{name}" if key else name, name))
            if not value and key:
                yield LEAF, node_pattern, node, "", ordinal, key, "object", "{}"
            stack.extend(reversed(below))
        elif isinstance(value, list):
            if value and any(isinstance(x, (dict, list)) for x in value):
                below = []
                for i, child in enumerate(value):
                    here, kind = f"{path}[{i}]", f"{pattern}[]"
                    if isinstance(child, dict):
                        below.append((child, here, kind, here, kind, i, "", inside))
                        yield NODE, kind, here, node, i, "", "object", None
                    else:
                        below.append((child, here, kind, node, node_pattern, ordinal, f"{key}[{i}]", inside))
                stack.extend(reversed(below))
            else:
                yield LEAF, node_pattern, node, "", ordinal, key, "array", _text(value)
        else:
            yield LEAF, node_pattern, node, "", ordinal, key, json_type(value), _text(value)


def shred(df: DataFrame, id_column: str, json_columns: dict[str, dict[str, str] | None], nodes_only: bool = False) -> DataFrame:
    """Triples of the given JSON columns of df; json_columns maps each column to its contract arrays (None: none).

    Narrow: one pass, no shuffle. Null, empty and broken JSON give no triple; repeated records give their triples
    again; other columns of df are not read, so clashing names cannot matter.
    """
    names = list(json_columns)

    def rows(source):
        for record, *texts in source:
            for name, text in zip(names, texts):
                for kind, *rest in triples_of(parse_json(text), json_columns[name]):
                    if kind == NODE or not nodes_only:
                        yield record, name, kind, *rest

    return map_rows(df.select(F.col(id_column).cast("string"), *[F.col(c) for c in names]), TRIPLES, rows)


def nodes(triples: DataFrame) -> DataFrame:
    """The array elements that are objects, with the link to the nearest enclosing one ('' = the record)."""
    return triples.where(F.col("kind") == NODE).select("record_id", "field", "node_path", "parent_path", "pattern", "ordinal")


def node_patterns(triples: DataFrame) -> DataFrame:
    """The child tables there are: each repeated ancestor with its number of rows."""
    return triples.where(F.col("kind") == NODE).groupBy("field", "pattern").agg(F.count("*").alias("n_rows"))


def child_table(triples: DataFrame, field: str, pattern: str, keys: list[str]) -> DataFrame:
    """The flat table of one repeated ancestor: record, node, parent, ordinal and a column for each key.

    The pivot is one grouped aggregation on (record, node); rows of a record never leave its partition's group, and
    the partial aggregation runs before the shuffle. A node without any of the keys keeps its row, with nulls.
    """
    mine = triples.where((F.col("field") == field) & (F.col("pattern") == pattern))
    pick: list[Column] = [F.max(F.when(F.col("key") == k, F.col("value"))).alias(k.replace(".", "_")) for k in keys]
    return mine.groupBy("record_id", "node_path").agg(
        F.max(F.when(F.col("kind") == NODE, F.col("parent_path"))).alias("parent_path"),
        F.max("ordinal").alias("ordinal"),
        *pick,
    )


def node_values(triples: DataFrame) -> DataFrame:
    """Every value of every pattern in one long table: its node ('' = the record), the key within it, its type and text.

    Narrow. With `nodes`, which has the nodes' parents and those without any value, it holds the whole of the records.
    """
    return triples.where(F.col("kind") == LEAF).select("record_id", "field", "pattern", "node_path", F.col("ordinal").cast("long").alias("ordinal"), "key", "type", "value")


def discover_keys(triples: DataFrame, field: str, pattern: str) -> list[str]:
    """Keys met in one repeated ancestor, sorted. Bounded by the schema, not by the rows."""
    found = triples.where((F.col("field") == field) & (F.col("pattern") == pattern) & (F.col("kind") == LEAF)).select("key").distinct()
    return sorted(r["key"] for r in found.collect())


def product_triples(products: DataFrame, nodes_only: bool = False) -> DataFrame:
    """Triples of products.json_data and products.product_data."""
    return shred(products, "id", {"json_data": None, "product_data": CONTRACT_ARRAYS}, nodes_only)


def found(products: DataFrame) -> DataFrame:
    """Every object that is an array element, in either JSON column of products."""
    return nodes(product_triples(products, nodes_only=True)).select(
        F.col("record_id").alias("product_id"), "field", "node_path", "parent_path"
    )
