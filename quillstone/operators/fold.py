"""Ordered folds of excerpts into an accumulator with a pluggable merger, and the streams of excerpts they read."""

from __future__ import annotations

import json
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quillstone.functions.arrowio import map_rows
from quillstone.functions.text import count_tokens

# The keys of a complete product document.
DOCUMENT_KEYS = ("substance", "presentations", "indications", "approval", "pivotal_evidence", "key_risks", "excipients")


class ContextOverflow(Exception):
    """What was given to a merger does not fit its window; given in two halves it may."""


class Merger(Protocol):
    """Merges excerpts into an accumulator; may raise ContextOverflow, or anything else for a failed call."""

    def merge(self, accumulated: dict, excerpts: list[str], first: int, total: int) -> dict: ...


class OfflineMerger:
    """A deterministic merger that needs no model: JSON objects in excerpts are merged key by key.

    A scalar that is there is kept, lists grow by new items in order, objects are merged; text that is no JSON object is
    counted in `columns.excerpts_read`. Excerpts above `window` tokens together overflow.
    """

    def __init__(self, window: int | None = None):
        self.window = window

    def merge(self, accumulated: dict, excerpts: list[str], first: int, total: int) -> dict:
        if self.window is not None and sum(max(1, len(x) // 4) for x in excerpts) > self.window:
            raise ContextOverflow(f"{len(excerpts)} excerpts from {first} of {total}")
        out = json.loads(json.dumps(accumulated))
        for text in excerpts:
            try:
                value = json.loads(text)
            except ValueError:
                value = None
            if isinstance(value, dict):
                out["product_data"] = merged(out.get("product_data") or {}, value)
            columns = out.setdefault("columns", {})
            columns["excerpts_read"] = columns.get("excerpts_read", 0) + 1
        return out


def merged(old: dict, new: dict) -> dict:
    """old with new's keys: what is there stays, nulls are filled, lists grow, objects are merged."""
    out = dict(old)
    for k, v in new.items():
        have = out.get(k)
        if isinstance(have, dict) and isinstance(v, dict):
            out[k] = merged(have, v)
        elif isinstance(have, list) and isinstance(v, list):
            out[k] = have + [x for x in v if x not in have]
        elif have is None or have == "":
            out[k] = v
    return out


def fold(excerpts: list[str], merger: Merger, per_call: int = 5, attempts: int = 3, most: int | None = None) -> tuple[dict, list[str]]:
    """(accumulator, failures) of excerpts merged in order, per_call at a time.

    A call that overflows is split in two until it fits, so each excerpt is read once; one that does not fit alone is a
    failure. A call that fails in all attempts leaves the accumulator as it was. Excerpts beyond `most` are a failure too.
    """
    state: dict = {"columns": {}, "product_data": {}}
    failures: list[str] = []
    total = len(excerpts)
    kept = excerpts if most is None else excerpts[:most]
    work = [(i, kept[i : i + per_call]) for i in range(0, len(kept), per_call)][::-1]
    while work:
        first, part = work.pop()
        error = None
        for _ in range(attempts):
            try:
                state = merger.merge(state, part, first + 1, total)
                error = None
                break
            except ContextOverflow as e:
                if len(part) > 1:
                    half = len(part) // 2
                    work += [(first + half, part[half:]), (first, part[:half])]
                else:
                    failures.append(f"{first + 1}: too large: {e}")
                error = None
                break
            except Exception as e:  # noqa: BLE001 - a failed call is data
                error = e
        if error is not None:
            failures.append(f"{first + 1}-{first + len(part)}: {error}")
    if most is not None and total > most:
        failures.append(f"{most + 1}-{total}: not read")
    return state, failures


FOLDED = T.StructType([T.StructField("id", T.StringType()), T.StructField("n_excerpts", T.IntegerType()), T.StructField("columns", T.StringType()), T.StructField("product_data", T.StringType()), T.StructField("complete", T.BooleanType()), T.StructField("error", T.StringType())])


def fold_products(units: DataFrame, make_merger=OfflineMerger, per_call: int = 5, most: int | None = None) -> DataFrame:
    """units (id, seq, unit) folded product by product, in order of seq.

    A product's excerpts stream through its task, sorted within the partition, so memory holds one call's excerpts and
    the accumulator, however long a document is.
    """

    def rows(source):
        merger, here, held = make_merger(), None, []

        def done():
            state, failures = fold(held, merger, per_call, most=most)
            data = state.get("product_data") or {}
            complete = not failures and all(k in data for k in DOCUMENT_KEYS)
            return here, len(held), json.dumps(state.get("columns"), sort_keys=True), json.dumps(data, sort_keys=True, ensure_ascii=False), complete, "; ".join(failures)[:2000] or None

        for key, _, unit in source:
            if key != here:
                if held:
                    yield done()
                here, held = key, []
            held.append(unit)
        if held:
            yield done()

    ordered = units.select("id", "seq", "unit").repartition("id").sortWithinPartitions("id", "seq")
    return map_rows(ordered, FOLDED, rows, batch=500)


def excerpts(chunks: DataFrame, json_units: DataFrame, chunks_only: DataFrame) -> DataFrame:
    """(id, seq, unit): a product's JSON units, then its chunks; only the chunks for the products in chunks_only that have any."""
    has = chunks.select(F.col("product_id").alias("id")).distinct()
    skip = chunks_only.select("id").join(has, "id", "left_semi")
    first = json_units.join(skip, "id", "left_anti").select("id", F.lit(0).alias("part"), "seq", "unit")
    then = chunks.select(F.col("product_id").alias("id"), F.lit(1).alias("part"), F.col("chunk_index").alias("seq"), F.col("chunk_text").alias("unit"))
    both = first.unionByName(then)
    return both.select("id", (F.row_number().over(Window.partitionBy("id").orderBy("part", "seq")) - 1).alias("seq"), "unit")


def primary_document_type(json_text: Column, source_url: Column) -> Column:
    """The document_type of the record's document whose path is source_url."""
    docs = F.from_json(F.get_json_object(json_text, "$.documents"), "array<struct<s3_path: string, doc_type: string, document_type: string>>")
    return F.try_element_at(F.filter(docs, lambda d: d["s3_path"] == source_url), F.lit(1))["document_type"]


def usage_totals(calls: DataFrame) -> DataFrame:
    """(provider, calls, prompt_tokens, completion_tokens, cost) of rows that describe one model call each."""
    return calls.groupBy("provider").agg(F.count("*").alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"), F.sum("cost").alias("cost"))


def reading_order(chunks: DataFrame) -> DataFrame:
    """(product_id, n_chunks, text): the chunks of a product joined in order; a chunk delivered twice counts once."""
    once = chunks.groupBy("product_id", "chunk_index").agg(F.min("chunk_text").alias("chunk_text"))
    ordered = F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_text")))
    return once.groupBy("product_id").agg(F.count("*").alias("n_chunks"), F.array_join(F.transform(ordered, lambda x: x["chunk_text"]), "\n").alias("text"))


def size_of_units(units: DataFrame) -> DataFrame:
    return units.groupBy("id").agg(F.count("*").alias("n_units"), F.sum(count_tokens(F.col("unit"))).alias("n_tokens"))
