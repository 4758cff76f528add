"""Targeted repair of stored documents: which rows need it, and strict checks of what a repair returns."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows
from quillstone.functions.jsonx import parse_reply
from quillstone.functions.text import distinct_ci

PRESENTATIONS = (
    "array<struct<per_value: double, per_unit: string, pack_size: string, pack_unit: string, form: string, route: string, active_ingredients: string>>"
)
COMPONENTS = "array<struct<pack_size: string, indications: string>>"
# Units of volume and weight, which no countable pack has.
UNCOUNTABLE = ("ml", "l", "g", "mg", "mcg", "kg", "gm", "litre", "liter", "millilitre", "milliliter", "gram", "milligram", "microgram", "iu", "%")


def candidates(products: DataFrame, key: str = "artg_id") -> DataFrame:
    """(id, n_components, n_presentations, chars): records with the key whose stored pack sizes fall short of what is written.

    A record falls short when a component states a pack size and a stored presentation has none, or when the text lists
    several sizes and one presentation is stored. Arrays are examined in the row: nothing is exploded or joined.
    """
    components = F.from_json(F.get_json_object("json_data", "$.components"), COMPONENTS)
    stored = F.from_json(F.get_json_object("product_data", "$.presentations"), PRESENTATIONS)
    df = products.select("id", "json_data", components.alias("c"), stored.alias("p"))
    stated = F.exists("c", lambda c: F.trim(F.coalesce(c["pack_size"], F.lit(""))) != "")
    missing = F.exists("p", lambda p: p["pack_size"].isNull())
    listed = (F.size("p") == 1) & F.exists("c", lambda c: c["pack_size"].contains(","))
    chosen = df.where(F.array_contains(F.json_object_keys("json_data"), key) & stated & (missing | listed))
    return chosen.select("id", F.size("c").alias("n_components"), F.size("p").alias("n_presentations"), F.length("json_data").alias("chars"))


def cost(chosen: DataFrame) -> DataFrame:
    """One row: how many records a repair would send, single-component ones, and their mean and greatest size."""
    one = F.col("n_components") == 1
    return chosen.agg(F.count("*").alias("records"), F.count(F.when(one, 1)).alias("single"), F.round(F.avg(F.when(one, F.col("chars"))), 2).alias("mean_chars"), F.max(F.when(one, F.col("chars"))).alias("max_chars"))


def identity(p: Column) -> Column:
    """The part of a presentation that a repair must return as it was."""
    return F.struct(p["form"].alias("form"), p["route"].alias("route"), p["active_ingredients"].alias("active_ingredients"))


def checked_presentations(original: Column, returned: Column) -> Column:
    """The returned presentations where they may be stored, else null (all or nothing).

    Each must be one of the original ones but for its pack; a stated per-quantity may not change; a pack of a volume or
    weight is moved to the per-quantity where that is free; equal packs are kept once.
    """
    known = F.transform(original, identity)
    per_value, per_unit = F.element_at(original, 1)["per_value"], F.element_at(original, 1)["per_unit"]
    same = lambda p: F.array_contains(known, identity(p)) & (per_value.isNull() | p["per_value"].eqNullSafe(per_value)) & (per_unit.isNull() | p["per_unit"].eqNullSafe(per_unit))

    def moved(p: Column) -> Column:
        unit = F.lower(F.trim(p["pack_unit"]))
        fill = F.coalesce(unit.isin(*UNCOUNTABLE), F.lit(False))
        free = fill & per_value.isNull() & p["per_value"].isNull() & p["pack_size"].isNotNull()
        return F.struct(
            F.when(free, p["pack_size"].try_cast("double")).otherwise(p["per_value"]).alias("per_value"), F.when(free, F.when(unit == "ml", F.lit("mL")).otherwise(unit)).otherwise(p["per_unit"]).alias("per_unit"),
            F.when(~fill, p["pack_size"]).alias("pack_size"), F.when(~fill, p["pack_unit"]).alias("pack_unit"), p["form"].alias("form"), p["route"].alias("route"), p["active_ingredients"].alias("active_ingredients"),
        )

    fixed = F.transform(returned, moved)
    packs = F.transform(fixed, lambda p: F.to_json(F.struct(p["pack_size"], p["pack_unit"]), {"ignoreNullFields": "false"}))
    once = F.filter(fixed, lambda p, i: F.array_position(packs, F.element_at(packs, i + 1)) == i + 1)
    fine = (F.size(original) > 0) & (F.size(returned) > 0) & F.forall(returned, lambda p: F.coalesce(same(p), F.lit(False)))
    return F.when(fine, once)


def checked_indications(raw: Column, returned: Column) -> Column:
    """The returned indications, first of each, where every one stands word for word in the raw text, else null."""
    norm = lambda t: F.lower(F.trim(F.regexp_replace(t, r"(?U)\s+", " ")))
    kept = distinct_ci(returned)
    fine = (F.size(returned) > 0) & (norm(F.coalesce(raw, F.lit(""))) != "") & F.forall(kept, lambda x: norm(raw).contains(norm(x)))
    return F.when(fine, kept)


class Repairer(Protocol):
    """Derives the two fields anew from a record and its stored document; answers with JSON text, may raise."""

    def repair(self, record: str, document: str) -> str: ...


class OfflineRepairer:
    """A deterministic repairer that needs no model: the stored presentation once for each pack size that the record lists."""

    def repair(self, record: str, document: str) -> str:
        component = json.loads(record)["components"][0]
        first = json.loads(document)["presentations"][0]
        sizes = [m.groups() for part in str(component["pack_size"]).split(",") if (m := re.fullmatch(r"\s*(?:pack of )?(\d+)\s*([a-z]*)\s*", part, re.I))]
        lines = [x.strip(" .-") for x in str(component.get("indications") or "").splitlines()]
        return json.dumps({"presentations": [first | {"pack_size": int(n), "pack_unit": unit.lower() or first.get("pack_unit")} for n, unit in sizes], "indications": [x for x in lines if x]})


REPLIES = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "json_data", "product_data", "reply", "error")])
REPAIRED = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "product_data", "error")])


def repaired(products: DataFrame, make_repairer: Callable[[], Repairer] = OfflineRepairer) -> DataFrame:
    """(id, product_data, error): the new documents of the candidates of one component, product_data null where nothing may be stored.

    Each field is checked by itself (checked_presentations, checked_indications) and replaced only where its check
    passes; a failed call, an unreadable reply and two failed checks are errors, never a failed task. Feed the rows to
    `tables.update` on id.
    """
    chosen = candidates(products).where("n_components = 1").select("id")
    rows_of = products.join(chosen, "id", "left_semi").select(F.col("id").cast("string").alias("id"), "json_data", "product_data")

    def ask(source):
        repairer = make_repairer()
        for key, record, document in source:
            try:
                yield key, record, document, repairer.repair(record, document), None
            except Exception as e:  # noqa: BLE001 - a failed call is data
                yield key, record, document, None, str(e)[:2000] or type(e).__name__

    answered = map_rows(rows_of, REPLIES, ask, batch=500).withColumn("reply", parse_reply(F.col("reply")))
    presented = lambda c: F.from_json(F.get_json_object(c, "$.presentations"), PRESENTATIONS)
    said = F.from_json(F.get_json_object("json_data", "$.components"), COMPONENTS)[0]["indications"]
    packs = checked_presentations(presented(F.col("product_data")), presented(F.col("reply")))
    uses = checked_indications(said, F.from_json(F.get_json_object("reply", "$.indications"), "array<string>"))
    checked = answered.select("id", "product_data", F.to_json(packs, {"ignoreNullFields": "false"}).alias("packs"), F.to_json(uses).alias("uses"), "reply", "error")

    def put(source):
        for key, document, packs, uses, reply, error in source:
            if error or reply is None:
                yield key, None, error or "unreadable reply"
                continue
            if packs is None and uses is None:
                yield key, None, "no field passed its check"
                continue
            new = json.loads(document)
            if packs is not None:
                opened = [p | {"active_ingredients": json.loads(p["active_ingredients"] or "null"), "pack_size": json.loads(p["pack_size"]) if (p["pack_size"] or "").isdigit() else p["pack_size"]} for p in json.loads(packs)]
                new["presentations"] = opened
            if uses is not None:
                known = {i.get("condition"): i for i in new.get("indications") or [] if isinstance(i, dict)}
                empty = dict.fromkeys(("condition", "population", "line_of_therapy", "biomarker", "approval_date"))
                new["indications"] = [known.get(x) or empty | {"condition": x} for x in json.loads(uses)]
            yield key, json.dumps(new, ensure_ascii=False), None

    return map_rows(checked, REPAIRED, put, batch=500)
