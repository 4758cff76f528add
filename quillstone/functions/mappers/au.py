"""Records of the Australian register: components with ingredients and pack sizes written as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions.mappers import common as C
from quillstone.functions.text import distinct_ci, let, split_top_level, strip

SCHEMA = (
    "artg_id string, pbs_code string, artg_category string, product_name string, sponsor_name string, start_date string, effective_date string, warnings string, "
    "components array<struct<active_ingredients: string, excipient_ingredients: string, dosage_form: string, route_of_administration: string, pack_size: string, indications: string>>"
)
# Categories whose medicines are small molecules, and the words of a countable pack.
LISTED = ("Listed", "Listed (Export Only)")
PACK_WORDS = ("tablet", "capsule", "sachet", "ampoule", "amp", "vial", "syringe", "bottle", "dose", "patch", "pen")

# An ingredient with its quantity, and a plain count of a pack.
_QUANTITY = r"(?i)^([^,]+?),\s*Quantity:\s*([\d.]+)\s*(.+?)\s*$"
_PACK = rf"(?i)^(?:pack\s+of\s+)?(\d+)\s*(?:'|’)?(?:({'|'.join(PACK_WORDS)})s?)?(?:\s+pack)?$"


def shape_error(j):
    """Why a record is not one of this register; null when it is."""
    known = F.coalesce(j["artg_id"], F.lit("")) != ""
    return F.when(known, F.lit(None).cast("string")).when(j["pbs_code"].isNotNull(), F.lit("benefits-scheme record, not a register entry")).otherwise(F.lit("no register id"))


def parse_ingredient(text):
    """struct(name, value, unit) of `name, Quantity: v unit (Equivalent: …)`; the bracket is left out."""

    def parts(t):
        hit = t.rlike(_QUANTITY)
        part = lambda i: F.regexp_extract(t, _QUANTITY, i)
        return F.struct(F.when(hit, C.clean(part(1))).otherwise(C.clean(t)).alias("name"), F.when(hit, part(2).try_cast("double")).alias("value"), F.when(hit, C.clean(part(3))).alias("unit"))

    return let(strip(F.substring_index(text, "(", 1)), parts)


def pack_sizes(text):
    """Distinct struct(size, unit) of the plain counts in a comma-separated text; anything with an x is left out.

    A bare `56s` is no plain count here: the plural belongs to a unit's word.
    """
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda p: strip(F.regexp_replace(p, r"\s*\([^)]*\)\s*$", "")))
    fit = F.filter(parts, lambda p: (p != "") & ~F.lower(p).contains("x") & p.rlike(_PACK))
    found = F.transform(fit, lambda p: F.struct(F.regexp_extract(p, _PACK, 1).try_cast("double").alias("size"), F.nullif(F.lower(F.regexp_extract(p, _PACK, 2)), F.lit("")).alias("unit")))
    return F.array_distinct(found)


def indication_lines(text):
    """One indication a line, without the list's separators, the first of each kept."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: C.clean(F.regexp_replace(x, r"^[ ;]+|[ ;]+$", "")))
    return distinct_ci(F.filter(lines, lambda x: x.isNotNull()))


def presentations(component):
    """The presentations of a component: one for each distinct pack size, or one without."""
    parsed = F.transform(split_top_level(component["active_ingredients"]), parse_ingredient)
    ingredients = F.transform(parsed, lambda p: C.ingredient(C.base_substance(p["name"]), p["value"], p["unit"]))
    form, way = F.lower(C.clean(component["dosage_form"])), F.lower(C.clean(component["route_of_administration"]))
    none = F.struct(F.lit(None).cast("double").alias("size"), F.lit(None).cast("string").alias("unit"))
    packs = pack_sizes(component["pack_size"])
    return F.transform(
        F.when(F.size(packs) > 0, packs).otherwise(F.array(none)),
        lambda p: F.struct(
            F.lit(None).cast("double").alias("per_value"), F.lit(None).cast("string").alias("per_unit"), p["size"].alias("pack_size"), p["unit"].alias("pack_unit"),
            form.alias("form"), way.alias("route"), ingredients.alias("active_ingredients"),
        ),
    )


def extract(df: DataFrame, json_column: str = "json_data") -> DataFrame:
    """df with `error`, `columns` and `product_data`; a record of another shape has an error and nulls."""
    df = df.withColumn("_j", F.from_json(json_column, SCHEMA)).withColumn("error", shape_error(F.col("_j")))
    g = lambda name: F.col(f"_j.{name}")
    parts = F.coalesce(g("components"), F.array().cast(df.select(g("components").alias("c")).schema["c"].dataType))
    df = df.withColumn("_presentations", F.flatten(F.transform(parts, presentations)))
    ingredients = F.flatten(F.transform("_presentations", lambda p: p["active_ingredients"]))
    df = df.withColumn("_ingredients", ingredients)
    bases, salts = C.substances(F.col("_ingredients"))
    kind = C.modality(bases, peptides=(), fallback=F.when(g("artg_category").isin(*LISTED), F.lit("small_molecule")))
    indications = F.array_distinct(F.flatten(F.transform(parts, lambda c: indication_lines(c["indications"]))))
    excipients = distinct_ci(F.flatten(F.transform(parts, lambda c: F.transform(split_top_level(c["excipient_ingredients"]), C.title))))
    began, revised = F.substring(C.clean(g("start_date")), 1, 10).try_cast("date"), F.substring(C.clean(g("effective_date")), 1, 10).try_cast("date")
    columns = C.flat_columns(
        brand_name=C.clean(g("product_name")), generic_name=F.nullif(F.array_join(bases, " + "), F.lit("")), mah_name=C.clean(g("sponsor_name")), registration_number=C.clean(g("artg_id")), product_type=g("artg_category"),
        registration_date=began, approval_date=began, market_authorization_date=began, label_revision_date=revised, source_language=F.lit("en"), indications=indications,
        active_ingredients=C.sorted_set(F.transform("_ingredients", lambda i: i["substance"])), strengths=C.strengths_text(F.col("_ingredients")),
        dosage_forms=C.sorted_set(F.transform("_presentations", lambda p: p["form"])), routes=C.sorted_set(F.transform("_presentations", lambda p: p["route"])),
    )
    made = lambda how, where: F.when(where, F.lit(how)).otherwise(F.lit(C.ABSENT))
    provenance = C.provenance({
        "substance.inn": F.lit(C.MAPPED), "substance.modality": made(C.RULE, kind.isNotNull()), "substance.target": F.lit(C.ABSENT), "substance.moa": F.lit(C.ABSENT), "presentations": F.lit(C.MAPPED),
        "columns.indications": F.lit(C.READ), "columns.label_revision_date": made(C.MAPPED, revised.isNotNull()), "columns.atc_code": F.lit(C.ABSENT), "columns.therapeutic_areas": F.lit(C.ABSENT), "columns.is_generic": F.lit(C.ABSENT),
        "approval.pathway": F.lit(C.ABSENT), "key_risks": made(C.MAPPED, C.clean(g("warnings")).isNotNull()), "excipients": F.lit(C.MAPPED),
    })
    null = F.lit(None).cast("string")
    product_data = F.struct(
        F.lit("1").alias("_schema_version"), C.substance_struct(bases, salts, kind).alias("substance"), F.col("_presentations").alias("presentations"),
        F.transform(indications, lambda c: F.struct(c.alias("condition"), null.alias("population"), null.alias("line_of_therapy"), null.alias("biomarker"), null.alias("approval_date"))).alias("indications"),
        F.struct(null.alias("pathway"), g("artg_category").alias("registration_class"), F.lit(None).cast("boolean").alias("conditional"), F.lit(None).cast("boolean").alias("priority_review"), null.alias("reference_product")).alias("approval"),
        F.array().cast("array<string>").alias("pivotal_evidence"), F.filter(F.array(C.clean(g("warnings"))), lambda x: x.isNotNull()).alias("key_risks"),
        F.transform(excipients, lambda e: F.struct(e.alias("name"), null.alias("name_local"), F.lit(None).cast("double").alias("value"), null.alias("unit"))).alias("excipients"),
    )
    ok = F.col("error").isNull()
    return df.withColumns({"provenance": F.when(ok, provenance), "columns": F.when(ok, columns), "product_data": F.when(ok, F.to_json(product_data, {"ignoreNullFields": "false"}))}).drop("_j", "_presentations", "_ingredients")
