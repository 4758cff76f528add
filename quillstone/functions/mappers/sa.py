"""Records of the Saudi register: one record is one presentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions.mappers import common as C
from quillstone.functions.text import distinct_ci, strip

SCHEMA = (
    "registration_number string, trade_name string, trade_name_ar string, scientific_name string, strength string, strength_unit string, pharmaceutical_form string, administration_route string, "
    "size double, size_unit string, package_size double, package_type string, drug_type string, authorization_status string, register_year string, atc_code_1 string, atc_code_2 string, "
    "marketing_company string, marketing_company_country string, manufacturers array<struct<name: string, country: string>>"
)
# Therapeutic areas by the first three characters of an ATC code, else by the first.
AREA_BY_PREFIX = {
    "A10": "Endocrinology", "B01": "Hematology", "M05": "Rheumatology", "N01": "Anaesthesiology", "N02": "Pain Management", "N05": "Psychiatry", "N06": "Psychiatry",
    "S01": "Ophthalmology", "S02": "Otolaryngology",
}
AREA_BY_LETTER = {
    "A": "Gastroenterology", "B": "Hematology", "C": "Cardiology", "D": "Dermatology", "G": "Urology", "H": "Endocrinology", "J": "Infectious Diseases", "L": "Oncology",
    "M": "Rheumatology", "N": "Neurology", "P": "Infectious Diseases", "R": "Pulmonology", "S": "Ophthalmology",
}
# The register's drug types as product types and as pathways.
PRODUCT_TYPES = {"Generic": "Generic", "NCE": "New Chemical Entity", "Biological": "Biological"}
PATHWAYS = {"Generic": "generic", "NCE": "innovator"}


def area(atc):
    """The therapeutic area of an ATC code."""
    code = F.upper(strip(atc))
    return F.coalesce(C.lookup(AREA_BY_PREFIX, F.substring(code, 1, 3)), C.lookup(AREA_BY_LETTER, F.substring(code, 1, 1)))


def route(text):
    """`Parenteral use` as `parenteral`."""
    return F.nullif(F.lower(F.regexp_replace(C.clean(text), r"(?i)\s+use\s*$", "")), F.lit(""))


def ingredient_names(text):
    """Comma-separated names; `tri sodium` is written as one word."""
    parts = F.filter(F.transform(F.split(C.clean(text), ","), strip), lambda x: x != "")
    return F.transform(parts, lambda n: F.regexp_replace(n, r"(?i)\b(mono|di|tri)\s+(sodium|potassium)\b", "$1$2"))


def strength_values(text):
    """Comma-separated numbers, in place: a blank or unreadable one is null."""
    return F.transform(F.split(C.clean(text), ","), lambda t: strip(t).try_cast("double"))


def manufacturers(items):
    """struct(names, countries): joined by '; ', the first of each name, positions aligned."""
    named = F.filter(items, lambda m: C.clean(m["name"]).isNotNull())
    names = distinct_ci(F.transform(named, lambda m: C.clean(m["name"])))
    first = F.transform(names, lambda n: F.element_at(F.filter(named, lambda m: F.lower(C.clean(m["name"])) == F.lower(n)), 1))
    countries = F.transform(first, lambda m: F.coalesce(C.clean(m["country"]), F.lit("")))
    return F.struct(F.nullif(F.array_join(names, "; "), F.lit("")).alias("names"), F.when(F.size(names) > 0, F.array_join(countries, "; ")).alias("countries"))


def extract(df: DataFrame, json_column: str = "json_data") -> DataFrame:
    """df with `columns` and `product_data` structs mapped from the record; broken or null JSON gives nulls throughout."""
    j = F.from_json(json_column, SCHEMA)
    df = df.withColumn("_j", j)
    g = lambda name: F.col(f"_j.{name}")
    names, values = ingredient_names(g("scientific_name")), strength_values(g("strength"))
    unit = C.clean(g("strength_unit"))
    named = F.coalesce(F.when(F.size(names) > 0, names), F.array(F.lit(None).cast("string")))
    ingredients = F.transform(named, lambda n, i: C.ingredient(C.base_substance(n), F.try_element_at(values, i + 1), unit))
    df = df.withColumn("_ingredients", ingredients)
    bases, salts = C.substances(F.col("_ingredients"))
    kind = C.modality(bases, first=F.when(g("drug_type") == "Biological", F.lit("biologic")))
    makers = manufacturers(g("manufacturers"))
    atc = F.coalesce(C.clean(g("atc_code_1")), C.clean(g("atc_code_2")))
    form = F.lower(C.clean(g("pharmaceutical_form")))
    way = route(g("administration_route"))
    pathway, label = C.lookup(PATHWAYS, g("drug_type")), F.coalesce(C.lookup(PRODUCT_TYPES, g("drug_type")), g("drug_type"))
    presentation = F.struct(
        g("size").alias("per_value"), C.clean(g("size_unit")).alias("per_unit"), g("package_size").alias("pack_size"), F.lower(C.clean(g("package_type"))).alias("pack_unit"),
        form.alias("form"), way.alias("route"), F.col("_ingredients").alias("active_ingredients"),
    )
    # the register knows only the year of registration, which stands in product_data: the date columns stay null
    columns = C.flat_columns(
        brand_name=C.clean(g("trade_name")), brand_name_local=C.clean(g("trade_name_ar")), generic_name=F.nullif(F.array_join(bases, " + "), F.lit("")), mah_name=C.clean(g("marketing_company")),
        mah_address=C.clean(g("marketing_company_country")), manufacturer=makers["names"], manufacturer_address=makers["countries"], registration_number=C.clean(g("registration_number")), product_type=label,
        status=F.when(F.lower(strip(g("authorization_status"))) == "valid", F.lit("Active")), atc_code=atc, is_generic=pathway != "innovator", source_language=F.lit("en"),
        therapeutic_areas=F.filter(F.array(area(atc)), lambda x: x.isNotNull()), active_ingredients=C.sorted_set(F.transform("_ingredients", lambda i: i["substance"])), strengths=C.strengths_text(F.col("_ingredients")),
        dosage_forms=F.filter(F.array(form), lambda x: x.isNotNull()), routes=F.filter(F.array(way), lambda x: x.isNotNull()),
    )
    made = lambda how, where: F.when(where, F.lit(how)).otherwise(F.lit(C.ABSENT))
    provenance = C.provenance({
        "substance.inn": F.lit(C.MAPPED), "substance.modality": F.lit(C.RULE), "substance.target": F.lit(C.ABSENT), "substance.moa": F.lit(C.ABSENT), "presentations": F.lit(C.MAPPED), "approval.pathway": F.lit(C.RULE),
        "approval.registration_year": made(C.MAPPED, g("register_year").try_cast("int").isNotNull()), "columns.therapeutic_areas": made(C.RULE, area(atc).isNotNull()), "columns.status": made(C.MAPPED, columns["status"].isNotNull()),
        "columns.approval_date": F.lit(C.ABSENT), "indications": F.lit(C.ABSENT), "key_risks": F.lit(C.ABSENT), "pivotal_evidence": F.lit(C.ABSENT), "excipients": F.lit(C.ABSENT),
    })
    none = F.array().cast("array<string>")
    product_data = F.struct(
        F.lit("1").alias("_schema_version"), C.substance_struct(bases, salts, kind).alias("substance"), F.array(presentation).alias("presentations"), none.alias("indications"),
        F.struct(pathway.alias("pathway"), label.alias("registration_class"), F.lit(None).cast("boolean").alias("conditional"), F.lit(None).cast("boolean").alias("priority_review"), F.lit(None).cast("string").alias("reference_product"), g("register_year").try_cast("int").alias("registration_year")).alias("approval"),
        none.alias("pivotal_evidence"), none.alias("key_risks"), none.alias("excipients"),
    )
    return df.withColumns({"provenance": provenance, "columns": columns, "product_data": F.to_json(product_data, {"ignoreNullFields": "false"})}).drop("_j", "_ingredients")
