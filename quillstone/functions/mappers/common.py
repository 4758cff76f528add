"""What the register mappers share: names, units, strengths, dates and substances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.text import let, strip

# Salt and hydrate words at the end of a substance's name, in the order in which they are tried.
SALTS = (
    "hydrochloride dihydrate", "hydrochloride monohydrate", "hydrogen tartrate", "sodium succinate", "sodium phosphate", "sodium sulfate", "sodium chloride", "calcium chloride",
    "hydrobromide", "hydrochloride", "dihydrochloride", "methylbromide", "monohydrate", "dihydrate", "trihydrate", "anhydrous", "besylate", "bitartrate", "camsylate", "citrate",
    "decanoate", "dipropionate", "esylate", "fumarate", "gluconate", "hyclate", "lactate", "maleate", "mesylate", "napsylate", "nitrate", "oxalate", "palmitate", "pamoate",
    "phosphate", "propionate", "salicylate", "stearate", "succinate", "sulfate", "trisodium", "disodium", "monosodium", "dipotassium", "monopotassium", "sulphate", "tannate",
    "tartrate", "tosylate", "valerate", "acetate", "benzoate", "bromide", "chloride", "iodide", "sodium", "potassium", "calcium", "magnesium", "meglumine", "hydrate", "base",
)
# Units of a strength as registers write them.
UNITS = {
    "MG": "mg", "G": "g", "GM": "g", "GRAM": "g", "MCG": "mcg", "UG": "mcg", "KG": "kg", "ML": "mL", "L": "L", "IU": "IU", "UNIT": "units", "UNITS": "units", "MEQ": "mEq",
    "MMOL": "mmol", "%": "%", "INH": "inhalation", "VIAL": "vial", "BOT": "bottle", "TBSP": "tablespoon", "SPRAY": "spray", "ACT": "actuation", "MG/ML": "mg/mL",
}
# Name endings and names that tell a substance's kind.
BIOLOGIC_ENDINGS = ("mab", "cept", "kinra", "ase", "gene", "cel")
PEPTIDES = (
    "insulin", "calcitonin", "octreotide", "leuprolide", "goserelin", "desmopressin", "vasopressin", "oxytocin", "glucagon", "teriparatide", "liraglutide", "semaglutide",
    "exenatide", "corticotropin", "cosyntropin",
)
PROTEINS = ("gonadotropin", "somatropin", "menotropins", "urofollitropin", "follitropin", "lutropin", "thyrotropin", "streptokinase")

SALT = T.StructType([T.StructField("substance", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("unit", T.StringType())])


def lookup(table: dict[str, str | None], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def clean(text: Column) -> Column:
    """text without footnotes in double asterisks, with single blanks and no outer blanks, semicolons or commas; empty as null."""
    t = F.regexp_replace(F.regexp_replace(text, r"(?s)\*\*.*?\*\*", " "), r"(?U)\s+", " ")
    return F.nullif(F.regexp_replace(t, r"^[ ;,]+|[ ;,]+$", ""), F.lit(""))


def title(name: Column) -> Column:
    """A name in sentence case; an inverted one (`B, A` without digits) turned round; a first word with a digit stays low."""

    def turned(c: Column) -> Column:
        head, tail = strip(F.substring_index(c, ",", 1)), strip(F.substring_index(c, ",", -1))
        inverted = c.rlike(r"^[^,\d]+,[^,\d]+$") & (head != "") & (tail != "")
        return F.regexp_replace(F.lower(F.when(inverted, F.concat_ws(" ", tail, head)).otherwise(c)), r"(?U)\s+", " ")

    def cased(low: Column) -> Column:
        return F.when(low.rlike(r"^\S*\d"), low).otherwise(F.concat(F.upper(F.substring(low, 1, 1)), F.substring(low, F.lit(2), F.length(low))))

    return let(clean(name), lambda c: let(turned(c), cased))


def base_substance(name: Column, passes: int = 4) -> Column:
    """struct(base, salt): the name without its salt words, and the full name where any were taken off (else null).

    In each pass the first salt word of the list that ends the name is taken off, unless what remains is a salt word
    itself (sodium chloride is a substance, not a salt of sodium).
    """
    kept = F.array(*[F.lit(s) for s in SALTS])
    without = lambda stem, s: strip(F.substring(stem, F.lit(1), F.length(stem) - F.length(s) - 1))

    def once(stem: Column) -> Column:
        ends = F.filter(kept, lambda s: F.endswith(stem, F.concat(F.lit(" "), s)) & ~F.array_contains(kept, without(stem, s)))
        return let(F.try_element_at(ends, F.lit(1)), lambda first: F.when(first.isNotNull(), without(stem, first)).otherwise(stem))

    def named(low: Column, stem: Column) -> Column:
        bare = stem == ""
        return F.struct(title(F.when(bare, low).otherwise(stem)).alias("base"), F.when(~bare & (stem != low), title(low)).alias("salt"))

    # a fold over the passes keeps the expression small
    passes_done = lambda low: F.aggregate(F.sequence(F.lit(1), F.lit(passes)), low, lambda acc, _: once(acc))
    return let(F.lower(clean(name)), lambda low: let(passes_done(low), lambda stem: named(low, stem)))


def norm_unit(unit: Column) -> Column:
    return let(F.nullif(strip(unit), F.lit("")), lambda u: F.coalesce(lookup(UNITS, F.upper(u)), F.lower(u)))


# Fixed value: a strength as the register writes it (value, unit, basis, per value, per unit).
_STRENGTH = r"(?i)^\s*(?:EQ\s+)?([\d.,]+)\s*(%|[A-Za-z/]+)(?:\s+([A-Z]+))?(?:\s*/\s*([\d.,]*)\s*([A-Za-z%]+))?\s*$"


def _figure(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("double")


def parse_strength(text: Column) -> Column:
    """struct(value, unit, per_value, per_unit) of a written strength such as `EQ 1GM BASE/VIAL` or `10,000 UNITS/ML`.

    What stands in brackets restates the strength and is left out. A volume without a number is one of its unit; a
    container has no amount. What is no strength gives nulls.
    """

    def parts(t: Column) -> Column:
        g = [F.nullif(F.regexp_extract(t, _STRENGTH, i), F.lit("")) for i in range(6)]
        fused = F.coalesce(g[2].contains("/") & g[5].isNull(), F.lit(False))
        return F.struct(
            _figure(g[1]).alias("value"), norm_unit(F.when(fused, F.substring_index(g[2], "/", 1)).otherwise(g[2])).alias("unit"), F.when(~fused, _figure(g[4])).alias("per_value"),
            norm_unit(F.when(fused, F.regexp_extract(g[2], r"^[^/]*/(.*)$", 1)).otherwise(g[5])).alias("per_unit"),
        )

    def filled(p: Column) -> Column:
        return F.struct(p["value"].alias("value"), p["unit"].alias("unit"), F.coalesce(p["per_value"], F.when(p["per_unit"].isin("mL", "L"), F.lit(1.0))).alias("per_value"), p["per_unit"].alias("per_unit"))

    return let(strip(F.regexp_replace(clean(text), r"\(.*?\)", " ")), lambda t: let(parts(F.when(t.rlike(_STRENGTH), t)), filled))


def iso_date(text: Column) -> Column:
    """A date written MM/DD/YYYY, YYYY-MM-DD or YYYYMMDD; other writings and impossible days are null."""

    def iso(t: Column) -> Column:
        american = F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.regexp_replace(t, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"))
        plain = F.when(t.rlike(r"^\d{8}$"), F.regexp_replace(t, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"))
        return F.coalesce(american, F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t), plain).try_cast("date")

    return let(clean(text), iso)


def number_text(value: Column) -> Column:
    """A number as text, whole ones without a fraction."""
    return F.when(value == F.floor(value), value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def modality(bases: Column, *, vaccine=("vaccine", "toxoid"), proteins=(), peptides=PEPTIDES, fallback: Column | None = None, first: Column | None = None, conjugates: bool = False) -> Column:
    """The kind of a medicine by the names of its substances; endings are looked up at the end of all names together."""
    joined = F.array_join(F.transform(F.filter(bases, lambda b: b.isNotNull()), F.lower), " ")
    has = lambda words: F.lit(False) if not words else joined.rlike("|".join(words))
    rule = F.when(joined == "", F.lit(None).cast("string")).when(has(vaccine), "vaccine").when(has(proteins), "biologic").when(has(peptides), "peptide")
    if conjugates:
        rule = rule.when(joined.rlike(r" vedotin|deruxtecan"), "adc")
    rule = rule.when(joined.rlike(f"({'|'.join(BIOLOGIC_ENDINGS)})$"), "biologic").otherwise(fallback if fallback is not None else F.lit("small_molecule"))
    return F.coalesce(first, rule) if first is not None else rule


def ingredient(substance: Column, value: Column, unit: Column) -> Column:
    """An entry of active_ingredients; substance is base_substance's struct."""
    return F.struct(
        substance["base"].alias("substance"),
        value.cast("double").alias("strength_value"),
        unit.alias("strength_unit"),
        F.when(substance["salt"].isNotNull(), F.struct(substance["salt"].alias("substance"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("unit"))).cast(SALT).alias("salt"),
    )


def substances(ingredients: Column) -> tuple[Column, Column]:
    """(distinct bases in order, distinct salts in order) of an array of ingredients."""
    bases = F.array_distinct(F.filter(F.transform(ingredients, lambda i: i["substance"]), lambda x: x.isNotNull()))
    salts = F.array_distinct(F.filter(F.transform(ingredients, lambda i: i["salt"]["substance"]), lambda x: x.isNotNull()))
    return bases, salts


def substance_struct(bases: Column, salts: Column, kind: Column, target: Column | None = None, moa: Column | None = None) -> Column:
    null = F.lit(None).cast("string")
    return F.struct(
        F.nullif(F.array_join(bases, " + "), F.lit("")).alias("inn"),
        F.when((F.size(salts) == 1) & (F.size(bases) == 1), salts[0]).alias("salt_form"),
        kind.alias("modality"),
        (null if target is None else target).alias("target"),
        (null if moa is None else moa).alias("moa"),
    )


def strengths_text(ingredients: Column) -> Column:
    """Sorted distinct `value unit` of the ingredients with a value."""
    shown = F.transform(F.filter(ingredients, lambda i: i["strength_value"].isNotNull()), lambda i: F.concat_ws(" ", number_text(i["strength_value"]), i["strength_unit"]))
    return F.array_sort(F.array_distinct(shown))


def sorted_set(items: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(items, lambda x: x.isNotNull())))


# The flat columns that every mapper fills, in their order, with their types.
FLAT = {
    **dict.fromkeys(["product_name_en", "brand_name", "brand_name_local", "generic_name", "mah_name", "mah_address", "manufacturer", "manufacturer_address", "registration_number", "product_type", "status"], "string"),
    **dict.fromkeys(["registration_date", "approval_date", "market_authorization_date", "expiry_date", "withdrawal_date", "label_revision_date"], "date"),
    "atc_code": "string", "is_generic": "boolean", "reference_product": "string", "source_language": "string",
    **dict.fromkeys(["therapeutic_areas", "indications", "symptoms", "adverse_reactions", "contraindications", "active_ingredients", "strengths", "dosage_forms", "routes"], "array<string>"),
}
#: How a field came about: copied from a field of the record, by a rule from such fields, read in prose, or not at all.
MAPPED, RULE, READ, ABSENT = "mapped", "rule", "read", "absent"


def flat_columns(**filled: Column) -> Column:
    """The struct of all FLAT columns; what a register does not give is null, or an empty array."""
    if unknown := set(filled) - set(FLAT):
        raise ValueError(f"no such columns: {sorted(unknown)}")
    none = lambda kind: (F.array() if kind.startswith("array") else F.lit(None)).cast(kind)
    return F.struct(*[(filled[c].cast(kind) if c in filled else none(kind)).alias(c) for c, kind in FLAT.items()])


def provenance(how: dict[str, Column]) -> Column:
    """A map from fields to how they came about."""
    return F.create_map(*[x for key, value in how.items() for x in (F.lit(key), value)])
