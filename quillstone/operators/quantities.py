"""Quantities recorded in different units (problem 3): one common unit for every strength, per and pack quantity.

Units written out in either field are resolved by expressions (no Python after the JSON is opened). Quantities whose
unit is missing or unreadable go to a calibrated random forest that predicts the unit from magnitude, source, dosage
form and neighbouring units; confident predictions are converted, the others come out for review.
"""

from __future__ import annotations

import json
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows
from quillstone.operators.nested import as_contract_array, parse_json
from quillstone.session import cut

# Unit words (lower case, without outer dots), their common unit and the factor to it.
UNITS: dict[str, tuple[str, str]] = {
    **dict.fromkeys(["mg", "milligram", "milligrams", "mgs", "milligramme", "milligrammes"], ("mg", "1")),
    **dict.fromkeys(["g", "gm", "gms", "gram", "grams", "gramme", "grammes"], ("mg", "1000")),
    **dict.fromkeys(["kg", "kilogram", "kilograms"], ("mg", "1000000")),
    **dict.fromkeys(["mcg", "ug", "µg", "μg", "microgram", "micrograms", "microgramme", "microgrammes"], ("mg", "0.001")),
    **dict.fromkeys(["ng", "nanogram", "nanograms"], ("mg", "0.000001")),
    **dict.fromkeys(["ml", "mls", "cc", "millilitre", "millilitres", "milliliter", "milliliters"], ("mL", "1")),
    **dict.fromkeys(["l", "ltr", "ltrs", "litre", "litres", "liter", "liters"], ("mL", "1000")),
    **dict.fromkeys(["dl", "decilitre", "decilitres", "deciliter", "deciliters"], ("mL", "100")),
    **dict.fromkeys(["cl", "centilitre", "centilitres", "centiliter", "centiliters"], ("mL", "10")),
    **dict.fromkeys(["ul", "µl", "μl", "microlitre", "microlitres", "microliter", "microliters"], ("mL", "0.001")),
    **dict.fromkeys(["iu", "i.u", "u", "unit", "units", "international unit", "international units"], ("IU", "1")),
    **dict.fromkeys(["kiu", "ku", "thousand iu", "thousand units", "thousand international units", "x10^3 iu", "x10^3 units"], ("IU", "1000")),
    **dict.fromkeys(["miu", "mega units", "mega iu", "megaunits", "mu", "million iu", "million units", "million international units", "x10^6 iu", "x10^6 units"], ("IU", "1000000")),
    **dict.fromkeys(["billion iu", "billion units", "x10^9 iu", "x10^9 units"], ("IU", "1000000000")),
    **dict.fromkeys(["mmol", "mmols", "millimol", "millimols", "millimole", "millimoles"], ("mmol", "1")),
    **dict.fromkeys(["mol", "mols", "mole", "moles"], ("mmol", "1000")),
    **dict.fromkeys(["umol", "µmol", "μmol", "micromol", "micromols", "micromole", "micromoles"], ("mmol", "0.001")),
    **dict.fromkeys(["nmol", "nanomol", "nanomole", "nanomoles"], ("mmol", "0.000001")),
    **dict.fromkeys(["%", "percent", "per cent", "% w/v", "%w/v", "% w/w", "%w/w", "% v/v", "%v/v", "pct"], ("mg", "10")),
    **dict.fromkeys(["tablet", "tablets", "tab", "tabs", "tablet(s)"], ("tablet", "1")),
    **dict.fromkeys(["capsule", "capsules", "cap", "caps", "capsule(s)"], ("capsule", "1")),
    **dict.fromkeys(["vial", "vials", "vial(s)"], ("vial", "1")),
    **dict.fromkeys(["ampoule", "ampoules", "amp", "amps", "ampule", "ampules", "ampoule(s)"], ("ampoule", "1")),
    **dict.fromkeys(["sachet", "sachets", "sach", "sachet(s)"], ("sachet", "1")),
    **dict.fromkeys(["patch", "patches", "patch(es)"], ("patch", "1")),
}
COMMON = ("mg", "mL", "IU", "mmol", "tablet", "capsule", "vial", "ampoule", "sachet", "patch")
# Words for a container whose content is counted, as regular-expression alternatives.
CONTAINERS = r"(?:packs?|blisters?|box(?:e?s)?|trays?|cartons?|strips?|cases?|bundles?|packets?|sleeves?|kits?)"

#: The forest is fitted on at most so many labelled quantities, chosen by a hash of the quantity's place.
TRAIN_ROWS = 20_000
#: Resolution of that choice, and number of steps of the calibrated confidence.
HASH_STEPS, CALIBRATION = 1 << 20, 512
TREES, DEPTH, SEED = 24, 8, 7
#: A predicted unit is used from this calibrated probability on; below it the quantity goes to review.
CONFIDENT = 0.9

NUM = r"[0-9]+(?:[.,][0-9]+)*"

RAW = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("presentation_no", T.IntegerType()),
        T.StructField("ingredient_no", T.IntegerType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("value_text", T.StringType()),
        T.StructField("value_is_number", T.BooleanType()),
        T.StructField("unit_text", T.StringType()),
        T.StructField("form", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("near_unit", T.StringType()),
    ]
)


def _plain(value) -> tuple[str | None, bool]:
    """A recorded value as plain decimal text, and whether it was a JSON number."""
    if value is None or isinstance(value, (bool, dict, list)):
        return None, False
    if isinstance(value, str):
        return value, False
    return format(Decimal(repr(value)), "f") if value == value and abs(value) < 1e25 else None, True


def recorded(products: DataFrame) -> DataFrame:
    """Every recorded quantity of product_data, one row each: narrow, one pass over the JSON.

    Off-contract arrays (lone objects, JSON text) are read as the arrays they stand for; null, empty and broken JSON
    give no row; a quantity whose two fields are null gives no row.
    """

    def rows(source):
        for pid, regulator, text in source:
            root = parse_json(text)
            if not isinstance(root, dict):
                continue
            for i, p in enumerate(as_contract_array(root.get("presentations"))):
                if not isinstance(p, dict):
                    continue
                form = p.get("form") if isinstance(p.get("form"), str) else None
                items = [("per", -1, p.get("per_value"), p.get("per_unit")), ("pack", -1, p.get("pack_size"), p.get("pack_unit"))]
                items += [
                    ("strength", k, a.get("strength_value"), a.get("strength_unit"))
                    for k, a in enumerate(as_contract_array(p.get("active_ingredients")))
                    if isinstance(a, dict)
                ]
                for name, k, value, unit in items:
                    shown, is_number = _plain(value)
                    unit = unit if isinstance(unit, str) or unit is None else json.dumps(unit)
                    if shown is None and unit is None:
                        continue
                    near = next((u for n, j, _, u in items if (n, j) != (name, k) and isinstance(u, str)), None)
                    yield pid, i, k, name, shown, is_number, unit, form, regulator, near

    return map_rows(products.select(F.col("id").cast("string"), F.col("regulator").cast("string"), "product_data"), RAW, rows)


def tidy_unit(text: Column) -> Column:
    """A unit's key: lower case, single spaces, no outer blanks or dots."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " ")), r"^[ .]+|[ .]+$", "")


def number(text: Column) -> Column:
    """A written number as decimal: a comma followed by exactly three digits is a thousands mark if the number starts
    with 1 to 9, any other comma is a decimal mark."""
    plain = F.trim(text)
    thousands = plain.rlike(r"^[1-9][0-9]{0,2}(,[0-9]{3})+(\.[0-9]+)?$")
    clean = F.when(thousands, F.regexp_replace(plain, ",", "")).otherwise(F.regexp_replace(plain, ",", "."))
    return clean.try_cast("decimal(38,12)")


def _lookup(part: int, key: Column) -> Column:
    pairs = ", ".join(f"'{k}', '{v[part]}'" for k, v in UNITS.items())
    return F.element_at(F.expr(f"map({pairs})"), key)


def resolve(raw: DataFrame) -> DataFrame:
    """Adds common_unit and amount (decimal, in the common unit); both null where the unit cannot be read.

    The text of value and unit are read as one phrase `[n container of] n unit`: counts within counts multiply. Each
    step is a column of its own, which the optimizer computes once however often it is used.
    """
    value = F.when(F.col("value_is_number"), F.col("value_text").try_cast("decimal(38,12)")).otherwise(number(F.col("value_text")))
    df = raw.withColumn("_value", value)
    joined = F.lower(F.concat_ws(" ", F.when(F.col("_value").isNull(), F.col("value_text")), F.col("unit_text")))
    df = df.withColumn("_words", F.trim(F.regexp_replace(joined, r"(?U)\s+", " ")))
    words = F.col("_words")
    # a leading multiplier "x10^6" belongs to the unit
    df = df.withColumn("_power", F.regexp_extract(words, r"^x ?10\^?[0-9]+ ?[a-z]", 0) != "")
    # "pack of", "boxs of", "blisters x", "carton" in front of a count only say that counts multiply
    peeled = F.regexp_replace(words, rf"\b{CONTAINERS}\b\.?\s*(?:of|x|×|\*)?\s*", " x ")
    peeled = F.trim(F.regexp_replace(peeled, r"[×*]|(?<=[0-9 ])x(?= ?[0-9])", " x "))
    df = df.withColumn("_text", F.when(F.col("_power"), words).otherwise(peeled))
    text, power = F.col("_text"), F.col("_power")
    factors = F.regexp_extract_all(F.when(power, F.lit("")).otherwise(text), F.lit(rf"(?:^|[\s x])({NUM})(?=[^0-9.,^]|$)"), F.lit(1))
    unit_words = F.when(power, F.regexp_replace(text, r"^x ?10", "x10")).otherwise(
        F.regexp_replace(F.regexp_replace(text, rf"(?:^|(?<=[\s x])){NUM}", " "), r"^[\sx]+(?=[^0-9]|$)", "")
    )
    product = F.aggregate(F.transform(factors, number), F.lit(1).cast("decimal(38,12)"), lambda a, x: (a * x).cast("decimal(38,12)"))
    df = df.withColumns({"_key": tidy_unit(unit_words), "_product": product})
    df = df.withColumns({"common_unit": _lookup(0, F.col("_key")), "_factor": _lookup(1, F.col("_key")).cast("decimal(38,12)")})
    known = F.col("common_unit").isNotNull()
    amount = (F.coalesce(F.col("_value"), F.lit(1).cast("decimal(38,12)")) * F.col("_product")).cast("decimal(38,12)")
    df = df.withColumns({
        "amount": F.when(known, (amount * F.col("_factor")).cast("decimal(38,12)")),
        "raw_unit": F.when(known, F.concat_ws("|", "common_unit", F.col("_factor").cast("double").cast("string"))),
    })
    return df.drop("_product", "_factor", "_words", "_power", "_text")


#: Quantities that the model can learn from: a value and a readable unit.
LABELLED = "raw_unit is not null and _value is not null"


def _features(df: DataFrame) -> DataFrame:
    """Model inputs of a quantity: size, roundness, kind, source, form and the neighbouring unit."""
    size = F.log10(F.greatest(F.coalesce(F.col("_value").cast("double"), F.lit(1.0)), F.lit(1e-9)))
    whole = (F.col("_value") == F.floor(F.col("_value"))).cast("double")
    hashed = lambda c, n: F.pmod(F.xxhash64(F.coalesce(F.lower(c), F.lit(""))), F.lit(n)).cast("double")
    kinds = [(F.col("quantity") == q).cast("double").alias(f"f_{q}") for q in ("strength", "per", "pack")]
    words = [F.coalesce(F.lower(F.col("form")).contains(w).cast("double"), F.lit(0.0)).alias(f"f_{w}") for w in ("tablet", "capsule", "solution", "cream", "powder", "patch", "sachet", "injection")]
    return df.select(
        "*", size.alias("f_size"), F.coalesce(whole, F.lit(0.0)).alias("f_whole"), hashed(F.col("source"), 16).alias("f_source"),
        hashed(_lookup(0, tidy_unit(F.col("near_unit"))), 16).alias("f_near"), *kinds, *words,
    )


class UnitModel:
    """A random forest for the unit of a quantity, with its confidence calibrated by isotonic regression on held-out rows."""

    def __init__(self, forest, labels: list[str], calibration: list[float], columns: list[str], held_out_accuracy: float):
        self.forest, self.labels, self.calibration, self.columns, self.held_out_accuracy = forest, labels, calibration, columns, held_out_accuracy

    @classmethod
    def fit(cls, resolved: DataFrame, train_rows: int = TRAIN_ROWS) -> "UnitModel | None":
        """Fits on labelled quantities with a value; None where there are none.

        The sample is bounded by train_rows: tasks hand on only rows below a hash threshold set from the number of all
        labelled rows, so what reaches the driver is the same at every size of the input. A fourth of the products is
        held out for the calibration.
        """
        from pyspark.ml.classification import RandomForestClassifier
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array
        from pyspark.ml.regression import IsotonicRegression

        labelled = resolved.where(LABELLED)
        n = labelled.count()
        if not n:
            return None
        order = F.xxhash64("product_id", "presentation_no", "ingredient_no", "quantity")
        # 19 of 20 rows of the bound are aimed at, so that chance does not pass it
        below = HASH_STEPS if n <= train_rows else int(HASH_STEPS * 0.95 * train_rows / n)
        picked = labelled.where(F.pmod(order, F.lit(HASH_STEPS)) < below)
        held = F.pmod(F.xxhash64("product_id"), F.lit(4)) == 0
        columns = [c for c in _features(picked).columns if c.startswith("f_")]
        sample = _features(picked).select(*columns, "raw_unit", held.alias("held"), order.alias("order")).toPandas()
        sample = sample.sort_values(["order", *columns], ignore_index=True).head(train_rows)
        labels = sorted(sample["raw_unit"].unique())
        if len(labels) < 2:
            return cls(None, labels, [1.0], columns, 1.0) if labels else None
        part = sample[columns].astype(float).assign(label=sample["raw_unit"].map({u: float(i) for i, u in enumerate(labels)}), held=sample["held"])
        if part["held"].all() or not part["held"].any():  # too few products to hold any out
            part["held"] = part.index % 4 == 0
        base = VectorAssembler(inputCols=columns, outputCol="features").transform(resolved.sparkSession.createDataFrame(part).coalesce(1))
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=32, featureSubsetStrategy="sqrt").fit(base.where(~F.col("held")))
        scored = forest.transform(base.where("held")).select(F.array_max(vector_to_array("probability")).alias("p"), (F.col("prediction") == F.col("label")).cast("double").alias("hit"))
        fitted = IsotonicRegression(featuresCol="p", labelCol="hit").fit(scored)
        steps = np.interp(np.arange(CALIBRATION + 1) / CALIBRATION, fitted.boundaries.toArray(), fitted.predictions.toArray())
        accuracy = scored.agg(F.avg("hit")).first()[0]
        return cls(forest, labels, [round(float(x), 6) for x in steps], columns, float(accuracy or 0.0))

    def predict(self, open_rows: DataFrame) -> DataFrame:
        """open_rows with the predicted unit and factor (`predicted`) and the calibrated confidence in it."""
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array

        if self.forest is None:
            return open_rows.withColumns({"predicted": F.lit(self.labels[0]), "confidence": F.lit(1.0)})
        ready = VectorAssembler(inputCols=self.columns, outputCol="features").transform(_features(open_rows))
        scored = self.forest.transform(ready)
        names = F.array(*[F.lit(x) for x in self.labels])
        scored = scored.withColumns({"predicted": F.element_at(names, F.col("prediction").cast("int") + 1), "p": F.array_max(vector_to_array("probability"))})
        # one array of a fixed number of steps: the plan does not grow with the fit, and a step's lower end never overrates
        steps = F.expr(f"array({', '.join(f'{x}D' for x in self.calibration)})")
        confidence = F.element_at(steps, F.floor(F.least(F.col("p"), F.lit(1.0)) * CALIBRATION).cast("int") + 1)
        return scored.withColumn("confidence", confidence).select(*open_rows.columns, "predicted", "confidence")


def converted(products: DataFrame, confident: float = CONFIDENT, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Every quantity in its common unit, with `how` = recorded, read or predicted, or `review` (amount null).

    The JSON is opened once and its quantities are written to the checkpoint folder; a model is fitted only where a
    quantity has no readable unit.
    """
    resolved = cut(resolve(recorded(products)))
    exact = F.col("value_is_number") & (F.col("unit_text") == F.col("common_unit"))
    readable = resolved.where(F.col("common_unit").isNotNull()).withColumns(
        {"how": F.when(exact, F.lit("recorded")).otherwise(F.lit("read")), "confidence": F.lit(1.0)}
    )
    unread = resolved.where(F.col("common_unit").isNull())
    keep = ["product_id", "presentation_no", "ingredient_no", "quantity", "value_text", "unit_text", "common_unit", "amount", "how", "confidence"]
    if unread.isEmpty():
        return readable.select(keep)
    model = UnitModel.fit(resolved, train_rows)
    if model is None:
        return readable.unionByName(unread.withColumns({"how": F.lit("review"), "confidence": F.lit(0.0)})).select(keep)
    guessed = model.predict(unread)
    sure = (F.col("confidence") >= confident) & F.col("_value").isNotNull() & (F.coalesce(F.col("_key"), F.lit("")) == "")
    factor = F.element_at(F.split("predicted", r"\|"), 2).cast("decimal(38,12)")
    guessed = guessed.withColumns(
        {
            "common_unit": F.when(sure, F.element_at(F.split("predicted", r"\|"), 1)),
            "amount": F.when(sure, (F.col("_value") * factor).cast("decimal(38,12)")),
            "how": F.when(sure, F.lit("predicted")).otherwise(F.lit("review")),
        }
    )
    return readable.select(keep).unionByName(guessed.select(keep))


def hidden(products: DataFrame, confident: float = CONFIDENT, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(product_id, presentation_no, ingredient_no, quantity, written, predicted, confidence, how, right) of every quantity
    with a value and a readable unit, that unit hidden from the model: what the model is worth on these tables.

    written and predicted are `unit|factor` to the common unit; how is `predicted` from the confidence asked for, else
    `review`. Where a confident prediction is not right, the written unit is a candidate for review itself. The rows of
    the training sample (TRAIN_ROWS at most) are among them.
    """
    resolved = cut(resolve(recorded(products)))
    model = UnitModel.fit(resolved, train_rows)
    rows = resolved.where(LABELLED)
    if model is None:
        rows = rows.withColumns({"predicted": F.lit(None).cast("string"), "confidence": F.lit(0.0)})
    else:
        rows = model.predict(rows)
    return rows.select(
        "product_id", F.col("presentation_no").cast("long").alias("presentation_no"), F.col("ingredient_no").cast("long").alias("ingredient_no"), "quantity", F.col("raw_unit").alias("written"), "predicted", "confidence",
        F.when(F.col("confidence") >= confident, F.lit("predicted")).otherwise(F.lit("review")).alias("how"), (F.col("predicted") == F.col("raw_unit")).alias("right"),
    )


def found(products: DataFrame) -> DataFrame:
    """The quantities not already recorded as a number in the common unit, converted; those for review are left out."""
    return (
        converted(products)
        .where(F.col("how").isin("read", "predicted"))
        .select("product_id", "presentation_no", "ingredient_no", "quantity", "common_unit", F.round(F.col("amount") * 1000, 0).cast("long").alias("milli_value"))
    )
