"""Golden values of the register mappers."""

import json

import pytest
from pyspark.sql import functions as F

from quillstone.functions.mappers import au, common, sa, us


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "name, base, salt",
    [
        ("ABACAVIR SULFATE", "Abacavir", "Abacavir sulfate"),
        ("HYDROCORTISONE SODIUM SUCCINATE", "Hydrocortisone", "Hydrocortisone sodium succinate"),
        ("GADOFOSVESET TRISODIUM", "Gadofosveset", "Gadofosveset trisodium"),
        ("LAMIVUDINE", "Lamivudine", None),
        ("GONADOTROPIN, CHORIONIC", "Chorionic gonadotropin", None),
        ("SODIUM CHLORIDE", "Sodium chloride", None),
        ("ONDANSETRON HYDROCHLORIDE DIHYDRATE", "Ondansetron", "Ondansetron hydrochloride dihydrate"),
        (None, None, None),
        ("", None, None),
    ],
)
def test_base_substance(spark, name, base, salt):
    got = one(spark, common.base_substance(F.lit(name).cast("string")))
    assert (got["base"], got["salt"]) == (base, salt)


@pytest.mark.parametrize(
    "text, want",
    [
        ("500MG", (500, "mg", None, None)),
        ("0.5MG", (0.5, "mg", None, None)),
        ("10,000 UNITS/VIAL", (10000, "units", None, "vial")),
        ("EQ 600MG BASE", (600, "mg", None, None)),
        ("EQ 1GM BASE/VIAL", (1, "g", None, "vial")),
        ("5MG/ML", (5, "mg", 1, "mL")),
        ("2440MG/10ML (244MG/ML)", (2440, "mg", 10, "mL")),
        ("10%", (10, "%", None, None)),
        ("100MG **Federal Register determination**", (100, "mg", None, None)),
        ("N/A", (None, None, None, None)),
        (None, (None, None, None, None)),
    ],
)
def test_strength(spark, text, want):
    assert tuple(one(spark, common.parse_strength(F.lit(text).cast("string")))) == want


@pytest.mark.parametrize(
    "text, form, route",
    [
        ("TABLET, DELAYED RELEASE;ORAL", "tablet, delayed release", "oral"),
        ("TABLET;BUCCAL, SUBLINGUAL", "tablet", "buccal, sublingual"),
        ("TABLET", "tablet", None),
        ("VIAL;SINGLE-USE", "vial", None),
    ],
)
def test_form_route(spark, text, form, route):
    product = F.from_json(F.lit(json.dumps({"dosage_form_route": text})), "dosage_form_route string, dosage_form string, route string")
    assert tuple(one(spark, us.form_route(product))) == (form, route)


@pytest.mark.parametrize("text, iso", [("03/28/2017", "2017-03-28"), ("1956-03-09", "1956-03-09"), ("20180201", "2018-02-01"), ("", None), ("13/45/2017", None)])
def test_dates(spark, text, iso):
    got = one(spark, common.iso_date(F.lit(text)))
    assert (str(got) if got else None) == iso


@pytest.mark.parametrize(
    "name, code, want",
    [("Abacavir", "ANDA", "small_molecule"), ("Something novel", "BLA", "biologic"), ("Disitamab vedotin", "BLA", "adc"), ("Insulin glargine", "NDA", "peptide"), ("Chorionic gonadotropin", "NDA", "biologic")],
)
def test_modality(spark, name, code, want):
    rule = common.modality(F.array(F.lit(name)), proteins=common.PROTEINS, conjugates=True, fallback=F.when(F.lit(code) == "BLA", F.lit("biologic")).otherwise(F.lit("small_molecule")))
    assert one(spark, rule) == want


def mapped(spark, module, record, letter=None):
    df = spark.createDataFrame([(json.dumps(record) if record is not None else None, letter)], "json_data string, letter string")
    row = (module.extract(df, text_column="letter") if module is us else module.extract(df)).first()
    return row, json.loads(row["product_data"]) if row["product_data"] else None


US = {
    "application_number": "N021652", "application_type_code": "ANDA", "company": "ACME ",
    "products": [
        {"drug_name": "EPZI", "strength": "EQ 600MG BASE;300MG", "dosage_form_route": "TABLET;ORAL", "active_ingredients": "ABACAVIR SULFATE; LAMIVUDINE", "marketing_status": "Prescription"},
        {"drug_name": "EPZI", "strength": "EQ 600MG BASE;300MG", "dosage_form_route": "TABLET;ORAL", "active_ingredients": "ABACAVIR SULFATE; LAMIVUDINE"},
    ],
    "spl_labels": [
        {"effective_time": "20180201", "indications_and_usage": ["1 INDICATIONS Epzi is indicated for the treatment of infection in adults. It helps."], "boxed_warning": ["HYPERSENSITIVITY REACTIONS may occur"]},
        {"effective_time": "20160101", "indications_and_usage": ["old"], "description": ["Inactive ingredients: povidone, talc and maize starch."]},
    ],
}


def test_us_combination_and_sections(spark):
    row, data = mapped(spark, us, US)
    assert len(data["presentations"]) == 1
    assert [(i["substance"], i["strength_value"], i["salt"] and i["salt"]["substance"]) for i in data["presentations"][0]["active_ingredients"]] == [("Abacavir", 600, "Abacavir sulfate"), ("Lamivudine", 300, None)]
    assert data["indications"][0]["condition"] == "Epzi is indicated for the treatment of infection in adults."
    assert data["indications"][0]["population"] == "adults"
    assert data["key_risks"] == ["Hypersensitivity Reactions"]
    assert [e["name"] for e in data["excipients"]] == ["Povidone", "Talc", "Maize starch"]
    assert str(row["columns"]["label_revision_date"]) == "2018-02-01" and row["columns"]["status"] == "Active"


@pytest.mark.parametrize(
    "entry",
    [
        {"submission": "ORIG-1", "action_date": "03/28/2017", "action_type": "Approval", "review_priority_orphan_status": "PRIORITY", "submission_classification": "Type 2"},
        {"submission_type": "ORIG", "submission_number": "1", "submission_status": "AP", "submission_status_date": "2017-03-28", "review_priority": "PRIORITY", "submission_class_description": "Type 2"},
    ],
)
def test_us_history_shapes(spark, entry):
    row, data = mapped(spark, us, {"application_type_code": "NDA", "approval_history": {"original_approvals": [entry]}})
    assert str(row["columns"]["approval_date"]) == "2017-03-28" and data["approval"]["priority_review"] is True


def test_us_unknown_priority_is_unstated(spark):
    _, data = mapped(spark, us, {"application_type_code": "NDA", "approval_history": {"original_approvals": [{"submission_type": "ORIG", "submission_status": "AP", "submission_status_date": "1956-03-09", "review_priority": "UNKNOWN"}]}})
    assert data["approval"]["priority_review"] is None


def test_us_letter(spark):
    _, data = mapped(spark, us, {"application_type_code": "NDA"}, "submitted under section 505(b)(2) of the Act")
    assert data["approval"]["pathway"] == "hybrid"
    letter = "the reference listed drug (RLD) upon which you have based your ANDA, Epzicom Tablets, 600 mg (base)/300 mg of VIIV Healthcare Company, is subject to periods"
    _, data = mapped(spark, us, {"application_type_code": "ANDA"}, letter)
    assert data["approval"]["reference_product"] == "Epzicom Tablets, 600 mg (base)/300 mg"


@pytest.mark.parametrize("record", [{}, None])
def test_us_empty(spark, record):
    _, data = mapped(spark, us, record)
    assert set(data) == {"_schema_version", "substance", "presentations", "indications", "approval", "pivotal_evidence", "key_risks", "excipients"} and data["presentations"] == []


def test_sa(spark):
    record = {
        "registration_number": "12-34-20", "trade_name": "Sod", "scientific_name": "TRI SODIUM CITRATE, paracetamol", "strength": "5,,", "strength_unit": "mg", "pharmaceutical_form": "Tablet",
        "administration_route": "Parenteral use", "drug_type": "Generic", "authorization_status": "Valid", "register_year": "2020", "atc_code_1": "N02BE01",
        "manufacturers": [{"name": "A", "country": "US"}, {"name": "a", "country": "FR"}, {"name": "B", "country": None}],
    }
    row, data = mapped(spark, sa, record)
    c = row["columns"]
    assert (c["manufacturer"], c["manufacturer_address"], c["status"], c["therapeutic_areas"], c["routes"]) == ("A; B", "US; ", "Active", ["Pain Management"], ["parenteral"])
    assert [(i["substance"], i["strength_value"]) for i in data["presentations"][0]["active_ingredients"]] == [("Trisodium citrate", 5), ("Paracetamol", None)]
    assert c["strengths"] == ["5 mg"] and data["approval"]["registration_year"] == 2020 and data["approval"]["pathway"] == "generic"


def test_au(spark):
    record = {
        "artg_id": "123", "artg_category": "Listed", "product_name": "Milk thistle", "start_date": "2021-01-04",
        "components": [{
            "active_ingredients": "Silybum marianum, Quantity: 140 mg (Equivalent: Silybum marianum, Qty 4.9 g; Equivalent: x, Qty 1 g); zinc, Quantity: 10 billion CFU",
            "excipient_ingredients": "talc; TALC; water", "dosage_form": "Tablet", "pack_size": "14 tablets, 56 tablets, 14 tablets, 2mL x 2, 30", "indications": "For a ;\nFor b ;\nfor A ;",
        }],
    }
    row, data = mapped(spark, au, record)
    assert [(p["pack_size"], p["pack_unit"]) for p in data["presentations"]] == [(14, "tablet"), (56, "tablet"), (30, None)]
    assert [(i["substance"], i["strength_value"], i["strength_unit"]) for i in data["presentations"][0]["active_ingredients"]] == [("Silybum marianum", 140, "mg"), ("Zinc", 10, "billion CFU")]
    assert row["columns"]["indications"] == ["For a", "For b"] and [e["name"] for e in data["excipients"]] == ["Talc", "Water"]
    assert data["substance"]["modality"] == "small_molecule"


def test_au_other_shape(spark):
    row, data = mapped(spark, au, {"pbs_code": "1234A"})
    assert row["error"].startswith("benefits-scheme") and data is None
    row, _ = mapped(spark, au, {})
    assert row["error"] == "no register id"


def test_pack_sizes_plural_needs_a_word(spark):
    assert [tuple(p) for p in one(spark, au.pack_sizes(F.lit("56s, box of 5, pack of 12, 28 patches, 3 vials")))] == [(12.0, None), (3.0, "vial")]


RECORDS = {
    "sa": {"drug_type": "NCE", "trade_name": "Omfrem", "scientific_name": "X", "register_year": "1999", "authorization_status": "Valid"},
    "au": {"artg_id": "7", "product_name": "Omfrem", "artg_category": "Registered", "start_date": "2001-02-03", "effective_date": "2010-05-06T00:00:00", "components": [{"active_ingredients": "X"}]},
    "us": {"application_number": "NDA1", "application_type_code": "NDA", "products": [{"drug_name": "Omfrem", "marketing_status": "Prescription"}], "approval_history": {"original_approvals": [{"submission": "ORIG-1", "action_date": "2001-02-03"}]}},
}


@pytest.mark.parametrize("register", ["sa", "au", "us"])
def test_every_mapper_fills_all_columns_and_says_how(spark, register):
    import importlib

    module = importlib.import_module(f"quillstone.functions.mappers.{register}")
    df = spark.createDataFrame([(json.dumps(RECORDS[register]),), (None,)], "json_data string")
    row, nothing = module.extract(df).select("columns", "provenance").collect()
    assert row["columns"].__fields__ == list(common.FLAT) and len(common.FLAT) == 30
    assert row["columns"]["brand_name"] == "Omfrem" and row["columns"]["source_language"] == "en" and row["columns"]["symptoms"] == [] and row["columns"]["expiry_date"] is None
    dates = {str(row["columns"][c]) for c in ("registration_date", "approval_date", "market_authorization_date")}
    assert dates == ({"None"} if register == "sa" else {"2001-02-03"})
    assert register != "sa" or row["columns"]["product_type"] == "New Chemical Entity" and row["provenance"]["approval.registration_year"] == "mapped"
    assert row["provenance"]["presentations"] == "mapped" and set(row["provenance"].values()) <= {"mapped", "rule", "read", "absent"}
    assert nothing["columns"] is None or nothing["columns"]["brand_name"] is None


def test_key_risks(spark):
    rows = [("WARNING: LIVER TOXICITY AND/OR DEATH", "5.1 Hypersensitivity Reactions Patients may react. 5.2 Liver Toxicity 5.3 Use In Pregnancy", None), (None, None, None), ("", "9.9 Pain", "x" * 50_000)]
    df = spark.createDataFrame(rows, "b string, w string, o string")
    got = [r[0] for r in df.select(us.key_risks(F.col("b"), F.col("w"), F.col("o"))).collect()]
    assert got == [["Liver Toxicity And/Or Death", "Hypersensitivity Reactions", "Use In Pregnancy"], [], []]
