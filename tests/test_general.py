"""The general data problems: unit conversion, schema drift, nested records."""

import json

import pytest
from pyspark.sql import functions as F

from quillstone.operators import drift, nested, quantities

PRODUCT = "id string, regulator string, product_data string, json_data string, field string, quantity string, kind string"


def products(spark, *rows):
    return spark.createDataFrame([(i, "TGA", d if d is None or isinstance(d, str) else json.dumps(d), j if j is None or isinstance(j, str) else json.dumps(j), "x", "y", "z") for i, d, j in rows], PRODUCT)


# ---- quantities


def presentation(value=None, unit=None, per=(None, None), pack=(None, None), **more):
    return {"per_value": per[0], "per_unit": per[1], "pack_size": pack[0], "pack_unit": pack[1], "form": "tablet", "active_ingredients": [{"substance": "a", "strength_value": value, "strength_unit": unit}], **more}


@pytest.mark.parametrize(
    "value, unit, want",
    [
        (75, "mg", None), ("75", "mg", ("mg", 75000)), (None, "9.5 MG", ("mg", 9500)), ("0,25", "g", ("mg", 250000)), ("1,500", "mg", ("mg", 1500000)), ("2,5", "mg", ("mg", 2500)),
        ("1,000,000", "mcg", ("mg", 1000000)), (5, "%", ("mg", 50000)), (5, "% w/v", ("mg", 50000)), (1, "x10^6 IU", ("IU", 1000000000)), (5, "thousand units", ("IU", 5000000)), (None, "5,000IU", ("IU", 5000000)),
        (2, "mol", ("mmol", 2000000)), (20000, "µmol", ("mmol", 20000)), (25000, "ng", ("mg", 25)), (1, "parsec", None), (None, None, None), (True, "mg", ("mg", 1000)), ("", "mg", ("mg", 1000)),
    ],
)
def test_strength_units(spark, value, unit, want):
    df = quantities.resolve(quantities.recorded(products(spark, ("p", {"presentations": [presentation(value, unit)]}, None))))
    rows = [r for r in df.collect() if r["common_unit"] and not (r["value_is_number"] and r["unit_text"] == r["common_unit"])]
    got = [(r["common_unit"], round(r["amount"] * 1000)) for r in rows]
    assert got == ([want] if want else [])


@pytest.mark.parametrize(
    "size, unit, want",
    [
        (3, "blister of 10 tablets", ("tablet", 30)), (3, "boxs x 9 VIAL", ("vial", 27)), (None, "2 x 10 vials", ("vial", 20)), (None, "pack of 28 capsules", ("capsule", 28)), (None, "9 cartons of 10 patches", ("patch", 90)),
        (None, "28TAB", ("tablet", 28)), ("20", "patch(es)", ("patch", 20)), (30, "g", ("mg", 30000)), (None, "0.5 L", ("mL", 500)), (None, "vial", ("vial", 1)),
    ],
)
def test_packs(spark, size, unit, want):
    df = quantities.resolve(quantities.recorded(products(spark, ("p", {"presentations": presentation(pack=(size, unit))}, None))))
    assert [(r["common_unit"], float(r["amount"])) for r in df.where("quantity = 'pack'").collect()] == [(want[0], float(want[1]))]


def test_off_contract_and_broken_documents(spark):
    p = presentation("5", "mg")
    lone = {"presentations": {**p, "active_ingredients": json.dumps(p["active_ingredients"])}}
    df = products(spark, ("lone", lone, None), ("text", {"presentations": json.dumps([p])}, None), ("null", None, None), ("empty", "{}", None), ("broken", "{oops", None), ("odd", "[1, 2]", None), ("nothing", {"presentations": [None, 3]}, None))
    found = quantities.found(df)
    assert sorted((r["product_id"], r["presentation_no"], r["ingredient_no"], r["milli_value"]) for r in found.collect()) == [("lone", 0, 0, 5000), ("text", 0, 0, 5000)]
    assert found.columns == ["product_id", "presentation_no", "ingredient_no", "quantity", "common_unit", "milli_value"]


def test_missing_units_are_predicted_or_reviewed(spark):
    rows = [(f"p{i}", {"presentations": [presentation(100 + i % 50, "mg", form="tablet"), presentation(100_000 + i, "IU", form="injection")]}, None) for i in range(300)]
    open_ = [(f"q{i}", {"presentations": [presentation(110 + i, None, form="tablet"), presentation(100_100 + i, None, form="injection")]}, None) for i in range(20)]
    out = quantities.converted(products(spark, *rows, *open_, ("q99", {"presentations": [presentation("some", None)]}, None)))
    got = out.where("product_id like 'q%'").collect()
    assert {r["how"] for r in got if r["product_id"] != "q99"} == {"predicted"}
    right = [r["common_unit"] == ("mg" if r["presentation_no"] == 0 else "IU") for r in got if r["product_id"] != "q99"]
    assert sum(right) / len(right) > 0.95
    assert [r["how"] for r in got if r["product_id"] == "q99"] == ["review"]
    model = quantities.UnitModel.fit(quantities.resolve(quantities.recorded(products(spark, *rows))))
    assert model.held_out_accuracy > 0.95


def test_no_products(spark):
    assert quantities.found(products(spark).limit(0)).count() == 0


# ---- nested records


def brute_nodes(value, contract, path="", parent="", inside=""):
    out = []
    if isinstance(value, dict):
        for k, v in value.items():
            if k in contract and contract[k] == inside and v is not None:
                v = nested.as_contract_array(v)
            out += brute_nodes(v, contract, f"{path}.{k}" if path else k, parent, k)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            here = f"{path}[{i}]"
            if isinstance(v, dict):
                out += [(here, parent)] + brute_nodes(v, contract, here, here, inside)
            else:
                out += brute_nodes(v, contract, here, parent, inside)
    return out


DEEP = {"a": {"b": [{"c": [{"d": 1}, {}, "s", [{"e": 2}]]}, None]}, "presentations": {"active_ingredients": '[{"x": 1}, {"x": 2}]'}, "excipients": None, "indications": '{"condition": "q"}', "key_risks": ["r"], "other": {"indications": {"n": 1}}}


def test_nodes_against_brute_force(spark):
    df = products(spark, ("1", DEEP, DEEP), ("2", None, "{broken"), ("3", "{}", "[]"), ("4", json.dumps(json.dumps(DEEP)), None))
    got = sorted(tuple(r) for r in nested.found(df).collect())
    want = []
    for pid, fields in (("1", ("json_data", "product_data")), ("4", ("product_data",))):
        for field in fields:
            want += [(pid, field, *n) for n in brute_nodes(DEEP, nested.CONTRACT_ARRAYS if field == "product_data" else {})]
    assert got == sorted(want) and ("1", "product_data", "presentations[0].active_ingredients[1]", "presentations[0]") in got


def test_child_tables_keep_links_and_values(spark):
    triples = nested.product_triples(products(spark, ("1", {"presentations": [presentation(5, "mg", form="tablet"), presentation(6, "g", form="gel")]}, None)))
    rows = nested.child_table(triples, "product_data", "presentations[].active_ingredients[]", ["strength_value", "strength_unit", "absent"]).orderBy("node_path").collect()
    assert [(r["parent_path"], r["ordinal"], r["strength_value"], r["strength_unit"], r["absent"]) for r in rows] == [("presentations[0]", 0, "5", "mg", None), ("presentations[1]", 0, "6", "g", None)]
    assert nested.discover_keys(triples, "product_data", "presentations[]") == ["form", "pack_size", "pack_unit", "per_unit", "per_value"]


def test_values_of_every_pattern_are_in_a_registered_query(spark, tmp_path):
    import __spark_entry__

    data = {"indications": [{"condition": "q", "line": {"no": 2}}], "presentations": [{"unlisted": "u", "active_ingredients": [{"extra": 1}]}], "note": None}
    products(spark, ("1", data, {"findings": [{"at": [{"text": "t"}, {"codes": [1, 2]}]}]}), ("2", None, "{broken")).write.parquet(str(tmp_path / "products.parquet"))
    got = {tuple(r) for r in __spark_entry__.queries()["p7_values"](spark, str(tmp_path)).select("product_id", "field", "pattern", "node_path", "ordinal", "key", "type", "value").collect()}
    d, j = ("1", "product_data"), ("1", "json_data")
    assert got == {
        (*d, "indications[]", "indications[0]", 0, "condition", "string", "q"), (*d, "indications[]", "indications[0]", 0, "line.no", "number", "2"), (*d, "", "", 0, "note", "null", None),
        (*d, "presentations[]", "presentations[0]", 0, "unlisted", "string", "u"), (*d, "presentations[].active_ingredients[]", "presentations[0].active_ingredients[0]", 0, "extra", "number", "1"),
        (*j, "findings[].at[]", "findings[0].at[0]", 0, "text", "string", "t"), (*j, "findings[].at[]", "findings[0].at[1]", 1, "codes", "array", "[1, 2]"),
    }


def test_depth_is_not_limited_by_recursion():
    value = {"v": 1}
    for _ in range(5000):
        value = {"k": [value]}
    assert sum(t[0] == nested.NODE for t in nested.triples_of(value, None)) == 5000


# ---- drift


def records(spark, *files):
    rows = [(i, "eu-feed-001", seq, r if r is None or isinstance(r, str) else json.dumps(r), "x") for i, (seq, r) in enumerate((s, r) for s, rs in files for r in rs)]
    return spark.createDataFrame(rows, "id int, feed string, file_seq int, json_data string, path string")


def test_each_kind_of_change(spark):
    names = ["Abacavir tablets", "Zinc oral solution", "Talc cream 5 mg", "Nasal spray 2 mL"]
    one = [{"name": n, "n": i, "holder": {"label": n}, "docs": [{"kind": "a"}], "gone": True, "same": None} for i, n in enumerate(names)]
    two = [{"title": n, "n": str(i), "holder": n, "docs": [{"kind": "a", "page": 3}], "price": {"amount": 3, "currency": "EUR"}, "same": 1} for i, n in enumerate(names)]
    got = sorted(tuple(r) for r in drift.found(records(spark, (1, one), (2, two + two[:1]), (3, two))).collect())
    assert got == sorted([
        ("eu-feed-001", 2, "added", "docs[].page", ""), ("eu-feed-001", 2, "added", "price", ""), ("eu-feed-001", 2, "removed", "gone", ""),
        ("eu-feed-001", 2, "renamed", "name", "title"), ("eu-feed-001", 2, "type_changed", "holder", ""), ("eu-feed-001", 2, "type_changed", "n", ""),
    ])


def test_presence_needs_one_record_and_files_follow_each_other(spark):
    got = drift.found(records(spark, (1, [{"a": 1}, None, "{broken", ""]), (2, [{"a": 1, "b": None}]), (4, [{"z": 1}]), (None, [{"y": 1}]))).collect()
    assert [tuple(r) for r in got] == [("eu-feed-001", 2, "added", "b", "")]
    assert drift.found(records(spark, (1, [{"a": 1}])).limit(0)).count() == 0


def test_unified_table_follows_renamings(spark):
    names = ["Abacavir tablets", "Zinc oral solution", "Talc cream 5 mg", "Nasal spray 2 mL"]
    df = records(spark, (1, [{"name": n} for n in names]), (2, [{"title": n} for n in names]), (3, [{"title": [n]} for n in names]))
    out = drift.unify(df)
    assert {(r["file_seq"], r["original_path"], r["path"], r["type"]) for r in out.collect()} == {(1, "name", "name", "string"), (2, "title", "name", "string"), (3, "title", "name", "array")}
    assert set(out.where("file_seq = 3").select("value").toPandas()["value"]) == set(names)
    assert all((r["as_array"] == [r["value"]]) if r["type"] == "array" else (r["as_string"] == r["value"] and r["as_array"] is None) for r in out.collect())
    fused = {r["path"]: (r["alternatives"], r["canonical"]) for r in drift.fused_schema(df).collect()}
    assert fused == {"name": (["string"], "string"), "title": (["array", "string"], "string")}


def test_unified_table_reconciles_nested_paths(spark):
    names = ["Abacavir tablets", "Zinc oral solution", "Talc cream 5 mg", "Nasal spray 2 mL"]
    product = lambda k, n: {"p": [{k: n, "no": 1}, {k: n, "no": 2}]}
    one, two = [{"top": product("state", n)} for n in names], [{"top": product("status", n)} for n in names]
    three = [{"head": product("status", n)} for n in names]
    changed = spark.createDataFrame([("eu-feed-001", 2, "renamed", "top.p[].state", "top.p[].status"), ("eu-feed-001", 3, "renamed", "top", "head")], drift.CHANGES)
    df = records(spark, (1, one), (2, two), (3, three))
    for out in (drift.unify(df, changed), drift.unify(df)):
        rows = out.where("type = 'string'").collect()
        assert {(r["file_seq"], r["original_path"], r["path"]) for r in rows} == {(1, "top.p[].state", "top.p[].state"), (2, "top.p[].status", "top.p[].state"), (3, "head.p[].status", "top.p[].state")}
        assert sorted(tuple(r["ordinals"]) for r in rows) == [(0,)] * 12 + [(1,)] * 12 and {r["as_string"] for r in rows} == set(names)
        assert {r["path"] for r in out.collect()} == {"top", "top.p", "top.p[].state", "top.p[].no"}


def test_paths_of_odd_arrays():
    root = {"a": [[{"b": 1}], 2, None, {}], "c": {}, "d": [], "e": [[1], 2], "f": None}
    got = sorted(drift.paths_of(root, {"a": "z", "e": "y"}))
    assert got == sorted([
        ("a", "z", [], "array", '[[{"b": 1}], 2, null, {}]'), ("a[].b", "z[].b", [0, 0], "number", "1"), ("a[]", "z[]", [1], "number", "2"), ("a[]", "z[]", [3], "object", "{}"),
        ("c", "c", [], "object", "{}"), ("d", "d", [], "array", "[]"), ("e", "y", [], "array", "[[1], 2]"),
    ])
