"""Promotion, table operators, folds, repair checks, documents, increments and providers on small fixtures."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillstone.functions import jsonx, text
from quillstone.operators import fold, promote, repair, tables
from quillstone.plans import pipeline, providers
from quillstone.sources import documents as docs
from quillstone.sources.catalog import Catalog, MissingTableError
from quillstone.sources.snapshot import Snapshots
from quillstone.streaming import incremental


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# ---- text


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab .!?\n\t", max_size=120), min_size=1, max_size=6))
def test_chunks_cover_the_text(spark, parts):
    source = "\n\n".join(parts)
    row = spark.createDataFrame([(source,)], "t string").select(text.normalize(F.col("t")).alias("n"), text.plain_chunks(F.col("t"), 10).alias("c"), text.normalize(text.normalize(F.col("t"))).alias("nn")).first()
    assert row["n"] == row["nn"]
    assert "".join("".join(row["c"]).split()) == "".join(row["n"].split())
    assert (row["c"] == []) == (row["n"] == "")


def test_chunks_edges(spark):
    assert one(spark, text.chunks(F.lit(None).cast("string"))) == [] and one(spark, text.chunks(F.lit("  \r\n "))) == []
    got = one(spark, text.chunks(F.lit("a" * 40 + "\n\n" + "b" * 40), 10, 0.15))
    assert got == ["a" * 40, "aaaa\n\n" + "b" * 40]


def test_section(spark):
    whole = "see ANNEX I\nAnnex I reference\n# **ANNEX III**\n# A. LABELLING\nbody Annex I body\nANNEX IV\nrest"
    assert one(spark, text.labelling_section(F.lit(whole))) == "A. LABELLING\nbody Annex I body"
    assert one(spark, text.labelling_section(F.lit("ANNEX III only this " + "x" * 200_000))).startswith("ANNEX III only")
    assert one(spark, text.labelling_section(F.lit("Annex III in title case"))) is None
    assert one(spark, text.section_or_full(F.lit("plain"), F.lit("European Union"))) == "plain"


def test_small_text_functions(spark):
    assert one(spark, text.split_top_level(F.lit("a (b; c); d;; (e")) ) == ["a (b; c)", "d", "(e"]
    assert one(spark, text.distinct_ci(F.array(F.lit(" A "), F.lit("a"), F.lit(None), F.lit(""), F.lit("b")))) == ["A", "b"]
    assert one(spark, text.batches(F.array(*[F.lit(x) for x in "abcde"]), 2)) == [["a", "b"], ["c", "d"], ["e"]]
    assert [one(spark, text.duration(F.lit(x).cast("double"))) for x in (42, 187, 3720, None)] == ["42s", "3m07s", "1h02m", "?"]
    assert [one(spark, text.is_identifier(F.lit(x).cast("string"))) for x in ("PL 1/2", "Old Medicine", "", None)] == [True, False, False, False]
    assert one(spark, text.split_oversized(F.lit("x" * 50), F.lit("H"), 5)) == ["x" * 20, "H\n" + "x" * 20, "H\n" + "x" * 10]


# ---- JSON


@pytest.mark.parametrize(
    "reply, want",
    [
        ('{"a": 1}', {"a": 1}), ('Sure:\n```json\n{"a": [1, 2,],}\n```', {"a": [1, 2]}), ('{"a": "x\ny"}', {"a": "x\ny"}), ('{"a": [{"b": 1}, {"b": 2', {"a": [{"b": 1}]}), ('{"a": [1, 2', {"a": [1, 2]}),
        ('{"a": 1, "b":', {"a": 1, "b": None}), ('{"a": "cut of', {"a": "cut of"}), ("no json", None), ("", None), (None, None),
    ],
)
def test_replies(spark, reply, want):
    got = spark.createDataFrame([(reply,)], "r string").select(jsonx.parse_reply(F.col("r")).alias("x")).first()["x"]
    assert (json.loads(got) if got else None) == want


def test_registration_number(spark):
    cases = [({"detail": {"registration_number": "D 1"}, "artg_id": "2"}, "D 1"), ({"registration_number": "Old Medicine", "artg_id": 7}, "7"), ({"registration_number": " "}, None), ({}, None), (None, None)]
    for record, want in cases:
        assert one(spark, jsonx.registration_number(F.lit(json.dumps(record) if record is not None else None).cast("string"))) == want


def test_json_units(spark):
    df = spark.createDataFrame([("1", json.dumps({"a": 1, "b": {"c": "x", "d": []}, "l": ["y" * 60] * 3})), ("2", "{}"), ("3", None), ("4", '{"a": null}')], "id string, j string")
    got = [(r["id"], r["seq"], r["unit"].splitlines()[0]) for r in jsonx.json_units(df, "id", "j", 20).orderBy("id", "seq").collect()]
    assert [g[:2] for g in got] == [("1", 0), ("1", 1), ("1", 2), ("1", 3), ("4", 0)] and got[3][2].endswith("l (items 3-3 of 3):")


# ---- promotion and tables


def test_geography_takes_the_whole_match(spark):
    countries = spark.createDataFrame([(1, " germany ", "de"), (2, None, "XK"), (3, "Spain", None), (4, "Nowhere", "QQ"), (5, "", "")], "id int, name string, code string")
    geography = spark.createDataFrame([(7, "Germany", "DE", "B"), (3, "Germany", "DE", "A"), (4, "Kosovo", "XK", None), (9, "Spain ", "ES", "C"), (1, "Kosovo", None, "K")], "id int, country_name string, country_code string, agency_acronym string")
    got = {r["country_id"]: (r["geography_id"], r["agency"]) for r in promote.resolve_geography(countries, geography).collect()}
    assert got == {1: (3, "A"), 2: (4, None), 3: (9, "C"), 4: (None, None), 5: (None, None)}


def test_insert_ignores_conflicts(spark):
    schema = "id string, raw_record_id int, country_id int, registration_number string"
    rows = spark.createDataFrame([("a", 1, 1, "N1"), ("b", 2, 1, "N1"), ("c", 3, 1, None), ("d", 4, 1, None), ("e", 5, 1, "N9"), ("f", 6, None, "N1")], schema)
    there = spark.createDataFrame([("z", 9, 1, "N9"), ("y", None, 1, None)], schema)
    assert sorted(r["id"] for r in promote.insert_new(rows, there).collect()) == ["a", "c", "d", "f"]


def test_guarded_updates(spark):
    df = spark.createDataFrame([("a", 1, "N1"), ("b", 1, None), ("c", 1, None), ("d", None, None), ("e", None, "N1")], "id string, country_id int, n string")
    want = spark.createDataFrame([("b", "N1"), ("c", "N2"), ("a", "N1"), ("d", "N1")], "id string, n string")
    got = {r["id"]: r["n"] for r in tables.guard_unique(df, want, "id", "country_id", "n").collect()}
    assert got == {"a": "N1", "b": None, "c": "N2", "d": None}
    twice = spark.createDataFrame([("b", "N5"), ("c", "N5")], "id string, n string")
    assert {r["id"]: r["n"] for r in tables.guard_unique(df, twice, "id", "country_id", "n").collect()} == {"b": "N5", "c": None}
    updated = tables.update(df, spark.createDataFrame([("b", "N7"), ("c", None)], "id string, n string"), "id", ["n"])
    assert {r["id"]: r["n"] for r in updated.collect()}["b"] == "N7"


def test_differences(spark):
    a = spark.createDataFrame([(1, "x", ["p", "q"]), (2, None, None)], "id int, v string, s array<string>")
    b = spark.createDataFrame([(1, "y", ["q", "r"]), (3, "z", ["t"])], "id int, v string, s array<string>")
    cells = {(r["id"], r["column_name"]): (r["left_value"], r["right_value"]) for r in tables.diff_columns(a, b, "id", ["v"]).collect()}
    assert cells == {(1, "v"): ("x", "y"), (3, "v"): (None, "z")}
    sets = {r["id"]: (r["only_left"], r["only_right"]) for r in tables.diff_sets(a, b, "id", "s").collect()}
    assert sets == {1: (["p"], ["r"]), 3: ([], ["t"])}
    assert one(spark, tables.union_merge(F.array(F.lit("a")), F.array(F.lit("b"), F.lit("a")))) == ["a", "b"]


# ---- folds


def test_fold_reads_each_excerpt_once_on_overflow():
    state, failures = fold.fold(["x" * 40] * 7, fold.OfflineMerger(window=25), per_call=5)
    assert state["columns"]["excerpts_read"] == 7 and failures == []
    _, failures = fold.fold(["x" * 400, "y"], fold.OfflineMerger(window=25), per_call=5)
    assert len(failures) == 1 and failures[0].startswith("1: too large")
    _, failures = fold.fold(["a"] * 4, fold.OfflineMerger(), most=3)
    assert failures == ["4-4: not read"]


def test_failed_call_leaves_the_accumulator():
    class Broken:
        calls = 0

        def merge(self, accumulated, excerpts, first, total):
            self.calls += 1
            accumulated["columns"]["spoilt"] = True
            raise RuntimeError("down")

    state, failures = fold.fold(["a"], Broken())
    assert failures == ["1-1: down"] and state["product_data"] == {}


def test_fold_products_in_order(spark):
    units = spark.createDataFrame([("p", 1, '{"substance": {"inn": "late"}, "key_risks": ["b"]}'), ("p", 0, '{"substance": {"inn": "first"}, "key_risks": ["a"]}'), ("q", 0, "prose")], "id string, seq int, unit string")
    got = {r["id"]: json.loads(r["product_data"]) for r in fold.fold_products(units).collect()}
    assert got["p"] == {"substance": {"inn": "first"}, "key_risks": ["a", "b"]} and got["q"] == {}


# ---- repair


def test_repair_checks(spark):
    schema = repair.PRESENTATIONS
    original = [{"form": "tablet", "route": "oral", "active_ingredients": "x", "per_value": None, "per_unit": None, "pack_size": None, "pack_unit": None}]

    def checked(returned):
        cols = [F.from_json(F.lit(json.dumps(x)), schema) for x in (original, returned)]
        return one(spark, repair.checked_presentations(*cols))

    base = original[0]
    assert [(p["pack_size"], p["pack_unit"]) for p in checked([{**base, "pack_size": "14", "pack_unit": "tablet"}, {**base, "pack_size": "14", "pack_unit": "tablet"}])] == [("14", "tablet")]
    moved = checked([{**base, "pack_size": "15", "pack_unit": "ml"}])[0]
    assert (moved["per_value"], moved["per_unit"], moved["pack_size"]) == (15.0, "mL", None)
    assert checked([{**base, "form": "gel"}]) is None and checked([]) is None
    said = lambda raw, items: one(spark, repair.checked_indications(F.lit(raw).cast("string"), F.array(*[F.lit(i) for i in items])))
    assert said("Relief of  pain.\nFever", ["relief of pain", "Fever", "fever "]) == ["relief of pain", "Fever"]
    assert said("Relief of pain", ["relief of stress"]) is None and said(None, ["a"]) is None


# ---- documents, snapshots, increments


def test_documents(spark, tmp_path):
    (tmp_path / "good.txt").write_text("A page of text that is long enough to be taken as it stands, surely.\fAnother page of text that is long enough, too.")
    (tmp_path / "scan.bin").write_bytes(b"\xff\xfe\x00scanned words here\x00")
    got = {r["path"].rsplit("/", 1)[1]: (r["method"], r["pages"], r["error"]) for r in docs.read_documents(docs.read_binary(spark, str(tmp_path))).collect()}
    assert got == {"good.txt": ("text", 2, None), "scan.bin": ("ocr", 1, None)}
    assert docs.page_groups([10, 10, 30, 5, 5], 20) == [(0, 2), (2, 3), (3, 5)]
    assert docs.inline_tables("see [t](a.md) and [u](b.md)", [{"tables": [{"id": "a.md", "content": "|1|"}]}]) == "see |1| and [u](b.md)"
    record = json.dumps({"documents": [{"s3_path": "a", "doc_type": "SPC"}, {"s3_path": "b", "doc_type": "PIL"}, {"s3_path": "c", "doc_type": "PIL"}]})
    chosen = lambda src, country: [tuple(d) for d in one(spark, docs.selected_documents(F.lit(record), F.lit(src), F.lit(country)))]
    assert chosen("a", "United Kingdom") == [("a", "SPC"), ("b", "PIL")] and chosen("b", "United Kingdom") == [("b", "PIL")] and chosen("a", "Spain") == [("a", "SPC")]


def test_snapshots(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path), "t")
    assert s.current() is None
    s.write(spark.range(3))
    s.write(s.current().where("id > 0"))
    assert s.versions() == [1, 2] and s.current().count() == 2
    with pytest.raises(MissingTableError):
        Catalog(spark, str(tmp_path)).require(["nothing"])


def test_increments_add_each_key_once(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, v string").schema
    source, target, progress = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def deliver(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        incremental.run_available(incremental.file_stream(spark, source, schema), incremental.append_new(spark, "id", ["v"], target), progress)

    deliver([(1, "b"), (1, "a"), (2, "c")])
    deliver([(2, "z"), (3, "d")])
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [(1, "a"), (2, "c"), (3, "d")]


# ---- control


def test_stages():
    assert pipeline.parse_stages("C, a") == ("promote", "extract") and pipeline.parse_stages("") == ("promote", "text", "extract", "repair")
    with pytest.raises(ValueError, match="nope"):
        pipeline.parse_stages("a,nope")


def test_breaker_and_retries():
    now, log = [0.0], []

    def primary(prompt):
        log.append(prompt)
        raise RuntimeError("down")

    b = providers.Breaker(primary, lambda p: "fallback", clock=lambda: now[0])
    assert [b.call(str(i)) for i in range(4)] == ["fallback"] * 4 and log == ["0", "1"]
    now[0] = 61.0
    b.call("probe")
    assert log[-1] == "probe" and b.open_until == 61.0 + 120.0
    waits = []
    with pytest.raises(providers.RetriesExhausted):
        providers.with_retries(lambda: 1 / 0, attempts=3, wait=2, sleep=waits.append)
    assert waits == [2, 4] and providers.is_context_error("Maximum context length exceeded")


# ---- the flow

RECORD = {"artg_id": "1", "components": [{"pack_size": "10, 20 tablets", "indications": "Fever.\nPain."}]}
STORED = {"presentations": [{"per_value": None, "per_unit": None, "pack_size": None, "pack_unit": None, "form": "tablet", "route": "oral", "active_ingredients": [{"substance": "a"}]}], "indications": [{"condition": "Fever", "population": "adults"}], "kept": 1}


class Stranger:
    def repair(self, record, document):
        if json.loads(record)["artg_id"] == "2":
            raise RuntimeError("down")
        return '{"presentations": [{"form": "cream"}], "indications": ["Gout"]}'


def test_repairs_are_checked_and_stored(spark):
    rows = [("a", json.dumps(RECORD), json.dumps(STORED)), ("b", json.dumps(RECORD | {"artg_id": "2"}), json.dumps(STORED)), ("c", None, None), ("d", json.dumps(RECORD), "{}")]
    df = spark.createDataFrame(rows, "id string, json_data string, product_data string")
    done = repair.repaired(df)
    new = json.loads(tables.update(df, done, "id", ["product_data"]).where("id = 'a'").first()["product_data"])
    assert [(p["pack_size"], p["pack_unit"], p["active_ingredients"]) for p in new["presentations"]] == [(10, None, [{"substance": "a"}]), (20, "tablets", [{"substance": "a"}])]
    assert [(i["condition"], i["population"]) for i in new["indications"]] == [("Fever", "adults"), ("Pain", None)] and new["kept"] == 1
    assert {r["id"]: r["error"] for r in repair.repaired(df, Stranger).collect()} == {"a": "no field passed its check", "b": "down"}


def test_documents_are_read_and_cut(spark, tmp_path):
    folder = tmp_path / "docs"
    (folder / "x").mkdir(parents=True)
    (folder / "x" / "one.txt").write_text("First document. " * 40)
    (folder / "x" / "two.txt").write_text("Second document. " * 40)
    named = json.dumps({"documents": [{"s3_path": "x/one.txt", "doc_type": "SmPC"}, {"s3_path": "x/two.txt", "doc_type": "PIL"}]})
    products = spark.createDataFrame([("a", 1, "x/one.txt", named), ("b", 2, "x/one.txt", named), ("c", 2, "x/gone.txt", None), ("d", 2, None, None)], "id string, country_id int, source_url string, json_data string")
    geography = spark.createDataFrame([(1, "United Kingdom"), (2, "France"), (2, "France")], "id int, country_name string")
    got = {r["product_id"]: r for r in pipeline.read_texts(products, geography, docs.read_binary(spark, str(folder)), str(folder)).collect()}
    assert got["a"]["text"].startswith("First") and "Second" in got["a"]["text"] and "Second" not in got["b"]["text"]
    assert got["c"]["text"] is None and got["c"]["error"] == "no file: x/gone.txt" and "d" not in got


def test_registers_without_a_mapper_are_folded(spark):
    products = spark.createDataFrame([("a", "EMA", '{"substance": {"inn": "x"}}'), ("b", "TGA", "{}"), ("c", None, None)], "id string, regulator string, json_data string")
    chunks = spark.createDataFrame([("a", 0, "text"), ("b", 0, "text"), ("c", 0, '{"key_risks": ["r"]}')], "product_id string, chunk_index int, chunk_text string")
    got = {r["id"]: r for r in pipeline.fold_registers(products, chunks).collect()}
    assert set(got) == {"a", "c"} and got["a"]["n_excerpts"] >= 2 and json.loads(got["c"]["product_data"]) == {"key_risks": ["r"]}


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace as N

    from quillstone.session import ensure_checkpoint_dir

    context = N(_jsc=N(sc=lambda: N(getCheckpointDir=lambda: N(isDefined=lambda: False))), master="spark://host:7077")
    with pytest.raises(RuntimeError, match="share"):
        ensure_checkpoint_dir(N(sparkContext=context, conf=N(get=lambda key, other: other)))
