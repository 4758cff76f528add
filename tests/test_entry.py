"""The entry points: every core query runs and equals its SQL; the core does without the optional subpackage."""

import glob
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from quillstone.plans import registry

ROOT = Path(__file__).resolve().parent.parent
DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def rows(frame, columns):
    show = lambda x: None if x is None or x != x else round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    return sorted(str(tuple(show(x) for x in r)) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        db.sql(f"CREATE VIEW {Path(f).stem} AS SELECT * FROM '{f}'")
    got, want = registry.queries()[name](spark, DATA).toPandas(), db.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_runs(spark, name):
    assert registry.queries()[name](spark, DATA).count() >= 0


def test_core_does_not_import_the_optional_subpackage():
    code = "import sys, quillstone.plans.registry as r; r.queries(); r.oracle_sql(); sys.exit(any(m.startswith('quillstone.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0
    for f in (ROOT / "quillstone").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            assert "quillstone.llm" not in f.read_text(), f


ODD_RECORDS = [
    None, "", " ", "{}", "[]", "5", "null", "tru", '[{"trade_name": "in a list"}]', '{"trade_name": "cut off', '{"trade_name": "behind"} x', '{"trade_name": "two"}{"b": 1}', "{'trade_name': 1}",
    '{"trade_name": "Alpha", "drug_type": "NCE", "authorization_status": " VALID ", "registration_number": " 1-2 "}', '{"trade_name": "  A   B ;", "drug_type": "Generic"}', '{"trade_name": "", "registration_number": null}',
    '{"trade_name": "one", "trade_name": "other", "drug_type": "Biological"}', '{"trade_name": "comma", "manufacturers": [1, 2, ], }', '{"trade_name": "nan", "size": nan, "package_size": -INF}', '{"trade_name": "text, ]", "size": "ten",}',
    '{"trade_name": "half \\ud800"}', '{"trade_name": "whole \\ud83d\\ude42"}', '{"trade_name": "a\nb"}', '{"trade_name": "lines\\n\\n"}', '{"trade_name": {"en": "x"}, "drug_type": "Other"}', '{"trade_name": "**note** C", "manufacturers": "none"}', "[,]",
    '{"trade_name": "' + "long " * 50_000 + '"}', '{"trade_name": "digits", "size": ' + "9" * 900 + "}", '{"trade_name": 12, "authorization_status": true}',
]


def test_sa_columns_of_odd_records_equal_sql(spark, tmp_path):
    spark.createDataFrame([(f"{i:02}", "SFDA", x) for i, x in enumerate(ODD_RECORDS)] + [("tga", "TGA", "{}")], "id string, regulator string, json_data string").coalesce(1).write.parquet(f"{tmp_path}/products.parquet")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW products AS SELECT * FROM '{tmp_path}/products.parquet/*.parquet'")
    got, want = registry.queries()["sa_columns"](spark, str(tmp_path)).toPandas(), db.sql(registry.oracle_sql()["sa_columns"]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and rows(got, columns) == rows(want, columns)
