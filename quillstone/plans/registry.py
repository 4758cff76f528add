"""All queries of the core, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Modules that each offer queries() and may offer oracle_sql().
MODULES = ("quillstone.plans.reference_queries", "quillstone.plans.general_queries")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name in MODULES:
        found |= importlib.import_module(name).queries()
    return found


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in MODULES:
        found |= getattr(importlib.import_module(name), "oracle_sql", dict)()
    return found
