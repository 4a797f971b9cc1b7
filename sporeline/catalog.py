"""All queries of the core operators and the SQL that checks them."""

from __future__ import annotations

import importlib

MODULES = ("lines", "joins", "analysis", "streams", "records", "texts", "lookups")


def queries() -> dict:
    found = {}
    for m in MODULES:
        found.update(importlib.import_module(f"sporeline.plans.{m}").QUERIES)
    return found


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for m in MODULES:
        sql.update(importlib.import_module(f"sporeline.plans.{m}").SQL)
    return sql
