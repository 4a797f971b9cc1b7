"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from sporeline.llm import chunking, components, languages, mixing, names, neardup, packing, scans, sentences, subjects

MODULES = (components, neardup, sentences, languages, chunking, names, packing, mixing, subjects, scans)


def queries() -> dict:
    """Every public function named pN_... of the problems' modules."""
    return {k: f for m in MODULES for k, f in vars(m).items() if k.startswith("p") and k[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for m in MODULES:
        sql.update(getattr(m, "SQL", {}))
    return sql
