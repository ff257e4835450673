"""The registered queries of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import importlib

MODULES = ("overlap", "ocr_repair", "language", "repetition", "alignment", "truncation", "packing", "mixing", "subjects")


def queries() -> dict:
    out: dict = {}
    for name in MODULES:
        try:
            out |= importlib.import_module(f"korale.llm.{name}").QUERIES
        except ModuleNotFoundError as e:
            if e.name != f"korale.llm.{name}":
                raise
    return out


def oracle_sql() -> dict[str, str]:
    return {}
