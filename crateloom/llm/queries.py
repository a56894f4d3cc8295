"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib

MODULES = ("survivors", "matching", "lookalikes", "name_variants", "packing", "mixing", "languages")

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"crateloom.llm.{_name}")
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
