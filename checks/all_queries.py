"""Importing this module registers every query."""

from __future__ import annotations

import importlib
import pkgutil

import checks
from checks.registry import QUERIES, SQL

for _module in pkgutil.iter_modules(checks.__path__):
    if _module.name.endswith("_queries") and _module.name != "all_queries":
        importlib.import_module(f"checks.{_module.name}")

__all__ = ["QUERIES", "SQL"]
