"""Registered queries and the SQL each result is compared with."""

import importlib

from .base import ORACLE, QUERIES

for _module in ("scalars", "ordered", "grouped", "feature_sets", "intake", "monitoring", "learning", "forced"):
    importlib.import_module(f"{__name__}.{_module}")

from .ordered import flagship  # noqa: E402

__all__ = ["ORACLE", "QUERIES", "flagship"]
