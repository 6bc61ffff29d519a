"""Operators for building training data, and their queries. Nothing else in the library imports this package."""

from __future__ import annotations

import importlib
from collections.abc import Callable

#: The modules that hold one problem each; a module has QUERIES and may have SQL.
MODULES = ("site_lines", "token_budget", "leaks", "mojibake", "shared_spans", "groups", "markup", "encode", "mixture", "canonical")


def _all(what: str) -> dict:
    out: dict = {}
    for name in MODULES:
        try:
            out |= getattr(importlib.import_module(f"{__name__}.{name}"), what, {})
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{name}":
                raise
    return out


def queries() -> dict[str, Callable]:
    return _all("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _all("SQL")
