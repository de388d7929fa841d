"""The registered queries over the given tables, each with its SQL twin where there is one."""

from __future__ import annotations

import importlib

from catalogue.registry import QUERIES, Query

MODULES = ["tables", "profiles", "preparation", "evaluation", "modelling"]


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"catalogue.{module}")
    return QUERIES
