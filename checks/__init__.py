"""Named queries over the given tables and the SQL they are checked against."""

from __future__ import annotations

import importlib

MODULES = ["features", "news", "indicators", "evaluation", "modeling", "ingest", "gaps", "composites"]


def load():
    """(queries, sql) of all families."""
    for module in MODULES:
        importlib.import_module(f"checks.{module}")
    from checks.registry import QUERIES, SQL

    return QUERIES, SQL
