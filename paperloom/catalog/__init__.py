"""Registered queries: every operator over the given tables, with its SQL twin."""

from __future__ import annotations

import importlib

MODULES = ("sources", "planning", "extraction", "crawling", "landing", "transforming", "runs", "quality", "streams")


def load() -> tuple[dict, dict]:
    """All queries and all SQL twins by name."""
    from paperloom.catalog.registry import QUERIES, TWINS

    for name in MODULES:
        importlib.import_module(f"paperloom.catalog.{name}")
    return QUERIES, TWINS
