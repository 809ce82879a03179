"""Registered queries of this subpackage."""

from __future__ import annotations

import importlib

MODULES = ("token_store", "packing", "quality", "decontaminate", "line_dedup", "jaccard", "substrings", "toxicity", "secrets", "sentences", "vector_codes", "licenses", "periodic")


def load() -> tuple[dict, dict]:
    """All queries and all SQL twins by name."""
    from paperloom.llm.base import QUERIES, TWINS

    for name in MODULES:
        importlib.import_module(f"paperloom.llm.{name}")
    pipeline = importlib.import_module("corpus_pipeline")
    twins = {**TWINS, **({"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {})}
    return {**QUERIES, "pipeline": pipeline.run}, twins
