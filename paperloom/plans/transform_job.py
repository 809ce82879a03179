"""Transform stored documents of a range of windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators.transform import (
    candidates, pending, transform_counts, transform_rows, transformed_columns,
)
from paperloom.session import materialise
from paperloom.sources.tables import Store


def transform_found(store: Store, found: DataFrame, sections: DataFrame, *, run_id: str, batch: str,
                    transformed_at: Column) -> DataFrame:
    """Transform candidates that have no output yet; return counts per section.

    Outcomes, bytes included, are written once; rows and counts are read back
    from there. Failures stay beside them with their error, and since the
    idempotency key is the source path of a finished row, a later run tries
    them again.
    """
    done = store.read("transformed_documents").where(F.col("ingest_batch") != batch)
    # Narrow rows; their batches and windows say which folders of bytes are read at all.
    todo = materialise(pending(found.drop("error"), done), "todo")
    outcome = transform_rows(todo, store.read("landing_content"), sections, run_id=run_id, transformed_at=transformed_at)
    with store.together():
        store.write("transformed_content", outcome.withColumnRenamed("new_content", "content"), batch)
        written = store.read("transformed_content", [batch])
        store.write("transformed_documents", transformed_columns(written), batch)
    return transform_counts(found, written, ["section_id"])


def transform_range(store: Store, sections: DataFrame, start: date, end: date, *, run_id: str, batch: str,
                    transformed_at: Column, only: list[str] | None = None) -> DataFrame:
    found = candidates(store.read("landing_documents"), start, end, only)
    return transform_found(store, found, sections, run_id=run_id, batch=batch, transformed_at=transformed_at)
