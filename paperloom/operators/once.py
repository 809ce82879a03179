"""Keep the optimiser from evaluating heavy columns more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    A filter on an ordinary computed column is pushed below it together with a
    copy of its expression. The output of a generator cannot be copied, and the
    outer form keeps the planner from deriving filters of its own.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return rows.select("*", F.inline_outer(F.array(row)))
