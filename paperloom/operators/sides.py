"""Which side of a join may be sent to every executor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Section settings with compiled selectors take some 10 KB a row: 20 MB at most.
SETTINGS_ROWS = 2_000


def broadcast_if_small(side: DataFrame, rows: int = SETTINGS_ROWS) -> DataFrame:
    """``side`` with a broadcast hint if it has at most ``rows`` rows.

    A larger side is left to the engine, which shuffles both and splits skewed
    partitions. Counting stops one row after the limit.
    """
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side
