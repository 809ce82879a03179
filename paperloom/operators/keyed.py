"""First, latest and numbered rows per key, safe against hot keys.

No key is ever gathered into one task: the first row per key is thinned out
before the shuffle, and numbering splits each key into slices of the arrival
order that hold an equal share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.once import with_computed

# Slices of the arrival order. One key, however hot, spreads over this many tasks.
SLICES = 128
_PERCENTILE_ACCURACY = 10_000


def first_per_key(rows: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key.

    The rank filter is planned as a group limit on both sides of the exchange,
    so a task sends at most one row per key.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def with_order_slice(rows: DataFrame, order: str, source: DataFrame, slices: int = SLICES) -> DataFrame:
    """Add ``_slice``: which equal-frequency slice of ``order`` a row falls into.

    The bounds come from one aggregate over a single column of ``source`` and
    are a fixed number of values, whatever the size of the data.
    """
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    bounds = source.agg(F.percentile_approx(F.col(order), shares, F.lit(_PERCENTILE_ACCURACY)).alias("bounds"))
    sliced = rows.withColumn("_bounds", bounds.scalar())
    return sliced.withColumn(
        "_slice", F.coalesce(F.size(F.filter("_bounds", lambda bound: bound < F.col(order))), F.lit(0))
    ).drop("_bounds")


def number_per_key(rows: DataFrame, key: str, order: str, out: str, *, source: DataFrame,
                   base: DataFrame | None = None, slices: int = SLICES) -> DataFrame:
    """Number the rows of each ``key`` 1, 2, 3 … by ``order``, gap-free.

    ``order`` is unique. ``base`` holds ``key`` and ``_base``, the number to
    continue after. ``source`` has the ``order`` column and is cheap to scan;
    it only balances the slices.

    Rows are ranked within (key, slice), slices are counted, and each slice
    continues after the ones before it. Only the small table of counts is ever
    grouped by the key alone.
    """
    sliced = with_order_slice(rows, order, source, slices)
    within = Window.partitionBy(key, "_slice").orderBy(order)
    ranked = sliced.withColumn("_rank", F.row_number().over(within))

    counts = sliced.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_count"))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_count").over(earlier), F.lit(0)))
    if base is not None:
        offsets = offsets.join(base, key, "left").withColumn(
            "_before", F.col("_before") + F.coalesce(F.col("_base"), F.lit(0))
        )
    offsets = offsets.select(key, "_slice", "_before")

    number = (F.col("_before") + F.col("_rank")).cast("int")
    return ranked.join(offsets, [key, "_slice"]).withColumn(out, number).drop("_slice", "_rank", "_before")


def last_before(rows: DataFrame, keys: list[str], order: list[str], value: Column, out: str, *,
                source: DataFrame | None = None, slices: int = SLICES) -> DataFrame:
    """Add ``out``: ``value`` of the nearest earlier row of the key that has one, or null.

    ``order`` starts with a number; rows are cut into slices of its values that
    hold equal shares. Windows run within (key, slice), and each slice is given
    what the slices before it ended with, from a table with one row for each
    key and slice. A hot key is spread like that; rows are not joined with rows.
    ``value`` that may be null itself is wrapped in a struct. ``source`` has the
    first column of ``order`` and is cheap to scan.
    """
    valued = rows.withColumn("_value", value)
    # The output of a generator isn't copied into the condition of the join.
    sliced = with_order_slice(valued, order[0], source if source is not None else rows, slices).withColumnRenamed("_slice", "_s")
    sliced = with_computed(sliced, _slice=F.col("_s")).drop("_s")
    within = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = sliced.withColumn("_near", F.last("_value", ignorenulls=True).over(within))
    place = F.when(F.col("_value").isNotNull(), F.struct(*order))
    ends = sliced.groupBy(*keys, "_slice").agg(F.max_by("_value", place).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(*[F.col(k).alias(f"_of{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_of"),
                         F.last("_end", ignorenulls=True).over(earlier).alias("_handed"))
    same = F.col("_slice") == F.col("_of")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_of{i}"))
    return near.join(handed, same, "left").select(*rows.columns, F.coalesce("_near", "_handed").alias(out))


def latest_at(rows: DataFrame, facts: DataFrame, keys: list[str], time: str, fact_time: str, out: str) -> DataFrame:
    """As-of join: each row with the columns of the last fact of its key at or before its time, as a struct ``out``.

    Facts of one key and time are ordered by their columns. Rows without a fact get null.
    """
    names = [c for c in facts.columns if c not in keys]
    fact = F.struct(*names)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    none = F.lit(None).cast(facts.select(fact).schema[0].dataType)
    left = rows.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], micros(time).alias("_at"), F.lit(1).alias("_kind"),
                       none.alias("_fact"), F.struct(*rows.columns).alias("_row"))
    right = facts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], micros(fact_time).alias("_at"), F.lit(0).alias("_kind"),
                         fact.alias("_fact"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"))
    both = left.unionByName(right)
    found = last_before(both, [f"_k{i}" for i in range(len(keys))], ["_at", "_kind", "_fact"], F.col("_fact"), out)
    return found.where(F.col("_kind") == 1).select("_row.*", out)
