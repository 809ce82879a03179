"""Contracts of the stored tables, as reports of their breaches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Key values held by more than one row; empty when the key is unique."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def key_report(rows: DataFrame, key: list[str]) -> DataFrame:
    """Distinct key values, and how many of them more than one row holds, in one grouping."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).agg(
        F.count(F.lit(1)).alias("keys"), F.count_if(F.col("rows") > 1).alias("duplicates"))


def schema_differences(rows: DataFrame, expected: T.StructType) -> list[str]:
    """Extra, missing and retyped columns."""
    have = {field.name: field.dataType for field in rows.schema}
    want = {field.name: field.dataType for field in expected}
    return (
        [f"extra column {name}" for name in have if name not in want]
        + [f"missing column {name}" for name in want if name not in have]
        + [f"column {name} is {have[name].simpleString()}, not {want[name].simpleString()}"
           for name in want if name in have and have[name] != want[name]]
    )


def row_breaches(rows: DataFrame, expected: T.StructType, rules: dict[str, Column]) -> DataFrame:
    """Rows with ``broken_rules``: required columns that are null, and named rules."""
    checks = [F.when(F.col(f.name).isNull(), F.lit(f"{f.name} is required"))
              for f in expected if not f.nullable and f.name in rows.columns]
    checks += [F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()]
    return rows.withColumn("broken_rules", F.array_compact(F.array(*checks))).where(F.size("broken_rules") > 0)


def breach_counts(rows: DataFrame, expected: T.StructType, rules: dict[str, Column]) -> DataFrame:
    """``rule, broken`` for every required column and named rule, zeros included, in one pass without moving rows."""
    checks = {f"{f.name} is required": F.col(f.name).isNull() for f in expected if not f.nullable and f.name in rows.columns}
    checks.update(rules)
    counted = rows.agg(*[F.count_if(F.coalesce(broken, F.lit(False))).alias(f"r{n}") for n, broken in enumerate(checks.values())])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"r{n}").alias("broken"))
                                             for n, rule in enumerate(checks)])))


def landing_rules() -> dict[str, Column]:
    stored = F.col("status") == "stored"
    return {
        "version >= 1": F.col("version") < 1,
        "status is stored or failed": ~F.col("status").isin("stored", "failed"),
        "stored rows have path and hash": stored & (F.col("file_path").isNull() | F.col("file_hash").isNull()),
        "failed rows have neither path nor hash": (F.col("status") == "failed")
        & (F.col("file_path").isNotNull() | F.col("file_hash").isNotNull()),
    }


def transformed_rules() -> dict[str, Column]:
    """A transformed row is complete and names the object it came from beside its own."""
    digest = "^[0-9a-f]{64}$"
    return {
        "version >= 1": F.col("version") < 1,
        "hashes are sha256 in hex": ~F.col("file_hash").rlike(digest) | ~F.col("source_file_hash").rlike(digest),
        "output is not its source": F.col("file_path") == F.col("source_file_path"),
    }


def stored_without_object(landing: DataFrame, content: DataFrame) -> DataFrame:
    """Stored rows that point at a missing object."""
    stored = landing.where(F.col("status") == "stored")
    return stored.join(content.select("file_path"), "file_path", "left_anti")


def version_gaps(landing: DataFrame) -> DataFrame:
    """Identifiers whose versions are not exactly 1 … n."""
    return landing.groupBy("identifier").agg(
        F.min("version").alias("lowest"), F.max("version").alias("highest"),
        F.count(F.lit(1)).alias("rows"),
    ).where((F.col("lowest") != 1) | (F.col("highest") != F.col("rows")))
