"""Check the contracts of all stored tables; every line of the report should say 0."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.quality import (
    breach_counts, key_report, landing_rules, schema_differences, stored_without_object, transformed_rules, version_gaps,
)
from paperloom.operators.runs import run_totals
from paperloom.schemas import ATTEMPT, LANDING, TRANSFORMED
from paperloom.sources.tables import Store

# Keys that are unique in their tables.
LANDING_KEY = ["identifier", "version"]
TRANSFORMED_KEY = ["source_file_path"]
RUN_KEY = ["run_id"]


def key_line(rows: DataFrame, key: list[str]) -> DataFrame:
    return key_report(rows, key).select(F.lit(f"{', '.join(key)} is unique").alias("rule"), F.col("duplicates").alias("broken"))


def _line(rule: str, broken: DataFrame) -> DataFrame:
    return broken.agg(F.count(F.lit(1)).alias("broken")).select(F.lit(rule).alias("rule"), "broken")


def check_store(store: Store) -> DataFrame:
    """``table, rule, broken``: columns, required values, row rules, unique keys, gaps and missing objects.

    Empty and absent tables break nothing. Objects are looked up by path, their bytes are not read.
    """
    landing, done = store.read("landing_documents"), store.read("transformed_documents")
    attempts = store.read("partition_attempts")
    for name, rows, expected in (("landing_documents", landing, LANDING), ("transformed_documents", done, TRANSFORMED),
                                 ("partition_attempts", attempts, ATTEMPT)):
        problems = schema_differences(rows.drop("ingest_batch"), expected)
        if problems:
            raise ValueError(f"{name}: {'; '.join(problems)}")
    stored = landing.where(F.col("status") == "stored")
    sources = done.select(F.col("source_file_path").alias("file_path"))
    lines = {
        "landing_documents": [
            breach_counts(landing, LANDING, landing_rules()), key_line(landing, LANDING_KEY),
            _line("versions are 1 to n", version_gaps(landing)),
            _line("stored rows have an object", stored_without_object(landing, store.read("landing_content"))),
        ],
        "transformed_documents": [
            breach_counts(done, TRANSFORMED, transformed_rules()), key_line(done, TRANSFORMED_KEY),
            _line("sources are stored rows", sources.join(stored.select("file_path"), "file_path", "left_anti")),
            _line("rows have an object", done.join(store.read("transformed_content").select("file_path"), "file_path", "left_anti")),
        ],
        "partition_attempts": [
            breach_counts(attempts, ATTEMPT, {"counters add up": F.col("found") < F.col("scraped") + F.col("failed") + F.col("skipped_unchanged")}),
            key_line(run_totals(attempts), RUN_KEY),
        ],
    }
    reports = [line.select(F.lit(table).alias("table"), "rule", "broken") for table, of in lines.items() for line in of]
    return reduce(DataFrame.unionByName, reports)
