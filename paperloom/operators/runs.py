"""Counters per partition, per attempt and per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.operators.keyed import first_per_key

COUNTERS = ("found", "scraped", "failed", "skipped_unchanged")
PARTITION = ["run_id", "section_id", "partition_date"]


def partition_counters(outcomes: DataFrame, plan: DataFrame | None = None,
                       keys: list[str] = PARTITION) -> DataFrame:
    """Counts of ``outcome`` values per partition; planned but empty ones get zeros.

    ``skipped`` covers both the server's "unchanged" and equal hashes.
    """
    counted = outcomes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(F.col("outcome") == "stored").alias("scraped"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped_unchanged"),
    )
    if plan is None:
        return counted
    return plan.join(counted, keys, "left").fillna(0, list(COUNTERS))


def fatal_message(finish_reason: Column, message: Column) -> Column:
    """Null for a finished partition, else the recorded message or the reason."""
    return F.when(finish_reason != "finished", F.coalesce(message, finish_reason))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def run_totals(attempts: DataFrame) -> DataFrame:
    """One row per run over all its attempts.

    The source and start are those of the first record, the finish that of the
    last. Retries add to the totals again.
    """
    totals = [F.sum(name).alias(name) for name in COUNTERS]
    return attempts.groupBy("run_id").agg(
        F.min_by("source_id", "recorded_at").alias("source_id"),
        F.count(F.lit(1)).alias("partitions"),
        *totals,
        F.min_by("started_at", "recorded_at").alias("started_at"),
        F.max_by("finished_at", "recorded_at").alias("finished_at"),
    )


def run_document(attempts: DataFrame, run_id: str) -> DataFrame:
    """One run with its partition entries, in recording order; empty if unknown.

    The entries of one run are as many as the windows it was planned with.
    """
    one = attempts.where(F.col("run_id") == run_id)
    fields = ["section_id", "partition_date", "window_start", "window_end", "finish_reason", "fatal",
              "started_at", "finished_at", "duration_seconds", *COUNTERS]
    entries = F.array_sort(F.collect_list(F.struct("recorded_at", *fields)))
    nested = one.groupBy("run_id").agg(
        F.min_by("source_id", "recorded_at").alias("source_id"),
        F.transform(entries, lambda e: F.struct(*[e[f].alias(f) for f in fields])).alias("partitions"),
        F.struct(*[F.sum(name).alias(name) for name in COUNTERS]).alias("totals"),
        F.min_by("started_at", "recorded_at").alias("started_at"),
        F.max_by("finished_at", "recorded_at").alias("finished_at"),
    )
    return nested


def latest_attempts(attempts: DataFrame) -> DataFrame:
    """The last attempt of each partition, so retries count once."""
    return first_per_key(attempts, PARTITION, F.desc("finished_at"), F.desc("recorded_at"))


def reconciliation(attempts: DataFrame) -> DataFrame:
    """Rows found but not accounted for, per partition."""
    known = F.col("scraped") + F.col("failed") + F.col("skipped_unchanged")
    return attempts.groupBy(*PARTITION).agg(*[F.sum(name).alias(name) for name in COUNTERS]).withColumn(
        "unaccounted", F.col("found") - known
    )


def dashboard(attempts: DataFrame) -> DataFrame:
    """Counts by run and section with subtotals and a grand total."""
    return attempts.rollup("run_id", "section_id").agg(
        F.count(F.lit(1)).alias("attempts"), *[F.sum(name).alias(name) for name in COUNTERS]
    )
