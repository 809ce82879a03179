"""Which archived answer belongs to which run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.urls import request_identity
from paperloom.operators.keyed import first_per_key, latest_at

# Runs whose starts are looked up in an array; more are joined by time.
RUNS = 2_000


def with_run(answers: DataFrame, runs: DataFrame) -> DataFrame:
    """Answers with the ``run_id`` of the last run that had started when they were fetched.

    ``runs``: run_id, started_at. Answers from before the first run, or without
    a time, belong to none and are left out.
    """
    runs = runs.select("run_id", F.col("started_at").cast("timestamp").alias("started_at"))
    if runs.limit(RUNS + 1).count() <= RUNS:
        starts = runs.agg(F.array_sort(F.collect_list(F.struct("started_at", "run_id"))).alias("starts"))
        known = answers.withColumn("_starts", starts.scalar())
        begun = F.filter("_starts", lambda run: run["started_at"] <= F.col("fetched_at"))
        found = known.withColumn("run_id", F.try_element_at(begun, F.lit(-1))["run_id"]).drop("_starts")
    else:
        times = answers.select("fetched_at").where(F.col("fetched_at").isNotNull()).distinct()
        by_time = latest_at(times, runs, [], "fetched_at", "started_at", "_run")
        found = answers.join(by_time.select("fetched_at", F.col("_run.run_id").alias("run_id")), "fetched_at")
    return found.where(F.col("run_id").isNotNull())


def answers_of_runs(archive: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """One answer per run and request: the last one fetched, as retries come after what they mend.

    URLs that ask for the same thing are one request, named by ``identity``.
    Without ``runs`` the archive is that of a single run. The rank filter lets a task send on at most one answer of a
    URL, so a URL that was fetched very often is no hot key. Equal times are
    decided by status and content.
    """
    known = (with_run(archive, runs) if runs is not None else archive).withColumn("identity", request_identity(F.col("url")))
    keys = ["run_id", "identity"] if runs is not None else ["identity"]
    rest = F.xxhash64("status", "content_type", "etag", "proxy", "body", "failure")
    return first_per_key(known, keys, F.desc_nulls_last("fetched_at"), F.asc_nulls_last("status"), rest)
