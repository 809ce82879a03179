"""Counters per partition and run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from paperloom.catalog.registry import query
from paperloom.catalog.stand_ins import ATTEMPTS_SQL, OUTCOMES_SQL, attempts, outcomes, stamp, stamp_sql
from paperloom.operators.planning import build_windows
from paperloom.operators.runs import (
    COUNTERS, dashboard, fatal_message, latest_attempts, partition_counters, reconciliation, run_document,
    run_totals, seconds_between,
)

_COUNTS = "count(o.seq) AS found, count(*) FILTER (outcome = 'stored') AS scraped, count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'skipped') AS skipped_unchanged"
_C = ", ".join(COUNTERS)
_SUMS = ", ".join(f"CAST(sum({name}) AS BIGINT) AS {name}" for name in COUNTERS)


@query("agg_1_partition_counters", f"""WITH {OUTCOMES_SQL},
plan AS (SELECT section_id, CAST(unnest(generate_series(TIMESTAMP '2023-12-01', TIMESTAMP '2024-01-31', to_days(days))) AS DATE) AS partition_date
         FROM (SELECT DISTINCT section_id, CASE section_id WHEN 'sec_a' THEN 3 WHEN 'sec_b' THEN 7 WHEN 'sec_c' THEN 10 ELSE 31 END AS days FROM outcomes))
SELECT p.section_id, p.partition_date, {_COUNTS}
FROM plan p LEFT JOIN outcomes o ON p.section_id = o.section_id AND o.day BETWEEN p.partition_date AND p.partition_date
  + (CASE p.section_id WHEN 'sec_a' THEN 3 WHEN 'sec_b' THEN 7 WHEN 'sec_c' THEN 10 ELSE 31 END) - 1 GROUP BY ALL""")
def counters(spark, sf):
    """A plan that begins a month early: windows without items get zeros."""
    from paperloom.operators.planning import window_of

    start = date(2023, 12, 1)
    rows = outcomes(spark, sf).select("section_id", "published_date", "outcome")
    days = F.element_at(F.array(*map(F.lit, (3, 7, 10, 31))), F.ascii(F.substring("section_id", 5, 1)) - 96)
    rows = rows.withColumn("partition_date", window_of(F.col("published_date"), F.lit(start), days))
    sections = rows.select("section_id").distinct()
    plan = build_windows(sections, F.lit(start), F.lit(date(2024, 1, 31)), days).select("section_id", "partition_date")
    return partition_counters(rows, plan, ["section_id", "partition_date"])


@query("agg_2_partition_summary", f"""WITH {ATTEMPTS_SQL}
SELECT run_id, section_id, partition_date, attempt, window_start, window_end, finish_reason,
       CASE WHEN finish_reason <> 'finished' THEN coalesce(message, finish_reason) END AS fatal,
       date_diff('microsecond', started_at, finished_at) / 1e6 AS duration_seconds, {_C} FROM attempts""")
def summary(spark, sf):
    rows = attempts(spark, sf)
    return rows.select(
        "run_id", "section_id", "partition_date", "attempt", "window_start", "window_end", "finish_reason",
        fatal_message(F.col("finish_reason"), F.col("message")).alias("fatal"),
        seconds_between(F.col("started_at"), F.col("finished_at")).alias("duration_seconds"), *COUNTERS)


@query("agg_3_run_rollup", f"""WITH {ATTEMPTS_SQL}
SELECT run_id, source_id, partitions, {_C}, {stamp_sql('started_at')}, {stamp_sql('finished_at')} FROM (
  SELECT run_id, arg_min(source_id, recorded_at) AS source_id, count(*) AS partitions, {_SUMS},
         arg_min(started_at, recorded_at) AS started_at, arg_max(finished_at, recorded_at) AS finished_at FROM attempts GROUP BY run_id)""")
def totals(spark, sf):
    rows = run_totals(attempts(spark, sf))
    return rows.select("run_id", "source_id", "partitions", *COUNTERS, stamp("started_at"), stamp("finished_at"))


@query("agg_4_run_lookup", f"""WITH {ATTEMPTS_SQL}
SELECT run_id, arg_min(source_id, recorded_at) AS source_id, CAST(count(*) AS INTEGER) AS entries,
       '{{"found":' || sum(found) || ',"scraped":' || sum(scraped) || ',"failed":' || sum(failed) || ',"skipped_unchanged":' || sum(skipped_unchanged) || '}}' AS totals,
       '[' || string_agg('{{"section_id":"' || section_id || '","partition_date":"' || strftime(partition_date, '%Y-%m-%d') || '","finish_reason":"' || finish_reason
         || CASE WHEN message IS NULL THEN '' ELSE '","fatal":"' || message END || '","found":' || found || ',"scraped":' || scraped || ',"failed":' || failed
         || ',"skipped_unchanged":' || skipped_unchanged || '}}', ',' ORDER BY recorded_at, section_id) || ']' AS partitions
FROM attempts WHERE run_id = 'run-2024-01-10' GROUP BY run_id""")
def lookup(spark, sf):
    rows = attempts(spark, sf).withColumn("fatal", F.col("message")).withColumn(
        "duration_seconds", seconds_between(F.col("started_at"), F.col("finished_at")))
    shown = ["section_id", "partition_date", "finish_reason", "fatal", *COUNTERS]
    return run_document(rows, "run-2024-01-10").select(
        "run_id", "source_id", F.size("partitions").alias("entries"), F.to_json("totals").alias("totals"),
        F.to_json(F.transform("partitions", lambda e: F.struct(*[e[f].alias(f) for f in shown]))).alias("partitions"))


@query("agg_5_latest_attempt", f"""WITH {ATTEMPTS_SQL}
SELECT run_id, section_id, partition_date, attempt, {_C} FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, section_id, partition_date ORDER BY finished_at DESC) AS rn FROM attempts) WHERE rn = 1""")
def latest(spark, sf):
    return latest_attempts(attempts(spark, sf)).select("run_id", "section_id", "partition_date", "attempt", *COUNTERS)


@query("agg_6_reconciliation", f"""WITH {ATTEMPTS_SQL}
SELECT run_id, section_id, partition_date, {_SUMS}, CAST(sum(found) - sum(scraped) - sum(failed) - sum(skipped_unchanged) AS BIGINT) AS unaccounted
FROM attempts GROUP BY ALL""")
def reconcile(spark, sf):
    return reconciliation(attempts(spark, sf))


@query("agg_7_dashboard", f"""WITH {ATTEMPTS_SQL}
SELECT run_id, section_id, count(*) AS attempts, {_SUMS} FROM attempts GROUP BY ROLLUP (run_id, section_id)""")
def board(spark, sf):
    return dashboard(attempts(spark, sf))
