"""Date windows over customers and orders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from paperloom.catalog.registry import query
from paperloom.catalog.stand_ins import CUSTOMER_SECTIONS_SQL, customer_sections, load
from paperloom.operators.planning import (
    assign_windows, build_windows, coverage, listing_requests, plan_run, request_bounds, window_of, with_listing_template,
)


def _windows(spark, sf, sections=None):
    if sections is None:
        sections = customer_sections(spark, sf)
    return build_windows(sections, F.col("start_day"), F.col("end_day"), F.col("partition_days"))


@query("prt_1_build_windows", f"WITH {CUSTOMER_SECTIONS_SQL} "
       "SELECT section_id, partition_date, partition_date AS window_start, window_end FROM windows")
def build(spark, sf):
    return _windows(spark, sf).select("section_id", "partition_date", "window_start", "window_end")


@query("prt_2_plan_source_run", f"""WITH {CUSTOMER_SECTIONS_SQL}
SELECT source_id, section_id, partition_date, least(CAST(partition_date + partition_days - 1 AS DATE), DATE '1998-12-31') AS window_end,
       'run-1' AS run_id
FROM (SELECT *, CAST(unnest(generate_series(TIMESTAMP '1998-01-01', TIMESTAMP '1998-12-31', to_days(partition_days))) AS DATE) AS partition_date
      FROM sections)""")
def plan(spark, sf):
    planned = plan_run(customer_sections(spark, sf), date(1998, 1, 1), date(1998, 12, 31), "run-1")
    return planned.select("source_id", "section_id", "partition_date", "window_end", "run_id")


@query("prt_3_assign_date_to_window", """
SELECT o_orderkey, CAST(DATE '1995-01-01' + CAST(floor(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / days) AS INTEGER) * days AS DATE) AS partition_date
FROM (SELECT *, CASE WHEN o_custkey % 2 = 0 THEN 30 ELSE 365 END AS days FROM orders)""")
def assign(spark, sf):
    days = F.when(F.col("o_custkey") % 2 == 0, 30).otherwise(365)
    start = window_of(F.col("o_orderdate").cast("date"), F.lit(date(1995, 1, 1)), days)
    return load(spark, sf, "orders").select("o_orderkey", start.alias("partition_date"))


def _priority_plan(spark, sf):
    days = F.coalesce(F.element_at(F.array(*map(F.lit, (30, 365, 7, 91, 1))),
                                   F.substring("o_orderpriority", 1, 1).cast("int")), F.lit(30))
    orders = load(spark, sf, "orders")
    sections = orders.select(F.col("o_orderpriority").alias("section_id")).distinct()
    sections = sections.withColumn("o_orderpriority", F.col("section_id")).select(
        F.lit("orders").alias("source_id"), "section_id", days.alias("partition_days"))
    return plan_run(sections, date(1995, 1, 1), date(2001, 8, 1), "run-1")


@query("join_6_date_to_window_interval", """
WITH plan AS (
  SELECT section_id, partition_date, least(CAST(partition_date + days - 1 AS DATE), DATE '2001-08-01') AS window_end
  FROM (SELECT *, CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', to_days(days))) AS DATE) AS partition_date
        FROM (SELECT DISTINCT o_orderpriority AS section_id,
                     CASE o_orderpriority[1] WHEN '1' THEN 30 WHEN '2' THEN 365 WHEN '3' THEN 7 WHEN '4' THEN 91 ELSE 1 END AS days FROM orders)))
SELECT o_orderkey, section_id, partition_date, window_end
FROM orders JOIN plan ON o_orderpriority = section_id AND CAST(o_orderdate AS DATE) BETWEEN partition_date AND window_end""")
def interval_join(spark, sf):
    records = load(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("section_id"), F.col("o_orderdate").cast("date").alias("day"))
    joined = assign_windows(records, _priority_plan(spark, sf), "day")
    return joined.select("o_orderkey", "section_id", "partition_date", "window_end")


def _with_source(windows):
    """Source fields: how the nation's site treats its date bounds."""
    return windows.withColumns({
        "start_inclusive": F.col("c_nationkey") % 2 == 0,
        "end_inclusive": F.col("c_nationkey") % 3 == 0,
        "date_show": F.lit("dd/MM/yyyy"), "date_from": F.lit("from"), "date_to": F.lit("to"),
        "page_param": F.lit("pageNumber"),
        "url": F.concat(F.lit("https://nation"), F.col("c_nationkey").cast("string"),
                        F.lit(".example.org/shelf?kind=9&to=x&q=a+b%2Fc&body="), F.col("c_custkey").cast("string"),
                        F.lit("&blank=")),
    })


_BOUNDS_SQL = CUSTOMER_SECTIONS_SQL + """,
bounds AS (
  SELECT *, CAST(CASE WHEN c_nationkey % 2 = 0 THEN partition_date ELSE partition_date - 1 END AS DATE) AS request_start,
         CAST(CASE WHEN c_nationkey % 3 = 0 THEN window_end ELSE window_end + 1 END AS DATE) AS request_end FROM windows)
"""


@query("prt_4_boundary_adaptation", f"WITH {_BOUNDS_SQL} SELECT section_id, partition_date, request_start, request_end FROM bounds")
def boundaries(spark, sf):
    start, end = request_bounds(F.col("window_start"), F.col("window_end"), F.col("start_inclusive"), F.col("end_inclusive"))
    return _with_source(_windows(spark, sf)).select(
        "section_id", "partition_date", start.alias("request_start"), end.alias("request_end"))


@query("prt_5_request_manifest", f"""WITH {_BOUNDS_SQL}
SELECT section_id, partition_date, 'https://nation' || c_nationkey || '.example.org/shelf?kind=9&to=' || strftime(request_end, '%d/%m/%Y')
  || '&q=a%20b/c&body=' || c_custkey || '&from=' || strftime(request_start, '%d/%m/%Y') || '&pageNumber=1' AS listing_url
FROM bounds""")
def manifest(spark, sf):
    sections = with_listing_template(_with_source(customer_sections(spark, sf)))
    return listing_requests(_windows(spark, sf, sections)).select("section_id", "partition_date", "listing_url")


@query("prt_6_coverage_audit", f"""WITH {CUSTOMER_SECTIONS_SQL},
active AS (
  SELECT DISTINCT section_id, partition_date, window_end FROM windows
  JOIN orders ON o_custkey = c_custkey AND CAST(o_orderdate AS DATE) BETWEEN partition_date AND window_end)
SELECT section_id, window_start, previous_end, gap_days, CASE WHEN gap_days > 0 THEN 'gap' ELSE 'overlap' END AS finding
FROM (SELECT section_id, partition_date AS window_start, previous_end, date_diff('day', previous_end, partition_date) - 1 AS gap_days
      FROM (SELECT *, lag(window_end) OVER (PARTITION BY section_id ORDER BY partition_date) AS previous_end FROM active))
WHERE gap_days <> 0""")
def audit(spark, sf):
    """Windows without any order are gaps in what a section delivered."""
    sections = customer_sections(spark, sf).withColumnRenamed("c_custkey", "o_custkey")
    orders = load(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    start = window_of(F.col("day"), F.col("start_day"), F.col("partition_days"))
    active = orders.join(sections, "o_custkey").select(
        "section_id", start.alias("window_start"), "partition_days", "end_day").distinct()
    active = active.withColumn("window_end", F.least(F.date_add("window_start", F.col("partition_days") - 1), F.col("end_day")))
    return coverage(active, ["section_id"]).select("section_id", "window_start", "previous_end", "gap_days", "finding")
