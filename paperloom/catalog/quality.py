"""Contract checks over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.catalog.registry import query
from paperloom.catalog.stand_ins import ATTEMPTS_SQL, CRAWL_LOG_SQL, PAGE_DOCS_SQL, SELECTORS, attempts, landing, load, page_docs
from paperloom.config import section_problems
from paperloom.operators.landing import landing_columns
from paperloom.operators.quality import (
    breach_counts, key_report, landing_rules, row_breaches, schema_differences, stored_without_object,
    transformed_rules, version_gaps,
)
from paperloom.operators.runs import run_totals
from paperloom.plans.contract_job import RUN_KEY, TRANSFORMED_KEY, key_line
from paperloom.schemas import LANDING, TRANSFORMED


@query("con_1_key_uniqueness", f"""WITH {CRAWL_LOG_SQL}
SELECT 'identifier, version' AS checked, CAST(count(*) AS BIGINT) AS keys, CAST(count(*) FILTER (n > 1) AS BIGINT) AS duplicates
FROM (SELECT identifier, version, count(*) AS n FROM landing GROUP BY ALL)
UNION ALL
SELECT 'l_orderkey, l_linenumber', count(*), count(*) FILTER (n > 1) FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)""")
def uniqueness(spark, sf):
    def report(rows, key):
        return key_report(rows, key).select(F.lit(", ".join(key)).alias("checked"), "keys", "duplicates")

    return report(landing(spark, sf), ["identifier", "version"]).unionByName(
        report(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query("con_2_row_contract", f"""WITH {CRAWL_LOG_SQL}
SELECT section_id, count(*) AS broken FROM landing WHERE version < 1 OR identifier IS NULL GROUP BY section_id
UNION ALL
SELECT 'documents without label', count(*) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL""")
def row_contract(spark, sf):
    rows = landing_columns(landing(spark, sf))
    assert schema_differences(rows, LANDING) == []
    broken = row_breaches(rows, LANDING, landing_rules()).groupBy("section_id").agg(F.count(F.lit(1)).alias("broken"))
    labelled = load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels"), "doc_id", "left")
    unlabelled = row_breaches(labelled, LANDING, {"quality is known": F.col("quality").isNull()})
    return broken.unionByName(unlabelled.agg(F.count(F.lit(1)).alias("broken")).select(
        F.lit("documents without label").alias("section_id"), "broken"))


@query("con_3_config_contract", """
SELECT 'cust_' || c_custkey AS section_id, broken_rule FROM (
  SELECT c_custkey, 'partition_days' AS broken_rule FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT c_custkey, 'title' FROM customer WHERE c_mktsegment = 'MACHINERY'
  UNION ALL SELECT c_custkey, 'identifier' FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT c_custkey, 'doc_link' FROM customer WHERE c_mktsegment = 'HOUSEHOLD')""")
def config_contract(spark, sf):
    """Section settings derived from customers, some of them broken."""
    segment = F.col("c_mktsegment")
    fixed = {name: F.lit(value).alias(name) for name, value in SELECTORS.items()
             if name not in ("identifier", "title", "doc_link")}
    sections = load(spark, sf, "customer").select(
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("section_id"),
        F.lit("https://example.org/").alias("url"),
        F.floor("c_acctbal").alias("balance"),
        F.when(F.col("c_acctbal") < 0, 0).otherwise(30).alias("partition_days"),
        F.when(segment == "BUILDING", F.array(F.lit("span.order-no"), F.lit("a[href]"))).otherwise(F.array(F.lit("span.order-no"))).alias("identifier"),
        F.when(segment == "MACHINERY", "h2 > a").otherwise("h2.title a").alias("title"),
        F.when(segment == "HOUSEHOLD", "a:first-child").alias("doc_link"),
        *fixed.values())
    return section_problems(sections)


@query("con_4_stored_has_object", f"""WITH {CRAWL_LOG_SQL}
SELECT seq, file_path FROM landing WHERE status = 'stored' AND doc_type = 'pdf'""")
def objects(spark, sf):
    """Against a content table that lost its PDFs."""
    rows = landing(spark, sf)
    content = rows.where((F.col("status") == "stored") & (F.col("doc_type") != "pdf")).select("file_path")
    return stored_without_object(rows, content).select("seq", "file_path")


@query("con_5_gap_free_versions", f"""WITH {CRAWL_LOG_SQL}
SELECT identifier, CAST(min(version) AS BIGINT) AS lowest, CAST(max(version) AS BIGINT) AS highest, count(*) AS rows
FROM landing WHERE status = 'stored' GROUP BY identifier HAVING min(version) <> 1 OR max(version) <> count(*)""")
def gaps(spark, sf):
    """The whole table has no gaps; its stored rows alone do, where failures took numbers."""
    rows = landing(spark, sf)
    found = version_gaps(rows.where(F.col("status") == "stored")).unionByName(version_gaps(rows))
    return found.select("identifier", F.col("lowest").cast("bigint").alias("lowest"),
                        F.col("highest").cast("bigint").alias("highest"), "rows")


# Transformed rows of two runs: the second had not seen the pages of the first with an even number.
_TWO_RUNS_SQL = PAGE_DOCS_SQL + """,
two_runs AS (SELECT *, 1 AS run FROM page_landing UNION ALL SELECT *, 2 FROM page_landing WHERE page_id % 2 = 0)
"""


def _two_runs(spark, sf):
    docs = page_docs(spark, sf).withColumnRenamed("file_path", "source_file_path").withColumnRenamed("file_hash", "source_file_hash")
    runs = F.explode(F.when(F.col("page_id") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = docs.drop("content", "html").withColumn("run", runs)
    # Defects by page number: a hash that is none, an output on its source, no run, a version below one.
    page = F.col("page_id")
    return rows.select(
        "*", F.when(page % 7 == 3, F.lit("none")).otherwise(F.col("source_file_hash")).alias("file_hash"),
        F.when(page % 5 == 1, F.col("source_file_path")).otherwise(F.concat(F.lit("out/"), F.col("source_file_path"))).alias("file_path"),
        F.when(page % 11 != 4, F.lit("run-1")).alias("run_id"), F.lit("2024-02-01").cast("timestamp").alias("transformed_at"),
    ).withColumn("version", F.when(page % 13 == 6, 0).otherwise(F.col("version")))


@query("con_1_outputs_and_runs", f"""WITH {ATTEMPTS_SQL}, {_TWO_RUNS_SQL}
SELECT 'transformed' AS checked, 'source_file_path is unique' AS rule, count(*) FILTER (n > 1) AS broken
FROM (SELECT file_path, count(*) AS n FROM two_runs GROUP BY ALL)
UNION ALL SELECT 'run totals', 'run_id is unique', CAST(0 AS BIGINT)
UNION ALL SELECT 'attempts', 'run_id is unique', count(*) FILTER (n > 1) FROM (SELECT run_id, count(*) AS n FROM attempts GROUP BY ALL)""")
def outputs_and_runs(spark, sf):
    """Outputs of two runs that overlap, totals of runs, and attempts, of which a run has several."""
    runs = attempts(spark, sf)
    lines = (("transformed", _two_runs(spark, sf), TRANSFORMED_KEY), ("run totals", run_totals(runs), RUN_KEY), ("attempts", runs, RUN_KEY))
    first, second, third = (key_line(rows, key).select(F.lit(name).alias("checked"), "rule", "broken") for name, rows, key in lines)
    return first.unionByName(second).unionByName(third)


@query("con_2_broken_transformed", f"""WITH {_TWO_RUNS_SQL}
SELECT r.rule, CASE r.rule WHEN 'run_id is required' THEN count(*) FILTER (page_id % 11 = 4) WHEN 'version >= 1' THEN count(*) FILTER (page_id % 13 = 6)
         WHEN 'hashes are sha256 in hex' THEN count(*) FILTER (page_id % 7 = 3)
         WHEN 'output is not its source' THEN count(*) FILTER (page_id % 5 = 1) ELSE 0 END AS broken
FROM two_runs, (SELECT unnest([{', '.join(f"'{f.name} is required'" for f in TRANSFORMED if not f.nullable)},
  'version >= 1', 'hashes are sha256 in hex', 'output is not its source']) AS rule) r GROUP BY r.rule""")
def broken_transformed(spark, sf):
    return breach_counts(_two_runs(spark, sf), TRANSFORMED, transformed_rules())


@query("con_2_broken_landing", f"""WITH {CRAWL_LOG_SQL}
SELECT * FROM (SELECT unnest([{', '.join(f"'{f.name} is required'" for f in LANDING if not f.nullable)}, 'version >= 1', 'status is stored or failed',
  'stored rows have path and hash', 'failed rows have neither path nor hash']) AS rule) r,
LATERAL (SELECT CASE r.rule WHEN 'title is required' THEN count(*) FILTER (seq % 17 = 2) WHEN 'version >= 1' THEN count(*) FILTER (seq % 13 = 5)
  WHEN 'status is stored or failed' THEN count(*) FILTER (seq % 19 = 7)
  WHEN 'stored rows have path and hash' THEN count(*) FILTER (status = 'stored' AND seq % 19 <> 7 AND seq % 11 = 3)
  WHEN 'failed rows have neither path nor hash' THEN count(*) FILTER (status = 'failed' AND seq % 19 <> 7 AND seq % 11 <> 3) ELSE 0 END AS broken FROM landing) b""")
def broken_landing(spark, sf):
    """Landing rows with defects by arrival number; failed ones got a hash."""
    rows, seq = landing(spark, sf), F.col("seq")
    kept = landing_columns(rows).columns
    spoiled = rows.withColumns({
        "title": F.when(seq % 17 != 2, F.col("title")), "version": F.when(seq % 13 == 5, 0).otherwise(F.col("version")),
        "status": F.when(seq % 19 == 7, "lost").otherwise(F.col("status")),
        "file_hash": F.when(seq % 11 != 3, F.coalesce(F.col("file_hash"), F.lit("x"))),
    }).select(kept)
    return breach_counts(spoiled, LANDING, landing_rules())
