"""Whole crawls from archives: next pages, lost listings, answers of runs, request identity."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.catalog.registry import query
from paperloom.catalog.stand_ins import SELECTORS, listing_sections, load, stamp, stamp_sql
from paperloom.operators.answers import answers_of_runs
from paperloom.operators.extract import unique_requests
from paperloom.plans.crawl_job import fetch_listings
from paperloom.plans.frontier import DEEPEST, follow
from paperloom.sources.pages import spread

# A customer's orders are the pages of one listing, linked in order. The last page leads nowhere, back to the
# first one, or to a page that isn't there. Links name the parameters in another order than the archive.
_CHAINS_SQL = """
pages AS (SELECT o_orderkey AS k, o_custkey AS c, CASE WHEN o_orderkey % 11 = 5 THEN 503 ELSE 200 END AS status,
                 row_number() OVER w AS n, lead(o_orderkey) OVER w AS following, first_value(o_orderkey) OVER w AS head
          FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
links AS (SELECT *, CASE WHEN following IS NOT NULL THEN following WHEN c % 3 = 0 THEN head WHEN c % 3 = 2 THEN -c END AS target FROM pages),
"""
_CRAWLED_SQL = "WITH RECURSIVE" + _CHAINS_SQL + """
crawled(c, k, depth) AS (
  SELECT c, k, 0 FROM pages WHERE n = 1
  UNION ALL
  SELECT r.c, l.target, r.depth + 1 FROM crawled r JOIN links l ON l.k = r.k AND l.c = r.c
  WHERE l.status = 200 AND l.target IS NOT NULL AND l.target <> l.head),
named AS (SELECT c, k, depth, 'https://list.example.org/en/search/?' || CASE WHEN depth = 0 THEN 'page=' || k || '&c=' || c ELSE 'c=' || c || '&page=' || k END AS page_url FROM crawled)
"""


def _archive(spark, sf):
    """One answer per order, with the link to the customer's next one."""
    orders = spread(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey")
    ordered = "OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    target = ("coalesce(lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), "
              f"CASE o_custkey % 3 WHEN 0 THEN first_value(o_orderkey) {ordered} WHEN 2 THEN -o_custkey END)")
    linked = orders.select("o_orderkey", "o_custkey", F.expr(target).alias("target"), F.expr(f"first_value(o_orderkey) {ordered}").alias("head"))
    link = F.when(F.col("target").isNotNull(), F.format_string('<a class="onward" href="?c=%d&amp;page=%d">next</a>', "o_custkey", "target"))
    none = F.lit(None).cast("string")
    archive = linked.select(
        F.format_string("https://list.example.org/en/search/?page=%d&c=%d", "o_orderkey", "o_custkey").alias("url"),
        F.when(F.col("o_orderkey") % 11 == 5, 503).otherwise(200).alias("status"), F.lit("text/html").alias("content_type"),
        none.alias("etag"), none.alias("proxy"), F.encode(F.concat(F.lit("<ul></ul>"), F.coalesce(link, F.lit(""))), "UTF-8").alias("body"),
        none.alias("failure"), F.lit(None).cast("timestamp").alias("fetched_at"))
    starts = linked.where(F.col("o_orderkey") == F.col("head")).select(
        F.lit("run").alias("run_id"), F.lit("sec_f").alias("section_id"), F.to_date(F.lit("2024-01-01")).alias("partition_date"),
        F.col("o_custkey").alias("start_no"), F.format_string("https://list.example.org/en/search/?page=%d&c=%d", "o_orderkey", "o_custkey").alias("page_url"))
    return archive, starts


@query("ext_10_follow_pages", f"{_CRAWLED_SQL} SELECT c AS start_no, depth, page_url FROM named")
def follow_pages(spark, sf):
    archive, starts = _archive(spark, sf)
    found = follow(starts, answers_of_runs(archive), listing_sections(spark), SELECTORS)
    return found.select("start_no", "depth", "page_url")


@query("ext_15_listing_failure", f"""{_CRAWLED_SQL}
SELECT n.c AS start_no, depth, page_url, 'listing fetch failed: ' || page_url || ' — ' || CASE WHEN p.k IS NULL THEN 'no response' ELSE 'HTTP status 503' END AS fatal
FROM named n LEFT JOIN pages p ON p.k = n.k WHERE p.k IS NULL OR p.status <> 200""")
def listing_failures(spark, sf):
    archive, starts = _archive(spark, sf)
    _, lost = fetch_listings(starts, archive, listing_sections(spark), shared=SELECTORS)
    return lost.select(F.floor(F.col("page_no") / DEEPEST).alias("start_no"), (F.col("page_no") % DEEPEST).alias("depth"), "page_url", "fatal")


@query("join_2_answer_of_run", f"""
WITH runs AS (SELECT DISTINCT date_trunc('day', ts) AS started_at FROM events WHERE day(ts) % 3 = 0),
answers AS (SELECT 'https://x.example.org/?u=' || (user_id % 40) AS url, ts AS fetched_at,
                   CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 304 WHEN 'error' THEN 500 ELSE 404 END AS status FROM events),
known AS (SELECT a.*, 'run-' || strftime(r.started_at, '%Y%m%d') AS run_id FROM answers a ASOF JOIN runs r ON a.fetched_at >= r.started_at)
SELECT run_id, url, {stamp_sql('fetched_at')}, status FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, url ORDER BY fetched_at DESC, status) AS n FROM known) WHERE n = 1""")
def answer_of_run(spark, sf):
    events = load(spark, sf, "events")
    status = F.when(F.col("event_type") == "view", 200).when(F.col("event_type") == "click", 304).when(F.col("event_type") == "error", 500).otherwise(404)
    none = F.lit(None).cast("string")
    archive = events.select(
        F.concat(F.lit("https://x.example.org/?u="), (F.col("user_id") % 40).cast("string")).alias("url"), F.col("ts").cast("timestamp").alias("fetched_at"),
        status.alias("status"), none.alias("content_type"), none.alias("etag"), none.alias("proxy"), none.alias("body"), none.alias("failure"))
    starts = events.where(F.day("ts") % 3 == 0).select(F.date_trunc("day", F.col("ts").cast("timestamp")).alias("started_at")).distinct()
    runs = starts.select(F.concat(F.lit("run-"), F.date_format("started_at", "yyyyMMdd")).alias("run_id"), "started_at")
    return answers_of_runs(archive, runs).select("run_id", "url", stamp("fetched_at"), "status")


@query("ext_17_request_identity", """
WITH requests AS (
  SELECT o_orderkey * 2 + i AS seq, 'site' || (o_custkey % 7) AS site, o_custkey AS c, o_orderstatus AS s FROM orders, range(2) t(i))
SELECT site, c, s, min(seq) AS seq FROM requests GROUP BY ALL""")
def request_identities(spark, sf):
    """Requests for the same list, with parameters in either order, quoted or not, some with a fragment."""
    orders = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"), F.explode(F.array(F.lit(0), F.lit(1))).alias("i"))
    site = F.concat(F.lit("site"), (F.col("c") % 7).cast("string"))
    plain = F.concat(F.lit("https://"), site, F.lit(".example.org/list?c="), F.col("c").cast("string"), F.lit("&s="), F.col("s"))
    turned = F.concat(F.lit("HTTPS://"), F.upper(site), F.lit(".example.org/list?s=%"), F.hex(F.ascii("s")), F.lit("&c="), F.col("c").cast("string"), F.lit("#row"))
    requests = orders.select((F.col("o_orderkey") * 2 + F.col("i")).alias("seq"), site.alias("site"), "c", "s", F.when(F.col("i") == 0, plain).otherwise(turned).alias("url"))
    return unique_requests(requests, ["site"], "url", "seq").select("site", "c", "s", "seq")
