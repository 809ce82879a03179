"""The engine's inputs, derived from the given tables.

Each stand-in exists twice: as a DataFrame, and as a common table expression
for the SQL twins.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.config import SECTION_DDL, section_row
from paperloom.functions.content import TRANSFORMED_BUCKET, content_hash, path_in
from paperloom.functions.formats import document_type
from paperloom.operators.landing import changed_items, new_versions, with_paths, with_stable_content
from paperloom.operators.planning import window_of
from paperloom.sources.pages import spread

ANCHOR = date(2024, 1, 1)
SPLIT = "2024-01-16"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- crawl log: what arrived, in order, from events -----------------------

def crawl_log(events: DataFrame) -> DataFrame:
    """Items with bytes, as a crawl hands them over."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    section = F.concat(F.lit("sec_"), F.element_at(F.array(*map(F.lit, "abcd")), (F.col("user_id") % 4 + 1).cast("int")))
    days = F.element_at(F.array(*map(F.lit, (3, 7, 10, 31))), (F.col("user_id") % 4 + 1).cast("int"))
    day = F.col("ts").cast("date")
    body = F.concat("event_type", F.lit(":"), (k % 10).cast("string"))
    is_pdf = F.col("event_type") == "purchase"
    html = F.concat(F.lit("<!-- served "), F.col("event_id").cast("string"), F.lit(" --><p>"), body, F.lit("</p>"))
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").alias("seq"),
        F.format_string("ADJ - %06d", "user_id").alias("identifier"),
        F.lit("src").alias("source_id"),
        section.alias("section_id"),
        F.concat(F.lit("Case "), F.col("user_id").cast("string")).alias("title"),
        F.lit("").alias("description"),
        day.alias("published_date"),
        window_of(day, F.lit(ANCHOR), days).alias("partition_date"),
        F.concat(F.lit("https://docs.example.org/"), F.col("user_id").cast("string")).alias("source_url"),
        F.concat(F.lit("https://docs.example.org/"), F.col("user_id").cast("string"), F.lit("/"),
                 (k % 3).cast("string")).alias("doc_link"),
        F.when(failed, "unknown").when(is_pdf, "pdf").otherwise("html").alias("doc_type"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("etag-"), F.col("event_id").cast("string"))).alias("etag"),
        F.lit(None).cast("string").alias("proxy"),
        F.when(failed, "failed").otherwise("stored").alias("status"),
        F.when(failed, F.struct(
            F.lit("download").alias("stage"), F.concat(F.lit("HTTP status "), (F.lit(500) + k % 5).cast("string")).alias("reason"),
            F.concat(F.lit("https://docs.example.org/"), F.col("user_id").cast("string")).alias("url"),
            (F.lit(500) + k % 5).cast("int").alias("status_code"))).alias("error"),
        F.col("ts").cast("timestamp").alias("scraped_at"),
        F.concat(F.lit("run-"), day.cast("string")).alias("run_id"),
        F.when(failed, F.lit(None)).otherwise(F.when(is_pdf, body).otherwise(html)).cast("binary").alias("content"),
        F.col("ts").alias("ts"),
    )


CRAWL_LOG_SQL = """
crawl_raw AS (
  SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k, CAST(ts AS DATE) AS day,
         CASE user_id % 4 WHEN 0 THEN 3 WHEN 1 THEN 7 WHEN 2 THEN 10 ELSE 31 END AS days
  FROM events),
crawl_log AS (
  SELECT event_id AS seq, printf('ADJ - %06d', user_id) AS identifier, 'src' AS source_id,
         CASE user_id % 4 WHEN 0 THEN 'sec_a' WHEN 1 THEN 'sec_b' WHEN 2 THEN 'sec_c' ELSE 'sec_d' END AS section_id,
         day AS published_date,
         CAST(DATE '2024-01-01' + CAST(floor(date_diff('day', DATE '2024-01-01', day) / days) AS INTEGER) * days AS DATE) AS partition_date,
         'https://docs.example.org/' || user_id AS source_url,
         'https://docs.example.org/' || user_id || '/' || (k % 3) AS doc_link,
         CASE event_type WHEN 'error' THEN 'unknown' WHEN 'purchase' THEN 'pdf' ELSE 'html' END AS doc_type,
         CASE WHEN event_id % 3 <> 0 THEN 'etag-' || event_id END AS etag,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'stored' END AS status,
         CASE WHEN event_type = 'error' THEN 500 + k % 5 END AS status_code,
         'run-' || strftime(day, '%Y-%m-%d') AS run_id, ts, day,
         CASE event_type WHEN 'error' THEN NULL WHEN 'purchase' THEN event_type || ':' || (k % 10)
              ELSE '<!-- served ' || event_id || ' --><p>' || event_type || ':' || (k % 10) || '</p>' END AS content
  FROM crawl_raw),
staged AS (
  SELECT *, CASE WHEN doc_type = 'html' THEN regexp_replace(content, '<!--.*?-->', '', 'gs') ELSE content END AS stable,
         sha256(CASE WHEN doc_type = 'html' THEN regexp_replace(content, '<!--.*?-->', '', 'gs') ELSE content END) AS file_hash
  FROM crawl_log),
kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY identifier, coalesce(file_hash, 'seq:' || seq) ORDER BY seq) AS rn FROM staged)
  WHERE rn = 1),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY seq) AS version FROM kept),
landing AS (
  SELECT *, CASE WHEN status = 'stored' THEN 'landing-zone/' || section_id || '/' || strftime(partition_date, '%Y-%m-%d') || '/'
           || replace(replace(identifier, '/', '_'), ' ', '_') || '/v' || version || '.' || doc_type END AS file_path
  FROM numbered)
"""


def staged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_stable_content(crawl_log(load(spark, sf_dir, "events")))


def no_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "identifier string, file_hash string, status string, version int")


def log_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(F.col("event_id").alias("seq"))


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table after the whole log came in."""
    return new_versions(staged_log(spark, sf_dir), no_history(spark), log_order(spark, sf_dir))


def history_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Landing rows of the first half month, and the staged rest."""
    staged = staged_log(spark, sf_dir)
    early = F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")
    history = new_versions(staged.where(early), no_history(spark), log_order(spark, sf_dir))
    return history, staged.where(~early)


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each log row with what became of it."""
    staged = staged_log(spark, sf_dir).drop("content")
    kept = changed_items(staged, no_history(spark)).select("seq", F.lit(True).alias("kept"))
    outcome = F.when(F.col("status") == "failed", "failed").when(F.col("kept"), "stored").otherwise("skipped")
    return staged.join(kept, "seq", "left").withColumn("outcome", outcome)


OUTCOMES_SQL = CRAWL_LOG_SQL + """,
outcomes AS (
  SELECT s.*, CASE WHEN s.status = 'failed' THEN 'failed' WHEN k.seq IS NOT NULL THEN 'stored' ELSE 'skipped' END AS outcome
  FROM staged s LEFT JOIN kept k ON s.seq = k.seq)
"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition attempts: one in the morning, one in the afternoon of a run."""
    keys = ["run_id", "section_id", "partition_date"]
    found = outcomes(spark, sf_dir).withColumn("attempt", F.when(F.hour("ts") < 12, 1).otherwise(2))
    counted = found.groupBy(*keys, "attempt").agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(F.col("outcome") == "stored").alias("scraped"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped_unchanged"),
        F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"),
    )
    days = F.element_at(F.create_map(*[F.lit(v) for pair in
                                       [("sec_a", 3), ("sec_b", 7), ("sec_c", 10), ("sec_d", 31)] for v in pair]),
                        F.col("section_id"))
    reason = (F.when(F.col("failed") * 4 > F.col("found"), "listing_failed")
              .when(F.col("failed") * 5 > F.col("found"), "zero_match").otherwise("finished"))
    return (
        counted.withColumn("source_id", F.concat(F.lit("src_"), F.col("attempt").cast("string")))
        .withColumn("window_start", F.col("partition_date"))
        .withColumn("window_end", F.date_add("partition_date", days - 1))
        .withColumn("finish_reason", reason)
        .withColumn("message", F.when(F.col("finish_reason") == "listing_failed",
                                      F.concat(F.lit("listing fetch failed: "), F.col("section_id"))))
        .withColumn("recorded_at", F.col("finished_at"))
    )


ATTEMPTS_SQL = OUTCOMES_SQL + """,
attempts AS (
  SELECT *, 'src_' || attempt AS source_id, partition_date AS window_start,
         CAST(partition_date + (CASE section_id WHEN 'sec_a' THEN 3 WHEN 'sec_b' THEN 7 WHEN 'sec_c' THEN 10 ELSE 31 END) - 1 AS DATE) AS window_end,
         CASE WHEN failed * 4 > found THEN 'listing_failed' WHEN failed * 5 > found THEN 'zero_match' ELSE 'finished' END AS finish_reason,
         CASE WHEN failed * 4 > found THEN 'listing fetch failed: ' || section_id END AS message,
         finished_at AS recorded_at
  FROM (SELECT run_id, section_id, partition_date, CASE WHEN hour(ts) < 12 THEN 1 ELSE 2 END AS attempt,
               count(*) AS found, count(*) FILTER (outcome = 'stored') AS scraped,
               count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'skipped') AS skipped_unchanged,
               min(ts) AS started_at, max(ts) AS finished_at
        FROM outcomes GROUP BY ALL))
"""


def stamp(column: str):
    """A timestamp as text, the same in both engines."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def stamp_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {column}"


# --- listing pages: one page per order, with known contents -----------------

SELECTORS = {
    "listing_row": "li.order-line", "empty_result": "div.no-orders", "identifier": ["span.order-no", "span.order-alias"],
    "title": "h3.caption", "description": "p.gist", "published_date": "em.dated",
    "detail_link": "h3.caption a.to", "next_page": "a.onward", "doc_link": None, "content_container": "section.body",
}

_KEY = "o_orderkey || '-' || i"
_ROW = (
    "'<li class=\"odd order-line\" data-n=''x>' || i || '''>  <span class=order-no>' || "
    "CASE WHEN (o_orderpriority = '2-HIGH' AND i = 2) OR (o_orderpriority = '1-URGENT' AND i = 3) THEN ' ' "
    "ELSE 'ORD / ' || {key} END || '</span><span class=\"order-alias\">' || "
    "CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE 'alt ' || {key} END || "
    "'</span><h3 class=\"caption\">' || "
    "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND i = 1 THEN '<a class=to>' ELSE '<a class=to href=\"' || {href} || '\">' END || "
    "CASE WHEN o_orderpriority = '5-LOW' AND i = 1 THEN '  ' ELSE 'Order &amp; &lt;' || {key} || '&gt;' END || '</a>' || "
    "CASE WHEN o_orderpriority = '3-MEDIUM' AND i = 1 THEN '<a class=\"to\" href=\"/second\">again</a>' ELSE '' END || "
    "'</h3><p class=\"gist\">' || "
    "CASE WHEN o_orderpriority = '1-URGENT' AND i = 1 THEN '<b> </b>' ELSE 'about <b>' || {key} || '</b>,  order' END || "
    "'</p><EM class=\"dated\">' || {day} || '</EM></li>'"
)
_HREF = (
    "CASE i WHEN 1 THEN '/en/cases/' || {key} || '.html?ref=a b' WHEN 2 THEN ' cases/x*' || {key} || '.pdf' "
    "ELSE '../x/' || {key} || '.DOCX' END"
)
_DAY = (
    "CASE WHEN o_orderpriority = '2-HIGH' AND i = 1 THEN '' WHEN o_orderpriority = '3-MEDIUM' AND i = 2 THEN '31/02/2024' "
    "WHEN o_orderpriority = '4-NOT SPECIFIED' AND i = 2 THEN '1/2/124' ELSE {day_text} END"
)


def _row_template(day_text: str) -> str:
    return _ROW.format(key=_KEY, href=_HREF.format(key=_KEY), day=_DAY.format(day_text=day_text))


_SPARK_ROW = _row_template("date_format(date_add(CAST(o_orderdate AS DATE), CAST(i AS INT)), CASE WHEN i = 1 THEN 'd/M/yyyy' ELSE 'dd/MM/yyyy' END)")
_DUCK_ROW = _row_template("CASE WHEN i = 1 THEN strftime(CAST(o_orderdate AS DATE) + CAST(i AS INTEGER), '%-d/%-m/%Y') "
                          "ELSE strftime(CAST(o_orderdate AS DATE) + CAST(i AS INTEGER), '%d/%m/%Y') END")


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing page of up to three rows per order, joined with its section."""
    orders = spread(load(spark, sf_dir, "orders"))
    head = "'<html><body><!-- <li class=\"order-line\">old</li> --><script>var s = \"<li class=''order-line''>\";</script>'"
    mark = ("CASE WHEN n = 0 AND o_orderstatus = 'F' THEN '<div class=\"no-orders\">nothing found</div>' ELSE '' END")
    link = ("CASE WHEN o_orderstatus = 'O' AND n = 3 THEN '<a class=\"onward\">next</a>' "
            "WHEN o_orderstatus = 'O' THEN '<a class=\"btn onward\" href=\"?page=' || (o_orderkey + 1) || '&amp;s=1\">next</a>' "
            "WHEN o_orderstatus = 'P' THEN '<a class=\"onward\" href=\"?a\">1</a><a class=\"onward\" href=\"?b\">2</a>' ELSE '' END")
    rows = f"CASE WHEN n > 0 THEN array_join(transform(sequence(1L, n), i -> {_SPARK_ROW}), '\\n') ELSE '' END"
    pages = orders.withColumn("n", F.col("o_custkey") % 4).select(
        F.col("o_orderkey").alias("page_no"),
        F.concat(F.lit("https://site"), (F.col("o_custkey") % 7).cast("string"),
                 F.lit(".example.org/en/search/?page="), F.col("o_orderkey").cast("string")).alias("page_url"),
        F.concat(F.lit("sec_"), F.lower(F.substring("o_orderstatus", 1, 1))).alias("section_id"),
        F.expr(f"{head} || {mark} || '<ul>' || {rows} || '</ul>' || {link} || '</body></html>'").alias("html"),
    )
    return pages.join(F.broadcast(listing_sections(spark)), "section_id")


def listing_sections(spark: SparkSession, **selectors) -> DataFrame:
    """Sections of the listing pages, one per order status."""
    rows = [section_row({
        "section_id": f"sec_{status}", "source_id": "orders", "url": "https://site.example.org/en/search/",
        "partition_days": 30, **{**SELECTORS, **selectors},
    }) for status in "fop"]
    return spark.createDataFrame(rows, SECTION_DDL).withColumn("date_parse", F.lit("d/M/yyyy"))


LISTING_SQL = f"""
listing_orders AS (
  SELECT *, o_custkey % 4 AS n,
         'https://site' || (o_custkey % 7) || '.example.org/en/search/?page=' || o_orderkey AS page_url,
         'https://site' || (o_custkey % 7) || '.example.org' AS site,
         'sec_' || lower(o_orderstatus[1]) AS section_id
  FROM orders),
listing_raw AS (
  SELECT *, {_KEY} AS key, {_DUCK_ROW} AS row_html,
         (o_orderpriority = '1-URGENT' AND i = 3) AS no_id,
         (o_orderpriority = '3-MEDIUM' AND i = 1) AS two_links,
         (o_orderpriority = '4-NOT SPECIFIED' AND i = 1) AS no_href,
         (o_orderpriority = '5-LOW' AND i = 1) AS no_title,
         (o_orderpriority = '1-URGENT' AND i = 1) AS no_description,
         (o_orderpriority = '2-HIGH' AND i = 1) AS no_date,
         (o_orderpriority = '3-MEDIUM' AND i = 2) OR (o_orderpriority = '4-NOT SPECIFIED' AND i = 2) AS bad_date,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN '31/02/2024' ELSE '1/2/124' END AS bad_date_text,
         CASE WHEN o_orderpriority = '2-HIGH' AND i = 2 THEN 'alt ' ELSE 'ORD / ' END || {_KEY} AS id_text
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM listing_orders)),
listing AS (
  SELECT *, i - 1 AS row_no,
    CASE WHEN no_id THEN 'identifier selectors [''span.order-no'', ''span.order-alias''] matched no text at ' || page_url
         WHEN two_links THEN 'detail_link ''h3.caption a.to'' matched 2 elements for ''' || id_text || ''' at ' || page_url
         WHEN no_href THEN 'detail_link ''h3.caption a.to'' matched no href for ''' || id_text || ''' at ' || page_url
         WHEN no_title THEN 'title ''h3.caption'' matched no text for ''' || id_text || ''' at ' || page_url
         WHEN no_description THEN 'description ''p.gist'' matched no text for ''' || id_text || ''' at ' || page_url
         WHEN no_date THEN 'published_date ''em.dated'' matched no text for ''' || id_text || ''' at ' || page_url
         WHEN bad_date THEN 'published_date ''em.dated'' matched invalid date ''' || bad_date_text || ''' for ''' || id_text || ''' at ' || page_url
    END AS error_reason,
    CASE i WHEN 1 THEN site || '/en/cases/' || key || '.html?ref=a%20b'
           WHEN 2 THEN site || '/en/search/cases/x%2A' || key || '.pdf'
           ELSE site || '/en/x/' || key || '.DOCX' END AS link,
    CAST(CAST(o_orderdate AS DATE) + CAST(i AS INTEGER) AS DATE) AS day
  FROM listing_raw)
"""


# --- document pages: the given raw web pages ---------------------------------

_MEDIA = ("text/html; charset=utf-8", "application/pdf", "Application/MSWord",
          "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "image/png")


def page_docs(spark: SparkSession, sf_dir: str, *, typed: bool = True) -> DataFrame:
    """Landing rows of the raw pages, content included."""
    pages = spread(load(spark, sf_dir, "pages"))
    media = F.element_at(F.array(*map(F.lit, _MEDIA)), (F.col("page_id") % 5 + 1).cast("int"))
    doc_type = F.coalesce(document_type(F.col("url"), media), F.lit("bin")) if typed else F.lit("html")
    rows = pages.select(
        F.concat(F.lit(" pg \N{EN DASH} "), F.col("page_id").cast("string"), F.lit("  / a ")).alias("identifier"),
        F.lit(1).alias("version"),
        F.lit("web").alias("source_id"),
        F.concat(F.lit("lang_"), F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1)).alias("section_id"),
        F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("title"),
        F.lit("").alias("description"),
        F.lit(None).cast("date").alias("published_date"),
        F.date_add(F.lit(ANCHOR), (F.length("html") % 31).cast("int")).alias("partition_date"),
        F.col("url").alias("source_url"), F.col("url").alias("doc_link"),
        doc_type.alias("doc_type"), F.lit("stored").alias("status"),
        media.alias("content_type"),
        F.col("html").cast("binary").alias("content"),
        F.col("page_id"), F.col("html"),
    )
    rows = with_paths(rows)
    return rows.withColumn("file_hash", content_hash(F.col("content")))


PAGE_DOCS_SQL = """
page_typed AS (
  SELECT *, CASE page_id % 5 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'application/pdf' WHEN 2 THEN 'Application/MSWord'
                WHEN 3 THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' ELSE 'image/png' END AS content_type,
         regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS url_path
  FROM pages),
page_docs AS (
  SELECT page_id, url, html, content_type, ' pg – ' || page_id || '  / a ' AS identifier, 1 AS version,
         'lang_' || regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS section_id,
         CAST(DATE '2024-01-01' + CAST(length(html) % 31 AS INTEGER) AS DATE) AS partition_date,
         CASE WHEN url_path LIKE '%.html' THEN 'html' ELSE
           CASE page_id % 5 WHEN 0 THEN 'html' WHEN 1 THEN 'pdf' WHEN 2 THEN 'doc' WHEN 3 THEN 'docx' ELSE 'bin' END END AS doc_type
  FROM page_typed),
page_landing AS (
  SELECT *, sha256(html) AS file_hash,
         'landing-zone/' || section_id || '/' || strftime(partition_date, '%Y-%m-%d') || '/' ||
         replace(replace(identifier, '/', '_'), ' ', '_') || '/v1.' || doc_type AS file_path
  FROM page_docs)
"""

PRIOR_BEFORE = date(2024, 1, 11)


def prior_transformed(docs: DataFrame) -> DataFrame:
    """Outputs of an earlier run that covered the windows before a date."""
    return docs.where(F.col("partition_date") < F.lit(PRIOR_BEFORE)).select(
        F.col("file_path").alias("source_file_path"),
        path_in(TRANSFORMED_BUCKET, F.col("page_id").cast("string")).alias("file_path"),
    )


def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One section per language that the site serves; the ad box of French pages is their document."""
    rows = [section_row({
        "section_id": f"lang_{lang}", "source_id": "web", "url": "https://example.org/", "partition_days": 30,
        **{**SELECTORS, "content_container": "div.ad" if lang == "fr" else "article"},
    }) for lang in ("en", "de", "fr", "es")]
    return spark.createDataFrame(rows, SECTION_DDL)


# --- sections with date ranges: customers and their orders -------------------

def customer_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section per customer, active from its first to its last order."""
    orders = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("date").alias("day"))
    spans = orders.groupBy("c_custkey").agg(F.min("day").alias("start_day"), F.max("day").alias("end_day"))
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return spans.join(customers, "c_custkey").select(
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("source_id"),
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("section_id"),
        "c_custkey", "c_nationkey", "start_day", "end_day",
        F.when(F.col("c_custkey") % 2 == 0, 30).otherwise(365).alias("partition_days"),
    )


CUSTOMER_SECTIONS_SQL = """
sections AS (
  SELECT 'nation_' || c_nationkey AS source_id, 'cust_' || c_custkey AS section_id, c_custkey, c_nationkey,
         start_day, end_day, CASE WHEN c_custkey % 2 = 0 THEN 30 ELSE 365 END AS partition_days
  FROM customer JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS start_day, max(CAST(o_orderdate AS DATE)) AS end_day
                      FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey),
windows AS (
  SELECT *, least(CAST(partition_date + partition_days - 1 AS DATE), end_day) AS window_end
  FROM (SELECT *, CAST(unnest(generate_series(CAST(start_day AS TIMESTAMP), CAST(end_day AS TIMESTAMP), to_days(partition_days))) AS DATE) AS partition_date
        FROM sections))
"""
