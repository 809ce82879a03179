"""Listing pages, links and fetch outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.catalog.registry import query
from paperloom.catalog.stand_ins import (
    LISTING_SQL, PAGE_DOCS_SQL, SELECTORS, listing_pages, load, page_docs,
)
from paperloom.functions.dates import engine_pattern, read_day
from paperloom.functions.formats import document_type, extension_of, media_type_of
from paperloom.functions.html import select_all, select_first, select_outer, attribute, text_of
from paperloom.functions.urls import link_target
from paperloom.config import SECTION_DDL, section_row
from paperloom.operators.extract import (
    allowed_requests, document_links, failed_rows, fetch_outcome, final_type, found_counts, listing_rows,
    next_pages, page_outcomes, retryable, row_fields, unified_items, unique_requests, with_row_fields, with_rows,
)
from paperloom.sources.pages import spread

# Text and link of the navigation entries of the raw pages, straight from their markup.
_NAV_SQL = """
nav AS (
  SELECT page_id, url, pos - 1 AS row_no, item
  FROM (SELECT page_id, url, unnest(items) AS item, generate_subscripts(items, 1) AS pos
        FROM (SELECT page_id, url, regexp_extract_all(html, '<li>.*?</li>') AS items FROM pages)))
"""
_ENTITIES_SQL = "replace(replace(replace({}, '&quot;', '\"'), '&lt;', '<'), '&amp;', '&')"


def _nav(spark, sf):
    pages = spread(load(spark, sf, "pages"))
    items = F.posexplode_outer(select_all(F.col("html"), "nav li")).alias("row_no", "item")
    return pages.select("page_id", "url", items).where(F.col("row_no").isNotNull())


@query("ext_1_listing_rows", f"WITH {_NAV_SQL} SELECT page_id, row_no, item FROM nav")
def rows_of_pages(spark, sf):
    return _nav(spark, sf).select("page_id", "row_no", "item")


@query("ext_1_unclosed_rows", f"WITH {_NAV_SQL} SELECT page_id, row_no, replace(item, '</li>', '') AS item FROM nav")
def unclosed_rows_of_pages(spark, sf):
    """The pages without the closing tags of their entries: each ends at the next, the last with its list."""
    pages = spread(load(spark, sf, "pages")).withColumn("html", F.replace("html", F.lit("</li>"), F.lit("")))
    items = F.posexplode(select_all(F.col("html"), "nav li")).alias("row_no", "item")
    return pages.select("page_id", items)


@query("ext_3_unclosed_cells", """
SELECT l_orderkey, l_linenumber, row_no, CASE row_no WHEN 0 THEN 'line ' || l_linenumber ELSE 'part ' || l_partkey END AS name,
       CASE row_no WHEN 0 THEN l_returnflag || ' inner row' ELSE l_linestatus END AS value
FROM lineitem, (SELECT unnest([0, 1]) AS row_no)""")
def unclosed_cells(spark, sf):
    """Each line as a table whose cells and rows have no closing tags, with a table in a cell."""
    page = F.concat(
        F.lit("<table><thead><tr><th class=name>name<th>value<tbody><tr class='r'><td class=name>line "), F.col("l_linenumber").cast("string"),
        F.lit("<td class=value>"), F.col("l_returnflag"), F.lit("<table><tr class=r><td class=name>inner<td>row</table><td>x<tr class=r><td class=name>part "),
        F.col("l_partkey").cast("string"), F.lit("<td class=value>"), F.col("l_linestatus"), F.lit("</tbody></table><p>after"))
    lines = spread(load(spark, sf, "lineitem")).select("l_orderkey", "l_linenumber", page.alias("html"))
    rows = lines.select("l_orderkey", "l_linenumber", F.posexplode(select_outer(F.col("html"), "tr.r")).alias("row_no", "row"))
    return rows.select("l_orderkey", "l_linenumber", "row_no", text_of(select_first(F.col("row"), "td.name")).alias("name"),
                       text_of(select_first(F.col("row"), "td.value")).alias("value"))


@query("ext_2_page_outcome", f"""WITH {LISTING_SQL}
SELECT o_orderkey AS page_no, n AS found, CASE WHEN n > 0 THEN 'ok' WHEN o_orderstatus = 'F' THEN 'empty' ELSE 'zero_match' END AS outcome,
       CASE WHEN n = 0 AND o_orderstatus <> 'F' THEN 'listing: listing_row ''li.order-line'' matched 0 rows at ' || page_url END AS fatal
FROM listing_orders""")
def outcomes_of_pages(spark, sf):
    return page_outcomes(with_rows(listing_pages(spark, sf), SELECTORS), SELECTORS).select("page_no", "found", "outcome", "fatal")


@query("ext_3_element_text", f"""WITH {_NAV_SQL}
SELECT page_id, row_no, {_ENTITIES_SQL.format("trim(regexp_replace(regexp_replace(item, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))")} AS text FROM nav""")
def element_text(spark, sf):
    return _nav(spark, sf).select("page_id", "row_no", text_of(F.col("item")).alias("text"))


def _pages(spark, sf):
    return with_row_fields(with_rows(listing_pages(spark, sf), SELECTORS), SELECTORS)


def _rows(spark, sf):
    return listing_rows(_pages(spark, sf), ["page_no", "section_id", "source_id"])


@query("ext_4_selector_fallback", f"""WITH {LISTING_SQL}
SELECT o_orderkey AS page_no, row_no, CASE WHEN no_id THEN NULL ELSE id_text END AS identifier_text FROM listing""")
def fallback(spark, sf):
    fields = row_fields(_pages(spark, sf), ["page_no"])
    return fields.select("page_no", "row_no", "identifier_text")


@query("ext_5_single_link", f"""WITH {LISTING_SQL}
SELECT o_orderkey AS page_no, row_no, CASE WHEN two_links THEN 2 ELSE 1 END AS links,
       CASE WHEN no_href THEN '' WHEN i = 1 THEN '/en/cases/' || key || '.html?ref=a b' WHEN i = 2 THEN ' cases/x*' || key || '.pdf'
            ELSE '../x/' || key || '.DOCX' END AS href
FROM listing""")
def single_link(spark, sf):
    fields = row_fields(_pages(spark, sf), ["page_no"])
    return fields.select("page_no", "row_no", "links", "href")


@query("ext_6_required_fields", f"WITH {LISTING_SQL} SELECT o_orderkey AS page_no, row_no, error_reason FROM listing")
def required(spark, sf):
    return _rows(spark, sf).select("page_no", "row_no", "error_reason")


@query("ext_7_date_parse", f"""WITH {LISTING_SQL}
SELECT o_orderkey AS page_no, row_no, CASE WHEN NOT no_date AND NOT bad_date THEN day END AS day FROM listing""")
def dates(spark, sf):
    return row_fields(_pages(spark, sf), ["page_no"]).select("page_no", "row_no", "day")


_FORMATS = ["%d %B %Y", "%b %d, %y", "%Y%m%d", "%j/%Y", "%d.%m.%Y at %H:%M o'clock"]


@query("ext_7_date_formats", "SELECT o_orderkey, n, text, CAST(d AS DATE) AS day FROM (" + " UNION ALL ".join(
    "SELECT o_orderkey, {n} AS n, o_orderdate AS d, strftime(o_orderdate, '{f}') AS text FROM orders".format(n=n, f=f.replace("'", "''"))
    for n, f in enumerate(_FORMATS)) + ")")
def date_formats(spark, sf):
    """Every order's date written in several formats and read again."""
    formats = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(engine_pattern(f, False)).alias("show"), F.lit(engine_pattern(f, True)).alias("read")) for n, f in enumerate(_FORMATS)])
    rows = spread(load(spark, sf, "orders")).select("o_orderkey", "o_orderdate", F.inline(formats))
    text = F.call_function("date_format", F.col("o_orderdate").cast("timestamp"), F.col("show"))
    return rows.withColumn("text", text).select("o_orderkey", "n", "text", read_day(F.col("text"), F.col("read")).alias("day"))


@query("ext_8_url_resolve", f"WITH {LISTING_SQL} SELECT o_orderkey AS page_no, row_no, link AS detail_link FROM listing WHERE error_reason IS NULL")
def urls(spark, sf):
    good = _rows(spark, sf).where(F.col("error_reason").isNull())
    return good.select("page_no", "row_no", "detail_link")


@query("ext_9_row_quarantine", f"""WITH {LISTING_SQL}
SELECT o_orderkey AS page_no, row_no, error_reason, 'unknown:' || substr(sha256(snippet), 1, 16) AS identifier, snippet
FROM (SELECT *, substr(trim(regexp_replace(row_html, '\\s+', ' ', 'g')), 1, 300) AS snippet FROM listing) WHERE error_reason IS NOT NULL""")
def quarantine(spark, sf):
    return failed_rows(_rows(spark, sf)).select("page_no", "row_no", "error_reason", "identifier", "snippet")


@query("ext_10_next_page", f"""WITH {LISTING_SQL}
SELECT o_orderkey AS page_no,
       CASE WHEN o_orderstatus = 'O' AND n <> 3 THEN site || '/en/search/?page=' || (o_orderkey + 1) || '&s=1' END AS next_page_url,
       CASE WHEN o_orderstatus = 'P' THEN 'next_page ''a.onward'' matched 2 elements at ' || page_url
            WHEN o_orderstatus = 'O' AND n = 3 THEN 'next_page ''a.onward'' matched no href at ' || page_url END AS next_page_error
FROM listing_orders""")
def next_links(spark, sf):
    return next_pages(listing_pages(spark, sf), SELECTORS).select("page_no", "next_page_url", "next_page_error")


@query("ext_11_document_link", """
WITH links AS (
  SELECT page_id, url, regexp_extract(html, '<nav>.*?<a href="([^"]*)"', 1) AS href FROM pages)
SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) ||
         replace(replace(replace(replace(replace(replace(replace(url_encode(replace(href, '&amp;', '&')), '%2F', '/'), '%3A', ':'), '%3F', '?'), '%26', '&'), '%3D', '='), '%7E', '~'), '%25', '%') AS document_url,
       NULLIF(CASE regexp_extract(href, '\\.(html|htm|pdf|docx|doc)$', 1) WHEN 'htm' THEN 'html' ELSE regexp_extract(href, '\\.(html|htm|pdf|docx|doc)$', 1) END, '') AS document_type
FROM links""")
def doc_links(spark, sf):
    """The first navigation entry stands for the link to the document."""
    row = section_row({"section_id": "x", "source_id": "web", "url": "https://example.org/", "partition_days": 30,
                       **{**SELECTORS, "doc_link": "nav a"}})
    section = spark.createDataFrame([row], SECTION_DDL).select("section_id", "doc_link", "doc_link_sel")
    pages = spread(load(spark, sf, "pages")).withColumn("section_id", F.lit("x")).withColumnRenamed("url", "page_url")
    found = document_links(pages.join(F.broadcast(section), "section_id"))
    return found.select("page_id", "document_url", "document_type")


@query("ext_12_document_type", f"WITH {PAGE_DOCS_SQL} SELECT page_id, doc_type FROM page_docs")
def doc_types(spark, sf):
    docs = page_docs(spark, sf)
    known = document_type(F.col("doc_link"))
    return docs.select("page_id", final_type(known, F.col("doc_link"), F.col("content_type")).alias("doc_type"))


@query("ext_13_found_count", f"WITH {LISTING_SQL} SELECT section_id, count(*) AS found FROM listing GROUP BY section_id")
def found(spark, sf):
    pages = page_outcomes(with_rows(listing_pages(spark, sf), SELECTORS), SELECTORS)
    return found_counts(pages, ["section_id"]).where("found > 0")


@query("ext_14_unified_items", f"""WITH {LISTING_SQL}
SELECT o_orderkey AS page_no, row_no,
       CASE WHEN error_reason IS NULL THEN id_text ELSE 'unknown:' || substr(sha256(snippet), 1, 16) END AS identifier,
       CASE WHEN error_reason IS NULL THEN 'Order & <' || key || '>' ELSE '' END AS title,
       CASE WHEN error_reason IS NULL THEN 'about ' || key || ' , order' ELSE '' END AS description,
       CASE WHEN error_reason IS NULL THEN day END AS published_date,
       CASE WHEN error_reason IS NULL THEN link ELSE page_url END AS source_url,
       CASE WHEN error_reason IS NULL THEN 'stored' ELSE 'failed' END AS status,
       CASE WHEN error_reason IS NOT NULL THEN 'listing_record' END AS stage, error_reason AS reason
FROM (SELECT *, substr(trim(regexp_replace(row_html, '\\s+', ' ', 'g')), 1, 300) AS snippet FROM listing)""")
def unified(spark, sf):
    return unified_items(_rows(spark, sf)).select(
        "page_no", "row_no", "identifier", "title", "description", "published_date", "source_url", "status",
        F.col("error.stage").alias("stage"), F.col("error.reason").alias("reason"))


@query("set_1_good_and_failed_items", f"""WITH {LISTING_SQL}
SELECT CASE WHEN error_reason IS NULL THEN 'stored' ELSE 'failed' END AS status, section_id, count(*) AS items FROM listing GROUP BY ALL""")
def good_and_failed(spark, sf):
    items = unified_items(_rows(spark, sf))
    return items.groupBy("status", "section_id").agg(F.count(F.lit(1)).alias("items"))


@query("ext_15_fetch_outcome", """
SELECT event_id, status,
  CASE WHEN status = 304 THEN 'skipped' WHEN status BETWEEN 200 AND 299 THEN 'stored' ELSE 'failed' END AS outcome,
  status IS NOT NULL AND status IN (408, 429, 500, 502, 503, 504) AS retry
FROM (SELECT event_id, CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 304 WHEN 'signup' THEN 404 WHEN 'error' THEN 500 + event_id % 5 END AS status FROM events)""")
def fetch_outcomes(spark, sf):
    status = (F.when(F.col("event_type") == "view", 200).when(F.col("event_type") == "click", 304)
              .when(F.col("event_type") == "signup", 404).when(F.col("event_type") == "error", 500 + F.col("event_id") % 5)).cast("int")
    answers = load(spark, sf, "events").select("event_id", status.alias("status"))
    codes = F.array(*map(F.lit, (408, 429, 500, 502, 503, 504)))
    no_failure = F.lit(None).cast("string")
    return answers.select("event_id", "status", fetch_outcome(F.col("status"), no_failure).alias("outcome"),
                          retryable(F.col("status"), codes).alias("retry"))


_RULES = {"com": ["/fr/", "/en/1"], "net": ["/de/", "/"], "org": ["/es/2", "/fr/9"]}
_ROBOTS_SQL = """
requests AS (SELECT page_id, url, regexp_extract(url, '^https?://[^/?#]*\\.([a-z]+)', 1) AS source_id,
                    regexp_extract(url, '^https?://[^/?#]*([^#]*)', 1) AS path FROM pages),
rules(source_id, prefix) AS (VALUES ('com', '/fr/'), ('com', '/en/1'), ('net', '/de/'), ('net', '/'), ('org', '/es/2'), ('org', '/fr/9'))
"""


def _robots(spark, sf):
    pages = load(spark, sf, "pages").select("page_id", "url", F.regexp_extract("url", r"^https?://[^/?#]*\.([a-z]+)", 1).alias("source_id"))
    rules = spark.createDataFrame(list(_RULES.items()), "source_id string, disallow array<string>")
    return allowed_requests(pages, rules, "url")


@query("ext_16_robots_filter", f"""WITH {_ROBOTS_SQL}
SELECT page_id, source_id FROM requests r WHERE NOT EXISTS (
  SELECT 1 FROM rules u WHERE u.source_id = r.source_id AND starts_with(r.path, u.prefix))""")
def robots(spark, sf):
    return _robots(spark, sf).select("page_id", "source_id")


@query("join_7_prefix_anti", f"""WITH {_ROBOTS_SQL}
SELECT source_id, count(*) AS allowed FROM requests r WHERE NOT EXISTS (
  SELECT 1 FROM rules u WHERE u.source_id = r.source_id AND starts_with(r.path, u.prefix)) GROUP BY source_id""")
def prefix_anti(spark, sf):
    return _robots(spark, sf).groupBy("source_id").agg(F.count(F.lit(1)).alias("allowed"))


@query("ext_17_request_dedup", f"""WITH {_NAV_SQL},
links AS (SELECT page_id, row_no, page_id * 1048576 + row_no AS seq, regexp_extract(url, '^(https?://[^/]+)', 1) AS site,
                 regexp_extract(item, 'href="([^"]*)"', 1) AS href FROM nav)
SELECT site, href, seq FROM (SELECT *, row_number() OVER (PARTITION BY site, href ORDER BY seq) AS rn FROM links) WHERE rn = 1""")
def dedup(spark, sf):
    site = F.regexp_extract("url", r"^(https?://[^/]+)", 1)
    links = _nav(spark, sf).select(
        site.alias("site"), F.regexp_extract("item", 'href="([^"]*)"', 1).alias("href"),
        (F.col("page_id") * 1048576 + F.col("row_no")).alias("seq"))
    return unique_requests(links, ["site"], "href", "seq")


@query("cnt_5_type_maps", f"""WITH {PAGE_DOCS_SQL}
SELECT page_id, doc_type AS extension, CASE doc_type WHEN 'html' THEN 'text/html' WHEN 'pdf' THEN 'application/pdf' WHEN 'doc' THEN 'application/msword'
  WHEN 'docx' THEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' ELSE 'application/octet-stream' END AS media_type
FROM page_docs""")
def type_maps(spark, sf):
    return page_docs(spark, sf).select("page_id", extension_of(F.col("doc_type")).alias("extension"),
                                       media_type_of(F.col("doc_type")).alias("media_type"))


@query("fn_1_link_target", f"""WITH {_NAV_SQL}
SELECT page_id, row_no, regexp_extract(url, '^(https?://[^/]+)', 1) ||
  replace(replace(replace(replace(replace(replace(replace(url_encode(replace(regexp_extract(item, 'href="([^"]*)"', 1), '&amp;', '&')), '%2F', '/'), '%3A', ':'), '%3F', '?'), '%26', '&'), '%3D', '='), '%7E', '~'), '%25', '%') AS target
FROM nav""")
def link_targets(spark, sf):
    href = attribute(select_first(F.col("item"), "a"), "href")
    return _nav(spark, sf).select("page_id", "row_no", link_target(F.col("url"), href).alias("target"))
