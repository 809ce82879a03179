"""Stored pages to main content under canonical identifiers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from paperloom.catalog.registry import query
from paperloom.catalog.stand_ins import (
    ANCHOR, PAGE_DOCS_SQL, load, page_docs, page_sections, prior_transformed,
)
from paperloom.functions.html import select_first
from paperloom.functions.text import canonical_identifier
from paperloom.operators.transform import (
    candidates, pending, transform_counts, transform_rows, transformed_columns,
)
from paperloom.session import materialise
from paperloom.sources.pages import spread

RANGE = (ANCHOR, date(2024, 1, 25))

_PENDING_SQL = PAGE_DOCS_SQL + """,
candidates AS (SELECT * FROM page_landing WHERE partition_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-25'),
pending AS (SELECT * FROM candidates WHERE partition_date >= DATE '2024-01-11'),
cut AS (
  SELECT *, CASE WHEN section_id = 'lang_fr' THEN 'div.ad' ELSE 'article' END AS selector,
    CASE WHEN doc_type <> 'html' THEN html
         WHEN section_id = 'lang_fr' THEN NULLIF(regexp_extract(html, '(?s)<div class="ad">.*?</div>'), '')
         ELSE NULLIF(regexp_extract(html, '(?s)<article>.*?</article>'), '') END AS part
  FROM pending),
outcome AS (
  SELECT *, CASE WHEN part IS NULL THEN 'content_container ''' || selector || ''' matched nothing at ' || url
                 WHEN doc_type = 'html' AND trim(regexp_replace(part, '<[^>]*>', '', 'g')) = '' THEN 'content_container ''' || selector || ''' matched an empty node at ' || url
            END AS error,
         'PG-' || page_id || ' / A' AS canonical
  FROM cut)
"""
# The same outcome for every page, whatever its window.
_EVERY_SQL = _PENDING_SQL.replace("pending AS (SELECT * FROM candidates WHERE partition_date >= DATE '2024-01-11')", "pending AS (SELECT * FROM page_landing)")
_OUT_PATH = "'transformed/' || section_id || '/' || strftime(partition_date, '%Y-%m-%d') || '/v1/' || replace(replace(canonical, '/', '_'), ' ', '_') || '.' || doc_type"


def _found(spark, sf):
    return candidates(page_docs(spark, sf), *RANGE)


def _todo(spark, sf):
    narrow = _found(spark, sf).drop("content", "html", "content_type")
    return pending(narrow, prior_transformed(page_docs(spark, sf)))


def _every(spark, sf):
    return page_docs(spark, sf).drop("content", "html", "content_type")


def _outcome(spark, sf, rows=None):
    return transform_rows(_every(spark, sf) if rows is None else rows, page_docs(spark, sf), page_sections(spark, sf), run_id="run-1",
                          transformed_at=F.lit("2024-02-01").cast("timestamp"))


@query("join_3_diff_query", f"WITH {_PENDING_SQL} SELECT page_id, file_path FROM pending")
def diff(spark, sf):
    return _todo(spark, sf).select("page_id", "file_path")


@query("join_4_section_config", f"WITH {_EVERY_SQL} SELECT page_id, section_id, selector AS content_container FROM cut")
def section_config(spark, sf):
    sections = page_sections(spark, sf).select("section_id", "content_container")
    return _every(spark, sf).join(F.broadcast(sections), "section_id").select("page_id", "section_id", "content_container")


@query("join_5_content_by_path", f"WITH {_EVERY_SQL} SELECT page_id, sha256(html) AS content_hash FROM pending")
def by_path(spark, sf):
    content = page_docs(spark, sf).select("file_path", "content")
    return _every(spark, sf).join(content, "file_path", "left").select("page_id", F.sha2("content", 256).alias("content_hash"))


@query("trn_1_canonical_identifier", f"WITH {PAGE_DOCS_SQL} SELECT page_id, 'PG-' || page_id || ' / A' AS canonical FROM page_docs")
def canonical(spark, sf):
    return page_docs(spark, sf).select("page_id", canonical_identifier(F.col("identifier")).alias("canonical"))


@query("trn_2_content_container", """
SELECT page_id, NULLIF(regexp_extract(html, '(?s)<article>.*?</article>'), '') AS article,
       NULLIF(regexp_extract(html, '(?s)<div class="ad">.*?</div>'), '') AS ad FROM pages""")
def container(spark, sf):
    pages = spread(load(spark, sf, "pages"))
    return pages.select("page_id", select_first(F.col("html"), "article").alias("article"),
                        select_first(F.col("html"), "div.ad").alias("ad"))


@query("trn_3_dispatch_by_type", f"WITH {_EVERY_SQL} SELECT page_id, doc_type, CASE WHEN error IS NULL THEN part END AS new_content, error FROM outcome")
def dispatch(spark, sf):
    return _outcome(spark, sf).select("page_id", "doc_type", F.col("new_content").cast("string").alias("new_content"), "error")


@query("trn_4_transformed_key", f"WITH {_EVERY_SQL} SELECT page_id, {_OUT_PATH} AS file_path FROM outcome")
def keys(spark, sf):
    return _outcome(spark, sf).select("page_id", "file_path")


@query("trn_5_rehash", f"WITH {_EVERY_SQL} SELECT page_id, file_hash AS source_file_hash, CASE WHEN error IS NULL THEN sha256(part) END AS file_hash FROM outcome")
def rehash(spark, sf):
    return _outcome(spark, sf).select("page_id", "source_file_hash", "file_hash")


@query("trn_6_carry_forward", f"""WITH {_EVERY_SQL}
SELECT canonical AS identifier, version, 'web' AS source_id, section_id, 'Page ' || page_id AS title, '' AS description,
       CAST(NULL AS DATE) AS published_date, partition_date, url AS source_url, url AS doc_link, doc_type,
       file_path AS source_file_path, file_hash AS source_file_hash, {_OUT_PATH} AS file_path, sha256(part) AS file_hash, 'run-1' AS run_id
FROM outcome WHERE error IS NULL""")
def carry_forward(spark, sf):
    return transformed_columns(_outcome(spark, sf)).drop("transformed_at")


@query("trn_7_failures", """
SELECT page_id, 'content_container ''div.content'' matched nothing at ' || url AS error FROM pages WHERE html NOT LIKE '%class="content"%'
UNION ALL
SELECT page_id, NULL FROM pages WHERE html LIKE '%class="content"%'""")
def failures(spark, sf):
    """No given page has the container of another site: each fails alone and leaves its error."""
    from paperloom.operators.transform import with_container

    docs = page_docs(spark, sf, typed=False)
    return with_container(docs, "div.content", F.lit("div.content")).select("page_id", "error")


@query("trn_8_counts", f"""WITH {_PENDING_SQL}
SELECT c.section_id, count(*) AS candidates, count(*) FILTER (o.page_id IS NOT NULL AND o.error IS NULL) AS transformed,
       count(*) FILTER (o.page_id IS NULL) AS skipped, count(*) FILTER (o.error IS NOT NULL) AS failed
FROM candidates c LEFT JOIN outcome o ON c.page_id = o.page_id GROUP BY c.section_id""")
def counts(spark, sf):
    outcome = materialise(_outcome(spark, sf, _todo(spark, sf)).select("section_id", "error"), "outcome")
    return transform_counts(_found(spark, sf).select("section_id"), outcome, ["section_id"])


@query("trn_9_range_check", f"WITH {_PENDING_SQL} SELECT section_id, count(*) AS candidates FROM candidates GROUP BY section_id")
def range_check(spark, sf):
    """A range that ends before it starts is refused; a sound one gives its candidates."""
    try:
        candidates(page_docs(spark, sf), RANGE[1], RANGE[0])
    except ValueError:
        return _found(spark, sf).groupBy("section_id").agg(F.count(F.lit(1)).alias("candidates"))
    raise AssertionError("a reversed range was accepted")
