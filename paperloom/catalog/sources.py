"""Scans, dimensions and the stored tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from paperloom.catalog.registry import query
from paperloom.catalog.stand_ins import (
    ATTEMPTS_SQL, CRAWL_LOG_SQL, CUSTOMER_SECTIONS_SQL, PAGE_DOCS_SQL, attempts, crawl_log, customer_sections, landing,
    load, page_docs, page_sections,
)
from paperloom.operators.runs import COUNTERS, fatal_message, seconds_between
from paperloom.operators.transform import candidates, with_content
from paperloom.plans.landing_job import land_batch
from paperloom.plans.transform_job import transform_found
from paperloom.session import new_folder
from paperloom.sources.tables import Store


@query("src_1_page_scan", f"WITH {PAGE_DOCS_SQL} SELECT page_id, url, content_type, octet_length(encode(html)) AS bytes FROM page_docs")
def page_scan(spark, sf):
    return page_docs(spark, sf).select("page_id", F.col("doc_link").alias("url"), "content_type",
                                       F.octet_length("content").alias("bytes"))


@query("src_2_section_dimension", f"""WITH {CUSTOMER_SECTIONS_SQL}
SELECT s.section_id, s.source_id, s.partition_days, n_name AS source_name FROM sections s JOIN nation ON n_nationkey = c_nationkey""")
def dimensions(spark, sf):
    sources = load(spark, sf, "nation").select(
        F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string")).alias("source_id"), F.col("n_name").alias("source_name"))
    return customer_sections(spark, sf).join(sources, "source_id").select("section_id", "source_id", "partition_days", "source_name")


@query("src_3_candidate_scan", f"""WITH {CRAWL_LOG_SQL}
SELECT identifier, version, file_path, partition_date FROM landing
WHERE status = 'stored' AND section_id = 'sec_b' AND partition_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-22'""")
def candidate_scan(spark, sf):
    found = candidates(landing(spark, sf), date(2024, 1, 8), date(2024, 1, 22), ["sec_b"])
    return found.select("identifier", "version", "file_path", "partition_date")


@query("src_4_content_fetch", f"""WITH {PAGE_DOCS_SQL}
SELECT page_id, split_part(file_path, '/', 1) AS bucket, substr(file_path, length(split_part(file_path, '/', 1)) + 2) AS key, doc_type = 'pdf' AS missing,
       CASE WHEN doc_type <> 'pdf' THEN octet_length(encode(html)) END AS bytes FROM page_landing""")
def content_fetch(spark, sf):
    """Against a bucket that lost its PDFs: those rows come back without bytes."""
    from paperloom.functions.content import bucket_of, key_of

    docs = page_docs(spark, sf)
    content = docs.where(F.col("doc_type") != "pdf")
    rows = with_content(docs.select("page_id", "file_path"), content)
    return rows.select("page_id", bucket_of(F.col("file_path")).alias("bucket"), key_of(F.col("file_path")).alias("key"),
                       F.col("content").isNull().alias("missing"), F.octet_length("content").alias("bytes"))


@query("src_5_sections_of_source", f"WITH {CUSTOMER_SECTIONS_SQL} SELECT section_id, partition_days FROM sections WHERE source_id = 'nation_7' ORDER BY section_id")
@query("sort_2_sections_by_id", f"WITH {CUSTOMER_SECTIONS_SQL} SELECT section_id, partition_days FROM sections WHERE source_id = 'nation_7' ORDER BY section_id")
def source_sections(spark, sf):
    found = customer_sections(spark, sf).where(F.col("source_id") == "nation_7")
    return found.select("section_id", "partition_days").orderBy("section_id")


@query("snk_1_landing_append", f"""WITH {CRAWL_LOG_SQL}
SELECT l.identifier, l.version, l.section_id, l.partition_date, l.doc_type, l.status, l.file_hash, l.file_path, l.status_code,
       CASE WHEN l.status = 'stored' THEN stable END AS content FROM landing l""")
def landing_append(spark, sf):
    """Both halves of the log as two batches, then rows with their bytes as stored."""
    store = Store(spark, new_folder(spark, "store"))
    items = crawl_log(load(spark, sf, "events"))
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    land_batch(store, items.where(early), "batch-1")
    land_batch(store, items.where(~early), "batch-2")
    rows = with_content(store.read("landing_documents"), store.read("landing_content"))
    return rows.select("identifier", "version", "section_id", "partition_date", "doc_type", "status", "file_hash", "file_path",
                       F.col("error.status_code").alias("status_code"), F.col("content").cast("string").alias("content"))


@query("snk_2_transformed_append", f"""WITH {PAGE_DOCS_SQL}
SELECT 'transformed/' || section_id || '/' || strftime(partition_date, '%Y-%m-%d') || '/v1/PG-' || page_id || '___A.' || doc_type AS file_path,
       doc_type, sha256(CASE WHEN doc_type <> 'html' THEN html WHEN section_id = 'lang_fr' THEN regexp_extract(html, '(?s)<div class="ad">.*?</div>')
                        ELSE regexp_extract(html, '(?s)<article>.*?</article>') END) AS file_hash, 'run-1' AS run_id
FROM page_landing""")
def transformed_append(spark, sf):
    """Two runs over the same documents: the second one finds nothing to do."""
    store = Store(spark, new_folder(spark, "store"))
    docs = page_docs(spark, sf)
    store.write("landing_content", docs.select("file_path", "content", "content_type", "section_id", "partition_date"), "load")
    found = docs.drop("content", "html", "content_type")
    for number in (1, 2):
        transform_found(store, found, page_sections(spark, sf), run_id=f"run-{number}", batch=f"run-{number}",
                        transformed_at=F.lit("2024-02-01").cast("timestamp"))
    return store.read("transformed_documents").select("file_path", "doc_type", "file_hash", "run_id")


@query("snk_3_run_attempts_append", f"""WITH {ATTEMPTS_SQL}
SELECT run_id, source_id, section_id, partition_date, finish_reason, CASE WHEN finish_reason <> 'finished' THEN coalesce(message, finish_reason) END AS fatal,
       {', '.join(COUNTERS)} FROM attempts""")
def attempts_append(spark, sf):
    store = Store(spark, new_folder(spark, "store"))
    rows = attempts(spark, sf).withColumns({
        "fatal": fatal_message(F.col("finish_reason"), F.col("message")),
        "duration_seconds": seconds_between(F.col("started_at"), F.col("finished_at"))})
    for number in (1, 2):
        store.write("partition_attempts", rows.where(F.col("attempt") == number), f"attempt-{number}")
    return store.read("partition_attempts").select(
        "run_id", "source_id", "section_id", "partition_date", "finish_reason", "fatal", *COUNTERS)
