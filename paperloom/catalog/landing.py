"""Content, change detection, versions and look-ups over the crawl log."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.catalog.registry import query
from paperloom.catalog.stand_ins import (
    CRAWL_LOG_SQL, SPLIT, history_and_batch, landing, load, log_order, no_history, staged_log,
)
from paperloom.functions.content import content_hash, without_comments
from paperloom.operators.keyed import first_per_key
from paperloom.operators.landing import (
    assign_versions, changed_items, conditional_requests, current_snapshot, key_collisions, latest_etags,
    new_versions, unchanged_items, version_history, with_paths,
)
from paperloom.sources.pages import spread

_COLUMNS = ["seq", "identifier", "version", "section_id", "partition_date", "status", "file_hash", "file_path"]


@query("flow_1_new_versions", f"WITH {CRAWL_LOG_SQL} SELECT {', '.join(_COLUMNS)} FROM landing WHERE ts >= TIMESTAMP '{SPLIT}'")
def flow(spark, sf):
    """Given a page archive and the landing history: which documents are new versions?"""
    history, batch = history_and_batch(spark, sf)
    return new_versions(batch, history, log_order(spark, sf)).select(*_COLUMNS)


@query("cnt_1_stable_content", "SELECT page_id, regexp_replace(html, '<!--.*?-->', '', 'gs') AS stable FROM pages")
def stable(spark, sf):
    pages = spread(load(spark, sf, "pages"))
    return pages.select("page_id", without_comments(F.col("html").cast("binary")).cast("string").alias("stable"))


@query("cnt_2_content_hash", "SELECT doc_id, sha256(text) AS file_hash FROM documents")
def hashes(spark, sf):
    documents = spread(load(spark, sf, "documents"))
    return documents.select("doc_id", content_hash(F.col("text").cast("binary")).alias("file_hash"))


@query("join_1_changed_items", f"""WITH {CRAWL_LOG_SQL}
SELECT seq, identifier, status, file_hash FROM kept WHERE ts >= TIMESTAMP '{SPLIT}'""")
def changed(spark, sf):
    history, batch = history_and_batch(spark, sf)
    return changed_items(batch, history).select("seq", "identifier", "status", "file_hash")


@query("join_1_skipped_items", f"""WITH {CRAWL_LOG_SQL}
SELECT s.seq, s.identifier, s.file_hash FROM staged s WHERE s.ts >= TIMESTAMP '{SPLIT}' AND s.status = 'stored'
  AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.seq = s.seq)""")
def skipped(spark, sf):
    history, batch = history_and_batch(spark, sf)
    return unchanged_items(batch, changed_items(batch, history)).select("seq", "identifier", "file_hash")


@query("join_1_documents_by_hash", """
SELECT doc_id, source, file_hash FROM (
  SELECT doc_id, source, sha256(text) AS file_hash, row_number() OVER (PARTITION BY source, sha256(text) ORDER BY doc_id) AS rn FROM documents)
WHERE rn = 1""")
def changed_documents(spark, sf):
    """The documents table as a crawl: a source delivers texts, repeats are skipped."""
    documents = spread(load(spark, sf, "documents")).select(
        F.col("doc_id").alias("seq"), F.col("source").alias("identifier"), F.lit("stored").alias("status"),
        content_hash(F.col("text").cast("binary")).alias("file_hash"))
    kept = changed_items(documents, no_history(spark))
    return kept.select(F.col("seq").alias("doc_id"), F.col("identifier").alias("source"), "file_hash")


@query("cnt_3_version_assignment", f"WITH {CRAWL_LOG_SQL} SELECT seq, identifier, status, version FROM landing")
def versions(spark, sf):
    changed_log = changed_items(staged_log(spark, sf), no_history(spark))
    numbered = assign_versions(changed_log, no_history(spark), log_order(spark, sf))
    return numbered.select("seq", "identifier", "status", "version")


@query("cnt_4_landing_key", f"WITH {CRAWL_LOG_SQL} SELECT seq, file_path FROM landing")
def keys(spark, sf):
    return landing(spark, sf).select("seq", "file_path")


@query("join_2_latest_etag", f"""WITH {CRAWL_LOG_SQL}
SELECT identifier, section_id, doc_link, etag FROM (
  SELECT *, row_number() OVER (PARTITION BY identifier, section_id, doc_link ORDER BY version DESC) AS rn FROM landing WHERE status = 'stored')
WHERE rn = 1""")
def etags(spark, sf):
    return latest_etags(landing(spark, sf)).select("identifier", "section_id", "doc_link", "etag")


@query("cnt_6_conditional_manifest", f"""WITH {CRAWL_LOG_SQL},
etags AS (SELECT identifier, section_id, doc_link, etag FROM (
  SELECT *, row_number() OVER (PARTITION BY identifier, section_id, doc_link ORDER BY version DESC) AS rn
  FROM landing WHERE status = 'stored' AND ts < TIMESTAMP '{SPLIT}') WHERE rn = 1)
SELECT s.seq, s.identifier, s.doc_link AS url, NULLIF(e.etag, '') AS if_none_match
FROM staged s LEFT JOIN etags e ON s.identifier = e.identifier AND s.section_id = e.section_id AND s.doc_link = e.doc_link
WHERE s.ts >= TIMESTAMP '{SPLIT}'""")
def conditional(spark, sf):
    history, batch = history_and_batch(spark, sf)
    requests = batch.select("seq", "identifier", "section_id", F.col("doc_link").alias("url"))
    return conditional_requests(requests, history).select("seq", "identifier", "url", "if_none_match")


@query("cnt_7_version_history", f"""WITH {CRAWL_LOG_SQL}
SELECT identifier, version, file_hash, previous_hash, file_hash IS DISTINCT FROM previous_hash AS changed
FROM (SELECT *, lag(file_hash) OVER (PARTITION BY identifier ORDER BY version) AS previous_hash FROM landing)""")
def history_report(spark, sf):
    rows = version_history(landing(spark, sf))
    return rows.select("identifier", "version", "file_hash", "previous_hash", "changed")


@query("cnt_8_current_snapshot", f"""WITH {CRAWL_LOG_SQL}
SELECT identifier, version, file_hash, file_path, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY version DESC) AS rn FROM landing WHERE status = 'stored') WHERE rn = 1""")
def snapshot(spark, sf):
    return current_snapshot(landing(spark, sf)).select("identifier", "version", "file_hash", "file_path", "seq")


@query("cnt_9_key_collisions", """
WITH ids AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'C/' || turn WHEN 'assistant' THEN 'C ' || turn ELSE 'C_' || turn END AS identifier FROM conversations),
paths AS (SELECT DISTINCT identifier, 'landing-zone/s/2024-01-01/' || replace(replace(identifier, '/', '_'), ' ', '_') || '/v1.html' AS file_path FROM ids)
SELECT file_path, count(*) AS identifiers, min(identifier) AS first_identifier, max(identifier) AS last_identifier
FROM paths GROUP BY file_path HAVING count(*) > 1""")
def collisions(spark, sf):
    """Identifiers that differ only in a blank or a slash claim the same path."""
    joint = F.when(F.col("role") == "user", "/").when(F.col("role") == "assistant", " ").otherwise("_")
    rows = load(spark, sf, "conversations").select(
        F.concat(F.lit("C"), joint, F.col("turn").cast("string")).alias("identifier"),
        F.lit("s").alias("section_id"), F.lit("2024-01-01").cast("date").alias("partition_date"),
        F.lit(1).alias("version"), F.lit("html").alias("doc_type"), F.lit("stored").alias("status"))
    return key_collisions(with_paths(rows))


@query("win_1_first_per_key", f"""WITH {CRAWL_LOG_SQL}
SELECT identifier, doc_link, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY identifier, doc_link ORDER BY seq) AS rn FROM crawl_log) WHERE rn = 1""")
def first(spark, sf):
    log = staged_log(spark, sf).select("identifier", "doc_link", "seq")
    return first_per_key(log, ["identifier", "doc_link"], "seq")


@query("win_2_arg_max_per_key", f"""WITH {CRAWL_LOG_SQL}
SELECT identifier, max(version) AS version, arg_max(seq, version) AS seq FROM landing GROUP BY identifier""")
def arg_max(spark, sf):
    return landing(spark, sf).groupBy("identifier").agg(
        F.max("version").alias("version"), F.max_by("seq", "version").alias("seq"))


@query("sort_1_candidates_in_order", f"""WITH {CRAWL_LOG_SQL}
SELECT identifier, version, section_id, partition_date, file_path FROM landing
WHERE status = 'stored' AND partition_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' ORDER BY identifier, version""")
def ordered(spark, sf):
    from datetime import date

    from paperloom.operators.transform import candidates

    found = candidates(landing(spark, sf), date(2024, 1, 5), date(2024, 1, 20))
    return found.select("identifier", "version", "section_id", "partition_date", "file_path").orderBy("identifier", "version")
