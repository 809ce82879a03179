"""Streams over data that arrive in parts: each stream is started, drained and started again for the next part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.catalog.registry import query
from paperloom.catalog.stand_ins import CRAWL_LOG_SQL, PAGE_DOCS_SQL, crawl_log, load, page_docs, page_sections
from paperloom.functions.content import content_hash
from paperloom.operators.landing import landing_columns, with_stable_content
from paperloom.session import new_folder
from paperloom.sources.tables import Store
from paperloom.streaming.incremental import drain, land_stream, transform_stream, version_stream


PARTS = 4


def _parts(rows: DataFrame, order: str) -> list[DataFrame]:
    """Consecutive ranges of about equal numbers of rows."""
    cuts = sorted(set(rows.approxQuantile(order, [n / PARTS for n in range(1, PARTS)], 0.01)))
    edges = [None, *cuts, None]
    return [rows.where((F.lit(low is None) | (F.col(order) > low)) & (F.lit(high is None) | (F.col(order) <= high)))
            for low, high in zip(edges[:-1], edges[1:])]


def _after_each_part(spark, sf, run) -> None:
    """Events arrive in their order; ``run`` gets the stream of all that has arrived, once per part."""
    events, folder = load(spark, sf, "events"), new_folder(spark, "arriving")
    for part in _parts(events, "event_id"):
        part.write.mode("append").parquet(folder)
        run(spark.readStream.schema(events.schema).parquet(folder))


@query("str_1_incremental_landing", f"WITH {CRAWL_LOG_SQL} SELECT identifier, version, section_id, status, file_hash, file_path FROM landing")
def landing_stream(spark, sf):
    store, checkpoint = Store(spark, new_folder(spark, "store")), new_folder(spark, "checkpoint")
    _after_each_part(spark, sf, lambda events: drain(land_stream(crawl_log(events), store, checkpoint)))
    return store.read("landing_documents").select("identifier", "version", "section_id", "status", "file_hash", "file_path")


@query("str_2_incremental_transform", f"""WITH {PAGE_DOCS_SQL}
SELECT file_path AS source_file_path, 'PG-' || page_id || ' / A' AS identifier,
       sha256(CASE WHEN doc_type <> 'html' THEN html WHEN section_id = 'lang_fr' THEN regexp_extract(html, '(?s)<div class="ad">.*?</div>')
              ELSE regexp_extract(html, '(?s)<article>.*?</article>') END) AS file_hash
FROM page_landing""")
def transforming_stream(spark, sf):
    """Hashes are taken from the stored bytes, not from the rows."""
    store, checkpoint = Store(spark, new_folder(spark, "store")), new_folder(spark, "checkpoint")
    docs = page_docs(spark, sf).withColumns({
        "etag": F.lit(None), "proxy": F.lit(None), "error": F.lit(None),
        "scraped_at": F.lit("2024-01-01").cast("timestamp"), "run_id": F.lit("run-1")})
    for number, part in enumerate(_parts(docs, "page_id")):
        with store.together():
            store.write("landing_content", part.select("file_path", "content", "content_type", "section_id", "partition_date"), f"load-{number}")
            store.write("landing_documents", landing_columns(part), f"load-{number}")
        drain(transform_stream(store, page_sections(spark, sf), checkpoint, run_id="run-1"))
    stored = store.read("transformed_content").where(F.col("content").isNotNull())
    return stored.select("source_file_path", "identifier", content_hash(F.col("content")).alias("file_hash"))


@query("str_3_keyed_change_detector", f"WITH {CRAWL_LOG_SQL} SELECT seq, identifier, file_hash, status, version FROM landing")
def change_detector(spark, sf):
    path, checkpoint = new_folder(spark, "versions"), new_folder(spark, "checkpoint")
    _after_each_part(spark, sf, lambda events: drain(version_stream(with_stable_content(crawl_log(events)), path, checkpoint)))
    return spark.read.parquet(path).select("seq", "identifier", "file_hash", "status", "version")
