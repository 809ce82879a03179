"""Stored documents to their main content under canonical identifiers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.content import TRANSFORMED_BUCKET, content_hash, path_in, transformed_key
from paperloom.functions.formats import media_type_of
from paperloom.functions.html import Selector, double_quoted, has_visible_text, select_first
from paperloom.functions.text import canonical_identifier, let
from paperloom.operators.extract import quoted
from paperloom.operators.keyed import first_per_key
from paperloom.operators.once import with_computed
from paperloom.operators.planning import check_range
from paperloom.operators.sides import broadcast_if_small
from paperloom.schemas import TRANSFORMED


def candidates(landing: DataFrame, start: date, end: date, sections: list[str] | None = None) -> DataFrame:
    """Stored rows whose window starts in the range; both ends count.

    Section and window are the partition columns of the landing table, so the
    scan reads only matching folders.
    """
    check_range(start, end)
    rows = landing.where((F.col("status") == "stored") & F.col("partition_date").between(F.lit(start), F.lit(end)))
    return rows if sections is None else rows.where(F.col("section_id").isin(*sections))


def pending(found: DataFrame, transformed: DataFrame) -> DataFrame:
    """Candidates whose stored file was not transformed yet; each file once."""
    done = transformed.select(F.col("source_file_path").alias("file_path"))
    once = first_per_key(found, ["file_path"], "identifier", "version")
    return once.join(done, "file_path", "left_anti")


# Rows with their metadata that are sent to the folders of stored bytes; some 20 MB.
CARRIED_ROWS = 20_000
FOLDERS = ("ingest_batch", "section_id", "partition_date")


def with_content(rows: DataFrame, content: DataFrame, carried: int = CARRIED_ROWS) -> DataFrame:
    """Rows with the bytes at their path; null where the object is missing.

    Stored content lies in folders by batch, section and window. The rows name
    folders too, so the scan of the bytes is pruned to these at run time. While
    the rows are few, they go to the bytes and no bytes are shuffled; rows that
    met none are found by their paths alone. Of many rows only the folders are
    sent, and the bytes of these are shuffled with the rows.
    """
    folders = [c for c in FOLDERS if c in content.columns and c in rows.columns]
    keys = [*folders, "file_path"]
    stored = content.select(*keys, "content")
    # The comparison is what lets the planner expect that pruning pays.
    named = rows.where(F.length("file_path") > 0)
    if rows.limit(carried + 1).count() <= carried:
        found = stored.join(F.broadcast(named), keys).select(*rows.columns, "content")
        absent = rows.join(F.broadcast(stored.join(F.broadcast(named.select(*keys)), keys, "left_semi").select(*keys)), keys, "left_anti")
        return found.unionByName(absent.withColumn("content", F.lit(None).cast("binary")))
    if folders:
        stored = stored.join(F.broadcast(named.select(*folders).distinct()), folders, "left_semi")
    return rows.join(stored, keys, "left")


def container_of(html: Column, selector: Selector | str) -> Column:
    return double_quoted(select_first(html, selector))


def with_container(rows: DataFrame, selector: Selector | str, selector_text: Column) -> DataFrame:
    """HTML rows reduced to their container; the other types pass through.

    ``error`` tells what is wrong; nothing is silently kept whole.
    """
    is_html = F.col("doc_type") == "html"
    text = F.make_valid_utf8(F.col("content").cast("string"))
    where = F.coalesce(F.nullif(F.col("source_url"), F.lit("")), F.lit("<html>"))
    name = F.concat(F.lit("content_container "), quoted(selector_text))
    nothing = F.concat(name, F.lit(" matched nothing at "), where)
    hollow = F.concat(name, F.lit(" matched an empty node at "), where)
    part = let(container_of(text, selector), lambda one: F.struct(
        one.alias("html"), F.coalesce(has_visible_text(one), F.lit(False)).alias("visible")))
    cut = with_computed(rows, _part=F.when(is_html, part))
    missing = F.concat(F.lit("no object at "), F.col("file_path"))
    problem = (
        F.when(F.col("content").isNull(), missing)
        .when(is_html & F.col("_part.html").isNull(), nothing)
        .when(is_html & ~F.col("_part.visible"), hollow)
    )
    return (
        cut.withColumn("error", problem)
        .withColumn("new_content", F.when(F.col("error").isNull(),
                                          F.when(is_html, F.encode("_part.html", "UTF-8")).otherwise(F.col("content"))))
        .drop("_part", "content")
    )


def transform_rows(rows: DataFrame, content: DataFrame, sections: DataFrame, *, run_id: str,
                   transformed_at: Column, bucket: str = TRANSFORMED_BUCKET) -> DataFrame:
    """Pending rows with their new bytes, key, hash and ``error``.

    A row of an unknown section fails like any other bad document.
    """
    settings = sections.select("section_id", "content_container", "content_container_sel")
    joined = with_content(rows, content).join(broadcast_if_small(settings), "section_id", "left")
    cut = with_container(joined, Selector.column(F.col("content_container_sel")), F.col("content_container"))
    unknown = (F.col("doc_type") == "html") & F.col("content_container").isNull()
    cut = cut.withColumn("error", F.when(unknown, F.concat(F.lit("unknown section "), quoted(F.col("section_id"))))
                         .otherwise(F.col("error")))
    canonical = canonical_identifier(F.col("identifier"))
    key = transformed_key(F.col("section_id"), F.col("partition_date"), F.col("_canonical"),
                          F.col("version"), F.col("doc_type"))
    return (
        cut.withColumn("_canonical", canonical)
        .withColumnRenamed("file_path", "source_file_path")
        .withColumnRenamed("file_hash", "source_file_hash")
        .withColumn("file_path", path_in(bucket, key))
        .withColumn("file_hash", content_hash(F.col("new_content")))
        .withColumn("content_type", media_type_of(F.col("doc_type")))
        .withColumn("identifier", F.col("_canonical"))
        .withColumn("transformed_at", transformed_at)
        .withColumn("run_id", F.lit(run_id))
        .drop("_canonical", "content_container", "content_container_sel")
    )


def transformed_columns(rows: DataFrame) -> DataFrame:
    """Good rows in exactly the columns of the transformed table."""
    good = rows.where(F.col("error").isNull())
    return good.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSFORMED])


def transform_counts(found: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates, transformed, failed and skipped per key.

    ``found`` are all candidates; ``done`` is the outcome of the pending ones.
    Each side is aggregated before they meet.
    """
    total = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("candidates"))
    tried = done.groupBy(*keys).agg(
        F.count_if(F.col("error").isNull()).alias("transformed"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )
    zero = F.lit(0).cast("bigint")
    return total.join(tried, keys, "left").select(
        *keys, "candidates",
        F.coalesce("transformed", zero).alias("transformed"),
        (F.col("candidates") - F.coalesce("transformed", zero) - F.coalesce("failed", zero)).alias("skipped"),
        F.coalesce("failed", zero).alias("failed"),
    )
