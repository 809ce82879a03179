"""Staged items to landing rows: hashing, change detection, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.content import (
    LANDING_BUCKET, content_hash, landing_key, path_in, stable_content,
)
from paperloom.operators.keyed import first_per_key, last_before, number_per_key
from paperloom.schemas import LANDING


def with_stable_content(items: DataFrame) -> DataFrame:
    """Items with the bytes to store and their hash; failed items have neither.

    A stored item without content fails the job.
    """
    stored = F.col("status") == "stored"
    lost = F.concat(F.lit("stored item has no content: "), F.col("identifier"))
    content = F.when(stored & F.col("content").isNull(), F.raise_error(lost).cast("binary")).when(
        stored, stable_content(F.col("content"), F.col("doc_type"))
    )
    return items.withColumn("content", content).withColumn("file_hash", content_hash(F.col("content")))


def _with_change_key(items: DataFrame) -> DataFrame:
    """Stored items are the same when their hash is; a failure is like no other."""
    return items.withColumn("_change", F.coalesce("file_hash", F.concat(F.lit("seq:"), F.col("seq").cast("string"))))


def known_hashes(history: DataFrame) -> DataFrame:
    """The stored (identifier, hash) pairs, of any version and any section."""
    return history.where((F.col("status") == "stored") & F.col("file_hash").isNotNull()).select(
        "identifier", F.col("file_hash").alias("_change")
    )


def changed_items(staged: DataFrame, history: DataFrame) -> DataFrame:
    """Items to append: failures, and content its identifier never had before.

    First-wins inside the batch, then against all history. Both steps use the
    same key, so the batch is shuffled once.
    """
    kept = first_per_key(_with_change_key(staged), ["identifier", "_change"], "seq")
    return kept.join(known_hashes(history), ["identifier", "_change"], "left_anti").drop("_change")


def unchanged_items(staged: DataFrame, changed: DataFrame) -> DataFrame:
    """Stored items that are not among the changed ones.

    The arrival number is unique, so no pair of identifier and hash, however
    often it repeats, is gathered anywhere.
    """
    return staged.where(F.col("status") == "stored").join(changed.select("seq"), "seq", "left_anti")


def last_versions(history: DataFrame) -> DataFrame:
    """Highest version per identifier, failures included, over all sections."""
    return history.groupBy("identifier").agg(F.max("version").alias("_base"))


def assign_versions(changed: DataFrame, history: DataFrame, batch: DataFrame) -> DataFrame:
    """Continue the versions of each identifier in arrival order, without gaps.

    ``batch`` is any cheap table with the batch's ``seq`` values.
    """
    return number_per_key(changed, "identifier", "seq", "version", source=batch.select("seq"),
                          base=last_versions(history))


def with_paths(versioned: DataFrame, bucket: str = LANDING_BUCKET) -> DataFrame:
    key = landing_key(F.col("section_id"), F.col("partition_date"), F.col("identifier"),
                      F.col("version"), F.col("doc_type"))
    return versioned.withColumn("file_path", F.when(F.col("status") == "stored", path_in(bucket, key)))


def new_versions(staged: DataFrame, history: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """A staged batch against the history: the rows that become new versions."""
    changed = changed_items(staged, history)
    return with_paths(assign_versions(changed, history, batch if batch is not None else staged))


def landing_columns(rows: DataFrame) -> DataFrame:
    """Exactly the columns of the landing table, in order."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LANDING])


def latest_etags(history: DataFrame) -> DataFrame:
    """ETag of the newest stored version per document URL.

    A newest version without ETag has none, whatever older versions had.
    """
    stored = history.where(F.col("status") == "stored")
    return stored.groupBy("identifier", "section_id", "doc_link").agg(
        F.max_by("etag", "version").alias("etag"), F.max("version").alias("etag_version")
    )


def conditional_requests(requests: DataFrame, history: DataFrame) -> DataFrame:
    """Requests with the header that lets the server answer "unchanged"."""
    etags = latest_etags(history).select("identifier", "section_id", F.col("doc_link").alias("url"),
                                         F.col("etag").alias("if_none_match"))
    joined = requests.join(etags, ["identifier", "section_id", "url"], "left")
    return joined.withColumn("if_none_match", F.when(F.col("if_none_match") != "", F.col("if_none_match")))


def current_snapshot(history: DataFrame) -> DataFrame:
    """The newest stored row per identifier."""
    stored = history.where(F.col("status") == "stored")
    return first_per_key(stored, ["identifier"], F.desc("version"))


def version_history(landing: DataFrame) -> DataFrame:
    """Every row with the hash of the version before it, whatever number that has."""
    rows = last_before(landing, ["identifier"], ["version"], F.struct("file_hash"), "_previous", source=landing.select("version"))
    rows = rows.withColumn("previous_hash", F.col("_previous.file_hash")).drop("_previous")
    return rows.withColumn("changed", ~F.col("file_hash").eqNullSafe(F.col("previous_hash")))


def key_collisions(rows: DataFrame) -> DataFrame:
    """Storage paths claimed by more than one identifier."""
    pairs = rows.where(F.col("file_path").isNotNull()).select("file_path", "identifier").distinct()
    return pairs.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("identifiers"), F.min("identifier").alias("first_identifier"),
        F.max("identifier").alias("last_identifier"),
    ).where(F.col("identifiers") > 1)
