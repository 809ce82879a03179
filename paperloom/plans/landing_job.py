"""Land one batch of items: bytes, rows and index in one commit, then counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.content import stable_content
from paperloom.functions.formats import media_type_of
from paperloom.operators.landing import landing_columns, new_versions, with_stable_content
from paperloom.session import materialise
from paperloom.sources import key_index
from paperloom.sources.tables import Store

# Index folders that are merged into one.
INDEX_FOLDERS = 30


def land_batch(store: Store, items: DataFrame, batch: str, *, replay: bool = False) -> DataFrame:
    """Append what is new in ``items`` and return counts per run and partition.

    Batches are numbered by their names, in text order. A batch below the newest
    one is refused unless ``replay`` is set: later versions were numbered after it.

    ``items`` has the columns of ``schemas.ITEM``. Everything up to the version
    numbers runs on narrow rows without bytes, against the key index of earlier
    batches and not their rows. Bytes are read a second time
    only for the items that are kept: few in a rerun, where the kept rows are
    small enough for the engine to broadcast, and joined on a unique key where
    they are many.
    """
    store.check_order(batch, replay=replay)
    staged = materialise(with_stable_content(items).drop("content"), "staged")
    earlier = materialise(key_index.known(store, batch, staged), "earlier")
    kept = materialise(new_versions(staged, earlier), "kept")

    paths = kept.where(F.col("status") == "stored").select("seq", "file_path", "section_id", "partition_date")
    bytes_of = items.select("seq", "doc_type", "content").join(paths, "seq")
    content = bytes_of.select(
        "file_path",
        stable_content(F.col("content"), F.col("doc_type")).alias("content"),
        media_type_of(F.col("doc_type")).alias("content_type"), "section_id", "partition_date",
    )
    # Bytes, rows and index appear at once: a row never points at bytes that are not there.
    with store.together():
        key_index.forget_batch(store, batch)
        store.write("landing_content", content, batch)
        store.write("landing_documents", landing_columns(kept), batch)
        key_index.add_batch(store, batch)
    if len(store.batches(key_index.TABLE)) > INDEX_FOLDERS:
        key_index.compact(store)

    keys = ["run_id", "section_id", "partition_date"]
    seen = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("items"))
    added = kept.groupBy(*keys).agg(
        F.count_if(F.col("status") == "stored").alias("scraped"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    zero = F.lit(0).cast("bigint")
    return seen.join(added, keys, "left").select(
        *keys, F.coalesce("scraped", zero).alias("scraped"), F.coalesce("failed", zero).alias("failed"),
        (F.col("items") - F.coalesce("scraped", zero) - F.coalesce("failed", zero)).alias("skipped_unchanged"),
    )
