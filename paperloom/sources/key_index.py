"""The key index of the landing table: what a new batch has to know of earlier ones.

Every landing row leaves its identifier, hash and version in a bucket of its
identifier, sorted by it. A batch reads only buckets that its identifiers fall
into, and of those the rows of its identifiers; the landing rows themselves are
not read. The index is derived: it is written after the rows, and a batch whose
index is missing, after a crash say, gets it from its rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import materialise
from paperloom.sources.tables import Store

TABLE, ROWS = "landing_keys", "landing_documents"
BUCKETS = 64
# Identifiers that are sent to the index; some 20 MB. More are joined by a shuffle.
SENT = 200_000
# Folder of an index that was made from several; it holds all batches up to the one it names.
MERGED = "upto."


def bucket_of(identifier: Column) -> Column:
    return F.pmod(F.xxhash64(identifier), F.lit(BUCKETS)).cast("int")


def index_rows(landed: DataFrame) -> DataFrame:
    """Index rows of landing rows with their batch."""
    return landed.select("identifier", "file_hash", "version", "status", F.col("ingest_batch").alias("landed_in"),
                         bucket_of(F.col("identifier")).alias("bucket"))


def _write(store: Store, rows: DataFrame, name: str) -> None:
    store.write(TABLE, rows.sortWithinPartitions("identifier"), name)


def add_batch(store: Store, batch: str) -> None:
    """Index a batch from its rows."""
    _write(store, index_rows(store.read(ROWS, [batch])), batch)


def _covered(store: Store) -> tuple[set[str], str | None]:
    names = store.batches(TABLE)
    merged = max((name.removeprefix(MERGED) for name in names if name.startswith(MERGED)), default=None)
    return {name for name in names if not name.startswith(MERGED)}, merged


def complete(store: Store) -> None:
    """Index the batches that have rows and no index."""
    own, merged = _covered(store)
    for batch in store.batches(ROWS):
        if batch not in own and (merged is None or batch > merged):
            add_batch(store, batch)


def forget_batch(store: Store, batch: str) -> None:
    """Take a batch out of the index before its rows are written again."""
    _, merged = _covered(store)
    if merged is not None and batch <= merged:
        # a batch inside a merged index: single ones are made again from the rows
        store.drop(TABLE, MERGED + merged)
    store.drop(TABLE, batch)


def compact(store: Store) -> None:
    """One index folder for all; readers see the new one or the old ones."""
    complete(store)
    own, merged = _covered(store)
    if own:
        newest = max(own)
        with store.together():
            _write(store, store.read(TABLE).drop("ingest_batch").distinct(), MERGED + newest)
            for batch in own:
                store.drop(TABLE, batch)
            if merged is not None and merged != newest:
                store.drop(TABLE, MERGED + merged)


def known(store: Store, batch: str, identifiers: DataFrame) -> DataFrame:
    """What earlier batches have of ``identifiers(identifier)``: identifier, file_hash, version, status.

    The work follows the identifiers: their buckets are the only folders read.
    """
    complete(store)
    index = store.read(TABLE).where(F.col("landed_in") < batch).drop("ingest_batch")
    return of_identifiers(index, identifiers).select("identifier", "file_hash", "version", "status")


def of_identifiers(index: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Rows of an index in buckets that belong to ``identifiers(identifier)``; only their buckets are read."""
    wanted = materialise(identifiers.select("identifier").distinct().withColumn("bucket", bucket_of(F.col("identifier"))), "identifiers")
    some = wanted.where(F.col("bucket") >= 0)
    if wanted.limit(SENT + 1).count() <= SENT:
        return index.join(F.broadcast(some), ["bucket", "identifier"], "left_semi")
    near = index.join(F.broadcast(some.select("bucket").distinct()), "bucket", "left_semi")
    return near.join(wanted, ["bucket", "identifier"], "left_semi")
