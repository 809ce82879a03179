"""The same jobs, fed by streams."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from paperloom.operators.landing import assign_versions, known_hashes
from paperloom.plans.landing_job import land_batch
from paperloom.plans.transform_job import transform_found
from paperloom.session import materialise
from paperloom.sources.key_index import bucket_of, of_identifiers
from paperloom.sources.tables import Store

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def land_stream(items: DataFrame, store: Store, checkpoint: str, name: str = "land") -> StreamingQuery:
    """Land every micro-batch of items as one batch.

    The batch id is part of the stored rows, so a micro-batch that is replayed
    after a crash replaces its own rows instead of adding failures twice.
    """
    def one(batch: DataFrame, number: int) -> None:
        land_batch(store, batch, f"{name}-{number:012d}")

    return (items.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def transform_stream(store: Store, sections: DataFrame, checkpoint: str, *, run_id: str,
                     name: str = "transform") -> StreamingQuery:
    """Transform landing batches as they are committed; finished paths are never redone.

    The stream carries names of batches. Their rows are read as they are now,
    so a batch that was written again in between is taken once, and rows of a
    writer that died are never seen.
    """
    def one(batch: DataFrame, number: int) -> None:
        names = [row["batch"] for row in batch.select("batch").distinct().collect()]
        stored = store.read("landing_documents", names).where(F.col("status") == "stored")
        transform_found(store, stored, sections, run_id=run_id, batch=f"{name}-{number:012d}",
                        transformed_at=F.current_timestamp())

    return (store.arrivals("landing_documents").writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


CHANGE = "seq long, identifier string, file_hash string, status string"
VERSIONED = CHANGE + ", version int"
CONTENT_KEY = ["identifier", "file_hash"]


# Buckets that contents are dealt to, contents in a block, and blocks of a bucket that are merged into full ones.
BUCKETS, BLOCK, BLOCKS = 1 << 13, 1 << 12, 16
DIGEST = 32


def _digest(identifier: str | None, file_hash: str | None) -> bytes:
    """SHA-256 of a content's key, no weaker than the hash of its bytes; null differs from any text."""
    parts = ("-" if part is None else f"{len(part)}:{part}" for part in (identifier, file_hash))
    return hashlib.sha256(" ".join(parts).encode()).digest()


def _packed(known: list[tuple[bytes, int]]) -> tuple[bytes, bytes]:
    return b"".join(content for content, _ in known), array("q", (at for _, at in known)).tobytes()


def _unpacked(contents: bytes, sights: bytes) -> dict[bytes, int]:
    """Last sight of each content; the latest, if a block has it twice."""
    known: dict[bytes, int] = {}
    for n, at in enumerate(array("q", sights)):
        content = contents[n * DIGEST:(n + 1) * DIGEST]
        known[content] = max(at, known.get(content, at))
    return known


def _content_bucket() -> Column:
    return F.pmod(F.xxhash64(*CONTENT_KEY), F.lit(BUCKETS)).cast("int")


def _pack_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of known contents, one per bucket and transfer batch."""
    for batch in batches:
        blocks: dict[int, list[tuple[bytes, int]]] = {}
        for bucket, identifier, file_hash, at in zip(*[column.to_pylist() for column in batch.columns]):
            blocks.setdefault(bucket, []).append((_digest(identifier, file_hash), at))
        packed = [_packed(block) for block in blocks.values()]
        columns = [pa.array(list(blocks), pa.int32()), *[pa.array(list(c), pa.binary()) for c in zip(*packed)]]
        if blocks:
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "contents", "sights"])


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last sight of each content within a transfer batch, before the shuffle."""
    for batch in batches:
        sights = pa.Table.from_batches([batch]).group_by(CONTENT_KEY).aggregate([("seq", "min"), ("at", "max")])
        columns = [sights["seq_min"], sights["identifier"], sights["file_hash"], sights["at_max"]]
        yield from pa.table(columns, names=["seq", *CONTENT_KEY, "at"]).to_batches()


class FirstSeen(StatefulProcessor):
    """Passes the earliest row of each content that its bucket has no state of.

    State is a digest per (identifier, hash), whatever the repeats. The contents
    of a bucket lie together in blocks, so state is read and written once per
    bucket and micro-batch, not once per content. With ``keep_for`` milliseconds
    the last sight lies beside each digest, and a timer forgets the contents
    that did not come again for so long, in time of the crawl.
    """

    def __init__(self, keep_for: int | None = None):
        self.keep_for = keep_for

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getListState("blocks", "contents binary, sights binary")

    def _known(self) -> tuple[dict[bytes, int], int]:
        """Last sight of each content, and the number of blocks."""
        known, n = {}, 0
        for contents, sights in self.blocks.get():
            known.update(_unpacked(bytes(contents), bytes(sights)))
            n += 1
        return known, n

    def _replace(self, known: dict[bytes, int]) -> None:
        pairs = list(known.items())
        self.blocks.put([_packed(pairs[n:n + BLOCK]) for n in range(0, len(pairs), BLOCK)])

    def _remind(self, sights: Iterable[int]) -> None:
        """Look at the bucket when its first content is due, ``keep_for`` after its last sight."""
        due = min(sights) + self.keep_for
        timers = list(self.handle.listTimers())
        if not timers or due < min(timers):
            for timer in timers:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first, last = {}, {}
        for row in rows:
            content = _digest(row.identifier, row.file_hash)
            last[content] = max(last.get(content, row.at), row.at)
            if content not in first or row.seq < first[content].seq:
                first[content] = row
        known, n = self._known()
        new = [content for content in first if content not in known]
        if self.keep_for is not None:
            known.update((content, max(at, known.get(content, at))) for content, at in last.items())
            self._replace(known)
            self._remind(last.values())
        elif n >= BLOCKS:
            self._replace(known | {content: 0 for content in new})
        elif new:
            self.blocks.appendValue(_packed([(content, 0) for content in new]))
        found = (first[content] for content in new)
        return iter([Row(seq=row.seq, identifier=row.identifier, file_hash=row.file_hash, status="stored") for row in found])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        contents, sights = bytes(initialState.contents), bytes(initialState.sights)
        self.blocks.appendValue((contents, sights))
        if self.keep_for is not None:
            self._remind(_unpacked(contents, sights).values())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        left = {content: at for content, at in self._known()[0].items() if at + self.keep_for > now}
        if left:
            self._replace(left)
            self.handle.registerTimer(min(left.values()) + self.keep_for)
        else:
            self.blocks.clear()
        return iter(())

    def close(self) -> None:
        pass


def _milliseconds(time: str) -> Column:
    return F.unix_millis(F.coalesce(F.col(time), F.lit(0).cast("timestamp")))


def detect_changes(items: DataFrame, history: DataFrame | None = None, keep_for: int | None = None) -> DataFrame:
    """Changed items of a stream, with state instead of a look-up in history.

    ``history`` (landing rows) fills the state before the first micro-batch.
    Repeats of a content are thinned before they are shuffled, and contents are
    dealt to buckets by identifier and hash; state is kept per bucket. Failures pass by: they are
    always new and need no state.
    """
    timed = items if keep_for is None else items.withWatermark("scraped_at", "0 seconds")
    # Items behind the watermark count like others: it drives the timers and nothing else.
    stored = timed.where(F.col("status") == "stored").select("seq", *CONTENT_KEY, _milliseconds("scraped_at").alias("at"))
    before = None
    if history is not None:
        known = history.where((F.col("status") == "stored") & F.col("file_hash").isNotNull())
        sights = known.groupBy(*CONTENT_KEY).agg(F.max(_milliseconds("scraped_at")).alias("at"))
        dealt = sights.select(_content_bucket().alias("bucket"), *CONTENT_KEY, "at").repartition("bucket").sortWithinPartitions("bucket")
        before = dealt.mapInArrow(_pack_known, "bucket int, contents binary, sights binary").groupBy("bucket")
    sights = stored.mapInArrow(_thin, "seq long, identifier string, file_hash string, at long")
    changed = sights.withColumn("bucket", _content_bucket()).groupBy("bucket").transformWithState(
        FirstSeen(keep_for), CHANGE, "append", "None" if keep_for is None else "EventTime", before)
    return changed.unionByName(items.where(F.col("status") == "failed").select("seq", *CONTENT_KEY, "status"))


def version_stream(items: DataFrame, path: str, checkpoint: str, *, history: DataFrame | None = None,
                   keep_for: int | None = None) -> StreamingQuery:
    """Number the changed items of a stream; one folder of ``path`` per micro-batch.

    ``history`` (landing rows) goes before the stream. It is kept as a folder of ``path`` of its own, with a negative ``ingest_batch``.
    A micro-batch reads only buckets and rows of the identifiers that changed,
    and asks them again for contents that the state had forgotten. So
    ``keep_for`` bounds the state and never changes the rows.
    """
    spark = items.sparkSession
    if history is not None:
        before = history.select(F.lit(None).cast("long").alias("seq"), *CONTENT_KEY, "status", F.col("version").cast("int"))
        _write_part(before, path, -1)
    schema = VERSIONED + ", ingest_batch long, bucket int"

    def one(batch: DataFrame, number: int) -> None:
        found = materialise(batch, "changed")
        earlier = batch.sparkSession.createDataFrame([], schema)
        if number > 0 or history is not None:
            stored = batch.sparkSession.read.schema(schema).parquet(path)
            earlier = materialise(of_identifiers(stored.where(F.col("ingest_batch") < number), found), "earlier")
        if keep_for is not None:
            seen = known_hashes(earlier).withColumnRenamed("_change", "file_hash")
            found = materialise(found.join(seen, CONTENT_KEY, "left_anti"), "unseen")
        _write_part(assign_versions(found, earlier, found), path, number)

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return (detect_changes(items, history, keep_for).writeStream.foreachBatch(one).outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(STATE_STORE, before)


def _write_part(rows: DataFrame, path: str, number: int) -> None:
    """One micro-batch's folder; a replayed micro-batch replaces it."""
    keyed = rows.withColumn("bucket", bucket_of(F.col("identifier"))).hint("rebalance", "bucket")
    (keyed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket")
        .parquet(f"{path}/ingest_batch={number}"))


def drain(query: StreamingQuery) -> None:
    """Wait until a stream with a finite trigger is through."""
    query.awaitTermination()
