"""The stored tables: landing, transformed and run facts, as parquet folders.

Rows are only ever added. Each write names its batch, the batch is the first
partition column, and running a batch again (after a crash, say) replaces what
that batch had written and nothing else. A write goes to a new folder, which
counts once the list of folders names it (``commits``): until then, and if the
writer dies, readers see what was there before.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.sources.commits import Commits
from paperloom.schemas import ATTEMPT, BATCH, CONTENT, LANDING, LANDING_KEYS, TRANSFORMED

# Transformed bytes are written together with their rows and their failures.
TRANSFORM_OUTCOME = T.StructType(
    list(TRANSFORMED) + [f for f in CONTENT if f.name not in TRANSFORMED.names] + [T.StructField("error", T.StringType())]
)


def _nullable(schema: T.StructType) -> T.StructType:
    """As files deliver it: no column is promised to be filled."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema] + [BATCH])


class Store:
    """The tables below one root folder."""

    SCHEMAS = {
        "landing_documents": LANDING,
        "landing_content": CONTENT,
        "landing_keys": LANDING_KEYS,
        "transformed_documents": TRANSFORMED,
        "transformed_content": TRANSFORM_OUTCOME,
        "partition_attempts": ATTEMPT,
    }
    PARTITIONS = {
        "landing_documents": ["ingest_batch", "section_id", "partition_date"],
        "landing_content": ["ingest_batch", "section_id", "partition_date"],
        "landing_keys": ["ingest_batch", "bucket"],
        "transformed_documents": ["ingest_batch", "section_id", "partition_date"],
        "transformed_content": ["ingest_batch", "section_id", "partition_date"],
        "partition_attempts": ["ingest_batch"],
    }

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.commits = Commits(spark, self.root)
        # Changes of this thread that are not committed yet.
        self._open = threading.local()

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @property
    def _changes(self) -> dict | None:
        return getattr(self._open, "changes", None)

    @contextmanager
    def together(self) -> Iterator[None]:
        """Writes and drops inside are seen by this thread, and by others all at once at the end, or never."""
        if self._changes is not None:
            yield
            return
        self._open.changes = {}
        try:
            yield
            if self._changes:
                self.commits.commit(self._changes)
        finally:
            self._open.changes = None

    def _folders(self, table: str) -> dict[str, str]:
        """Folder of each batch that a table has."""
        folders = {**self.commits.newest().folders, **(self._changes or {})}
        return {batch: folder for (of, batch), folder in sorted(folders.items()) if of == table and folder}

    def read(self, table: str, batches: list[str] | None = None) -> DataFrame:
        """Committed rows, of all batches or some; a batch that is not there has none."""
        schema = _nullable(self.SCHEMAS[table])
        paths = [f"{self.path(table)}/ingest_batch={batch}/{folder}" for batch, folder in self._folders(table).items()
                 if batches is None or batch in batches]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)
        return rows.select(*schema.names)

    def write(self, table: str, rows: DataFrame, batch: str) -> None:
        """Write a batch; whatever the batch had written before goes, also folders it no longer fills."""
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.SCHEMAS[table]]
        out = rows.select(*columns)
        folders = self.PARTITIONS[table][1:]
        if folders:
            # Few files per folder; a folder that holds very many rows is split.
            out = out.hint("rebalance", *folders)
        folder = f"write=w{uuid.uuid4().hex}"
        writer = out.write
        (writer.partitionBy(*folders) if folders else writer).parquet(f"{self.path(table)}/ingest_batch={batch}/{folder}")
        with self.together():
            self._changes[table, batch] = folder

    def batches(self, table: str) -> list[str]:
        """Batches that a table has."""
        return sorted(self._folders(table))

    def drop(self, table: str, batch: str) -> None:
        with self.together():
            self._changes[table, batch] = None

    def arrivals(self, table: str) -> DataFrame:
        """Stream of the names of batches as they are committed: (batch, folder)."""
        return self.commits.stream(table)

    def check_order(self, batch: str, replay: bool = False) -> None:
        """A batch is refused where later ones were numbered after it. Only names are read."""
        if not replay and any(name > batch for name in self.batches("landing_documents")):
            raise ValueError(f"batch {batch!r} is older than the newest; later versions count on it")
