"""Lines that many documents share, found with levelled sorted runs of line hashes.

``LineRuns`` keeps what earlier batches had, as bucketed sorted tables in the
shared folder: open runs of (hash, documents) by level, and one settled run of
hashes that already reached ``least`` documents. A new batch counts its own
lines, merge-anti-joins the settled run, so that a line whose fate is known is
not written again, and adds the rest as a run of level 0. When a level holds
``FANOUT`` runs they are merged into one of the next level; sums that reach
``least`` move to the settled run. All runs share one bucketing by h1, one sorted
file per bucket, so merges and joins read a run bucket by bucket in its order:
a batch is shuffled, a run is neither shuffled nor sorted to be read (writing
sorts each bucket once more by itself, as Spark's bucketed writer does).

A key is the line without ASCII white space at its ends, A-Z lower-cased. It
is held as two 64-bit hashes with different beginnings.

Defined results: null or empty text is one empty line, whose key is too short
to be dropped; each row counts as a document, also repeated ones; a document's
own repeats of a line count once; null ids are kept apart by their texts;
other columns are passed on by ``drop_lines``; an empty table gives an empty
result. Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.base import BLANKS, ascii_lower, forget, fresh, lean, query, table
from paperloom.session import new_folder

LEAST, FANOUT, BATCHES = 10, 2, 4
# Buckets of h1 serve joins on (h1, h2), and one sorted file per bucket is read in its order.
MERGING = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
           "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def hashed(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def document_keys(docs: DataFrame, shortest: int) -> DataFrame:
    """One row per document and distinct key: doc_id, mark (hash of the text), h1, h2."""
    keys = F.filter(F.transform(lines_of(F.col("text")), line_key), lambda k: F.length(k) >= shortest)
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.explode(F.array_distinct(keys)).alias("key"))
    return rows.select("doc_id", "mark", hashed(F.col("key")).alias("h")).select("doc_id", "mark", "h.h1", "h.h2")


class LineRuns:
    """The index. ``add`` takes batches of (h1, h2) rows, one for each document and key."""

    def __init__(self, spark: SparkSession, least: int = LEAST, fanout: int = FANOUT):
        self.spark, self.least, self.fanout = spark, least, fanout
        self.folder = new_folder(spark, "lines")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.settled: str | None = None
        self.interim: list[str] = []

    def _write(self, counts: DataFrame) -> str:
        """A run of rows that lie in their buckets: one sorted file per bucket."""
        name = f"lines_{uuid.uuid4().hex}"
        with lean(self.spark, MERGING):
            (counts.select("h1", "h2", "n").write.option("path", f"{self.folder}/{name}")
             .bucketBy(self.buckets, "h1").sortBy("h1", "h2").saveAsTable(name))
        return name

    def _drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            forget(self.spark, f"{self.folder}/{name}")

    def _both(self, one: DataFrame, other: DataFrame) -> DataFrame:
        """Two runs merged by their sort order, bucket by bucket."""
        both = one.join(other.withColumnRenamed("n", "m").hint("merge"), ["h1", "h2"], "full_outer")
        return both.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))

    def _sum(self, runs: list[str]) -> DataFrame:
        """Runs merged two at a time, the smallest first; all merges but the last are written."""
        while len(runs) > 2:
            self.interim.append(self._write(self._sum(runs[:2])))
            runs = [*runs[2:], self.interim[-1]]
        first = self.spark.table(runs[0])
        return first if len(runs) == 1 else self._both(first, self.spark.table(runs[1]))

    def _unsettled(self, run: str) -> DataFrame:
        """A run without settled lines."""
        return self.spark.table(run).join(self.spark.table(self.settled).hint("merge"), ["h1", "h2"], "left_anti")

    def add(self, keys: DataFrame) -> None:
        # Written before it meets the settled run: the engine would move that join below the sums and shuffle every key.
        run = self._write(keys.groupBy("h1", "h2").agg(F.count("*").alias("n")).repartition(self.buckets, "h1"))
        if self.settled:
            run, own = self._write(self._unsettled(run)), run
            self._drop(own)
        self.levels[0].append(run)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._compact(self.levels[level]))
            self.levels[level] = []
            level += 1

    def _compact(self, runs: list[str]) -> str:
        """One run for several; what has reached ``least`` goes to the settled run."""
        merged = self._write(self._sum(runs))
        whole = self.spark.table(merged)
        ripe = whole.where(F.col("n") >= self.least)
        if self.settled:
            ripe = self._both(self.spark.table(self.settled), ripe)
        settled = self._write(ripe)
        rest = self._write(whole.where(F.col("n") < self.least))
        self._drop(*runs, merged, *self.interim, *([self.settled] if self.settled else []))
        self.settled, self.interim = settled, []
        return rest

    def frequent(self) -> DataFrame:
        """(h1, h2) of every line that ``least`` documents have."""
        runs = [name for level in self.levels for name in level]
        if not runs:
            return self.spark.createDataFrame([], "h1 long, h2 long")
        found = self._sum(runs).where(F.col("n") >= self.least).select("h1", "h2")
        return found.unionByName(self.spark.table(self.settled).select("h1", "h2")) if self.settled else found

    def close(self) -> None:
        self._drop(*[name for level in self.levels for name in level], *self.interim, *([self.settled] if self.settled else []))


def batches_of(docs: DataFrame, n: int) -> list[DataFrame]:
    """Ranges of doc_id with about as many documents each; null ids are in the first."""
    ids = docs.select(F.col("doc_id").cast("double").alias("x"))
    bounds = sorted(set(ids.approxQuantile("x", [i / n for i in range(1, n)], 0.01))) if n > 1 else []
    edges = [None, *[int(b) for b in bounds], None]
    parts = []
    for low, high in zip(edges[:-1], edges[1:]):
        part = F.lit(True)
        if low is not None:
            part = part & (F.col("doc_id") > low)
        if high is not None:
            part = part & ((F.col("doc_id") <= high) if low is not None else (F.col("doc_id").isNull() | (F.col("doc_id") <= high)))
        parts.append(docs.where(part))
    return parts


def frequent_lines(docs: DataFrame, least: int = LEAST, shortest: int = 1, batches: int = BATCHES) -> tuple[DataFrame, LineRuns]:
    runs = LineRuns(docs.sparkSession, least)
    for batch in batches_of(docs.select("doc_id", "text"), batches):
        runs.add(document_keys(batch, shortest))
    return runs.frequent(), runs


def drop_lines(docs: DataFrame, least: int = LEAST, shortest: int = 1, batches: int = BATCHES) -> DataFrame:
    """``docs`` without shared lines, plus n_lines (before) and n_dropped. A text that loses nothing stays as it is."""
    spark = docs.sparkSession
    frequent, runs = frequent_lines(docs, least, shortest, batches)
    path = f"{runs.folder}/dropped"
    keys = document_keys(docs.select("doc_id", "text"), shortest)
    with lean(spark, MERGING):
        shared = keys.join(frequent, ["h1", "h2"], "left_semi")
        shared.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("h1", "h2")).alias("shared")).write.parquet(path)
    runs.close()
    dropped = spark.read.schema("doc_id long, mark long, shared array<struct<h1: long, h2: long>>").parquet(path)
    mark, before, after = fresh([*docs.columns, "n_lines", "n_dropped"], "mark", "before", "after")
    d, s = docs.withColumn(mark, F.xxhash64("text")).alias("d"), dropped.alias("s")
    joined = d.join(s, F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col(f"d.{mark}") == F.col("s.mark")), "left")
    lines = lines_of(F.col("d.text"))
    kept = F.when(F.col("s.shared").isNull(), lines).otherwise(F.filter(lines, lambda line: ~F.array_contains(
        F.col("s.shared"), hashed(line_key(line)))))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = joined.select(*[F.col(f"d.{c}") for c in columns if c != "text"], F.col("d.text").alias(before),
                         F.size(lines).cast("long").alias("n_lines"), kept.alias(after))
    n_dropped = F.col("n_lines") - F.size(after)
    text = F.when(n_dropped == 0, F.col(before)).otherwise(F.array_join(after, "\n"))
    return rows.select(*[text.alias("text") if c == "text" else F.col(c) for c in columns], "n_lines", n_dropped.alias("n_dropped"))


SQL = """
    WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) i, unnest(ls) line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) ls FROM documents)),
    k AS (SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k FROM l),
    f AS (SELECT k FROM k WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
    SELECT doc_id, count(*) n_lines, count(f.k) n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.k IS NULL), '')) kept_sha256
    FROM k LEFT JOIN f USING (k) GROUP BY doc_id"""


@query("op5_line_dedup", SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
