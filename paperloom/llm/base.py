"""What the operators of this subpackage share: tables that are written once, and byte-level text helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.session import new_folder

# Shuffle files go with their job. And a union of bucketed tables isn't taken for one bucketed table:
# Spark 4.1 may then read the tables without their buckets, and would sum up parts of a key apart.
DURING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.unionOutputPartitioning": "false"}
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` and, where SQL can say it, the SQL that gives the same rows."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def lean(spark: SparkSession, more: dict[str, str] | None = None):
    """Settings of the jobs that write an intermediate table, and ``more``."""
    during = {**DURING, **(more or {})}
    before = {key: spark.conf.get(key, None) for key in during}
    for key, value in during.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def keep(rows: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """Write ``rows`` to the shared folder; the table read back, and its path.

    The table has no lineage, survives lost executors, and all later readers
    see one evaluation.
    """
    spark = rows.sparkSession
    path = new_folder(spark, purpose)
    with lean(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete tables of ``keep`` that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only. Pure ASCII takes the faster built-in function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


PORTION = 8 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def fresh(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, with as many underscores behind them as make them differ from all ``columns``."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def by_batch(rows: DataFrame, work: Callable[[Iterator], Iterator], schema: str, portion: int = PORTION) -> DataFrame:
    """``mapInArrow`` over slices of about ``portion`` bytes, so that a task holds little at a time.

    Neither side of the exchange with the Python workers holds larger batches:
    the session's limit of an Arrow batch is lowered to ``PORTION``.
    """
    conf = rows.sparkSession.conf
    if int(conf.get(ARROW_BYTES).rstrip("b") if conf.get(ARROW_BYTES).rstrip("b").isdigit() else PORTION + 1) > PORTION:
        conf.set(ARROW_BYTES, f"{PORTION}b")

    def portions(batches):
        for batch in batches:
            step = max(1, batch.num_rows * portion // max(batch.nbytes, 1))
            for start in range(0, batch.num_rows, step):
                yield batch.slice(start, step)

    return rows.mapInArrow(lambda batches: work(portions(batches)), schema)
