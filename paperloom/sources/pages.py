"""Page archives: reading fetched pages, splitting tiny inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.schemas import FETCH


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived responses with the fields a crawl reads off them."""
    return spark.read.schema(FETCH).parquet(path)


def read_objects(spark: SparkSession, path: str, bucket: str) -> DataFrame:
    """Objects lying in a bucket folder, as (file_path, content)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    key = F.regexp_extract("path", f"/{bucket}/(.*)$", 1)
    return files.select(F.concat(F.lit(bucket + "/"), key).alias("file_path"), "content")


# Rows of a task that does heavy work on each; half a minute or so.
ROWS_PER_TASK = 25_000


def spread(pages: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out where tasks would get unequal shares, or too many rows for heavy work on each.

    Input splits say little: a file's row groups are never divided, so one
    split may hold all rows and the others none. Rows per split are counted,
    which reads no column; where they are even and few, nothing is shuffled.
    Rows that are to be grouped go by their ``keys`` at once; the number of
    tasks is kept then, where the engine would pack narrow rows into few.
    """
    cores = pages.sparkSession.sparkContext.defaultParallelism
    splits = pages.groupBy(F.spark_partition_id()).count()
    found = splits.agg(F.count(F.lit(1)).alias("splits"), F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    rows = found["rows"] or 0
    parts = max(cores, found["splits"], -(-rows // ROWS_PER_TASK))
    if keys:
        return pages.repartition(parts, *keys)
    return pages.repartition(parts) if (found["most"] or 0) * parts > 2 * rows else pages
