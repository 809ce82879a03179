"""Dealing out of input rows."""

from pyspark.sql import functions as F

from paperloom.sources.pages import ROWS_PER_TASK, spread


def _shares(rows):
    return [row["count"] for row in rows.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    """The file has more splits than there are cores, but all rows lie in one of them."""
    rows = 4 * ROWS_PER_TASK + 1000
    spark.range(rows).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1).write.parquet(str(tmp_path / "one"))
    before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in before:
            spark.conf.set(key, "256k")
        stored = spark.read.parquet(str(tmp_path / "one"))
        assert stored.rdd.getNumPartitions() > 4 and max(_shares(stored)) == rows
        shares = _shares(spread(stored))
        even = spark.range(1000).repartition(8)
        assert sum(shares) == rows and max(shares) <= ROWS_PER_TASK
        assert spread(even) is even
        assert spread(stored.where("id < 0")).count() == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_rows_by_keys_keep_the_number_of_tasks(spark):
    """Narrow rows, of which the engine would put all into one task after a shuffle."""
    grouped = spread(spark.range(1000).withColumn("k", F.col("id") % 50), "k").groupBy("k").count()
    assert grouped.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and grouped.count() == 50
