"""Connected components of a link table, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.base import forget, keep


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the smallest node of its component.

    Every node points to its smallest neighbour, or itself; pointers are
    doubled until they end at local minima; links between these are what is
    left for the next round. Each round at least halves the nodes. A node with
    very many links is only ever grouped with partial sums, and joined as a
    key that Spark splits.
    """
    spark = links.sparkSession
    left, path = keep(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    done: DataFrame | None = None
    old = [path]
    while not left.isEmpty():
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        pointer, at = keep(near.select("node", F.least("node", "low").alias("root")), "pointers")
        while True:
            up = pointer.select(F.col("node").alias("root"), F.col("root").alias("above"))
            step, to = keep(pointer.join(up, "root").select("node", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "pointers")
            forget(spark, at)
            pointer, at = step.select("node", "root"), to
            if step.where("moved").isEmpty():
                break
        if done is None:
            done, kept = pointer, at
        else:
            merged = done.alias("d").join(pointer.alias("p"), F.col("d.root") == F.col("p.node"), "left").select("d.node", F.coalesce("p.root", "d.root").alias("root"))
            new, kept = keep(merged, "components")
            old.append(at)
            done = new
        old.append(kept)
        a, b = pointer.toDF("a", "ra"), pointer.toDF("b", "rb")
        between = left.join(a, "a").join(b, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        left, path = keep(between, "links")
        old.append(path)
    if done is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    forget(spark, *[x for x in old if x != kept])
    return done
