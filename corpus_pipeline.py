"""The corpus pipeline: documents in, packed training sequences out.

Each stage gets what the one before kept, as a table that was written and read
again; all but the last return the columns of documents. Empty tables pass
through every stage. Other columns are passed on, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import decontaminate, jaccard, line_dedup, packing, quality
from paperloom.llm.base import fresh, keep, table

# Tokens are the work of a tokenizers file, which SQL can't express.
ORACLE_SQL = None
LOWEST = -(1 << 63)


def _with_length(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules. Null and empty texts fail; repeated rows and null ids are judged row by row."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that ten or more rows share. A row counts as a document, also with a repeated or null id."""
    return _with_length(line_dedup.drop_lines(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, null ids last.

    Of rows with one id and text one stays; texts of one id are one document,
    of which one text stays. Documents without words are in no group and stay.
    """
    stay = jaccard.one_of_each(docs)
    mark, unknown = fresh(docs.columns, "mark", "unknown")
    stay = stay.select(F.coalesce("doc_id", F.lit(LOWEST)).alias("of"), F.col("doc_id").isNull().alias(unknown), F.col("mark").alias(mark))
    keyed = docs.withColumn(mark, F.xxhash64("text")).withColumn(unknown, F.col("doc_id").isNull())
    same = (F.coalesce(keyed["doc_id"], F.lit(LOWEST)) == stay["of"]) & (keyed[unknown] == stay[unknown]) & (keyed[mark] == stay[mark])
    return keyed.join(stay, same, "left_semi").dropDuplicates(["doc_id", mark]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's passages; those that are mostly such passages go. Null texts stay null."""
    return _with_length(decontaminate.remove(docs, table(spark, sf_dir, "benchmark")), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece; a null text is one piece, the end id."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = keep(stage(spark, docs, sf_dir), name)
    return keep(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])[0]
