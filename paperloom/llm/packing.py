"""Packing by power-of-two decomposition.

Each document's ids (with its end id) are cut into pieces of ``longest`` ids
and then of the powers of two that make up the rest, largest first. Every
piece is a sequence of its own, so no sequence crosses documents, none is
padded, and sequences of one length form a bucket: their numbers follow each
other, so a training step can draw equal lengths.

Defined results: null text is empty and gives one piece, the end id; repeated
ids are documents of their own; other columns are ignored; an empty table has
no pieces.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.llm import base
from paperloom.llm.base import keep, query, table
from paperloom.llm.tokens import encoder, public_file
from paperloom.operators.sides import broadcast_if_small

LONGEST = 2048
# Rows of the table of first numbers that are sent to all tasks: some 20 MB.
STARTS = 500_000
PIECE = "part int, number long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"


def cuts(n: int, longest: int = LONGEST) -> list[tuple[int, int]]:
    """(start, length) of a document of ``n`` ids; ``longest`` is a power of two."""
    out = [(at, longest) for at in range(0, n - n % longest, longest)]
    at, rest = n - n % longest, n % longest
    while rest:
        length = 1 << rest.bit_length() - 1
        out.append((at, length))
        at, rest = at + length, rest - length
    return out


def pieces(docs: DataFrame, tokenizer: str, end_id: int, longest: int = LONGEST, with_ids: bool = True) -> DataFrame:
    """Pieces with a checksum and, if wanted, their ids; numbered within their length and partition."""
    names = NAMES if with_ids else NAMES[:-1]

    def work(batches):
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        counts: dict[int, int] = {}
        for batch in batches:
            ids, at = enc.encode(batch.column(1))
            out: list[tuple] = []
            for doc_id, a, b in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                data = np.append(ids[a:b], np.uint32(end_id)).astype("<u4").tobytes()
                for start, length in cuts(b - a + 1, longest):
                    number = counts.get(length, 0)
                    counts[length] = number + 1
                    own = data[4 * start:4 * (start + length)]
                    out.append((part, number, doc_id, start, length, b - a + 1, crc32(own), own)[:len(names)])
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ARROW)], names=names)

    schema = ", ".join(PIECE.split(", ")[:len(names)])
    return base.by_batch(docs.select(F.col("doc_id").cast("long"), "text"), work, schema)


NAMES = [part.split(" ")[0] for part in PIECE.split(", ")]
ARROW = [pa.int32()] + [pa.int64()] * 6 + [pa.binary()]


def bases(stored: DataFrame) -> DataFrame:
    """(length, part, base): how many sequences shorter buckets and earlier partitions have.

    Sums run over partitions within a length; only the totals of the lengths,
    a dozen rows, come to the driver.
    """
    sizes = stored.groupBy("length", "part").agg(F.count("*").alias("n"))
    before, total = [], 0
    for length, n in sorted(map(tuple, sizes.groupBy("length").agg(F.sum("n")).collect())):
        before.append((length, total))
        total += n
    shorter = F.coalesce(*[F.when(F.col("length") == length, F.lit(n)) for length, n in before], F.lit(0))
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    return sizes.select("length", "part", (earlier + shorter).cast("long").alias("base"))


def pack(docs: DataFrame, tokenizer: str, end_id: int, longest: int = LONGEST, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if wanted.

    The pieces are written once, so their numbers hold. A table with a row for
    each partition and length says where their numbers begin; while it is
    small, it goes to the pieces, and their ids stay where they are.
    """
    stored, _ = keep(pieces(docs, tokenizer, end_id, longest, with_ids), "pieces")
    numbered = stored.join(broadcast_if_small(bases(stored), STARTS), ["length", "part"])
    more = ["ids"] if with_ids else []
    return numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("number")).alias("sequence_id"),
                           F.lit(0).cast("long").alias("offset"), *more)


def packed(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The pieces without their ids, which are then not stored either."""
    return pack(docs, tokenizer or public_file("byte_bpe_50k.json"), end_id=1, with_ids=False)


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
