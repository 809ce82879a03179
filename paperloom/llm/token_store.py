"""Token ids on disk: one frame per document, compressed with a shared dictionary.

``write_store`` range-partitions the documents by id, encodes every whole text
and writes blocks. A block is one row: the ids of its documents, the byte
offsets of their frames (the offset index), token counts and the frames. Each
frame is one document's ids, compressed on its own with a zstandard dictionary
that was trained on serialised id arrays, so that a short document costs a few
bytes and can be read without its neighbours. Every block names the hash of
the dictionary; the dictionary is a small table beside the blocks.

Defined results: null text is empty (only the end id); null ids sort first;
repeated ids are documents of their own, in the order of their texts' hashes;
other columns are ignored; an empty table gives a store without blocks.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import base
from paperloom.llm.base import lean, query, table
from paperloom.llm.tokens import encoder, public_file
from paperloom.session import new_folder

DICTIONARY_BYTES = 64 << 10
# The dictionary is fitted on this many documents of moderate length, chosen by the hash of their id.
SAMPLE, SAMPLE_CHARS = 1_000, 20_000
BLOCK_BYTES, BLOCK_DOCUMENTS = 4 << 20, 5_000
LEVEL = 3
BLOCK = ("shard int, block int, dictionary string, width int, base long, first_doc long, last_doc long, "
         "doc_ids array<long>, offsets array<long>, counts array<long>, frames binary")


def _width(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


def _dictionary(texts: list[str], path: str, end_id: int) -> bytes:
    """A dictionary for the sample; empty where the sample is too small to train one."""
    import zstandard

    enc = encoder(path)
    ids, at = enc.encode(pa.array(texts, pa.large_string()))
    kind = f"<u{_width(enc.vocabulary)}"
    samples = [np.append(ids[a:b], end_id).astype(kind).tobytes() for a, b in zip(at[:-1], at[1:])]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(data: bytes, make):
    import zstandard

    return make(zstandard, zstandard.ZstdCompressionDict(data) if data else None)


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Write ``docs(doc_id, text)`` in ascending order of their ids to ``path``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    every = docs.count()
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(max(every // (2 * SAMPLE), 1))) == 0
    sample = docs.where(chosen & F.length("text").between(1, SAMPLE_CHARS)).orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(SAMPLE)
    data = _dictionary([row.text for row in sample.select("text").collect()], tokenizer, end_id)
    name = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(name, data)], "dictionary string, data binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def blocks(batches):
        enc = encoder(tokenizer)
        width = _width(enc.vocabulary)
        pack = _compressor(data, lambda z, d: z.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=True))
        shard, number, total = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []

        def block():
            nonlocal number, total
            ids = [x for x, _, _ in held]
            sizes = np.cumsum([0] + [len(f) for _, f, _ in held])
            known = [x for x in ids if x is not None]
            row = [shard, number, name, width, total, min(known, default=None), max(known, default=None), ids,
                   sizes.tolist(), [c for _, _, c in held], b"".join(f for _, f, _ in held)]
            number, total = number + 1, total + sum(c for _, _, c in held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, ARROW)], names=NAMES)

        size = 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            ids, at = enc.encode(batch.column(1))
            ids = ids.astype(f"<u{width}")
            for doc_id, a, b in zip(doc_ids, at[:-1].tolist(), at[1:].tolist()):
                frame = pack.compress(np.append(ids[a:b], ids.dtype.type(end_id)).tobytes())
                held.append((doc_id, frame, b - a + 1))
                size += len(frame)
                if size >= BLOCK_BYTES or len(held) >= BLOCK_DOCUMENTS:
                    yield block()
                    size = 0
        if held:
            yield block()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    with lean(spark):
        base.by_batch(ordered, blocks, BLOCK).write.parquet(f"{path}/blocks")


NAMES = [part.strip().split(" ")[0] for part in BLOCK.split(", ")]
ARROW = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
         pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK).parquet(f"{path}/blocks")


def read_store(spark: SparkSession, path: str, blocks: DataFrame | None = None, ids: bool = True) -> DataFrame:
    """Every document of the store: doc_id, start (ids before it), n_tokens, crc of its ids, and the ids.

    The numbers of ids before each shard come from one sum per shard.
    """
    whole = read_blocks(spark, path)
    blocks = whole if blocks is None else blocks
    row = spark.read.parquet(f"{path}/dictionary").first()
    name, data = row.dictionary, bytes(row.data)
    sums = whole.groupBy("shard").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = {}
    total = 0
    for shard in sorted(sums.collect()):  # one row for each written partition
        before[shard.shard] = total
        total += shard.n

    def documents(batches):
        unpack = _compressor(data, lambda z, d: z.ZstdDecompressor(dict_data=d))
        for batch in batches:
            for block in batch.to_pylist():
                if block["dictionary"] != name:
                    raise ValueError(f"block {block['shard']}/{block['block']} wants another dictionary")
                frames, at = block["frames"], before[block["shard"]] + block["base"]
                out = {"doc_id": block["doc_ids"], "start": [], "n_tokens": block["counts"], "ids_crc32": [], "ids": []}
                for a, b, n in zip(block["offsets"], block["offsets"][1:], block["counts"]):
                    found = np.frombuffer(unpack.decompress(frames[a:b]), f"<u{block['width']}").astype("<u4").tobytes()
                    out["start"].append(at)
                    out["ids_crc32"].append(zlib.crc32(found))
                    if ids:
                        out["ids"].append(found)
                    at += n
                arrays = [pa.array(out[c], pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]
                if ids:
                    arrays.append(pa.array(out["ids"], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=list(out)[:len(arrays)])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")
    return base.by_batch(blocks, documents, schema)


def fetch(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Some documents: blocks are pruned by their id ranges, then cut by the offset index."""
    wanted = F.array(*[F.lit(int(x)).cast("long") for x in doc_ids])
    near = F.lit(False)
    for x in doc_ids:
        near = near | ((F.col("first_doc") <= int(x)) & (F.col("last_doc") >= int(x)))
    blocks = read_blocks(spark, path).where(near)
    return read_store(spark, path, blocks).where(F.array_contains(wanted, F.col("doc_id")))


@query("op2_token_store")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    write_store(table(spark, sf_dir, "documents"), path, public_file("byte_bpe_50k.json"), end_id=0)
    return read_store(spark, path, ids=False)
