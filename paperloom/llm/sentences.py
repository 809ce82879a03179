"""Passages that documents share, by sliding spans of sentences.

A text is cut into units: sentences, and pieces of those that have enough words
for two; a unit has at most ``LONGEST`` words. The words themselves say where
to cut, so that the same words get the same pieces wherever their sentence
begins and ends. Every run of ``RUN`` consecutive units, however short, is
hashed (128 bits, of its words with A-Z lower-cased). Spark counts the hashes
and finds each one's first place; every later run covers its units, and runs
that touch are one span. Spans of at least ``least_words`` words are removed; 0
removes all. Units that lie only partly in a repeated passage stay.

The first place is that of the smallest (doc_id, hash of the text, unit); so a
repeat inside one document goes too.

Defined results: null and empty texts have no units; a text of one unit has no
run and stays; null ids come first; rows of one id with one text are the same
document, so neither is earlier; what remains keeps its own white space; other
columns are passed on (columns with the names of results are replaced); an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import base
from paperloom.llm.base import forget, fresh, keep, query, table
from paperloom.llm.words import LOWERED

RUN, LONGEST = 2, 24
# Words of the shortest repeated span that the query removes. Shorter ones are mostly lines that belong
# to many documents and are no passages.
PASSAGE = 12
# Pieces of a sentence have at least so many words: two of them make a run.
SHORTEST = 6
# Odd, and its inverse modulo 2^64: hashes of words from sums over the bytes.
FACTOR = 0x100000001B3
INVERSE = pow(FACTOR, -1, 1 << 64)
LOWEST = -(1 << 63)
_END = re.compile(rb"(?<=[.!?])[ \t\x0b\x0c\r]+|[ \t\x0b\x0c\r]*\n\s*")


@lru_cache(4)
def _all_powers(base: int, bits: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(1 << bits, base, np.uint64)]), dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    """The powers of ``base`` from 0 to n, modulo 2^64."""
    return _all_powers(base, max(n.bit_length(), 16))[:n + 1]


class Places:
    """Of all words of a text: first byte, hash with the word before, and where that hash is the least of all near it."""

    def __init__(self, data: bytes):
        byte = np.frombuffer(data.translate(LOWERED), np.uint8)
        edge = np.diff(((byte != 0x20) & ((byte < 9) | (byte > 13))).astype(np.int8), prepend=0, append=0)
        self.starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum((byte + np.uint64(1)) * _powers(FACTOR, len(byte))[:-1], dtype=np.uint64)])
            own = (sums[ends] - sums[self.starts]) * _powers(INVERSE, len(byte))[self.starts]
            own = own * np.uint64(0x9E3779B97F4A7C15)
            x = (np.concatenate([own[:1], own[:-1]]) ^ (own >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + own
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
        self.value = x ^ (x >> np.uint64(31))
        least = np.ones(len(x), bool)
        for k in range(1, SHORTEST):
            least[k:] &= self.value[k:] < self.value[:-k]
            least[:-k] &= self.value[:-k] <= self.value[k:]
        self.least = np.flatnonzero(least).tolist()

    def cuts(self, low: int, high: int) -> list[int]:
        """First words of the pieces of the sentence of these words.

        A cut is where the hash is the least within ``SHORTEST`` - 1 places;
        what that leaves longer than ``LONGEST`` is cut at its least hash in reach.
        """
        out = [low]
        for end in [*self.least[bisect_left(self.least, low + SHORTEST):bisect_right(self.least, high - SHORTEST)], high]:
            while end - out[-1] > LONGEST:
                first = out[-1] + SHORTEST
                out.append(first + int(self.value[first:min(out[-1] + LONGEST, end - SHORTEST) + 1].argmin()))
            out.append(end)
        return out[:-1]


def units(data: bytes) -> list[tuple[int, int, list[bytes]]]:
    """(start, end, words) of each unit, in bytes; a unit ends with the white space after it."""
    out = []
    at = word = 0
    places = Places(data)
    ends = [m.end() for m in _END.finditer(data)]
    for end in [*ends, len(data)]:
        found = data[at:end].split()
        if not found:
            continue  # white space belongs to the unit that follows
        if len(found) >= 2 * SHORTEST:
            first = places.cuts(word, word + len(found))
            begins = [at, *places.starts[first[1:]].tolist(), end]
            for k, a in enumerate(first):
                b = first[k + 1] if k + 1 < len(first) else word + len(found)
                out.append((begins[k], begins[k + 1], found[a - word:b - word]))
        else:
            out.append((at, end, found))
        word += len(found)
        at = end
    if out and at < len(data):
        out[-1] = (out[-1][0], len(data), out[-1][2])
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("place"), F.xxhash64("text").alias("mark"), "text")


def runs(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(place, mark, at, h1, h2) of every run by its first unit."""
    def work(batches):
        for batch in batches:
            which, at, digests = [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                found = units((text or "").encode().translate(LOWERED))
                own = [xxhash.xxh3_128_digest(b" ".join(w)) for _, _, w in found]
                n = max(len(own) - run + 1, 0)
                which += [row] * n
                at += range(n)
                digests += [xxhash.xxh3_128_digest(b"".join(own[i:i + run])) for i in range(n)]
            h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            which = pa.array(which, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(which), batch.column(1).take(which), pa.array(at, pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1])],
                                             names=["place", "mark", "at", "h1", "h2"])

    return base.by_batch(_keyed(docs), work, "place long, mark long, at int, h1 long, h2 long", 4 << 20)


def later_units(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(place, mark, gone): first units of the runs that occur earlier."""
    every, path = keep(runs(docs, run), "runs")
    own = F.struct("place", "mark", "at")
    firsts = every.groupBy("h1", "h2").agg(F.min(own).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = every.join(firsts, ["h1", "h2"]).where(own > F.col("first"))
    gone, _ = keep(later.groupBy("place", "mark").agg(F.collect_set("at").alias("gone")), "later")
    forget(docs.sparkSession, path)
    return gone


def covered(gone: list[int], sizes: list[int], run: int, least_words: int) -> set[int]:
    """Units of the spans that runs starting at ``gone`` make up, if these have enough words."""
    out: set[int] = set()
    span: list[int] = []
    for i in sorted({x + k for x in gone for k in range(run)}):
        if span and i > span[-1] + 1:
            out.update(span if sum(sizes[k] for k in span) >= least_words else ())
            span = []
        span.append(i)
    out.update(span if sum(sizes[k] for k in span) >= least_words else ())
    return out


def cut_passages(docs: DataFrame, run: int = RUN, least_words: int = 0) -> DataFrame:
    """``docs`` with what is left of their texts, plus n_sentences, n_removed and n_bytes_removed."""
    names = ["n_sentences", "n_removed", "n_bytes_removed"]
    carried = docs.drop(*names)
    gone = later_units(docs, run).alias("g")
    at, mark, own = fresh(carried.columns, "place", "mark", "gone")
    d = carried.withColumn(mark, F.xxhash64("text")).withColumn(at, F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))).alias("d")
    joined = d.join(gone, (F.col(f"d.{at}") == F.col("g.place")) & (F.col(f"d.{mark}") == F.col("g.mark")), "left")
    columns = carried.columns
    text, width = columns.index("text"), len(columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields)

    def work(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for value, later in zip(batch.column(text).to_pylist(), batch.column(width).to_pylist()):
                data = (value or "").encode()
                found = units(data)
                out_of = covered(later or [], [len(w) for _, _, w in found], run, least_words)
                kept = b"".join(data[a:b] for i, (a, b, _) in enumerate(found) if i not in out_of) if out_of else data
                row = (kept.decode() if out_of else value, len(found), len(out_of), len(data) - len(kept))
                for column, x in zip(out, row):
                    column.append(x)
            arrays = [pa.array(c, t) for c, t in zip(out, [pa.string()] + [pa.int64()] * 3)]
            yield pa.RecordBatch.from_arrays([arrays[0] if i == text else batch.column(i) for i in range(width)] + arrays[1:], names=[*columns, *names])

    picked = joined.select(*[F.col(f"d.{c}") for c in columns], F.col("g.gone").alias(own))
    return base.by_batch(picked, work, f"{schema}, n_sentences long, n_removed long, n_bytes_removed long", 4 << 20)


@query("op9_sentence_spans")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), least_words=PASSAGE)
    return rows.select("doc_id", "n_sentences", "n_removed", "n_bytes_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), "text")
