"""Periodic runs of words, by branching tandem repeats of an enhanced suffix array.

The texts of a slice get one suffix array: a word counts together with its
text, so suffixes of different texts share nothing. It is built by doubling
ranks; only suffixes that still share their rank are sorted again. The ranks of
all rounds stay, so the length that two positions have in common, forwards or
backwards, is read off in as many steps as there were rounds. That gives the
longest common prefixes of neighbours in the array; their intervals are found by
a search for the next smaller value on both sides, without a tree.

A square of period d (two equal halves of d words) that can't be shifted to the
right has its halves in different children of an interval of depth d. So every
interval looks only at the suffixes of its smaller children: i and i + d are
such a square if the inverse array says that i + d lies in the interval, and
i - d and i if i - d does. A suffix changes to an interval twice as large each
time it is looked at, so there are at most n log n looks. Each run has exactly
one such square at its end. Rotating it to the left, as long as the words agree,
gives where the run starts; of runs over the same words the one with the
smallest period stays.

A run of at least ``exponent`` periods has as many suffixes in its interval, so
smaller intervals are left out. Whole texts are handled in their task; nothing
is shuffled or gathered.

Defined results: a null or empty text has no words and no runs; every row is
handled alone, so repeated and null ids give a row each; a null id is not
edited. An empty table gives no rows. Columns other than ``doc_id`` and ``text``
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.base import by_batch, query, table
from paperloom.llm.words import words

LEAST_WORDS, EXPONENT = 6, 4
PORTION = 2 << 20


class Suffixes(NamedTuple):
    array: np.ndarray          # positions in order
    levels: list[np.ndarray]   # per round h: ranks by the first 2**h words; equal only if these are equal
    place: np.ndarray          # of each position in the array


def suffixes(codes: np.ndarray, text: np.ndarray, ends: np.ndarray) -> Suffixes:
    """Suffix array of several texts; ``text`` and ``ends`` give the number and end of each position's text."""
    n = len(codes)
    key = text * (int(codes.max(initial=0)) + 1) + codes
    array = np.argsort(key, kind="stable").astype(np.int32)
    rank = np.empty(n, np.int32)
    new = np.ones(n, bool)
    new[1:] = np.diff(key[array]) != 0
    slots = np.arange(n, dtype=np.int32)
    rank[array] = np.maximum.accumulate(np.where(new, slots, 0))
    levels, step = [rank], 1
    left = _shared(new, slots)
    while len(left):
        at = array[left]
        ahead = at + step
        within = ahead < ends[at]
        key = rank[at].astype(np.int64) * (n + 1)
        key[within] += rank[ahead[within]] + 1
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        array[left] = at
        new = np.ones(len(left), bool)
        new[1:] = np.diff(key) != 0
        rank = rank.copy()
        rank[at] = left[np.maximum.accumulate(np.where(new, np.arange(len(left)), 0))]
        levels.append(rank)
        left = _shared(new, left)
        step *= 2
    return Suffixes(array, levels, rank)


def _shared(new: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Slots of groups that have more than one member."""
    alone = new & np.append(new[1:], True)
    return slots[~alone]


def common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many words from a and from b on are equal; a and b differ and lie in one text."""
    size = np.zeros(len(a), np.int64)
    top = np.maximum(a, b)
    for h in range(len(levels) - 1, -1, -1):
        open_ = np.flatnonzero(top + size < ends[top])
        x, y = a[open_] + size[open_], b[open_] + size[open_]
        size[open_[levels[h][x] == levels[h][y]]] += 1 << h
    return size


def common_back(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many words before a and before b are equal."""
    size = np.zeros(len(a), np.int64)
    low = np.minimum(a, b)
    for h in range(len(levels) - 1, -1, -1):
        open_ = np.flatnonzero(low - size - (1 << h) >= starts[low])
        x, y = a[open_] - size[open_] - (1 << h), b[open_] - size[open_] - (1 << h)
        size[open_[levels[h][x] == levels[h][y]]] += 1 << h
    return size


def intervals(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of the interval in which each slot of ``at`` separates two children."""
    n = len(lcp)
    least = [lcp]
    while (1 << len(least)) <= n:
        half = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
    value = lcp[at]
    start, end = at.copy(), at + 1
    for h in range(len(least) - 1, -1, -1):
        size = 1 << h
        wide = np.flatnonzero(start >= size)
        wide = wide[least[h][start[wide] - size] >= value[wide]]
        start[wide] -= size
        wide = np.flatnonzero(end + size <= n)
        wide = wide[least[h][end[wide]] >= value[wide]]
        end[wide] += size
    return start - 1, end


def smaller_children(lcp: np.ndarray, fewest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every suffix slot in a child that isn't the largest: slot, interval start and end, and depth."""
    at = np.flatnonzero(lcp > 0)
    start, end = intervals(lcp, at)
    large = end - start >= fewest
    at, start, end = at[large], start[large], end[large]
    if not len(at):
        return at, at, at, at
    order = np.lexsort((at, end, start))
    at, start, end = at[order], start[order], end[order]
    first = np.ones(len(at), bool)
    first[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)
    # children of an interval: from its start to its first separator, and between and after separators
    heads = np.flatnonzero(first)
    owner = np.cumsum(first) - 1
    low = np.insert(at, heads, start[heads])
    high = np.concatenate([low[1:], [0]])
    number = np.insert(owner, heads, np.arange(len(heads)))
    last = np.append(np.diff(number) != 0, True)
    high[last] = end[heads]
    size = high - low
    groups = np.flatnonzero(np.insert(np.diff(number) != 0, 0, True))
    largest = np.repeat(np.maximum.reduceat(size, groups), np.diff(np.append(groups, len(size))))
    is_largest = size == largest
    # of several largest children, the first
    seen = np.cumsum(is_largest)
    before = np.repeat(np.concatenate([[0], seen])[groups], np.diff(np.append(groups, len(size))))
    small = ~(is_largest & (seen - before == 1))
    low, size, number = low[small], size[small], number[small]
    slots = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
    number = np.repeat(number, size)
    depth = lcp[at[heads]]
    return slots, start[heads][number], end[heads][number], depth[number]


def runs(codes: np.ndarray, bounds: np.ndarray, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs, by start and period; texts lie between ``bounds``."""
    none = np.zeros(0, np.int64)
    if len(codes) < least:
        return none, none, none
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    starts, ends = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
    array, levels, place = suffixes(codes, text, ends)
    # slots of words that occur again in their text
    word = levels[0][array]
    shared = np.zeros(len(array), bool)
    same = word[1:] == word[:-1]
    shared[1:] |= same
    shared[:-1] |= same
    slots = np.flatnonzero(shared)
    if not len(slots):
        return none, none, none
    first = array[slots].astype(np.int64)
    lcp = np.zeros(len(slots), np.int64)
    follows = np.flatnonzero(word[slots[1:]] == word[slots[:-1]]) + 1
    lcp[follows] = common(levels, first[follows - 1], first[follows], ends)
    inverse = np.full(len(array), -1, np.int64)
    inverse[first] = np.arange(len(slots))

    member, low, high, depth = smaller_children(lcp, exponent)
    position = first[member]
    left, period = [], []
    for begin in (position, position - depth):
        other = np.where(begin == position, position + depth, begin)
        fits = np.flatnonzero((begin >= starts[position]) & (begin + 2 * depth <= ends[position]))
        where = inverse[other[fits]]
        fits = fits[(where >= low[fits]) & (where < high[fits])]
        b, d = begin[fits], depth[fits]
        behind = b + 2 * d
        last = behind == ends[b]
        branches = last.copy()
        branches[~last] = codes[behind[~last]] != codes[b[~last] + d[~last]]
        left.append(b[branches])
        period.append(d[branches])
    square, period = np.concatenate(left), np.concatenate(period)
    if not len(square):
        return none, none, none
    begin = square - common_back(levels, square, square + period, starts)
    end = square + 2 * period
    fine = end - begin >= np.maximum(least, exponent * period)
    begin, end, period = begin[fine], end[fine], period[fine]
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    new = np.ones(len(begin), bool)
    new[1:] = (np.diff(begin) != 0) | (np.diff(end) != 0)
    begin, end, period = begin[new], end[new], period[new]
    order = np.lexsort((period, begin))
    return begin[order], (end - begin)[order], period[order]


Edit = Callable[[object, int], "np.ndarray | None"]


def find(docs: DataFrame, edit: Edit | None = None, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """One row per document: doc_id, its runs by start and period, and its words without the repeated periods.

    ``edit(doc_id, n)`` may name the words that stand in a text's n places before runs are looked for.
    """
    def work(batches):
        for batch in batches:
            found = words(batch.column(1))
            codes, bounds = found.codes, found.bounds
            if edit is not None:
                codes = codes.copy()
                for k, doc in enumerate(batch.column(0).to_pylist()):
                    a, b = int(bounds[k]), int(bounds[k + 1])
                    index = edit(doc, b - a)
                    if index is not None:
                        codes[a:b] = codes[a:b][index]
            begin, length, period = runs(codes, bounds, least, exponent)
            dropped = np.zeros(len(codes) + 1, np.int64)
            np.add.at(dropped, begin + period, 1)
            np.add.at(dropped, begin + length, -1)
            kept = np.cumsum(dropped)[:-1] == 0
            until = np.concatenate([[0], np.cumsum(kept)])[bounds]
            lists = pa.LargeListArray.from_arrays(pa.array(until, pa.int64()), found.distinct.take(pa.array(codes[kept])))
            collapsed = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
            at = np.searchsorted(begin, bounds)
            text = np.repeat(bounds[:-1], np.diff(at))
            records = pa.StructArray.from_arrays([pa.array(begin - text), pa.array(length), pa.array(period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), records), collapsed],
                names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_batch(docs.select("doc_id", "text"), work,
                    f"doc_id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string", PORTION)


def planted(doc: object, n: int) -> np.ndarray | None:
    """The contract's edit: by its id, a document may repeat one stretch of its words until its end."""
    if doc is None or not n:
        return None
    h = zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    index = np.arange(n)
    index[a:] = a + (index[a:] - a) % p
    return index


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), planted)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    picked = found.withColumn("best", best)
    return picked.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
