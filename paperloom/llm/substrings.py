"""Repeated byte strings, by prefix doubling over a sparse set of positions.

A byte goes if a string of ``LENGTH`` (100) bytes that covers it also starts
earlier: in a document with a smaller id, or earlier in the same one. The
windows of a document are the strings of that length, overlapping ones too.

Doubling over every byte would sort as many rows as there are bytes, several
times. Instead each window is represented by its anchor, the string of
``GRAM`` bytes in it with the smallest hash (the first of equals). Equal
windows have equal anchors at equal distances, so it is enough to rank anchors
(one byte in thirty) and the range of windows that an anchor stands for.

Round 0 ranks the anchors by their ``GRAM`` bytes; unique ones are done. One
pass over the texts gives their ranks and the hashes of what they span, which
travel packed. In every further round a range of windows is halved, and the
string that all its windows share grows, from 37 bytes over 68, 84, ... to 100:
its new rank is that of the pair (rank so far, the bytes it grew by), grouped
by Spark. A range is done

- when its rank is unique or the first of its kind: none of its windows
  starts earlier anywhere;
- past the threshold: when the whole string it spans, as long as its windows
  together, starts earlier. All its bytes go.

The first of a kind stays as a witness while others of its kind are open. What
a range spans holds the string it is ranked by, so one sort by rank, span and
place settles a round. Ranks are 128 bits (64 in round 0, which only finds
candidates).

Defined results: null and empty texts, and texts shorter than a window, lose
nothing; matches never cross documents; null ids come first; rows of one id
with one text are the same document, so neither is earlier; rows of one id
with other texts are ordered by a hash; other columns are passed on by
``cut_repeats``; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.llm import base
from paperloom.llm.base import forget, fresh, keep, query, table
from paperloom.llm.jaccard import mixed
from paperloom.llm.words import buffer_of

LENGTH, SPREAD = 100, 64
GRAM = LENGTH - SPREAD + 1
# Windows hashed at a time, few enough for their hashes to stay in the cache; places within them fit in LOW.
STEP, LOW = 1 << 14, (1 << 15) - 1
LOWEST = -(1 << 63)
# Anchors in one bucket of round 0; some 100 bytes each in its task.
BUCKET, LEAST_BUCKETS = 1_000_000, 64


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at each place."""
    n = len(data) - GRAM + 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data),), "<u8", padded.tobytes(), 0, (1,)).copy()
    with np.errstate(over="ignore"):
        h = eight[:n] * np.uint64(0x9E3779B97F4A7C15)
        for shift in (*range(8, GRAM - 8, 8), GRAM - 8):
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h += eight[shift:shift + n]
    return mixed(h)


def anchors(data: bytes, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, place of the anchor, nearest and farthest window before it, hash) for each anchor.

    Places are in bytes within the text. Work goes by stretches of STEP bytes.
    Hashes are compared without their lowest bits, which hold the place instead.
    """
    raw = np.frombuffer(data, np.uint8)
    sizes = np.diff(bounds)
    fitting = np.maximum(sizes - LENGTH + 1, 0)
    inside = np.repeat(np.tile([True, False], len(sizes)), np.stack([fitting, sizes - fitting], 1).ravel())
    firsts, chosen, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    before = -1
    for start in range(0, max(len(raw) - LENGTH + 1, 0), STEP):
        h = _grams(raw[start:start + STEP + LENGTH - 1])
        least = (h & np.uint64(~LOW & (1 << 64) - 1)) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while width < SPREAD:
            least = np.minimum(least[width:], least[:-width])
            width *= 2
        at = (least & np.uint64(LOW)).astype(np.int64)
        own = inside[start:start + len(at)]
        new = own.copy()
        new[1:] &= (at[1:] != at[:-1]) | ~own[:-1]
        new[0] &= at[0] + start != before
        before = at[-1] + start if own[-1] else -1
        first = np.flatnonzero(new)
        firsts.append(first + start)
        chosen.append(at[first] + start)
        hashes.append(h[at[first]])
    first, at = np.concatenate(firsts), np.concatenate(chosen)
    text = np.searchsorted(bounds, first, side="right") - 1
    last = np.minimum(np.append(first[1:], len(raw)) - 1, bounds[text + 1] - LENGTH)
    return text, at - bounds[text], at - last, at - first, np.concatenate(hashes)


def _keyed(docs: DataFrame) -> DataFrame:
    """(place, mark, text): place orders documents, mark tells texts of one id apart."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("place"), F.xxhash64("text").alias("mark"), "text")


def _several(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(values)
    same = values[order[1:]] == values[order[:-1]]
    out = np.zeros(len(values), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def settled(u: np.ndarray, place: np.ndarray, mark: np.ndarray, spot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the first ranges with their bytes (u), and of those that start later; others repeat a first row."""
    order = np.lexsort((spot, mark, place, u[:, 1], u[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (u[order[1:]] != u[order[:-1]]).any(axis=1)
    first = order[new]
    lead = np.repeat(first, np.diff(np.append(np.flatnonzero(new), len(order))))
    return first, order[(place[order] != place[lead]) | (mark[order] != mark[lead]) | (spot[order] != spot[lead])]


def _span(spot: np.ndarray) -> np.ndarray:
    """What a range spans: its first byte and the one behind it, packed."""
    at, near, far = spot >> 12, spot >> 6 & 63, spot & 63
    return at - far << 32 | at - near + LENGTH


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Row numbers at which one of the columns changes, and the first."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def first_round(docs: DataFrame, buckets: int) -> DataFrame:
    """Round 0: (place, mark, gone, open, ranks), several rows for a document.

    ``gone`` has the spans that start earlier, ``open`` the ranges (place,
    near and far, packed) whose rank others have too, ``ranks`` their hashes
    of the GRAM bytes. Ranges are known by two hashes of all bytes they span.
    A batch of texts settles the equal ones among its own and sends the first.
    """
    def packed(batches):
        import xxhash

        for batch in batches:
            place, mark = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, bounds = buffer_of(batch.column(2))
            text, at, near, far, h = anchors(data, bounds)
            if not len(text):
                continue
            start = bounds[text] + at - far
            end = bounds[text] + at - near + LENGTH
            whole = b"".join([xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(start.tolist(), end.tolist())])
            shape = mixed((near * SPREAD + far).astype(np.uint64) + np.uint64(1)).view(np.int64)
            u = np.frombuffer(whole, "<i8").reshape(-1, 2) ^ shape[:, None]
            spot = at << 12 | near << 6 | far
            again = np.flatnonzero(_several(u[:, 0]))
            first, later = settled(u[again], place[text[again]], mark[text[again]], spot[again])
            sent = np.ones(len(text), bool)
            sent[again] = False
            sent[again[first]] = True
            sent = np.flatnonzero(sent)
            bucket = ((h >> np.uint64(7)) % np.uint64(buckets)).astype(np.int64)
            sent = sent[np.lexsort((text[sent], bucket[sent]))]
            later = np.sort(again[later])
            # what is settled here is passed on by any bucket
            rows = [*parts(bucket[sent], place, mark, text[sent], spot[sent], h[sent], u[sent])]
            if len(later):
                anywhere = np.full(len(later), int(place[text[later[0]]] ^ mark[text[later[0]]]) % buckets)
                rows += parts(anywhere, place, mark, text[later], spot[later], h[:0], u[:0])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 6)],
                                             names=["bucket", "place", "mark", "counts", "spot", "h", "u"])

    def parts(bucket, place, mark, text, spot, h, u):
        docs = _changes(bucket, text)
        counts = np.diff(np.append(docs, len(text))).astype("<u4")
        place, mark = place[text[docs]], mark[text[docs]]
        cuts = _changes(bucket).tolist()
        ends = [*cuts[1:], len(bucket)]
        for a, b, c, d in zip(cuts, ends, np.searchsorted(docs, cuts).tolist(), np.searchsorted(docs, ends).tolist()):
            yield (int(bucket[a]), place[c:d].tobytes(), mark[c:d].tobytes(), counts[c:d].tobytes(), spot[a:b].tobytes(), h[a:b].tobytes(), u[a:b].tobytes())

    def in_bucket(batches):
        known, open_ = [[], [], []], [[], [], [], [], []]
        for batch in batches:
            for place, mark, counts, spot, h, u in zip(*[batch.column(i).to_pylist() for i in range(1, 7)]):
                times = np.frombuffer(counts, "<u4")
                row = [np.repeat(np.frombuffer(place, np.int64), times), np.repeat(np.frombuffer(mark, np.int64), times), np.frombuffer(spot, np.int64)]
                if h:
                    row += [np.frombuffer(h, np.int64), np.frombuffer(u, np.int64).reshape(-1, 2)]
                for column, part in zip(open_ if h else known, row):
                    column.append(part)
        none = np.zeros(0, np.int64)
        known = [np.concatenate([none, *c]) for c in known]
        if open_[0]:
            place, mark, spot, h, u = (np.concatenate(c) for c in open_)
            open_.clear()
            more = _several(h)
            place, mark, spot, h, u = place[more], mark[more], spot[more], h[more], u[more]
            first, later = settled(u, place, mark, spot)
            first = first[_several(h[first])]
        else:
            place, mark, spot, h, first, later = [none] * 6
        place, mark, spot, h = (np.concatenate([a[first], a[later], b]) for a, b in zip((place, mark, spot, h), (*known, np.zeros(len(known[0]), np.int64))))
        if not len(place):
            return
        order = np.lexsort((spot, mark, place))
        place, mark, spot, h, left = place[order], mark[order], spot[order], h[order], order < len(first)
        cuts = _changes(place, mark)
        n = [np.concatenate([[0], np.cumsum(x)])[np.append(cuts, len(x))].astype(np.int32) for x in (left, ~left)]
        lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x)) for at, x in ((n[1], _span(spot[~left])), (n[0], spot[left]), (n[0], h[left]))]
        out = pa.RecordBatch.from_arrays([pa.array(place[cuts]), pa.array(mark[cuts]), *lists], names=["place", "mark", "gone", "open", "ranks"])
        for start in range(0, out.num_rows, 5_000):
            yield out.slice(start, 5_000)

    blobs = base.by_batch(_keyed(docs), packed, "bucket int, place binary, mark binary, counts binary, spot binary, h binary, u binary", 2 << 20)
    return blobs.repartitionById(buckets, F.col("bucket")).mapInArrow(in_bucket, "place long, mark long, gone array<long>, open array<long>, ranks array<long>")


def with_bytes(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The open ranges with the bytes they span; ``low`` and ``high`` bound the node of the halving they are in."""
    lists = rows.where(F.size("open") > 0).groupBy("place", "mark").agg(F.collect_list(F.struct("open", "ranks")).alias("x")).select(
        "place", "mark", F.flatten("x.open").alias("open"), F.flatten("x.ranks").alias("ranks"))
    # repeated rows of a document once
    texts = _keyed(docs).join(lists, ["place", "mark"]).dropDuplicates(["place", "mark"])

    def work(batches):
        for batch in batches:
            data, bounds = buffer_of(batch.column(2))
            spot, r = batch.column(3).flatten().to_numpy(), batch.column(4).flatten().to_numpy()
            text = np.repeat(np.arange(batch.num_rows), batch.column(3).value_lengths().to_numpy())
            for start in range(0, len(spot), 20_000):
                own, of = spot[start:start + 20_000], text[start:start + 20_000]
                span = _span(own)
                pieces = [data[a:b] for a, b in zip((bounds[of] + (span >> 32)).tolist(), (bounds[of] + (span & 0xFFFFFFFF)).tolist())]
                arrays = [batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)), *[pa.array(x.astype(np.int32)) for x in (own >> 12, own >> 6 & 63, own & 63)],
                          pa.array(r[start:start + 20_000]), pa.array(pieces, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["place", "mark", "at", "near", "far", "r", "bytes"])

    out = base.by_batch(texts, work, "place long, mark long, at int, near int, far int, r long, bytes binary")
    return out.select("place", "mark", "at", "near", "far", F.col("r").alias("r1"), F.col("r").alias("r2"), F.col("far").alias("base"), "bytes",
                      F.lit(0).alias("low"), F.lit(SPREAD - 1).alias("high"))


def halved(rows: DataFrame) -> DataFrame:
    """Both halves of each range, with the rank pair of the string their windows share, and the hash of what they span."""
    mid = F.expr("low + (high - low) div 2")
    halves = F.array(
        F.struct(F.lit(0).alias("side"), F.col("low").alias("lo"), mid.alias("hi")),
        F.struct(F.lit(1).alias("side"), (mid + 1).alias("lo"), F.col("high").alias("hi")))
    each = rows.withColumn("half", F.explode(halves)).withColumn("n", F.greatest("near", "half.lo")).withColumn("f", F.least("far", "half.hi")).where("n <= f")

    def piece(start, size):  # bytes from start on, counted from the first byte held
        return F.substring("bytes", start + 1, size)

    # one half grows at its right end, the other at its left
    grown = F.when(F.col("half.side") == 0, piece(F.col("base") - F.col("high") + LENGTH, F.col("high") - F.col("half.hi"))).otherwise(
        piece(F.col("base") - F.col("half.lo"), F.col("half.lo") - F.col("low")))
    spanned = piece(F.col("base") - F.col("f"), F.col("f") - F.col("n") + LENGTH)
    return each.select(
        "place", "mark", "at", F.col("n").alias("near"), F.col("f").alias("far"),
        F.xxhash64("r1", "half.side", grown).alias("r1"), F.xxhash64(F.lit("r"), "r2", "half.side", grown).alias("r2"),
        F.xxhash64("n", "f", spanned).alias("u1"), F.xxhash64(F.lit("u"), "n", "f", spanned).alias("u2"),
        "base", "bytes", F.col("half.lo").alias("low"), F.col("half.hi").alias("high"))


def ranked(rows: DataFrame) -> DataFrame:
    """Adds whether a range is gone (what it spans starts earlier); drops firsts without others of their rank.

    Equal spans have equal ranks, so one sort by rank, span and place tells both.
    """
    order = Window.partitionBy("r1", "r2").orderBy("u1", "u2", "place", "mark", "at")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gone = F.coalesce((F.lag("u1").over(order) == F.col("u1")) & (F.lag("u2").over(order) == F.col("u2")), F.lit(False))
    alone = (F.first("u1").over(whole) == F.last("u1").over(whole)) & (F.first("u2").over(whole) == F.last("u2").over(whole))
    return rows.withColumns({"gone": gone, "alone": alone}).where("gone or not alone").drop("alone", "u1", "u2")


def repeats(docs: DataFrame) -> DataFrame:
    """(place, mark, spans): bytes to remove, in pieces that may overlap, each with its start and end packed."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(size // (SPREAD // 2) // BUCKET, LEAST_BUCKETS)
    start, _ = keep(first_round(docs, buckets), "ranges")
    gone = [start.where(F.size("gone") > 0).select("place", "mark", F.col("gone").alias("spans"))]
    if not start.where(F.size("open") > 0).isEmpty():
        rows, at, width = with_bytes(docs, start), None, SPREAD
        while width > 1 and (at is None or not rows.isEmpty()):
            new, new_at = keep(ranked(halved(rows)), "open")
            if at:
                forget(spark, at)
            gone.append(keep(_bytes_of(new), "gone")[0])
            rows, at, width = new.where("not gone").drop("gone"), new_at, width // 2
        forget(spark, at)
    every = gone[0]
    for more in gone[1:]:
        every = every.unionByName(more)
    return every.groupBy("place", "mark").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _bytes_of(rows: DataFrame) -> DataFrame:
    start, end = (F.col("at") - F.col("far")).cast("long"), (F.col("at") - F.col("near") + LENGTH).cast("long")
    return rows.where("gone").select("place", "mark", F.array(F.shiftleft(start, 32).bitwiseOR(end)).alias("spans"))


def merged(spans: np.ndarray) -> np.ndarray:
    """(start, end) of the maximal runs of packed spans."""
    spans = np.sort(spans)
    start, end = spans >> 32, np.maximum.accumulate(spans & 0xFFFFFFFF)
    new = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    return np.stack([start[new], end[np.append(new[1:], len(end)) - 1]], 1)


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` plus n_bytes, n_removed, n_spans (maximal removed runs) and kept (the other bytes); replaces columns of these names."""
    names = ["n_bytes", "n_removed", "n_spans", "kept"]
    carried = docs.drop(*names)
    spans, _ = keep(repeats(docs), "spans")
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    at, mark, own = fresh(carried.columns, "place", "mark", "spans")
    d, s = carried.withColumn(mark, F.xxhash64("text")).withColumn(at, place).alias("d"), spans.alias("s")
    joined = d.join(s, (F.col(f"d.{at}") == F.col("s.place")) & (F.col(f"d.{mark}") == F.col("s.mark")), "left")
    columns = carried.columns
    width, text = len(columns), columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields)

    def work(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            data, bounds = buffer_of(batch.column(text))
            lists = batch.column(width)
            spans = lists.flatten().to_numpy()
            ends = np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy())
            for a, b, first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                own, runs = data[a:b], 0
                rest = own
                if last > first:
                    cuts = merged(spans[first:last])
                    runs = len(cuts)
                    edges = [0, *cuts.ravel().tolist(), len(own)]
                    rest = b"".join([own[x:y] for x, y in zip(edges[::2], edges[1::2])])
                for column, x in zip(out, (len(own), len(own) - len(rest), runs, rest)):
                    column.append(x)
            arrays = [pa.array(c, t) for c, t in zip(out, [pa.int64()] * 3 + [pa.binary()])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *arrays], names=[*columns, *names])

    picked = joined.select(*[F.col(f"d.{c}") for c in carried.columns], F.col("s.spans").alias(own))
    return base.by_batch(picked, work, f"{schema}, n_bytes long, n_removed long, n_spans long, kept binary")


@query("op4_suffix_array_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
