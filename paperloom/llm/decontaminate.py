"""Benchmark decontamination with a generalised suffix automaton.

The automaton of the normalised test items has a state for every set of end
positions in them. A document's words stream through it; after each word the
state and the matched length say the longest run of item words that ends here.
A run of ``window`` words is a hit, and so is a whole item that is shorter.
Words unknown to the items cannot be inside a match, so only runs of known
words are streamed.

Items are put into blocks of about ``BLOCK_WORDS`` words; each block's
automaton is sent to the tasks on its own, so that no broadcast grows with the
benchmark. With several blocks the documents are streamed once per block, and
the hit spans of a document are merged.

``find`` marks, ``remove`` cuts the hit spans out of the texts and drops
documents of which more than ``COVERAGE`` of the words are hit.

Defined results: a null text or item has no words; an item with a null id
marks words but is not listed; items of one id are one item; repeated
documents are marked one by one; an empty table of either kind gives no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import base
from paperloom.llm.base import fresh, keep, query, table
from paperloom.llm.words import ALPHANUMERIC, buffer_of, texts_of, words

WINDOW = 10
BLOCK_WORDS = 200_000
COVERAGE = 0.5


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, items: Iterable[tuple[object, list[int]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = [(name, seq) for name, seq in items if seq]
        self.least = min([window, *(len(seq) for _, seq in items)])
        for _, seq in items:
            state = 0
            for word in seq:
                state = self._extend(state, word)
        # the state that holds a state's last `window` words, and which items have them
        self.long: list[int] = [-1] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            if self.length[state] >= window:
                up = self.link[state]
                self.long[state] = self.long[up] if self.length[up] >= window else state
        self.items: dict[int, set] = {}
        whole: dict[int, list[tuple[int, object]]] = {}
        for name, seq in items:
            state = 0
            for i, word in enumerate(seq):
                state = self.next[state][word]
                if i + 1 >= window:
                    self.items.setdefault(self.long[state], set()).add(name)
            if len(seq) < window:
                whole.setdefault(state, []).append((len(seq), name))
        # short items that end where a state's longest run ends
        self.short: list[list[tuple[int, object]]] = [[]] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = self.short[self.link[state]]
            self.short[state] = above + whole[state] if state in whole else above

    def _extend(self, last: int, word: int) -> int:
        old = self.next[last].get(word)
        if old is not None and self.length[old] == self.length[last] + 1:
            return old
        if old is not None:
            return self._split(last, word, old)
        state = self._new(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            old = self.next[at][word]
            self.link[state] = old if self.length[old] == self.length[at] + 1 else self._split(at, word, old)
        return state

    def _new(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _split(self, at: int, word: int, old: int) -> int:
        """The shorter strings of ``old`` get a state of their own."""
        state = self._new(self.length[at] + 1, dict(self.next[old]))
        self.link[state], self.link[old] = self.link[old], state
        while at >= 0 and self.next[at].get(word) == old:
            self.next[at][word] = state
            at = self.link[at]
        return state

    def stream(self, seq: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans (start, end), merged and in order, and the items with hits."""
        spans: list[list[int]] = []
        names: set = set()
        state = matched = 0
        for i, word in enumerate(seq):
            step = self.next[state].get(word)
            while step is None and state:
                state = self.link[state]
                matched = self.length[state]
                step = self.next[state].get(word)
            if step is None:
                continue
            state, matched = step, matched + 1
            hit = 0
            if matched >= self.window:
                hit = self.window
                names |= self.items[self.long[state]]
            for size, name in self.short[state]:
                if size <= matched:
                    hit = max(hit, size)
                    names.add(name)
            if hit:
                start = i + 1 - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])
        return [(a, b) for a, b in spans], names


def blocks_of(items: DataFrame, block_words: int = BLOCK_WORDS) -> list[DataFrame]:
    """The items in parts of about ``block_words`` words."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.coalesce(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), "[^\\p{Alnum}]+"))), F.lit(0))).first()[0]
    n = size // block_words + 1
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def _marked(docs: DataFrame, block: DataFrame, window: int) -> DataFrame:
    """(doc_id, mark, n_words, spans, items) for one block; spans in words."""
    rows = block.collect()  # one block, whose size is bounded
    found = words(pa.array([r.text for r in rows], pa.large_string()), ALPHANUMERIC)
    vocabulary = {w: i for i, w in enumerate(found.distinct.to_pylist())}
    seqs = [found.codes[a:b].tolist() for a, b in zip(found.bounds[:-1], found.bounds[1:])]
    automaton = Automaton([(r.item_id, seq) for r, seq in zip(rows, seqs)], window)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, automaton))

    def work(batches):
        vocabulary, automaton = shared.value
        for batch in batches:
            found = words(batch.column(2), ALPHANUMERIC)
            codes = np.array([vocabulary.get(w, -1) for w in found.distinct.to_pylist()], np.int64)[found.codes]
            # runs of known words inside one document that are long enough for a hit
            doc = found.text_of()
            run = np.flatnonzero(codes >= 0)
            new = np.ones(len(run), bool)
            new[1:] = (np.diff(run) > 1) | (np.diff(doc[run]) > 0)
            starts = run[new]
            ends = np.append(run[np.flatnonzero(new)[1:] - 1], run[-1:]) + 1 if len(run) else run
            size = len(batch)
            spans: list[list] = [[] for _ in range(size)]
            items: list[set] = [set() for _ in range(size)]
            for a, b in zip(starts.tolist(), ends.tolist()):
                if b - a >= automaton.least:
                    hits, names = automaton.stream(codes[a:b].tolist())
                    if hits:
                        d = int(doc[a])
                        shift = a - int(found.bounds[d])
                        spans[d] += [[x + shift, y + shift] for x, y in hits]
                        items[d] |= names
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(found.bounds)),
                 pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                 pa.array([sorted(x - {None}) for x in items], pa.list_(pa.string()))],
                names=["doc_id", "mark", "n_words", "spans", "items"])

    narrow = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return base.by_batch(narrow, work, "doc_id long, mark long, n_words long, spans array<array<long>>, items array<string>")


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, mark (hash of the text), n_words, hit spans in words, and the ids of its items."""
    parts = [_marked(docs, block, window) for block in blocks_of(items, block_words)]
    if len(parts) == 1:
        return parts[0]
    # each document has one row per block and copy of itself: equal rows of a block count once
    hits = [keep(part.where(F.size("spans") > 0).distinct(), "hits")[0] for part in parts]
    every = hits[0]
    for more in hits[1:]:
        every = every.unionByName(more)
    merged = every.groupBy("doc_id", "mark").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    plain = _marked(docs, items.limit(0).select("item_id", "text"), window).select("doc_id", "mark", "n_words")
    joined = plain.alias("p").join(merged.alias("m"), F.col("p.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("p.mark") == F.col("m.mark")), "left")
    return joined.select("p.doc_id", "p.mark", "n_words", F.coalesce(_united("spans"), F.array().cast("array<array<long>>")).alias("spans"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _united(spans: str):
    """Overlapping and touching spans as one; a document's spans only."""
    none = F.array().cast("array<array<long>>")

    def step(done, span):
        last = F.try_element_at(done, F.lit(-1))
        joins = (F.size(done) > 0) & (last[1] >= span[0])
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                                      F.array(F.array(last[0], F.greatest(last[1], span[1]))))).otherwise(F.concat(done, F.array(span)))

    return F.when(F.col(spans).isNotNull(), F.aggregate(F.array_sort(spans), none, step))


def hit_words(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def cut(text: str | None, spans: list[list[int]]) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if not text or not spans:
        return text
    data = text.encode()
    flags = np.frombuffer(data.translate(ALPHANUMERIC), np.uint8)
    word = ~np.isin(flags, np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:starts[a]])
        at = ends[b - 1]
    return b"".join([*out, data[at:]]).decode()


def remove(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the hit spans, and without documents of which more than ``coverage`` of the words are hit."""
    found = find(docs, items, window).where(F.size("spans") > 0).select("doc_id", "mark", "n_words", "spans").distinct()
    hits, _ = keep(found, "spans")
    columns = docs.columns
    mark, own = fresh(columns, "mark", "spans")
    keyed = docs.withColumn(mark, F.xxhash64("text"))
    joined = keyed.alias("d").join(hits.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col(f"d.{mark}") == F.col("h.mark")), "left")
    joined = joined.where(F.col("h.spans").isNull() | (hit_words("h.spans") <= F.col("h.n_words") * coverage))
    place = columns.index("text")

    def work(batches):
        for batch in batches:
            spans = batch.column(len(columns)).to_pylist()
            texts = batch.column(place)
            if any(spans):
                texts = pa.array([cut(t, s) for t, s in zip(texts.to_pylist(), spans)], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == place else batch.column(i) for i in range(len(columns))], names=columns)

    picked = joined.select(*[F.col(f"d.{c}") for c in columns], F.coalesce("h.spans", F.array().cast("array<array<long>>")).alias(own))
    return base.by_batch(picked, work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))


def _sql(window: int) -> str:
    split = "list_filter(regexp_split_to_array(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    return f"""
    WITH d AS (SELECT doc_id, {split.format(t="coalesce(text, '')")} w FROM documents),
    b AS (SELECT item_id, {split.format(t="coalesce(text, '')")} w FROM benchmark),
    dw AS (SELECT doc_id, i, w[i:i + k - 1] g, k FROM d, (SELECT DISTINCT least(len(w), {window}) k FROM b WHERE len(w) > 0),
           LATERAL (SELECT unnest(generate_series(1, len(w) - k + 1)) i)),
    bw AS (SELECT DISTINCT item_id, w[i:i + least(len(w), {window}) - 1] g FROM b,
           LATERAL (SELECT unnest(generate_series(1, len(w) - least(len(w), {window}) + 1)) i) WHERE len(w) > 0),
    hits AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.g = bw.g),
    hit AS (SELECT doc_id, count(DISTINCT p) n FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) p FROM hits) GROUP BY 1),
    its AS (SELECT doc_id, count(*) n, string_agg(item, ',' ORDER BY item) items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) item FROM hits) GROUP BY 1)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) n_words, CAST(coalesce(hit.n, 0) AS BIGINT) n_hit, CAST(coalesce(its.n, 0) AS BIGINT) n_items,
           sha256(coalesce(its.items, '')) items_sha256, coalesce(hit.n, 0) > 0 contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""


@query("op6_decontamination", _sql(WINDOW))
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
