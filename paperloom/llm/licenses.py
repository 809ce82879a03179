"""Licence scan with a generalised suffix automaton of licence texts.

The words of all templates (texts of licences and their usual notices, and the
base phrases) are put into one suffix automaton. A document's words stream
through it and give the matching statistics: for every word the longest run of
template words that ends there, and the state that says where in the templates
it stands. Runs that can't be prolonged and are long enough are chained per
template: the next run goes on with a chain if it stands after it in the
document and in the template, with no more than ``GAP`` words between in
either, so that a changed name, year or line doesn't break a span. A chain that
covers ``SHARE`` of its template is a span with that template's label.

Base phrases are whole runs that are shorter; they are found in the same pass,
at every place. Two neighbouring words that stand side by side in no template
can't be inside a run, so only stretches of known pairs are streamed. Whole
texts are read, documents stay in their tasks, and nothing is shuffled.

Defined results: a null or empty text has no words, places or spans. Rows are
taken one by one, so null and repeated ids give a row each. An empty table
gives no rows. Columns other than ``doc_id`` and ``text`` are not read. Spans of
one template don't overlap; spans of several may. Templates need two words and
hold at most ``MOST_WORDS`` words in all, which bounds what the tasks are sent.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import base
from paperloom.llm.base import query, table
from paperloom.llm.decontaminate import Automaton
from paperloom.llm.words import ALPHANUMERIC, words

LEAST = 4        # words of a run that is chained
GAP = 12         # words between two runs of a chain
SHARE = 0.6      # of a template's words that a span covers
BASE_SCORE = 0.5
MOST_WORDS = 200_000
PORTION = 4 << 20

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public licence notices, by the label that they give.
NOTICES = {
    "mit-notice": ["Released under the MIT License."],
    "mit-text": ["""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
        to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
        whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
        permission notice shall be included in all copies or substantial portions of the Software."""],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
        WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "gpl-or-later": ["""This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
        warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "bsd": ["""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution."""],
    "isc": ["""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies."""],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}


class Span(NamedTuple):
    template: int
    start: int     # word of the document
    end: int
    covered: int   # words of the template


class Matcher(Automaton):
    """Suffix automaton of template word codes, with the places of every state."""

    def __init__(self, templates: list[list[int]], phrases: list[list[int]], least: int = LEAST, gap: int = GAP, share: float = SHARE):
        self.sizes = [len(t) for t in templates]
        self.least, self.gap, self.share = least, gap, share
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for seq in [*templates, *phrases]:
            state = 0
            for word in seq:
                state = self._extend(state, word)
        # where the longest run of a state ends in the templates; a state's runs also end where those of its suffix links' children do
        self.ends: list[dict[int, list[int]]] = [{} for _ in self.next]
        for number, seq in enumerate(templates):
            at = 0
            for i, word in enumerate(seq):
                at = self.next[at][word]
                up = at
                while up > 0 and self.length[up] >= min(least, len(seq)):
                    self.ends[up].setdefault(number, []).append(i + 1)
                    up = self.link[up]
        whole: dict[int, list[tuple[int, int]]] = {}
        for number, seq in enumerate(phrases):
            state = 0
            for word in seq:
                state = self.next[state][word]
            whole.setdefault(state, []).append((len(seq), number))
        self.phrases: list[list[tuple[int, int]]] = [[]] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = self.phrases[self.link[state]]
            self.phrases[state] = above + whole[state] if state in whole else above

    def statistics(self, seq: list[int]) -> Iterable[tuple[int, int]]:
        """For every word: how long the longest run is that ends with it, and its state."""
        state = matched = 0
        for word in seq:
            step = self.next[state].get(word)
            while step is None and state:
                state = self.link[state]
                matched = self.length[state]
                step = self.next[state].get(word)
            if step is not None:
                state, matched = step, matched + 1
            yield matched, state

    def _long(self, state: int, size: int) -> bool:
        return any(size >= min(self.least, self.sizes[number]) for number in self.ends[state])

    def stream(self, seq: list[int], shift: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Places of phrases (number, start), and runs (start, end, state) that can't be prolonged and are long enough."""
        places, runs = [], []
        before, last = 0, 0
        for i, (matched, state) in enumerate(self.statistics(seq)):
            for size, number in self.phrases[state]:
                if size <= matched:
                    places.append((number, shift + i + 1 - size))
            if matched <= before and self._long(last, before):
                runs.append((shift + i - before, shift + i, last))
            before, last = matched, state
        if self._long(last, before):
            runs.append((shift + len(seq) - before, shift + len(seq), last))
        return places, runs

    def chains(self, runs: list[tuple[int, int, int]]) -> list[Span]:
        """Spans of one document from its runs, in order."""
        open_: dict[int, list[int]] = {}  # template: start, end, end in the template, words covered
        out: list[Span] = []

        def close(number: int) -> None:
            start, end, _, covered = open_.pop(number)
            if covered >= self.share * self.sizes[number]:
                out.append(Span(number, start, end, covered))

        for start, end, state in runs:
            size = end - start
            for number, ends in self.ends[state].items():
                if size < min(self.least, self.sizes[number]):
                    continue
                chain = open_.get(number)
                if chain is not None:
                    known = max(0, chain[1] - start)  # words of this run that the chain has already
                    begins = [e - size + known for e in ends]
                    fits = [b for b in begins if chain[2] <= b <= chain[2] + self.gap]
                    if known < size and fits and start - chain[1] <= self.gap:
                        chain[1], chain[2], chain[3] = end, min(fits) + size - known, chain[3] + size - known
                        continue
                    if known:
                        # stands elsewhere in the template and overlaps the chain: only what covers more is kept
                        if size <= chain[3]:
                            continue
                        del open_[number]
                    else:
                        close(number)
                open_[number] = [start, end, ends[0], size]
        for number in list(open_):
            close(number)
        return sorted(out, key=lambda s: (s.start, s.end, s.template))


def matcher(notices: Mapping[str, list[str]], phrases: Mapping[str, str], **options) -> tuple[dict[str, int], Matcher, list[str], list[str]]:
    """Vocabulary, automaton, and the labels of templates and of phrases."""
    labels = [label for label, texts in notices.items() for _ in texts]
    texts = [text for texts in notices.values() for text in texts]
    found = words(pa.array([*texts, *phrases], pa.large_string()), ALPHANUMERIC)
    if len(found.codes) > MOST_WORDS:
        raise ValueError(f"templates hold {len(found.codes)} words, more than {MOST_WORDS}")
    if len(labels) + len(phrases) and np.diff(found.bounds).min() < 2:
        raise ValueError("a template needs two words")
    seqs = [found.codes[a:b].tolist() for a, b in zip(found.bounds[:-1], found.bounds[1:])]
    vocabulary = {w: i for i, w in enumerate(found.distinct.to_pylist())}
    return vocabulary, Matcher(seqs[:len(labels)], seqs[len(labels):], **options), labels, list(phrases.values())


FOUND = ("doc_id {id}, n_words bigint, places array<struct<label: string, start: bigint>>, "
         "spans array<struct<label: string, template: int, start: bigint, end: bigint, covered: bigint, share: double>>")


def scan(docs: DataFrame, notices: Mapping[str, list[str]] = NOTICES, phrases: Mapping[str, str] = PHRASES, **options) -> DataFrame:
    """One row per document: number of words, places of the phrases, and spans of the templates (words from 0, ends exclusive)."""
    made = matcher(notices, phrases, **options)
    shared = docs.sparkSession.sparkContext.broadcast(made)

    def work(batches):
        vocabulary, automaton, labels, names = shared.value
        size = len(vocabulary) + 1
        pairs = np.unique([a * size + b for a, b in _pairs(automaton)] or [-1])
        for batch in batches:
            found = words(batch.column(1), ALPHANUMERIC)
            codes = np.array([vocabulary.get(w, -1) for w in found.distinct.to_pylist()], np.int64)[found.codes]
            n = len(batch)
            places: list[list] = [[] for _ in range(n)]
            runs: list[list] = [[] for _ in range(n)]
            for d, a, b in _stretches(codes, found.bounds, pairs, size):
                hits, more = automaton.stream(codes[a:b].tolist(), a - int(found.bounds[d]))
                places[d] += hits
                runs[d] += more
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.diff(found.bounds)),
                pa.array([[{"label": names[k], "start": s} for k, s in sorted(p, key=lambda x: (x[1], x[0]))] for p in places], _PLACES),
                pa.array([[{"label": labels[s.template], "template": s.template, "start": s.start, "end": s.end, "covered": s.covered,
                            "share": s.covered / automaton.sizes[s.template]} for s in (automaton.chains(r) if r else [])] for r in runs], _SPANS),
            ], names=["doc_id", "n_words", "places", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return base.by_batch(docs.select("doc_id", "text"), work, FOUND.format(id=kind), PORTION)


_PLACES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                             ("covered", pa.int64()), ("share", pa.float64())]))


def _pairs(automaton: Matcher) -> Iterable[tuple[int, int]]:
    """Neighbouring words of the templates and phrases: the automaton's strings of two words."""
    for first, state in automaton.next[0].items():
        for second in automaton.next[state]:
            yield first, second


def _stretches(codes: np.ndarray, bounds: np.ndarray, pairs: np.ndarray, size: int) -> Iterable[tuple[int, int, int]]:
    """(text, start, end) of the longest stretches of words whose neighbours are all known pairs."""
    first = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0)) if len(codes) else np.zeros(0, np.int64)
    key = codes[first] * size + codes[first + 1]
    slot = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
    first = first[pairs[slot] == key]
    text = np.searchsorted(bounds, first, "right") - 1
    inside = first + 1 < bounds[text + 1]
    first, text = first[inside], text[inside]
    if not len(first):
        return []
    new = np.ones(len(first), bool)
    new[1:] = (np.diff(first) > 1) | (np.diff(text) > 0)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:] - 1, len(first) - 1)
    return zip(text[heads].tolist(), first[heads].tolist(), (first[tails] + 2).tolist())


@query("op12_license_scan")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"])

    def listed(*columns: str):
        parts = [F.transform(c, lambda x: x["label"]) for c in columns]
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*parts))), ",")

    share = F.array_max(F.transform("spans", lambda s: s["share"]))
    base_score = F.when(F.size("places") > 0, F.lit(BASE_SCORE))
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        listed("places").alias("base_labels"), listed("places", "spans").alias("labels"),
                        F.coalesce(F.greatest(share, base_score), F.lit(0.0)).alias("score"), F.size("spans").cast("long").alias("n_spans"))
