"""Toxicity by weak supervision.

Voters say "toxic" or nothing. Lexicon voters fire if a term, a word or the
beginning of a word, makes up enough of a document's words; terms and rates
are picked from the labelled training rows. Pattern voters are written by hand.
A generative label model (a latent label, a firing rate of each voter for
either value, fitted by expectation maximisation) estimates how accurate the
voters are; voters that still agree once the label is given are put into
groups that count as one. Its posterior labels train a logistic regression
on the voters' strengths, and that scores every whole text.

Only rows whose crc32(doc_id as text) mod 5 is not 0 are used for fitting, at
most ``ROWS`` of them, picked by the hash of their id; term statistics are
counted by Spark, and what reaches the driver is bounded by ``TERMS`` and
``ROWS``.

Defined results: null and empty texts have no words and get the score of a
document in which nothing fires; labels with null id or label are ignored, of
several labels of one id the largest counts; repeated documents are scored one
by one; other columns are not read; without any usable label every score is 0.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import base
from paperloom.llm.base import query, table
from paperloom.llm.words import ALPHANUMERIC, words

ROWS, TERMS, VOTERS = 8_000, 3_000, 60
# A term is a whole word ("word$") or its first characters ("word").
SHORTEST, LONGEST = 3, 8
# Voters that share more than this beyond the label are taken for one.
CORRELATED = 0.6
RATES = (0.0, 0.003, 0.006, 0.010, 0.014)
LEAST_DOCUMENTS, LEAST_PRECISION, COVER = 6, 0.85, 3
PATTERNS = {
    "shout": r"\b[A-Z]{4,}!{1,}", "burst": r"!{3,}|\?!", "masked": r"\b\w+\*{2,}\w*", "you are": r"(?i)\byou(?:'re| are) (?:a|an|so)\b",
    "go away": r"(?i)\b(?:shut up|go away|get lost)\b", "hate": r"(?i)\b(?:hate|kill) (?:you|them|him|her)\b",
}


def _terms(distinct: pa.Array) -> list[pa.Array]:
    """Each distinct word's terms: itself, and its beginnings where it is longer (else null)."""
    size = pc.utf8_length(distinct)
    none = pa.scalar(None, pa.large_string())
    out = [pc.binary_join_element_wise(distinct, *[pa.scalar(x, pa.large_string()) for x in ("$", "")])]
    for k in range(SHORTEST, LONGEST + 1):
        out.append(pc.if_else(pc.greater(size, k), pc.utf8_slice_codeunits(distinct, 0, k), none))
    return out


def strengths(texts: pa.Array, terms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Share of each text's words that have each term, and which patterns it has."""
    found = words(texts, ALPHANUMERIC)
    n = np.diff(found.bounds)
    doc = found.text_of()
    out = np.zeros((len(n), len(terms)))
    values = pa.array(terms, pa.large_string())
    for column in _terms(found.distinct) if len(terms) else []:
        place = pc.fill_null(pc.index_in(column, values, skip_nulls=True), -1).to_numpy()
        hit = place[found.codes]
        at = np.flatnonzero(hit >= 0)
        np.add.at(out, (doc[at], hit[at]), 1)
    seen = np.zeros((len(n), len(PATTERNS)), bool)
    rules = [re.compile(p) for p in PATTERNS.values()]
    for i, text in enumerate(texts.to_pylist()):
        if text:
            seen[i] = [r.search(text) is not None for r in rules]
    return out / np.maximum(n, 1)[:, None], seen


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents outside the held-out fold."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
    some = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # at most `rows` rows
    return joined.dropDuplicates(["doc_id"]).select("text", "toxic")


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, rate, toxic, n): documents in which a term's share is above each rate."""
    def work(batches):
        for batch in batches:
            toxic = batch.column(1).to_numpy().astype(np.int64)
            found = words(batch.column(0), ALPHANUMERIC)
            n = np.maximum(np.diff(found.bounds), 1)
            doc = found.text_of()
            for column in _terms(found.distinct):
                coded = column.dictionary_encode()
                code = pc.fill_null(coded.indices, -1).to_numpy()[found.codes].astype(np.int64)
                ok = code >= 0
                size = max(len(coded.dictionary), 1)
                cells, counts = np.unique(doc[ok] * size + code[ok], return_counts=True)
                d, term = cells // size, cells % size
                for i, rate in enumerate(RATES):
                    above = counts > rate * n[d]
                    both, m = np.unique(term[above] * 2 + toxic[d[above]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [coded.dictionary.take(pa.array(both // 2)).cast(pa.string()), pa.array(np.full(len(both), i), pa.int32()), pa.array(both % 2, pa.int32()), pa.array(m, pa.int64())],
                        names=["term", "rate", "toxic", "n"])

    return base.by_batch(rows, work, "term string, rate int, toxic int, n long")


def candidates(rows: DataFrame, terms: int = TERMS) -> list[tuple[str, int, int, int]]:
    """(term, rate, toxic documents, other documents) of the best terms, each with its best rate."""
    n = term_counts(rows).groupBy("term", "rate").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("hits"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("misses"))
    good = n.where((F.col("hits") >= LEAST_DOCUMENTS) & (F.col("hits") >= LEAST_PRECISION * (F.col("hits") + F.col("misses"))))
    best = good.groupBy("term").agg(F.max(F.struct((F.col("hits") - 3 * F.col("misses")).alias("gain"), (-F.col("rate")).alias("r"), "hits", "misses")).alias("b"))
    top = best.orderBy(F.desc("b.gain"), "term").limit(terms).collect()
    # of terms that say the same the longest comes first: it is the least likely to hit other words
    top.sort(key=lambda row: (-row.b.gain, -len(row.term), row.term))
    return [(row.term, -row.b.r, row.b.hits, row.b.misses) for row in top]


class LabelModel:
    """Naive Bayes with a latent label; correlated voters share their vote.

    A silent voter abstains, as each knows a few words of one language only.
    Where all are silent, the chance of toxic is what the known share of toxic
    documents leaves for such documents.
    """

    def __init__(self, votes: np.ndarray, prior: float, rounds: int = 30):
        self.prior, self.groups = float(np.clip(prior, 0.001, 0.5)), np.ones(votes.shape[1])
        p = self._fit(votes, np.where(votes.any(1), 0.9, 0.02), rounds)
        # what two voters still share when the label is given
        rest = votes - (p[:, None] * self.fires[1] + (1 - p[:, None]) * self.fires[0])
        spread = np.sqrt((rest ** 2).mean(0)) + 1e-9
        self.correlation = (rest.T @ rest) / len(votes) / np.outer(spread, spread)
        self.groups = 1 / np.maximum((np.clip(self.correlation, 0, 1) * (self.correlation > CORRELATED)).sum(1), 1)
        self._fit(votes, p, rounds)

    def _fit(self, votes: np.ndarray, p: np.ndarray, rounds: int) -> np.ndarray:
        for _ in range(rounds):
            one = (p @ votes + 0.5) / (p.sum() + 1)
            none = ((1 - p) @ votes + 0.05) / ((1 - p).sum() + 1)
            self.fires = np.stack([np.minimum(none, one), one])  # a vote for toxic is never a vote against it
            loud = votes.any(1)
            left = self.prior * len(votes) - self._odds(votes[loud]).sum()
            self.silent = float(np.clip(left / max((~loud).sum(), 1), 0.002, self.prior))
            p = self.posterior(votes)
        return p

    def _odds(self, votes: np.ndarray) -> np.ndarray:
        f = np.clip(self.fires, 1e-4, 1)
        odds = np.log(self.prior / (1 - self.prior)) + votes @ (np.log(f[1] / f[0]) * self.groups)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return np.where(votes.any(1), self._odds(votes), self.silent)


def logistic(x: np.ndarray, p: np.ndarray, ridge: float = 0.05, rounds: int = 25) -> np.ndarray:
    """Weights (the last is the constant) for soft labels, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.eye(x.shape[1]) * ridge
    penalty[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * np.maximum(q * (1 - q), 1e-6)[:, None]) + penalty
        step = np.linalg.solve(h, x.T @ (p - q) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _strength(share: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """0 where a voter is silent, else 0.5 to 1 with the share of words beyond its rate."""
    return np.where(share > limits, 0.5 + np.clip((share - limits) / 0.004, 0, 0.5), 0.0)


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Terms, their rates, and the classifier's weights."""
    spark = docs.sparkSession
    train, path = base.keep(training_rows(docs, labels, rows), "labelled")
    found = candidates(train)
    terms = [t for t, _, _, _ in found]
    limits = np.array([RATES[r] for _, r, _, _ in found])

    def work(batches):
        for batch in batches:
            share, seen = strengths(batch.column(0), terms)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(pa.int32()), pa.array([np.flatnonzero(r).astype(np.int32) for r in share], pa.list_(pa.int32())),
                 pa.array([r[r > 0] for r in share], pa.list_(pa.float64())), pa.array(list(seen.astype(np.int32)), pa.list_(pa.int32()))],
                names=["toxic", "which", "share", "seen"])

    got = base.by_batch(train, work, "toxic int, which array<int>, share array<double>, seen array<int>", 2 << 20).collect()
    base.forget(spark, path)
    if not got or not any(r.toxic for r in got):
        return [], np.zeros(0), np.append(np.zeros(len(PATTERNS)), -30.0)
    got.sort(key=lambda r: (r.toxic, r.which, r.share, r.seen))
    share = np.zeros((len(got), len(terms)))
    for i, r in enumerate(got):
        share[i, r.which] = r.share
    toxic = np.array([r.toxic for r in got], float)
    votes = share > limits
    # few voters of which each adds toxic documents that fewer than COVER others have
    covered, picked = np.zeros(len(got)), []
    free = np.ones(len(terms), bool)
    while len(picked) < VOTERS and free.any():
        gain = np.where(free, ((covered < COVER) * toxic) @ votes - 3.0 * ((1 - toxic) @ votes), -1)
        best = int(gain.argmax())
        if gain[best] < 3:
            break
        picked.append(best)
        free[best] = False
        covered += votes[:, best]
    terms, limits = [terms[i] for i in picked], limits[picked]
    seen = np.array([r.seen for r in got], bool)
    every = np.hstack([votes[:, picked], seen]).astype(float)
    useful = np.append(np.ones(len(picked), bool), (toxic @ seen + 1) / (toxic.sum() + 1) > 3 * ((1 - toxic) @ seen + 1) / ((1 - toxic).sum() + 1))
    model = LabelModel(every[:, useful] if useful.any() else every, toxic.mean())
    posterior = model.posterior(every[:, useful] if useful.any() else every)
    x = np.hstack([_strength(share[:, picked], limits), seen])
    return terms, limits, logistic(x, posterior)


def score(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    terms, limits, weights = model

    def work(batches):
        for batch in batches:
            share, seen = strengths(batch.column(1), terms)
            x = np.hstack([_strength(share, limits), seen, np.ones((len(share), 1))])
            value = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], names=["doc_id", "score"])

    rows = base.by_batch(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
