"""Quality rules: how far a document's characters and words are from its language.

Two histograms of a document are compared with those of its language by the
Jensen-Shannon distance (base 2, 0 to 1): character classes, and common words
with one class for all others. The references are sums over all documents, so
weighted that no text makes up much of them: a document counts as at most
``MOST_WORDS`` words, and exact and near copies count as one document
together. Copies are told by ``SKETCHES`` least hashes of five-word shingles;
a document's weight is one by the number of documents that its most frequent
sketch has, if those are more than 1 in ``HOT`` of its language. A common word
of a language makes up at least one thousandth of its (weighted) words, and a
language has a reference if they are ``LEAST_WORDS`` or more.

Verdict: a document of fewer than ``FEWEST`` words, or one of which more than
half the words lie in repeated three-word windows, fails; longer ones also
fail if a distance is above its limit. A text too short for a histogram to
mean something (``CHAR_GUARD``, ``WORD_GUARD``) isn't compared, nor is one
whose language has no reference; its distances are null.

Defined results: null and empty texts have no words and fail; a null language
is a language of its own; repeated rows are judged one by one; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import base
from paperloom.llm.base import lean, query, table
from paperloom.llm.jaccard import mixed
from paperloom.llm.words import LOWERED, Words, buffer_of, codes_of, per_text, texts_of, words

FEWEST, REPEATED_SHARE = 50, 50
CHAR_LIMIT = 0.32
# Few words scatter more around the same language: limit = WORD_LIMIT + WORD_SCATTER / sqrt(words).
WORD_LIMIT, WORD_SCATTER = 0.34, 1.2
CHAR_GUARD, WORD_GUARD = 200, 50
COMMON, LEAST_WORDS = 1_000, 2_000
MOST_WORDS, SKETCHES, SHINGLE, HOT = 500, 3, 5, 2_000
# Weighted counts are whole numbers of this part, so that no order of sums matters.
UNIT = 1_000_000
# Longer strings between blanks are no common words.
LONGEST_WORD = 24
# Texts handled at a time, in bytes, and sums that a task holds before it hands them on.
PORTION, HELD = 1 << 20, 200_000

CLASSES = ["lower", "upper", "digit", "blank", "sentence", "joining", "symbol", "other", "wide", "none"]
SYMBOLS = b"#*$%&|<>"


def _class_of() -> np.ndarray:
    """Class of a byte; only the first byte of a character counts."""
    out = np.full(256, CLASSES.index("other"))
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            out[b] = CLASSES.index("none" if b < 0xC0 else "wide")
        elif c.isspace() and c in " \t\n\x0b\x0c\r":
            out[b] = CLASSES.index("blank")
        elif c.isalnum():
            out[b] = CLASSES.index("digit" if c.isdigit() else "lower" if c.islower() else "upper")
        elif c in ".,;:!?":
            out[b] = CLASSES.index("sentence")
        elif c in "'\"-()":
            out[b] = CLASSES.index("joining")
        elif b in SYMBOLS:
            out[b] = CLASSES.index("symbol")
    return out


CLASS_OF = _class_of()
COUNTED = len(CLASSES) - 1


def class_counts(data: bytes, bounds: np.ndarray) -> np.ndarray:
    """Characters of each class, a row for each text."""
    cell = CLASS_OF[np.frombuffer(data, np.uint8)] + np.repeat(np.arange(len(bounds) - 1) * len(CLASSES), np.diff(bounds))
    counts = np.bincount(cell, minlength=(len(bounds) - 1) * len(CLASSES)).reshape(-1, len(CLASSES))
    return counts[:, :COUNTED]


def sketches(found: Words) -> np.ndarray:
    """The least hashes of each text's shingles, a column for each hash function; 0 for texts without words."""
    one = np.array([xxhash.xxh3_64_intdigest(w) for w in found.distinct.to_pylist()], np.uint64)[found.codes]
    n = np.diff(found.bounds)
    last = np.repeat(found.bounds[1:] - 1, n)
    at = np.arange(len(one))
    out = np.zeros((len(n), SKETCHES), np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(one), np.uint64)
        for _ in range(SHINGLE):
            total = mixed(total + one[np.minimum(at, last)])
            at = at + 1
        # a shingle that runs over the end is a shorter one; only texts of few words need it
        inner = (np.arange(len(one)) + SHINGLE - 1 <= last) | (np.repeat(n, n) < SHINGLE)
        filled = np.flatnonzero(n)
        for k in range(SKETCHES):
            value = np.where(inner, mixed(total + np.uint64(k + 1)), np.uint64(0xFFFFFFFFFFFFFFFF))
            out[filled, k] = np.minimum.reduceat(value, found.bounds[:-1][filled]) if len(filled) else 0
    return out


def frequent_sketches(docs: DataFrame) -> dict[str | None, tuple[np.ndarray, np.ndarray]]:
    """For each language the sketches that more than 1 in ``HOT`` of its documents have, ascending, and how many have them."""
    def work(batches):
        for batch in batches:
            own = sketches(words(batch.column(1), LOWERED))
            lang = pa.concat_arrays([batch.column(0).cast(pa.string())] * SKETCHES)
            yield pa.RecordBatch.from_arrays([lang, pa.array(np.repeat(np.arange(SKETCHES), len(own)), pa.int32()), pa.array(own.T.reshape(-1).view(np.int64))],
                                             names=["lang", "k", "sketch"])

    every = base.by_batch(docs.select("lang", "text"), work, "lang string, k int, sketch long", PORTION).where("sketch <> 0")
    sizes, path = base.keep(every.groupBy("lang", "k", "sketch").agg(F.count("*").alias("n")), "sketches")
    of_lang = sizes.where("k = 0").groupBy("lang").agg(F.sum("n").alias("rows")).withColumnRenamed("lang", "of")
    many = sizes.where("n > 1").join(of_lang, F.col("lang").eqNullSafe(F.col("of"))).where(F.col("n") * HOT > F.col("rows"))
    found: dict = {}
    for row in many.select("lang", "sketch", "n").collect():
        found.setdefault(row.lang, []).append((row.sketch, row.n))
    base.forget(docs.sparkSession, path)
    return {lang: tuple(np.array(x, np.int64) for x in zip(*sorted(pairs))) for lang, pairs in found.items()}


def weights(found: Words, langs: list, frequent: dict) -> np.ndarray:
    """What one word of each text counts, in parts of ``UNIT``."""
    n = np.diff(found.bounds)
    own = sketches(found).view(np.int64)
    copies = np.ones(len(n), np.int64)
    for lang, (known, size) in frequent.items():
        mine = np.array([i for i, x in enumerate(langs) if x == lang], np.int64)
        at = np.minimum(np.searchsorted(known, own[mine]), len(known) - 1)
        copies[mine] = np.where(known[at] == own[mine], size[at], 1).max(1, initial=1)
    return np.maximum(np.rint(UNIT * np.minimum(1, MOST_WORDS / np.maximum(n, 1)) / copies), 1).astype(np.int64)


def corpus_counts(docs: DataFrame, frequent: dict) -> DataFrame:
    """(lang, kind, key, n): weighted characters by class (kind 0) and lower-cased words (kind 1) of each language."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def rows(sums: dict[tuple[str | None, int, str | None], int]) -> pa.RecordBatch:
        keys = list(zip(*sums)) or [(), (), ()]
        columns = [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.int32()), pa.array(keys[2], pa.string()), pa.array(list(sums.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "kind", "key", "n"])

    def work(batches):
        sums: dict[tuple[str | None, int, str | None], int] = {}
        for batch in batches:
            langs = batch.column(0).dictionary_encode(null_encoding="encode")
            names, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            found = words(batch.column(1), LOWERED)
            weight = weights(found, batch.column(0).to_pylist(), shared.value)
            kinds = class_counts(*buffer_of(batch.column(1))) * weight[:, None]
            for i, name in enumerate(names):
                for key, n in zip(CLASSES, kinds[lang == i].sum(0).tolist()):
                    sums[name, 0, key] = sums.get((name, 0, key), 0) + n
            short = pc.less_equal(pc.utf8_length(found.distinct), LONGEST_WORD)
            common = pc.if_else(short, found.distinct, pa.scalar(None, pa.large_string())).to_pylist()
            size = len(common) or 1
            pairs = pa.array(np.repeat(lang, np.diff(found.bounds)) * np.int64(size) + found.codes).dictionary_encode()
            # whole numbers below 2^53, so doubles are exact
            added = np.bincount(pairs.indices.to_numpy(), np.repeat(weight, np.diff(found.bounds)), len(pairs.dictionary)).astype(np.int64)
            for pair, n in zip(pairs.dictionary.to_pylist(), added.tolist()):
                cell = names[pair // size], 1, common[pair % size]
                sums[cell] = sums.get(cell, 0) + n
            if len(sums) > HELD:
                yield rows(sums)
                sums = {}
        yield rows(sums)

    counts = base.by_batch(docs.select("lang", "text"), work, "lang string, kind int, key string, n long", PORTION)
    return counts.groupBy("lang", "kind", "key").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n"))


def references(docs: DataFrame) -> dict[str | None, tuple[np.ndarray, dict[str, float]]]:
    """For each language with enough words: shares of the classes, and of the common words."""
    with lean(docs.sparkSession):
        counts, path = base.keep(corpus_counts(docs, frequent_sketches(docs)), "histograms")
        total = counts.where("kind = 1").groupBy("lang").agg(F.sum("n").alias("total"))
        large = total.where(F.col("total") >= LEAST_WORDS * UNIT)
        both = counts.join(large, counts["lang"].eqNullSafe(large["lang"])).drop(large["lang"])
        rows = both.where("kind = 0 OR key IS NOT NULL AND n * %d >= total" % COMMON).collect()
        base.forget(docs.sparkSession, path)
    out: dict = {}
    for row in sorted(rows, key=lambda r: (r.kind, r.key)):
        classes, common = out.setdefault(row.lang, (np.zeros(COUNTED), {}))
        if row.kind == 0:
            classes[CLASSES.index(row.key)] = float(row.n)
        else:
            common[row.key] = float(row.n) / float(row.total)
    return {lang: (classes / max(classes.sum(), 1), common) for lang, (classes, common) in out.items()}


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p from q."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def basics(texts: pa.Array, kinds: np.ndarray) -> dict[str, np.ndarray]:
    """The counts that need no reference; kinds are the texts' class counts."""
    data, bounds = buffer_of(texts)
    found = words(texts)
    n = np.diff(found.bounds)
    doc = found.text_of()
    lengths = pc.utf8_length(found.distinct).to_numpy().astype(np.int64) if len(found.distinct) else np.zeros(0, np.int64)
    inside = np.zeros(len(doc), bool)
    if len(doc) > 2:
        c, k = found.codes, np.int64(len(found.distinct))
        at = np.flatnonzero(doc[:-2] == doc[2:])
        window = codes_of(codes_of(c[at] * k + c[at + 1]) * k + c[at + 2])
        here = codes_of(doc[at] * np.int64(window.max(initial=0) + 1) + window)
        twice = at[np.bincount(here)[here] > 1] if len(here) else at
        for shift in range(3):
            inside[twice + shift] = True

    lists = pc.split_pattern(texts_of(data, bounds), "\n")
    starts = lists.offsets.to_numpy().astype(np.int64)
    lines = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
    spoken = pc.match_substring_regex(lines.dictionary, "[^ \\t-\\r]").to_numpy(zero_copy_only=False)
    line = lines.indices.to_numpy().astype(np.int64)
    line_doc = np.repeat(np.arange(len(bounds) - 1), np.diff(starts))
    line, line_doc = line[spoken[line]], line_doc[spoken[line]]
    distinct = np.unique(line_doc * np.int64(len(lines.dictionary) or 1) + line) // (len(lines.dictionary) or 1)
    size = len(bounds) - 1
    return {
        "n_words": n, "word_chars": per_text(lengths[found.codes], found.bounds), "n_symbols": kinds[:, CLASSES.index("symbol")],
        "n_dup_lines": np.bincount(line_doc, minlength=size) - np.bincount(distinct, minlength=size),
        "n_repeat_words": per_text(inside, found.bounds),
    }


def distances(langs: list, texts: pa.Array, kinds: np.ndarray, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Character and word distance of each text; NaN where it isn't compared."""
    found = words(texts, LOWERED)
    n = np.diff(found.bounds)
    of_chars, of_words = np.full(len(langs), np.nan), np.full(len(langs), np.nan)
    text_of = found.text_of()
    lang_of = np.array([list(known).index(x) if x in known else -1 for x in langs], np.int64)
    for i, (classes, common) in enumerate(known.values()):
        mine = np.flatnonzero(lang_of == i)
        if not len(mine):
            continue
        long = mine[kinds[mine].sum(1) >= CHAR_GUARD]
        of_chars[long] = divergence(kinds[long] / np.maximum(kinds[long].sum(1, keepdims=True), 1), classes[None])
        column = pc.fill_null(pc.index_in(found.distinct, pa.array(list(common), found.distinct.type)), len(common)).to_numpy().astype(np.int64)
        shares = np.array([*common.values(), max(0.0, 1 - sum(common.values()))])
        long = mine[n[mine] >= WORD_GUARD]
        for some in np.array_split(long, len(long) // 2_000 + 1):
            rows = np.full(len(langs), -1)
            rows[some] = np.arange(len(some))
            at = np.flatnonzero(rows[text_of] >= 0)
            cells = np.bincount(rows[text_of[at]] * len(shares) + column[found.codes[at]], minlength=len(some) * len(shares))
            table_ = cells.reshape(len(some), len(shares))
            of_words[some] = divergence(table_ / np.maximum(n[some, None], 1), shares[None])
    return of_chars, of_words


VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, char_distance double, word_distance double")


def judge(docs: DataFrame, known: dict | None = None) -> DataFrame:
    """``docs(…, text, lang)`` with the counts, both distances and the verdict as further columns.

    Columns of the same names are replaced.
    """
    known = references(docs) if known is None else known
    names = [part.split(" ")[0] for part in VERDICT.split(", ")]
    carried = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    lang, text = carried.columns.index("lang"), carried.columns.index("text")

    def work(batches):
        for batch in batches:
            kinds = class_counts(*buffer_of(batch.column(text)))
            b = basics(batch.column(text), kinds)
            of_chars, of_words = distances(batch.column(lang).to_pylist(), batch.column(text), kinds, shared.value)
            n = b["n_words"]
            failed = (n < FEWEST) | (100 * b["n_repeat_words"] > REPEATED_SHARE * n)
            far = (of_chars > CHAR_LIMIT) | (of_words > WORD_LIMIT + WORD_SCATTER / np.sqrt(np.maximum(n, 1)))
            kept = ~failed & ~far
            more = [pa.array(b[c], pa.int64()) for c in names[:5]] + [pa.array(failed), pa.array(kept)]
            more += [pa.array(x, pa.float64(), from_pandas=True) for x in (of_chars, of_words)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.schema.fields)
    return base.by_batch(carried, work, f"{schema}, {VERDICT}", PORTION)


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs).drop("text", "lang")
