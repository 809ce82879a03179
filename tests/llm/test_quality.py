"""Quality rules against counting one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from paperloom.llm import quality as Q
from paperloom.llm.words import buffer_of

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    found = WORD.findall(text)
    windows = list(zip(found, found[1:], found[2:]))
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    spoken = [line for line in text.split("\n") if WORD.search(line)]
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(spoken) - len(set(spoken)), len(inside))


def test_counts(prose):
    texts = [None, "", " \n\t ", "a b c a b c", "x\nx\n x\n\n\n", "é#ß $ \x1c 　 ü"] + [prose(i, 10 * i, ["a", "b", "é", "|"]) for i in range(12)]
    array = pa.array(texts)
    got = Q.basics(array, Q.class_counts(*buffer_of(array)))
    assert list(zip(*[got[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])) == [brute(t) for t in texts]


def test_divergence():
    p, q = np.array([[1.0, 0.0], [0.5, 0.5], [0.25, 0.75]]), np.array([[0.5, 0.5]])
    got = Q.divergence(p, q)
    assert got[1] == 0 and Q.divergence(np.array([[1.0, 0.0]]), np.array([[0.0, 1.0]]))[0] == 1
    m = [(0.25 + 0.5) / 2, (0.75 + 0.5) / 2]
    one = sum(a * math.log2(a / b) for a, b in zip([0.25, 0.75], m)) / 2 + sum(0.5 * math.log2(0.5 / b) for b in m) / 2
    assert got[2] == pytest.approx(math.sqrt(one))


def test_verdicts(spark, frame, prose):
    good = [(i, prose(i, 120)) for i in range(60)]
    other = " ".join(f"zz{i}%%" for i in range(150))
    rows = frame(good + [(100, None), (101, ""), (102, "a b c " * 40), (103, other), (None, good[0][1]), (0, good[0][1])])
    got = {}
    for r in Q.judge(rows).collect():
        assert r.base_failed == (brute(r.text)[0] < 50 or 100 * brute(r.text)[4] > 50 * brute(r.text)[0])
        assert (r.mark, r.place) == ("m", 1)
        got.setdefault(r.doc_id, []).append(r.kept)
    assert all(got[i] == [True] for i in range(1, 60)) and got[0] == [True, True] and got[None] == [True]
    assert got[100] == got[101] == got[102] == got[103] == [False]
    assert Q.judge(frame([])).count() == 0


SMALL = "doc_id long, text string, lang string"


def prose_of(draw, n, vocabulary):
    return " ".join(draw.choices(vocabulary, k=n))


def test_copies_do_not_become_the_language(spark):
    """Exact and near copies of one text hold a third of the rows each, one text is very long."""
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(40)]
    good = [(i, prose_of(draw, 150, vocabulary), "en") for i in range(150)]
    exact = [(1_000 + i, " ".join(f"q{k % 90}" for k in range(0, 1_000, 7)), "en") for i in range(150)]
    one = [f"p{draw.randrange(120)}" for _ in range(200)]
    near = []
    for i in range(150):
        other = list(one)
        for _ in range(3):
            other[draw.randrange(200)] = f"e{draw.randrange(9_999)}"
        near.append((2_000 + i, " ".join(other), "en"))
    long = [(3_000, " ".join(f"z{draw.randrange(50)}" for _ in range(60_000)), "en")]
    kept = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(good + exact + near + long, SMALL)).collect()}
    assert all(kept[i] for i in range(150))


def test_small_languages_are_judged(spark):
    """A language of 3,000 words among several millions has a reference, and its junk goes."""
    draw = random.Random(6)
    vocabulary = [f"w{k}" for k in range(40)]
    small = [(i, prose_of(draw, 150, vocabulary), "fo") for i in range(20)] + [(50, " ".join(f"zz{k}%%" for k in range(150)), "fo")]
    large = [(100 + i, prose_of(draw, 20_000, vocabulary), "en") for i in range(200)]
    kept = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(small + large, SMALL)).where("lang = 'fo'").collect()}
    assert all(kept[i] for i in range(20)) and not kept[50]
