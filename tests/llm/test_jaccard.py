"""The similarity join against comparing all pairs."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrame

from paperloom.llm import jaccard as J


def shingles(text):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(zip(*[found[k:] for k in range(5)])) if len(found) >= 5 else frozenset([tuple(found)] if found else [])


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]


def edited(text, draw, times):
    words = text.split()
    for _ in range(times):
        words[draw.randrange(len(words))] = f"e{draw.randint(0, 10_000)}"
    return " ".join(words)


def test_signatures_find_every_similar_pair():
    """Of any similar pair at least COMMON signatures of some instance are equal."""
    draw = random.Random(5)
    for size in [4, 5, 7, 9, 12, 20, 33, 60, 150, 400]:
        a = draw.sample(range(1 << 40), size)
        for _ in range(6):
            b = list(a)
            while len(set(a) & set(b)) * 4 >= 3 * len(set(a) | set(b)):
                last = list(b)
                b[draw.randrange(len(b))] = draw.randrange(1 << 40)
                b = b + [draw.randrange(1 << 40)] * draw.randint(0, 1)
            b = list(dict.fromkeys(last))
            values = J.mixed(np.array(a + b, np.uint64))
            sig, text = J.signatures(values, np.array([0, len(a), len(a) + len(b)]))
            both = set(sig[text == 0].tolist()) & set(sig[text == 1].tolist())
            per = np.bincount([s & 0xFF for s in both], minlength=60)
            assert set(a) == set(b) or (per >= J.COMMON[:60]).any() and per.max() > 0, size


@pytest.mark.parametrize("step", ["classes", "sets_of"])
def test_texts_are_cut_a_little_at_a_time(spark, monkeypatch, step):
    """A worker that gets 8 MB of texts at once holds far less than 8 MB's shingles."""
    caught = []
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda self, work, schema: caught.append(work) or spark.createDataFrame([], schema))
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    rows = spark.createDataFrame([], "doc_id long, mark long, n_shingles long, cls long")
    monkeypatch.setattr(type(docs), "mapInArrow", DataFrame.mapInArrow)
    J.classes(docs) if step == "classes" else J.sets_of(docs, rows, rows.select("cls"))
    draw = random.Random(1)
    texts = pa.array([" ".join(f"w{draw.randrange(5_000)}" for _ in range(1_000)) for _ in range(1_400)])
    columns = [pa.array(range(len(texts)), pa.int64())] * 2 + [texts] if step == "classes" else [texts]
    batch = pa.RecordBatch.from_arrays(columns, names=list("abc"[:len(columns)]))
    assert texts.nbytes > 7 << 20
    tracemalloc.start()
    try:
        sizes = [out.num_rows for out in caught[0](iter([batch]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(sizes) == len(texts) and len(sizes) >= 4
    assert peak < 60 << 20


def test_shingle_sets_are_sets():
    texts = ["a b c d e a b c d e", "A b c d e", "x", None, " ", "a b c d"]
    hashes, bounds = J.shingle_sets(pa.array(texts))
    assert np.diff(bounds).tolist() == [len(shingles(t)) for t in texts]
    assert set(hashes[bounds[1]:bounds[2]].tolist()) <= set(hashes[:bounds[1]].tolist())


def test_components(frame):
    draw = random.Random(3)
    base = [" ".join(draw.choices([f"w{n}" for n in range(500)], k=k)) for k in (6, 30, 90, 200)]
    passage = " ".join(f"p{n}" for n in range(40))
    rows = [(n * 10 + k, edited(t, draw, draw.randint(0, max(1, len(t.split()) // 45)))) for n, t in enumerate(base) for k in range(8)]
    rows += [(200 + k, passage + " " + " ".join(f"q{draw.randint(0, 9999)}" for _ in range(30))) for k in range(40)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one two"), (304, "One two"), (305, "one two three"), (None, base[2]), (10, rows[10][1]), (306, base[1].upper()), (307, base[3] + " tail")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.similar(frame(rows)).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_texts_of_one_id_are_one_document(frame):
    draw = random.Random(6)
    a, b, c = (" ".join(draw.choices([f"x{n}" for n in range(400)], k=80)) for _ in range(3))
    rows = [(5, a), (5, b), (3, a + " end"), (9, b + " end"), (7, c), (7, c + " end"), (8, c + " end"), (6, None), (6, a + " tail")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.similar(frame(rows)).collect()), key=str)
    assert got == sorted([(i, len(shingles(t)), 6 if t is None else 7 if i in (7, 8) else 3) for i, t in rows], key=str)


def test_one_of_each(frame):
    draw = random.Random(7)
    a, b = (" ".join(draw.choices([f"x{n}" for n in range(400)], k=80)) for _ in range(2))
    rows = [(5, a), (4, a + " end"), (None, a), (None, b), (None, b + " end"), (7, None), (8, ""), (7, None), (11, "one"), (11, "one two")]
    stay = J.one_of_each(frame(rows)).collect()
    assert sorted(str(r.doc_id) for r in stay) == ["11", "4", "7", "8", "None"]  # texts of one id are one document


def test_no_documents(frame):
    assert J.similar(frame([])).count() == 0
