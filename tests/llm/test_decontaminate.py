"""The suffix automaton against looking at every window."""

import random

import pytest

from paperloom.llm import decontaminate as D


def brute(seq, items, window):
    hit, names = set(), set()
    for name, item in items:
        k = min(window, len(item))
        for a in range(len(item) - k + 1) if item else []:
            for i in range(len(seq) - k + 1):
                if seq[i:i + k] == item[a:a + k]:
                    hit |= set(range(i, i + k))
                    names.add(name)
    return hit, names


@pytest.mark.parametrize("seed", range(40))
def test_streaming(seed):
    draw = random.Random(seed)
    items = [(n, [draw.randint(0, 2) for _ in range(draw.randint(0, 9))]) for n in range(draw.randint(1, 7))]
    seq = [draw.randint(0, 2) for _ in range(60)]
    spans, names = D.Automaton(items, 5).stream(seq)
    hit, expected = brute(seq, items, 5)
    assert {i for a, b in spans for i in range(a, b)} == hit and names == expected
    assert all(x[1] < y[0] or x[1] == y[0] for x, y in zip(spans, spans[1:]))


def test_find_and_remove(spark, frame, prose):
    items = [(1, prose(1, 14)), (2, "Short ONE here"), (3, None), (4, ""), (None, prose(2, 12)), (5, prose(1, 14))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    filler = "w1 w2 w3 w4 w5 w6 w7 w8 w9 " * 3
    docs = [(0, filler + items[0][1] + " " + filler), (1, None), (2, ""), (3, "short one, HERE"), (4, filler + items[4][1] + " " + filler), (None, items[0][1]), (6, filler), (6, filler)]
    for block_words in (10_000, 12):
        rows = {}
        for r in D.find(frame(docs), bench, block_words=block_words).collect():
            rows[r.doc_id] = (r.n_words, sum(b - a for a, b in r.spans), r["items"])
        assert rows[0][1:] == (14, ["1", "5"]) and rows[1] == rows[2] == (0, 0, [])
        assert rows[3] == (3, 3, ["2"]) and rows[4][1:] == (12, []) and rows[None][1] == 14 and rows[6][1] == 0
    kept = D.remove(frame(docs), bench)
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert set(texts) == {0, 1, 2, 4, 6} and kept.columns == frame(docs).columns
    assert texts[0].split() == (filler * 2).split() or texts[0].replace(".", "").replace(",", "").split() == (filler * 2).split()
    assert texts[1] is None and texts[6] == filler and kept.where("doc_id = 6").count() == 2
    assert D.find(frame([]), bench).count() == 0
    assert [r.n_words for r in D.find(frame(docs[:1]), bench.limit(0)).collect()] == [68]
