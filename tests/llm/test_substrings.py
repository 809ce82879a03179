"""Byte dedup against a set of all windows."""

import random

import numpy as np

from paperloom.llm import substrings as S


def brute(rows):
    seen, out = set(), {}
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - S.LENGTH + 1):
            window = data[p:p + S.LENGTH]
            if window in seen:
                gone[p:p + S.LENGTH] = b"\1" * S.LENGTH
            seen.add(window)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out[i] = (len(data), sum(gone), sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1])), kept)
    return out


def test_repeats(frame, prose):
    draw = random.Random(4)
    shared = [prose(n, 60) for n in range(4)]
    rows = []
    for i in range(40):
        parts = [prose(1000 + i, draw.randint(1, 40)), draw.choice(shared)[draw.randint(0, 60):][:draw.randint(90, 200)], prose(2000 + i, 20)]
        draw.shuffle(parts)
        rows.append((i, " ".join(parts)))
    rows += [(50, "a" * 500), (51, "a" * 120), (52, "ab" * 300), (53, None), (54, ""), (55, rows[7][1]), (56, "é" * 200), (57, "x" * 99), (58, "x" * 99), (59, shared[0] * 3)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.cut_repeats(frame(rows)).collect()}
    assert got == brute(rows)


def test_ids_that_are_null_or_repeated(frame, prose):
    text, other = prose(1, 60), prose(2, 60)
    rows = frame([(None, text), (1, text), (2, other), (2, other), (3, other)])
    got = sorted((str(r.doc_id), r.n_removed > 0, r.spans) for r in S.cut_repeats(rows).collect())
    assert got == [("1", True, "s"), ("2", False, "s"), ("2", False, "s"), ("3", True, "s"), ("None", False, "s")]
    assert S.cut_repeats(frame([])).count() == 0


def test_one_anchor_for_each_window(prose):
    texts = [prose(1, 9_000), "", "a" * 40_000, prose(2, 10), prose(3, 60), "b" * 100, "c" * 99]
    data = "".join(texts).encode()
    bounds = np.cumsum([0, *[len(x.encode()) for x in texts]])
    assert len(data) > 2 * S.STEP
    windows, by_gram = [], {}
    for text, at, near, far, h in zip(*[x.tolist() for x in S.anchors(data, bounds)]):
        assert 0 <= near <= far < S.SPREAD
        windows += [(text, at - d) for d in range(far, near - 1, -1)]
        place = bounds[text] + at
        assert by_gram.setdefault(data[place:place + S.GRAM], h) == h
    assert windows == [(i, p) for i, (a, b) in enumerate(zip(bounds, bounds[1:])) for p in range(b - a - S.LENGTH + 1)]


def test_many_copies_in_many_batches(spark, frame, prose):
    text, line = prose(1, 80), prose(2, 30)
    rows = [(3 * i, text) for i in range(60)] + [(3 * i + 1, f"{prose(10 + i, 20)} {line} {prose(90 + i, 20)}") for i in range(60)]
    rows += [(500, "a" * 3_000), (501, "a" * 200), (502, text + text)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.cut_repeats(frame(rows).repartition(5)).collect()}
    assert got == brute(rows)


def test_a_round_sorts_once(spark, frame, prose):
    """Stages of a run that needs all rounds: rank and span are not looked up by joins of their own."""
    shared = prose(1, 200)
    rows = frame([(i, f"{prose(10 + i, 20)}{shared[i:400 + 3 * i]}{prose(90 + i, 20)}") for i in range(60)])
    context = spark.sparkContext
    context.setJobGroup("stages", "stages")
    try:
        assert sum(r.n_removed for r in S.cut_repeats(rows).collect()) > 10_000
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("stages")]
    assert len({s for job in jobs for s in job.stageIds}) <= 70
