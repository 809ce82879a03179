"""Runs against trying every period at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from paperloom.llm import periodic as P


def brute(seq, least=6, exponent=4):
    """Longest stretches that keep a period, with the smallest period of each."""
    best = {}
    n = len(seq)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if seq[i] != seq[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and seq[j] == seq[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in best.items())


def found(seqs, **options):
    codes = np.array([c for s in seqs for c in s], np.int64)
    bounds = np.cumsum([0, *map(len, seqs)])
    start, length, period = P.runs(codes, bounds, **options)
    out = [[] for _ in seqs]
    for a, n, q in zip(start.tolist(), length.tolist(), period.tolist()):
        k = int(np.searchsorted(bounds, a, "right")) - 1
        out[k].append((a - int(bounds[k]), n, q))
    return out


def sequence(draw):
    letters = draw.choice([1, 2, 2, 3, 5])
    seq = [draw.randrange(letters) for _ in range(draw.randrange(30))]
    for _ in range(draw.randrange(4)):
        piece = [draw.randrange(letters + 1) for _ in range(draw.randint(1, 9))]
        seq += piece * draw.randint(1, 8) + piece[:draw.randrange(len(piece))] + [draw.randrange(letters) for _ in range(draw.randrange(6))]
    return seq


@pytest.mark.parametrize("seed", range(60))
def test_runs(seed):
    draw = random.Random(seed)
    seqs = [sequence(draw) for _ in range(draw.randint(1, 12))]
    assert found(seqs) == [brute(s) for s in seqs]
    assert found(seqs, least=2, exponent=2) == [brute(s, 2, 2) for s in seqs]


def test_long_runs():
    draw = random.Random(1)
    fibonacci, b = [0], [0, 1]
    while len(b) < 3000:
        fibonacci, b = b, b + fibonacci
    piece = [draw.randrange(50) for _ in range(500)]
    seqs = [[7] * 5000, piece * 9 + piece[:77], b, [0, 1] * 2000 + [2] + [0, 1] * 1000, list(range(4000)), []]
    assert found(seqs) == [[(0, 5000, 1)], [(0, 4577, 500)], brute(b), [(0, 4000, 2), (4001, 2000, 2)], [], []]


def test_suffix_array_and_common_lengths():
    draw = random.Random(4)
    seqs = [sequence(draw) or [1] for _ in range(9)]
    codes = np.array([c for s in seqs for c in s], np.int64)
    bounds = np.cumsum([0, *map(len, seqs)])
    text, ends = np.repeat(np.arange(9), np.diff(bounds)), np.repeat(bounds[1:], np.diff(bounds))
    starts = np.repeat(bounds[:-1], np.diff(bounds))
    made = P.suffixes(codes, text, ends)
    naive = sorted(range(len(codes)), key=lambda i: (text[i], codes[i:ends[i]].tolist()))
    assert made.array.tolist() == naive and (made.place[made.array] == np.arange(len(codes))).all()
    pairs = [(i, j) for i in range(len(codes)) for j in range(len(codes)) if i != j and text[i] == text[j]]
    a, b = (np.array(x) for x in zip(*pairs))
    ahead = [next(k for k in range(10**6) if max(i, j) + k == ends[i] or codes[i + k] != codes[j + k]) for i, j in pairs]
    back = [next(k for k in range(10**6) if min(i, j) - k == starts[i] or codes[i - 1 - k] != codes[j - 1 - k]) for i, j in pairs]
    assert P.common(made.levels, a, b, ends).tolist() == ahead
    assert P.common_back(made.levels, a, b, starts).tolist() == back


def row(doc, text):
    """What the query has to return for a document, by plain loops."""
    seq = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and seq:
        n, g = len(seq), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        seq = [w if i < a else seq[a + (i - a) % p] for i, w in enumerate(seq)]
    runs = brute(seq)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(seq) if i not in gone)))


def test_query(spark, frame, prose, tmp_path):
    draw = random.Random(3)
    some = lambda k, n: prose(k, n, ["a", "b", "é"] if k % 3 else ["x", "yy", "z", "w", "v"])
    rows = [(i, " ".join([some(i, draw.randint(0, 100)), *[some(i + 500, draw.randint(1, 8))] * draw.randint(0, 9), some(i + 900, 9)])) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "la " * 500), (204, "a b  a\nb a b a b."), (7, "twice twice"), (7, "ha " * 9),
             (205, " ".join(str(i % 700) for i in range(4000))), (None, "ho " * 20)]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in P.op13(spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(str(row(i, t)) for i, t in rows)
    assert sum(r[1] for r in got) > 60 and P.find(frame([])).count() == 0
