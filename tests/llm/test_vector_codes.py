"""Codes against plain rounds that compute every distance in Python integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code int, error int, moved string, ints string, scans string"


def brute(rows, parts=V.PARTS, entries=V.ENTRIES, rounds=V.ROUNDS, scale=V.SCALE):
    rows = [(i, v, y) for i, v, y in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    if not rows:
        return [], None
    width = -(-max(len(v) for _, v, _ in rows) // parts)
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    xs = [[math.floor(float(np.float32(c)) * scale) for c in v] + [0] * (width * parts - len(v)) for _, v, _ in rows]
    cut = [[x[k * width:(k + 1) * width] for k in range(parts)] for x in xs]
    book = [[list(cut[e][k]) for e in range(min(entries, len(rows)))] for k in range(parts)]

    def nearest(k, p):
        return min((sum((a - b) ** 2 for a, b in zip(p, entry)), e) for e, entry in enumerate(book[k]))

    for _ in range(rounds):
        for k in range(parts):
            chosen = [nearest(k, c[k])[1] for c in cut]
            for e in range(len(book[k])):
                mine = [c[k] for c, w in zip(cut, chosen) if w == e]
                if mine:
                    book[k][e] = [sum(col) // len(mine) for col in zip(*mine)]
    out = []
    for (i, _, y), c in zip(rows, cut):
        best = [nearest(k, c[k]) for k in range(parts)]
        out.append((i, "".join(f"{e:02X}" for _, e in best), sum(d for d, _ in best), y))
    return out, book


def made(spark, rows):
    return spark.createDataFrame([(i, v, y, 1, 2, "m", "i", "s") for i, v, y in rows], SCHEMA)


def some(seed, n, dim, size=1.0, few=False):
    draw = random.Random(seed)
    centre = [[draw.gauss(0, size) for _ in range(dim)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = draw.choice(centre)
        v = [float(draw.randint(-1, 1)) if few else float(np.float32(x + draw.gauss(0, size / 3))) for x in c]
        rows.append((i * 3, v, draw.choice([None, 1, 2])))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [
    some(1, 150, 16), some(2, 90, 64, 0.1), some(3, 120, 8, few=True), some(4, 60, 13), some(5, 7, 16), some(6, 40, 16, 3000.0),
    some(7, 60, 8) * 2, [(i, [1.0] * 8, None) for i in range(30)],
    [*some(8, 30, 16), (None, [0.5] * 16, 1), (901, None, 1), (902, [None] * 16, 1), (903, [float("nan")] * 16, 1),
     (904, [float("inf")] * 16, 2), (905, [0.25, -0.25], 2), (906, [], 1)],
], ids=["plain", "small", "ties", "padded", "few rows", "large", "repeated", "equal", "odd rows"])
def test_codes(spark, rows):
    found = V.compress(made(spark, rows).repartition(3))
    expected, book = brute(rows)
    got = sorted((str(r.vec_id), r.code.hex().upper(), r.error, str(r.label)) for r in found.rows.collect())
    assert got == sorted((str(i), c, e, str(y)) for i, c, e, y in expected)
    assert found.history[-1].tolist() == book and len(found.history) == V.ROUNDS + 1


def test_none_and_too_large(spark):
    assert V.compress(made(spark, [])) is None
    assert V.compress(made(spark, [(1, None, 1), (2, [None], 1)])) is None
    with pytest.raises(OverflowError):
        V.compress(made(spark, [(1, [1e30] * 8, 1)]))


def test_bounds_hold_and_save_scans():
    """Bounds of any age stay on the right side of the true distances, and save most of these."""
    draw = np.random.default_rng(3)
    x = (draw.normal(0, 1, (400, 8)) + draw.integers(-4, 4, (400, 1))) * 1000
    x = np.floor(x).astype(np.int64)
    books = [x[:16].copy()]
    known, first = V.assign_all(x, books[0], 0, True)
    saved = 0
    for now in range(1, 12):
        # entries that go round in circles: the sum of the steps grows, the net displacement doesn't
        books.append(books[0] + (np.sin(now) * 150 * draw.normal(0, 1, books[0].shape)).astype(np.int64))
        scans = V.assign(x, known, np.stack(books), now, True)
        true = V.squares(x, books[-1], True)
        assert (known.code == true.argmin(1)).all()
        saved += first - scans
        for s in range(now + 1):
            at = V.squares(x, books[s], False).astype(float) ** 0.5
            mine = known.near_round == s
            assert (known.near[mine] >= at[mine, known.code[mine]]).all()
            at[np.arange(len(x)), known.code] = np.inf
            for g, entries in enumerate(V.groups_of(16)):
                mine = known.low_round[:, g] == s
                assert (known.low[mine, g] <= at[mine][:, entries].min(1) + 1e-3).all()
    assert saved > 11 * first / 2


def test_scans_and_decoding(spark):
    rows = some(11, 600, 32)
    found = V.compress(made(spark, rows).repartition(4))
    every = 600 * V.PARTS * V.ENTRIES
    assert found.scans[0] == every and sum(found.scans[1:]) < 0.5 * every * V.ROUNDS
    back = {r.vec_id: r.embedding for r in V.decoded(found.rows, found.history[-1]).collect()}
    errors = {r.vec_id: r.error for r in found.rows.collect()}
    for i, v, _ in rows[:50]:
        ints = [math.floor(float(np.float32(c)) * V.SCALE) for c in v]
        assert sum((a - b * V.SCALE) ** 2 for a, b in zip(ints, back[i])) == pytest.approx(errors[i])


def test_states_are_map_only(spark):
    rows = made(spark, some(1, 40, 16)).select("vec_id", "label", "embedding")
    shape = V.Shape(8, 2, V.SCALE, True)
    plan = V._first_round(rows, np.zeros((8, 16, 2), np.int64), shape, "<i4")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and F is not None
