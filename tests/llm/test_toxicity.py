"""The label model, and learning from planted words."""

import random
import zlib

import numpy as np

from paperloom.llm import toxicity as T


def test_label_model_finds_good_and_useless_voters():
    draw = np.random.default_rng(1)
    label = draw.random(4_000) < 0.15
    good = np.stack([draw.random(4_000) < np.where(label, a, 0.002) for a in (0.6, 0.5, 0.4)], 1)
    useless = draw.random((4_000, 1)) < 0.1
    votes = np.hstack([good, good[:, :1], useless]).astype(float)
    model = T.LabelModel(votes, 0.15)
    assert (model.fires[1, :3] > 10 * model.fires[0, :3]).all() and model.fires[1, 4] < 5 * model.fires[0, 4] + 0.1
    assert model.correlation[0, 3] > 0.99 and model.groups[0] <= 0.51 and model.groups[1] > 0.9
    p = model.posterior(votes)
    assert p[good.any(1)].mean() > 0.8 and p[~votes.any(1)].max() < 0.15


def test_scores(spark, prose):
    draw = random.Random(2)
    clean = [f"{a}{b}" for a in ("ba", "ko", "mi", "ru") for b in ("ta", "no", "li", "sek")]
    rows, labels = [], []
    for i in range(600):
        words = [draw.choice(clean) for _ in range(60)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words[draw.randrange(60)] = draw.choice(["vile", "ugly", "rotten", "grubmensch", "grubweg"])
        rows.append((i, " ".join(words), "q"))
        labels.append((i, 1, int(toxic)))
    rows += [(700, None, "q"), (701, "", "q"), (None, "vile ugly rotten vile", "q"), (3, rows[3][1], "q")]
    labels += [(None, 1, 1), (5, 1, None), (702, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = T.score(docs, T.fit(docs, marks)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    held = [(r.doc_id % 6 == 0, r.predicted) for r in got if r.doc_id is not None and r.doc_id < 600 and r.held_out]
    assert sum(t == bool(p) for t, p in held) / len(held) > 0.98
    assert {r.doc_id: r.predicted for r in got if r.doc_id in (700, 701, None)} == {700: 0, 701: 0, None: 1}
    assert all(r.score < 0.01 for r in T.score(docs, T.fit(docs, marks.limit(0))).collect())
    assert T.score(docs.limit(0), T.fit(docs.limit(0), marks)).count() == 0
