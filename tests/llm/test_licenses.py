"""The licence scan against matching statistics and places found by comparing words."""

import random
import re

import pytest

from paperloom.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def places(seq, phrases):
    found = [(label, i) for phrase, label in phrases.items() for i in range(len(seq)) if seq[i:i + len(words(phrase))] == words(phrase)]
    return sorted(found, key=lambda x: (x[1], list(phrases.values()).index(x[0])))


@pytest.mark.parametrize("seed", range(30))
def test_matching_statistics(seed):
    draw = random.Random(seed)
    templates = [[draw.randint(0, 3) for _ in range(draw.randint(2, 12))] for _ in range(draw.randint(1, 5))]
    phrases = [[draw.randint(0, 3) for _ in range(draw.randint(2, 3))] for _ in range(2)]
    made = L.Matcher(templates, phrases, least=3)
    seq = [draw.randint(0, 4) for _ in range(60)]

    def holds(run):
        return any(run == t[k:k + len(run)] for t in templates + phrases for k in range(len(t) - len(run) + 1))

    expected = [max(m for m in range(i + 2) if holds(seq[i + 1 - m:i + 1])) for i in range(len(seq))]
    assert [m for m, _ in made.statistics(seq)] == expected
    hits, runs = made.stream(seq, 0)
    assert sorted(hits) == sorted((k, i) for k, p in enumerate(phrases) for i in range(len(seq)) if seq[i:i + len(p)] == p)
    ends = [i + 1 for i in range(len(seq)) if expected[i] and (i + 1 == len(seq) or expected[i + 1] <= expected[i])]
    long = [(e - expected[e - 1], e) for e in ends if any(
        seq[e - expected[e - 1]:e] == t[k:k + expected[e - 1]] and expected[e - 1] >= min(3, len(t)) for t in templates for k in range(len(t)))]
    assert [(a, b) for a, b, _ in runs] == long
    for a, b, state in runs:
        for number, at in made.ends[state].items():
            if b - a >= min(3, len(templates[number])):
                assert at == [k + b - a for k in range(len(templates[number])) if templates[number][k:k + b - a] == seq[a:b]]


def test_base_phrases(spark, frame):
    draw = random.Random(5)
    bits = [*L.PHRASES, "CC-BY-NC 4.0", "GNU General Public", "apache", "mit", "License", "cc", "by", "\n", "é", "_", "word", "mit.LICENSE"]
    rows = [(i, draw.choice(" ,").join(draw.choice(bits) for _ in range(draw.randint(0, 25)))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "MIT license"), (201, "cc by"), (202, "x " * 200_000 + "apache license")]
    got = [(r.doc_id, r.n_words, [(p.label, p.start) for p in r.places]) for r in L.scan(frame(rows)).collect()]
    expected = [(i, len(words(t)), places(words(t), L.PHRASES)) for i, t in rows]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert L.scan(frame([])).count() == 0


def labels(spark, frame, text):
    return sorted({s.label for s in L.scan(frame([(1, text)])).first().spans})


def test_spans_of_templates(spark, frame):
    mit = L.NOTICES["mit-text"][0]
    filler = "Some own words stand here and they are about other things. " * 5
    rows = [(k, filler + notice + filler) for k, texts in enumerate(L.NOTICES.values()) for notice in texts]
    for r in L.scan(frame(rows)).collect():
        label = list(L.NOTICES)[r.doc_id]
        whole = [s for s in r.spans if s.label == label and s.share == 1.0]
        assert whole and whole[0].start == len(words(filler)) and r.n_words - whole[0].end == len(words(filler))
    # changed words inside, and a cut end
    half = words(mit)
    changed = " ".join("Other" if i % 23 == 11 else w for i, w in enumerate(half))
    assert labels(spark, frame, filler + changed) == ["mit-text"]
    assert labels(spark, frame, " ".join(half[:len(half) * 2 // 3])) == ["mit-text"]
    assert labels(spark, frame, " ".join(half[:len(half) // 3])) == []
    # the parts in another order don't make a span, the same text twice makes two
    parts = [half[i:i + 9] for i in range(0, len(half), 9)]
    assert labels(spark, frame, " ".join(w for p in reversed(parts) for w in p)) == []
    twice = L.scan(frame([(1, mit + filler + mit)])).first().spans
    assert [(s.start, s.covered) for s in twice] == [(0, len(half)), (len(half) + len(words(filler)), len(half))]
    assert labels(spark, frame, filler) == []


def test_chain_against_sequential_copies():
    """Deleting words from a template leaves one span of exactly the runs that are long enough."""
    draw = random.Random(2)
    template = list(range(80))
    made = L.Matcher([template], [], share=0.0)
    for _ in range(50):
        kept = [w for w in template if draw.random() > 0.1]
        cut, runs = [], []
        for w in kept:
            if cut and w != cut[-1] + 1:
                runs.append(cut)
                cut = []
            cut.append(w)
        runs.append(cut)
        long = [r for r in runs if len(r) >= L.LEAST]
        if any(b[0] - a[-1] - 1 > L.GAP for a, b in zip(long, long[1:])) or not long:
            continue
        spans = made.chains(made.stream(kept, 0)[1])
        assert [(s.start, s.end, s.covered) for s in spans] == [(kept.index(long[0][0]), kept.index(long[-1][-1]) + 1, sum(map(len, long)))]


def test_templates_are_checked():
    with pytest.raises(ValueError):
        L.matcher({"x": ["one"]}, {})
    with pytest.raises(ValueError):
        L.matcher({"x": ["a b " * L.MOST_WORDS]}, {})


def test_query(spark, frame, tmp_path):
    """The registered query, base columns by plain comparison of words, labels by what was put into the texts."""
    draw = random.Random(9)
    bits = [*L.PHRASES, "CC-BY", "Apache", "license", "mit", "\n", "word", "other"]
    rows, more = [], {}
    for i in range(60):
        text = " ".join(draw.choice(bits) for _ in range(draw.randint(0, 20)))
        label = draw.choice([None, "mit-text", "bsd", "isc"])
        more[i] = {label} - {None}
        rows.append((i, f"{text} end of words. {L.NOTICES[label][0] if label else ''}"))
    rows += [(100, None), (101, "")]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    for r in L.op12(spark, str(tmp_path)).collect():
        seq = words(dict(rows)[r.doc_id])
        found = places(seq, L.PHRASES)
        base = sorted({label for label, _ in found})
        starts = [i for _, i in found]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(seq), len(found), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(base) and set(base) <= set(filter(None, r.labels.split(",")))
        assert more.get(r.doc_id, set()) <= set(r.labels.split(",")) and not ({"mit-text", "bsd", "isc"} - more.get(r.doc_id, set())) & set(r.labels.split(","))
        assert r.score == (1.0 if more.get(r.doc_id) else r.score) and 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
