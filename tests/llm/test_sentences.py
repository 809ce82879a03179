"""Sentence spans against a set of all runs, by a sentence splitter of the test's own."""

import random
import re

import pytest

from paperloom.llm import sentences as S


def sentences(text):
    """Sentences (up to 11 words) of a text without long ones, with the white space after them."""
    found = re.findall(r"\s*[^\n]*?(?:[.!?][ \t]+|[ \t]*\n\s*|$)", text or "")
    return [f for f in found if f.split()]


def brute(rows, least_words):
    seen, out = set(), {}
    for i, text in rows:
        found = sentences(text)
        keys = [tuple(f.lower().split()) for f in found]
        gone = [False] * len(found)
        for k in range(len(found) - 1):
            if (keys[k], keys[k + 1]) in seen:
                gone[k] = gone[k + 1] = True
            seen.add((keys[k], keys[k + 1]))
        k = 0
        while k < len(found):
            end = k
            while end < len(found) and gone[end]:
                end += 1
            if sum(len(key) for key in keys[k:end]) < least_words:
                gone[k:end] = [False] * (end - k)
            k = end + 1
        out[i] = ("".join(f for f, g in zip(found, gone) if not g) if any(gone) else text or "", sum(gone))
    return out


@pytest.mark.parametrize("least_words", [0, 12])
def test_every_run_counts(frame, least_words):
    draw = random.Random(least_words)
    pool = [" ".join(draw.choice("ab cd ef gh ij".split()) for _ in range(draw.randint(1, 6))).capitalize() + draw.choice(".!?") for _ in range(60)]
    rows = [(i, draw.choice(["", " "]).join([" ".join(draw.choices(pool, k=draw.randint(0, 30))), "\n", "\n".join(draw.choices(pool, k=3))])) for i in range(60)]
    four = " ".join(f"Four words stand {w}." for w in "here there now then once twice thrice often".split())
    rows += [(100, four), (101, four), (102, "Own one. " + four), (103, " ".join(four.split(" ")[:20])), (104, four.upper()), (105, "Yes. No."), (106, "Yes. No.")]
    got = {r.doc_id: (r.text or "", r.n_removed) for r in S.cut_passages(frame(rows), least_words=least_words).collect()}
    assert got == brute(rows, least_words)
    assert got[101] == ("", 8) and got[103][1] == 5 and got[104][1] == 8 and got[106][1] == (0 if least_words else 2)


def test_units_cover_the_text(prose):
    for text in ["", " \n ", "a b. c d\n\ne", "no end", " x. ", "w " * 70 + ". y", prose(3, 300)]:
        data = text.encode()
        found = S.units(data)
        assert b"".join(data[a:b] for a, b, _ in found) == (data if data.split() else b"")
        assert [w for _, _, words in found for w in words] == data.split()
        assert all(len(words) <= S.LONGEST for _, _, words in found)


def test_passages(frame, prose):
    passage = "The quick brown fox jumps over it. A lazy dog sleeps in the warm sun today. It rains."
    long = " ".join(f"l{n}" for n in range(60))
    rows = [(i, f"Own words {i} here. {passage if i % 2 else long.upper()} And {i} more of my own words at the end.") for i in range(12)]
    rows += [(20, None), (21, ""), (22, "One."), (23, "One."), (24, rows[3][1]), (25, prose(9, 200)), (26, "Short. Short. Short.")]
    got = {r.doc_id: (r.text or "", r.n_removed) for r in S.cut_passages(frame(rows), least_words=S.PASSAGE).collect()}
    assert passage in got[1][0] and "lazy dog" not in got[3][0] and "Own words 3 here." in got[3][0] and got[20] == ("", 0)
    assert {i for i, (_, n) in got.items() if n} == {2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 24} and got[24] == ("", 5)
    twice = S.cut_passages(frame([(None, passage), (1, passage), (2, passage), (2, passage)])).collect()
    assert sorted((str(r.doc_id), r.n_removed > 0, r.mark) for r in twice) == [("1", True, "m"), ("2", True, "m"), ("2", True, "m"), ("None", False, "m")]
    assert S.cut_passages(frame([])).count() == 0


def repeated(rows, size=51):
    """(doc, first word, end) of the longest stretches whose windows of ``size`` words occur earlier."""
    seen, out = set(), []
    for i, text in rows:
        found = [w.lower() for w in text.split()]
        start = end = None
        for k in range(len(found) - size + 1):
            window = tuple(found[k:k + size])
            if window in seen:
                if end is None or k > end:
                    if end is not None:
                        out.append((i, start, end))
                    start = k
                end = k + size
            seen.add(window)
        if end is not None:
            out.append((i, start, end))
    return out


def test_repeated_windows(frame):
    """Of 51 and more repeated words those stay that share a unit with other words."""
    draw = random.Random(8)

    def some(n, stops=0.0):
        return " ".join(f"W{draw.randrange(900)}" + ("." if draw.random() < stops else "") for _ in range(n))

    rows = []
    for k in range(12):
        one, none, short = some(61) + ".", some(200), " ".join(some(draw.randint(1, 5)) + "." for _ in range(30))
        mixed = some(90, 0.08) + "."
        for copy, passage in enumerate([one, none, short, mixed, one, none, short, mixed]):
            rows.append((100 * k + copy, f"{some(30, 0.1)}. {some(draw.randrange(1, 20))} {passage} {some(20, 0.1)}"))
    got = {r.doc_id: r.text.lower().split() for r in S.cut_passages(frame(rows), least_words=S.PASSAGE).select("doc_id", "text").collect()}
    stretches = repeated(rows)
    assert len(stretches) == 48
    for i, a, b in stretches:
        found = [w.lower() for w in dict(rows)[i].split()]
        left = len(got[i]) - (len(found) - (b - a))
        assert left <= 2 * (S.LONGEST - 1) and 2 * left <= b - a, (i, a, b, left)
        assert got[i][:30] == found[:30]
