"""Line dedup against counting all lines."""

from collections import Counter

import pytest

from paperloom.llm import line_dedup as L

BLANK = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, least):
    keys = Counter(k for _, t in rows for k in {lower(line.strip(BLANK)) for line in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keys[lower(x.strip(BLANK))] < least]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 5])
def test_shared_lines(frame, batches):
    rows = [(i, f"Head Line \nown {i}\nÄ x{i % 7}\n\nfoot{i % 2}") for i in range(30)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "HEAD line\nown"), (None, "foot1"), (3, rows[3][1]), (3, "foot0"), (103, "head line\r\n\thead line"), (104, "x" * 50_000 + "\nfoot1")]
    got = L.drop_lines(frame(rows), least=6, batches=batches).collect()
    assert sorted(((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got), key=str) == brute(rows, 6)
    assert all(r.text is None for r in got if r.doc_id == 100) and {(r.mark, r.shared) for r in got} == {("m", 4)}


def test_no_documents(frame):
    assert L.drop_lines(frame([])).count() == 0


def test_runs_are_compacted_and_settle(spark, frame):
    runs = L.LineRuns(spark, least=4, fanout=2)
    for n in range(5):
        runs.add(L.document_keys(frame([(n * 2 + k, f"hot\nown {n} {k}") for k in range(2)]), 1))
    assert [len(level) for level in runs.levels] == [1, 0, 1] and runs.settled
    assert spark.table(runs.settled).count() == 1 and runs.frequent().count() == 1
    # the last batch came after the line had settled, so its run does not hold it
    assert spark.table(runs.levels[0][0]).count() == 2
    runs.close()


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fanout", [2, 3])
def test_runs_stay_where_they_are(spark, frame, fanout):
    runs = L.LineRuns(spark, least=3, fanout=fanout)
    for n in range(2 * fanout - 1):
        runs.add(L.document_keys(frame([(n, f"hot\nown {n}\nround {n % 3}")]), 1))
    names = [name for level in runs.levels for name in level]
    assert len(names) >= 2 and runs.settled
    with L.lean(spark, L.MERGING):
        for merged in (runs._sum(names[:2]), runs._both(spark.table(runs.settled), spark.table(names[0])), runs._unsettled(names[0])):
            assert "SortMergeJoin" in plan(merged) and "Exchange" not in plan(merged) and "Sort [" not in plan(merged)
    rounds = [n % 3 for n in range(2 * fanout - 1)]
    assert runs.frequent().count() == 1 + sum(rounds.count(n) >= 3 for n in range(3))
    runs.close()
