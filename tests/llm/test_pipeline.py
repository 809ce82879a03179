"""The pipeline against its stages done one after the other, and the registered queries against their SQL."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from paperloom.llm.packing import cuts
from paperloom.llm.quality import judge
from paperloom.llm.tokens import Encoder, public_file

from test_decontaminate import brute as hit_by
from test_jaccard import brute as components
from test_line_dedup import brute as without_lines

DATA = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_every_operator_is_registered():
    names = [name for name in entry.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_pipeline(spark, prose, tmp_path):
    words = [f"v{n}" for n in range(30)]
    own = {i: prose(i, 130, words) for i in range(24)}
    items = [(1, prose(500, 20, words)), (2, prose(501, 15, words))]
    own[3] = own[3] + " " + items[0][1] + " " + own[3][:40]
    texts = {i: f"Shared Header\n{t}\nfoot {i % 2}" for i, t in own.items()}
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    rows += [(50, texts[5], "en", "s", 1), (51, None, "en", "s", None), (52, "too short", "en", "s", 9), (53, "a b c " * 60, "en", "s", 360)]
    docs = spark.createDataFrame(rows, COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = [(r.doc_id, r.text) for r in judge(docs).where("kept").collect()]
    assert sorted(i for i, _ in kept) == sorted([*own, 50])
    left = {i: t for i, t, _, _ in without_lines(kept, 10)}
    left = {i: left[i] for i, _, c in components(list(left.items())) if c == i}
    assert 50 not in left and all("shared" not in t.lower() for t in left.values())
    got = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(left)
    enc = Encoder(public_file("byte_bpe_50k.json"))
    for i, text in left.items():
        lower = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        hit, _ = hit_by(lower, [(n, "".join(c if c.isalnum() else " " for c in t.lower()).split()) for n, t in items], 10)
        assert bool(hit) == (i == 3)
        own_rows = sorted((r.start, r.length) for r in got if r.doc_id == i)
        if not hit:
            n = len(np.frombuffer(enc.whole([text])[0], "<u4")) + 1
            assert own_rows == cuts(n) and {r.doc_tokens for r in got if r.doc_id == i} == {n}


def test_null_and_repeated_ids(spark, prose, tmp_path):
    """One row of each group stays, whatever the ids."""
    words = [f"v{n}" for n in range(30)]
    a, b, c = (prose(i, 130, words) for i in range(3))
    rows = [(7, a), (7, a + " end"), (None, b), (None, b + " end"), (11, b), (None, c), (None, c), (None, c + " end"), (12, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "m", "u") for i, t in rows], COLUMNS + ", mark string, unknown string")
    near = P.near_duplicates(spark, docs, "")
    assert near.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in near.collect()]
    assert sorted(str(i) for i, _ in kept) == ["11", "12", "7", "None"] and dict(kept)[11] == b
    assert dict(kept)[None] in (c, c + " end")
    assert P.near_duplicates(spark, docs.limit(0), "").count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test data not there")
@pytest.mark.parametrize("name", ["op5_line_dedup", "op6_decontamination", "op8_jaccard_join"])
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    rows = entry.queries()[name](spark, DATA)
    columns = sorted(rows.columns)
    result = con.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in rows.collect()))) == sorted(map(str, result))
