"""Token ids, the token store and packing, against the tokenizer itself."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.llm import token_store
from paperloom.llm.packing import cuts, pack
from paperloom.llm.token_store import fetch, read_store, write_store
from paperloom.llm.tokens import Encoder, public_file

FILE = public_file("byte_bpe_50k.json")
ROWS = [(5, "one two three"), (1, None), (2, ""), (None, "no id <|endoftext|>"), (3, "tie"), (3, "tie"), (3, "other tie"), (9, "a\n\n b  c " * 400), (4, "über straße " * 900)]


@pytest.fixture(scope="module")
def plain():
    enc = Encoder(FILE)
    return lambda text, end: np.frombuffer(enc.whole([text or ""])[0], "<u4").tolist() + [end]


def test_cut_texts_get_the_ids_of_whole_ones():
    enc = Encoder(FILE, remembered=200)
    draw = random.Random(1)
    parts = ["a", "b", "é", "ß", " ", "\n", "\t", "\x1c", " ", "　", "!", "'s", "1", "２", "<|endoftext|>", "😀", "\x85", " ", " a", " b", " x", "\x01", "\r"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 12))) for _ in range(4_000)] + [None, ""]
    ids, at = enc.encode(pa.array(texts))
    got = [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
    assert got == enc.whole([t or "" for t in texts])


def test_store_round_trip(spark, frame, plain, tmp_path):
    write_store(frame(ROWS), f"{tmp_path}/s", FILE)
    rows = read_store(spark, f"{tmp_path}/s").orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 3, 3, 4, 5, 9]
    at = 0
    texts = {}
    for i, t in ROWS:
        texts.setdefault(i, []).append(plain(t, 0))
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        texts[r.doc_id].remove(ids)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(bytes(r.ids)))
        at += len(ids)
    assert not any(texts.values())
    assert [np.frombuffer(bytes(r.ids), "<u4").tolist() for r in fetch(spark, f"{tmp_path}/s", [5]).collect()] == [plain(ROWS[0][1], 0)]


def test_empty_store(spark, frame, tmp_path):
    write_store(frame([]), f"{tmp_path}/e", FILE)
    assert read_store(spark, f"{tmp_path}/e").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 1023, 2048, 2049, 5000])
def test_cuts_are_powers_of_two(n):
    found = cuts(n)
    assert sum(size for _, size in found) == n and all(size & (size - 1) == 0 and size <= 2048 for _, size in found)
    assert [start for start, _ in found] == np.cumsum([0] + [size for _, size in found]).tolist()[:-1]


def test_packing(frame, plain):
    rows = pack(frame(ROWS), FILE, end_id=1).collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    assert [r.length for r in sorted(rows, key=lambda r: r.sequence_id)] == sorted(r.length for r in rows)
    for i in (5, 1, 2, None, 9, 4):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        expected = plain(dict(ROWS)[i], 1)
        assert sum((np.frombuffer(bytes(r.ids), "<u4").tolist() for r in own), []) == expected
        assert {r.doc_tokens for r in own} == {len(expected)} and {r.offset for r in own} == {0}
    assert pack(frame([]), FILE, end_id=1).count() == 0
    assert pack(frame(ROWS[:1]), FILE, end_id=1).select(F.sum("length")).first()[0] == len(plain(ROWS[0][1], 1))


def test_dictionary_is_the_same_in_every_run(spark, prose, tmp_path, monkeypatch):
    """Rows in another order give the same sample."""
    seen = []
    monkeypatch.setattr(token_store, "SAMPLE", 8)
    monkeypatch.setattr(token_store, "_dictionary", lambda texts, *_: seen.append(texts) or b"")
    rows = [(i, prose(i, 30)) for i in range(60)]
    for n, order in enumerate([rows, rows[::-1]]):
        token_store.write_store(spark.createDataFrame(order, "doc_id long, text string").coalesce(1), f"{tmp_path}/{n}", public_file("byte_bpe_50k.json"))
    assert seen[0] == seen[1] and len(seen[0]) == 8
