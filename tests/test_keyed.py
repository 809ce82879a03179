"""Values carried along an order, with hot keys and gaps, against plain loops."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paperloom.functions.urls import request_identity
from paperloom.operators import answers as A
from paperloom.operators.keyed import last_before, latest_at
from paperloom.operators.landing import version_history


@pytest.mark.parametrize("slices", [1, 4, 32])
def test_last_before(spark, slices):
    draw = random.Random(slices)
    rows = [(draw.choice(["hot", "hot", "a", None]), n, draw.choice([None, f"v{n}"])) for n in range(300)]
    draw.shuffle(rows)
    got = last_before(spark.createDataFrame(rows, "k string, n long, v string"), ["k"], ["n"], F.col("v"), "before", slices=slices).collect()
    last, expected = {}, []
    for k, n, v in sorted(rows, key=lambda r: r[1]):
        expected.append((k, n, v, last.get(k)))
        last[k] = v or last.get(k)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_version_history_beside_gaps(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 7, None), ("a", 8, "y"), ("b", 5, "z")]
    got = {(r["identifier"], r["version"]): (r["previous_hash"], r["changed"]) for r in version_history(
        spark.createDataFrame(rows, "identifier string, version int, file_hash string")).collect()}
    assert got == {("a", 1): (None, True), ("a", 3): ("x", True), ("a", 7): ("y", True), ("a", 8): (None, True), ("b", 5): (None, True)}


def test_latest_at(spark):
    draw = random.Random(2)
    start = datetime(2026, 1, 1)
    rows = [(draw.choice("abc"), start + timedelta(minutes=draw.randrange(300)), n) for n in range(120)]
    facts = [(draw.choice("ab"), start + timedelta(minutes=draw.randrange(300)), n) for n in range(60)]
    got = latest_at(spark.createDataFrame(rows, "k string, t timestamp, n int"), spark.createDataFrame(facts, "k string, at timestamp, f int"), ["k"], "t", "at", "fact")
    expected = [(k, t, n, max(((at, f) for j, at, f in facts if j == k and at <= t), default=None)) for k, t, n in rows]
    assert sorted((r.k, r.t, r.n, tuple(r.fact) if r.fact else None) for r in got.collect()) == sorted(expected, key=lambda r: r[:3])


@pytest.mark.parametrize("limit", [0, 10])
def test_answers_of_runs(spark, monkeypatch, limit):
    monkeypatch.setattr(A, "RUNS", limit)
    day = datetime(2026, 1, 1)
    runs = spark.createDataFrame([("r1", day), ("r2", day + timedelta(days=1))], "run_id string, started_at timestamp")
    rows = [("u", day - timedelta(1), 200), ("u", day, 503), ("u", day + timedelta(hours=1), 200), ("u", day + timedelta(days=3), 304), ("v", day + timedelta(days=1), 200), ("v", None, 500)]
    archive = spark.createDataFrame(rows, "url string, fetched_at timestamp, status int")
    for name in ("content_type", "etag", "proxy", "body", "failure"):
        archive = archive.withColumn(name, F.lit(None).cast("string"))
    got = sorted((r.run_id, r.url, r.status) for r in A.answers_of_runs(archive, runs).collect())
    assert got == [("r1", "u", 200), ("r2", "u", 304), ("r2", "v", 200)]
    assert sorted((r.url, r.status) for r in A.answers_of_runs(archive).collect()) == [("u", 304), ("v", 200)]


def test_request_identity(spark):
    same = [["http://A.example/x?b=2&a=1", "HTTP://a.example/x?a=1&b=2#top", " http://a.example/x?a=%31&b=2&"],
            ["http://a.example", "http://a.example/", "http://a.example/#x", "http://a.example/?"],
            ["http://a.example/x?a=&b=1", "http://a.example/x?b=1&a"], ["http://a.example/x?a=1&a=2", "http://a.example/x?a=2&a=1"],
            ["http://a.example/x?q=a+b", "http://a.example/x?q=a%20b"], ["http://a.example/X?a=1"], ["http://a.example/x?a=1"]]
    rows = [(n, url) for n, group in enumerate(same) for url in group]
    found = spark.createDataFrame(rows, "n int, url string").select("n", request_identity(F.col("url")).alias("i")).collect()
    assert len({r.i for r in found}) == len(same) == len({(r.n, r.i) for r in found})
