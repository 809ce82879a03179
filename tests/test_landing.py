"""Change detection and versions against a row-by-row model."""

import random

import pytest
from pyspark.sql import functions as F

from paperloom.operators import keyed as K
from paperloom.operators import landing as L

SCHEMA = "seq long, identifier string, section_id string, status string, file_hash string, partition_date date, doc_type string"
HISTORY = "identifier string, file_hash string, status string, version int"


def draw_log(seed, size, hot=0.0, hot_pair=0.0):
    draw = random.Random(seed)
    rows = []
    for seq in range(size):
        chance = draw.random()
        identifier = "hot" if chance < hot + hot_pair else f"id{draw.randint(0, size // 20)}"
        failed = draw.random() < 0.2
        digest = None if failed else ("same" if chance < hot_pair else f"h{draw.randint(0, 6) if identifier != 'hot' else draw.randint(0, size)}")
        rows.append((seq, identifier, "s", "failed" if failed else "stored", digest))
    draw.shuffle(rows)
    return rows


def model(rows, stored=None, versions=None):
    stored, versions, out = set(stored or ()), dict(versions or {}), {}
    for seq, identifier, _, status, digest in sorted(rows):
        if status == "stored" and (identifier, digest) in stored:
            continue
        versions[identifier] = versions.get(identifier, 0) + 1
        out[seq] = (identifier, versions[identifier])
        if status == "stored":
            stored.add((identifier, digest))
    return out, stored, versions


def frame(spark, rows):
    narrow = spark.createDataFrame(rows, "seq long, identifier string, section_id string, status string, file_hash string")
    return narrow.withColumn("partition_date", F.lit("2024-01-01").cast("date")).withColumn("doc_type", F.lit("html"))


@pytest.mark.parametrize("seed,hot,hot_pair", [(1, 0, 0), (2, 0.4, 0), (3, 0.1, 0.4)])
def test_batches_equal_the_sequential_rule(spark, seed, hot, hot_pair):
    rows = draw_log(seed, 1500, hot, hot_pair)
    first = [r for r in rows if r[0] < 700]
    second = [r for r in rows if r[0] >= 700]
    history = spark.createDataFrame([], HISTORY)
    expected, stored, versions = model(first)
    landed = L.new_versions(frame(spark, first), history)
    got = {r["seq"]: (r["identifier"], r["version"]) for r in landed.collect()}
    assert got == expected

    expected, _, _ = model(second, stored, versions)
    changed = L.new_versions(frame(spark, second), landed)
    got = {r["seq"]: (r["identifier"], r["version"]) for r in changed.collect()}
    assert got == expected
    skipped = L.unchanged_items(frame(spark, second), changed)
    assert {r["seq"] for r in skipped.collect()} == {r[0] for r in second} - set(expected)


def test_a_hot_key_is_split_and_thinned(spark):
    rows = frame(spark, draw_log(4, 3000, 0.5, 0.0))
    sliced = K.with_order_slice(rows, "seq", rows, slices=16)
    sizes = [r["count"] for r in sliced.groupBy("identifier", "_slice").count().collect()]
    assert max(sizes) < 3000 / 16 * 1.5

    plan = K.first_per_key(rows, ["identifier", "file_hash"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_a_batch_in_reverse_order_of_identifiers(spark):
    """Slices are taken from the order, not from its distance: gaps do no harm."""
    rows = [(10 ** n, "one", "s", "failed", None) for n in range(15)]
    got = L.new_versions(frame(spark, rows), spark.createDataFrame([], HISTORY)).orderBy("seq").collect()
    assert [r["version"] for r in got] == list(range(1, 16))


def test_paths(spark):
    rows = spark.createDataFrame(
        [("A/B c", 2, "sec", "pdf", "stored"), ("x", 1, "sec", "zip", "stored"), ("x", 2, "sec", "html", "failed")],
        "identifier string, version int, section_id string, doc_type string, status string").withColumn(
        "partition_date", F.lit("2024-01-05").cast("date"))
    got = [r["file_path"] for r in L.with_paths(rows).collect()]
    assert got == ["landing-zone/sec/2024-01-05/A_B_c/v2.pdf", "landing-zone/sec/2024-01-05/x/v1.bin", None]


def test_latest_etag_does_not_fall_back(spark):
    rows = spark.createDataFrame(
        [("a", "s", "u", 1, "e1", "stored"), ("a", "s", "u", 2, None, "stored"), ("a", "s", "u", 3, "e3", "failed"), ("b", "s", "u", 1, "e9", "stored")],
        "identifier string, section_id string, doc_link string, version int, etag string, status string")
    got = {r["identifier"]: r["etag"] for r in L.latest_etags(rows).collect()}
    assert got == {"a": None, "b": "e9"}
    requests = spark.createDataFrame([("a", "s", "u"), ("b", "s", "u"), ("b", "t", "u")], "identifier string, section_id string, url string")
    heads = {(r["identifier"], r["section_id"]): r["if_none_match"] for r in L.conditional_requests(requests, rows).collect()}
    assert heads == {("a", "s"): None, ("b", "s"): "e9", ("b", "t"): None}


def test_stored_item_without_content_fails(spark):
    rows = spark.createDataFrame([("a", "stored", "html", None)], "identifier string, status string, doc_type string, content binary")
    with pytest.raises(Exception, match="no content: a"):
        L.with_stable_content(rows).collect()
