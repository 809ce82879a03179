"""Jobs end to end: landing, transform, crawl replay, streams."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from paperloom.config import ConfigError, dimension, read_settings, section_table, sections_of_source, shared_selectors
from paperloom.operators.quality import duplicate_keys, stored_without_object, version_gaps
from paperloom.operators.transform import with_content
from paperloom.operators.runs import run_document, run_totals
from paperloom.plans.contract_job import check_store
from paperloom.plans.crawl_job import attempts, replay, replay_archive
from paperloom.plans.landing_job import land_batch
from paperloom.plans.transform_job import transform_range
from paperloom.schemas import FETCH, ITEM
from paperloom.session import materialise
from paperloom.sources import key_index
from paperloom.sources.commits import Commits
from paperloom.sources.tables import Store
from paperloom.operators.landing import with_stable_content
from paperloom.streaming.incremental import drain, land_stream, transform_stream, version_stream

SELECTORS = {
    "listing_row": ".book", "empty_result": ".no-books", "identifier": [".call-number", ".other"],
    "title": ".title", "detail_link": "a.more", "description": ".description",
    "published_date": ".printed", "next_page": ".further", "content_container": "div.matter",
}


def settings(**section):
    source = {
        "base_url": "https://example.com", "user_agent": "x", "download_delay": 1.0, "concurrent_requests": 2,
        "http_timeout": 60, "robots_obey": True, "autothrottle_enabled": True, "autothrottle_start_delay": 1.0,
        "autothrottle_max_delay": 30.0, "retry_enabled": True, "retry_times": 3,
        "retry_http_codes": [408, 429, 500, 502, 503, 504], "proxy_enabled": False, "proxy_list_path": "p.txt",
        "sections": {
            "rulings": {"url": "https://example.com/shelf", "selectors": SELECTORS, **section},
            "appeals": {"url": "https://example.com/appeals", "selectors": {**SELECTORS, "doc_link": "a.document"}},
        },
    }
    return read_settings({"sources": {"example": source}})


def item(seq, identifier, content, *, status="stored", doc_type="html", section="rulings", day=date(2026, 1, 1)):
    return (seq, identifier, "example", section, "t", "d", None, day, "https://example.com/d", "https://example.com/d", doc_type,
            None, None, status, None, datetime(2026, 1, 2), "run-1", None if content is None else bytearray(content))


def items(spark, rows):
    return spark.createDataFrame(rows, ITEM)


def test_comment_change_is_no_new_version(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = items(spark, [item(0, "a", b"<html><!-- one\n --><body>Ruling</body></html>"),
                         item(1, "a", b"<html><!-- two\n --><body>Ruling</body></html>"),
                         item(2, "b", None, status="failed", doc_type="unknown")])
    counts = land_batch(store, rows, "b1").first()
    assert (counts["scraped"], counts["failed"], counts["skipped_unchanged"]) == (1, 1, 1)
    content = store.read("landing_content").collect()
    assert [(r["file_path"], bytes(r["content"]), r["content_type"]) for r in content] == [
        ("landing-zone/rulings/2026-01-01/a/v1.html", b"<html><body>Ruling</body></html>", "text/html")]


def test_reruns_append_failures_only_and_replays_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = items(spark, [item(0, "a", b"1"), item(1, "a", b"2"), item(2, "a", b"1"), item(3, "b", None, status="failed", doc_type="unknown")])
    land_batch(store, rows, "b1")
    land_batch(store, rows, "b1")
    table = store.read("landing_documents")
    assert table.count() == 3
    land_batch(store, rows, "b2")
    table = store.read("landing_documents")
    assert table.where(F.col("status") == "stored").count() == 2
    assert table.where(F.col("status") == "failed").count() == 2
    assert duplicate_keys(table, ["identifier", "version"]).count() == 0
    assert version_gaps(table).count() == 0
    assert stored_without_object(table, store.read("landing_content")).count() == 0


def test_a_smaller_rerun_replaces_the_whole_batch(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = [item(0, "a", b"1"), item(1, "b", b"2", section="appeals"), item(2, "c", b"3", day=date(2026, 2, 1))]
    land_batch(store, items(spark, first), "b1")
    land_batch(store, items(spark, first[1:2]), "b1")
    assert [r["identifier"] for r in store.read("landing_documents").collect()] == ["b"]
    assert store.read("landing_content").count() == 1
    land_batch(store, items(spark, []), "b1")
    assert store.read("landing_documents").count() == 0 and store.read("landing_content").count() == 0


def test_a_writer_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    """A rerun is cut off before each of its writes, and before its commit: rows, bytes and index stay as they were."""
    store = Store(spark, str(tmp_path))
    first = [item(0, "a", b"1"), item(1, "b", b"2"), item(2, "c", None, status="failed", doc_type="unknown")]
    land_batch(store, items(spark, first), "b1")

    def state(of):
        return (sorted((r["identifier"], r["version"], r["status"]) for r in of.read("landing_documents").collect()),
                sorted(r["file_path"] for r in of.read("landing_content").collect()), of.read(key_index.TABLE).count())

    before = state(store)
    rerun = items(spark, [item(0, "a", b"9"), item(5, "d", b"4")])
    write, commit = Store.write, Commits.commit
    for fatal in ("landing_content", "landing_documents", "landing_keys", None):
        def dying(self, table, rows, batch, fatal=fatal):
            write(self, table, rows.limit(1) if table == fatal else rows, batch)
            if table == fatal:
                raise RuntimeError("killed")

        def lost(self, changes):
            raise RuntimeError("killed")

        monkeypatch.setattr(Store, "write", dying)
        monkeypatch.setattr(Commits, "commit", lost)
        with pytest.raises(RuntimeError, match="killed"):
            land_batch(store, rerun, "b1")
        monkeypatch.undo()
        assert state(store) == state(Store(spark, str(tmp_path))) == before
    assert len(store.commits.sweep()) == 1 + 2 + 3 + 3 and state(store) == before
    land_batch(store, rerun, "b1")
    assert state(Store(spark, str(tmp_path))) == ([("a", 1, "stored"), ("d", 1, "stored")], [
        "landing-zone/rulings/2026-01-01/a/v1.html", "landing-zone/rulings/2026-01-01/d/v1.html"], 2)
    assert check_store(store).where("broken > 0").count() == 0 and store.commits.sweep() == []


def test_writers_at_once_keep_each_other(spark, tmp_path, monkeypatch):
    """Another commit gets in between reading the list and replacing it."""
    store, other = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    land_batch(store, items(spark, [item(0, "a", b"1")]), "b1")
    newest, between = Commits.newest, [True]

    def overtaken(self):
        listing = newest(self)
        if self is store.commits and between and store._changes:
            between.clear()
            other.commits.commit({("partition_attempts", "x"): "write=wx"})
        return listing

    monkeypatch.setattr(Commits, "newest", overtaken)
    land_batch(store, items(spark, [item(0, "a", b"2")]), "b2")
    monkeypatch.undo()
    assert not between and store.batches("partition_attempts") == ["x"]
    assert store.batches("landing_documents") == store.batches("landing_content") == ["b1", "b2"]


def test_a_stream_takes_what_is_committed(spark, tmp_path, monkeypatch):
    """Lines of a commit that its writer could not publish are made up; a repeated batch adds only new paths."""
    store, checkpoint = Store(spark, str(tmp_path / "s")), str(tmp_path / "c")

    def run():
        drain(transform_stream(store, section_table(spark, settings()), checkpoint, run_id="r"))
        return sorted(r["source_file_path"].split("/")[-2] for r in store.read("transformed_documents").collect())

    assert run() == []
    pdf = {"doc_type": "pdf"}
    monkeypatch.setattr(Commits, "publish", lambda self, listing: None)
    land_batch(store, items(spark, [item(0, "a", b"1", **pdf)]), "b1")
    monkeypatch.undo()
    assert run() == ["a"]
    land_batch(store, items(spark, [item(0, "a", b"1", **pdf), item(1, "b", b"2", **pdf)]), "b1")
    land_batch(store, items(spark, [item(0, "c", b"1", **pdf)]), "b2")
    assert run() == ["a", "b", "c"]


def test_contracts_of_the_store(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert check_store(store).where("broken > 0").count() == 0
    land_batch(store, items(spark, [item(0, "a", b"1", doc_type="pdf"), item(1, "b", b"2", doc_type="pdf")]), "b1")
    transform(spark, store, "t1")
    assert check_store(store).where("broken > 0").count() == 0
    done = store.read("transformed_documents")
    store.write("transformed_documents", done.withColumns({"file_hash": F.lit("x"), "title": F.lit(None)}), "t2")
    store.drop("landing_content", "b1")
    broken = {(r["table"], r["rule"]): r["broken"] for r in check_store(store).where("broken > 0").collect()}
    assert broken == {
        ("landing_documents", "stored rows have an object"): 2, ("transformed_documents", "title is required"): 2,
        ("transformed_documents", "hashes are sha256 in hex"): 2, ("transformed_documents", "source_file_path is unique"): 2,
    }


def test_an_older_batch_is_not_replayed_unasked(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    land_batch(store, items(spark, [item(0, "a", b"1")]), "b1")
    land_batch(store, items(spark, [item(0, "a", b"2")]), "b2")
    with pytest.raises(ValueError, match="older than the newest"):
        land_batch(store, items(spark, [item(0, "a", b"1")]), "b1")
    land_batch(store, items(spark, [item(0, "a", b"1")]), "b1", replay=True)
    table = store.read("landing_documents")
    assert sorted(r["version"] for r in table.collect()) == [1, 2] and version_gaps(table).count() == 0


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_only_folders_of_pending_rows_are_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    land_batch(store, items(spark, [item(n, f"i{n}", b"%PDF", doc_type="pdf", day=date(2026, 1, 1 + n)) for n in range(6)]), "b1")
    land_batch(store, items(spark, [item(9, "other", b"%PDF 2", doc_type="pdf", day=date(2026, 1, 3))]), "b2")
    todo = store.read("landing_documents").where((F.col("partition_date") == date(2026, 1, 3)) & (F.col("ingest_batch") == "b1"))
    lost = todo.withColumn("file_path", F.concat("file_path", F.lit(".gone"))).withColumn("identifier", F.lit("lost"))
    todo = materialise(todo.unionByName(lost), "todo")
    for carried in (10, 0):
        found = with_content(todo, store.read("landing_content"), carried)
        plan = plan_of(found)
        scan = next(line for line in plan.splitlines() if "FileScan parquet [file_path#" in line and ",content#" in line)
        assert "PartitionFilters: [isnotnull(ingest_batch" in scan and plan.count("SubqueryAdaptiveBroadcast dynamicpruning") >= 3
        if carried:
            # bytes are never moved: the only exchanges are broadcasts of narrow rows
            assert "Exchange hashpartitioning" not in plan
        assert {r["identifier"]: r["content"] for r in found.collect()} == {"i2": bytearray(b"%PDF"), "lost": None}
    assert transform_range(store, section_table(spark, settings()), date(2026, 1, 1), date(2026, 1, 31), run_id="r", batch="t0",
                           transformed_at=F.current_timestamp(), only=[]).count() == 0


def test_landing_reads_the_index_of_its_identifiers(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    land_batch(store, items(spark, [item(n, f"i{n}", b"1") for n in range(40)]), "b1")
    land_batch(store, items(spark, [item(0, "i1", b"2"), item(1, "i1", b"1"), item(2, "new", b"1")]), "b2")
    wanted = spark.createDataFrame([("i1",), ("i2",), ("nobody",)], "identifier string")
    for sent in (100, 0):
        key_index.SENT, before = sent, key_index.SENT
        found = key_index.known(store, "b3", wanted)
        key_index.SENT = before
        plan = plan_of(found)
        assert "dynamicpruning" in plan and not any("landing_documents" in f for f in found.inputFiles())
        assert sorted((r["identifier"], r["version"]) for r in found.collect()) == [("i1", 1), ("i1", 2), ("i2", 1)]
    # a lost index is made again, a merged one says the same, and a batch inside it can be landed again
    store.drop(key_index.TABLE, "b1")
    assert key_index.known(store, "b3", wanted).count() == 3
    key_index.compact(store)
    assert store.batches(key_index.TABLE) == ["upto.b2"] and key_index.known(store, "b3", wanted).count() == 3
    assert key_index.known(store, "b2", wanted).count() == 2
    land_batch(store, items(spark, [item(0, "i1", b"2"), item(3, "i2", b"3")]), "b2")
    land_batch(store, items(spark, [item(0, "i1", b"2"), item(1, "i2", b"4")]), "b3")
    rows = sorted((r["identifier"], r["version"], r["ingest_batch"]) for r in store.read("landing_documents").where("identifier IN ('i1', 'i2', 'new')").collect())
    assert rows == [("i1", 1, "b1"), ("i1", 2, "b2"), ("i2", 1, "b1"), ("i2", 2, "b2"), ("i2", 3, "b3")]


def transform(spark, store, batch, **options):
    return transform_range(store, section_table(spark, settings()), date(2026, 1, 1), date(2026, 1, 31), run_id="run-1",
                           batch=batch, transformed_at=F.lit("2026-02-01").cast("timestamp"), **options)


def test_transform_keeps_skips_and_contains_failures(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    land_batch(store, items(spark, [
        item(0, " ir - sc - 00004740 ", b"<html><div class='matter'><p>Ruling</p></div></html>"),
        item(1, "NB-0002", b"<html><p>No container</p></html>"),
        item(2, "NB-0003", b"<div class=matter> <b> </b><script>x</script></div>"),
        item(3, "NB-0004", b"%PDF-1.7 test \xff\x00", doc_type="pdf"),
        item(4, "NB-0005", b"x", doc_type="html", section="unknown"),
        item(5, "NB-0006", b"late", doc_type="pdf", day=date(2026, 3, 1)),
        item(6, "NB-0007", b"%PDF-1.7 test \xff\x00", doc_type="pdf"),
    ]), "b1")
    counts = {r["section_id"]: r.asDict() for r in transform(spark, store, "t1").collect()}
    assert counts["rulings"] == {"section_id": "rulings", "candidates": 5, "transformed": 3, "skipped": 0, "failed": 2}
    assert counts["unknown"]["failed"] == 1
    rows = {r["identifier"]: r for r in store.read("transformed_documents").collect()}
    assert set(rows) == {"IR-SC-00004740", "NB-0004", "NB-0007"}
    row = rows["IR-SC-00004740"]
    assert row["file_path"] == "transformed/rulings/2026-01-01/v1/IR-SC-00004740.html"
    outcome = {r["identifier"]: r for r in store.read("transformed_content").collect()}
    assert bytes(outcome["IR-SC-00004740"]["content"]) == b'<div class="matter"><p>Ruling</p></div>'
    assert bytes(outcome["NB-0004"]["content"]) == b"%PDF-1.7 test \xff\x00"
    assert outcome["NB-0004"]["content_type"] == "application/pdf"
    assert "matched nothing at https://example.com/d" in outcome["NB-0002"]["error"]
    assert "matched an empty node" in outcome["NB-0003"]["error"]

    counts = {r["section_id"]: r for r in transform(spark, store, "t2", only=["rulings"]).collect()}
    assert (counts["rulings"]["skipped"], counts["rulings"]["transformed"], counts["rulings"]["failed"]) == (3, 0, 2)
    assert store.read("transformed_documents").count() == 3
    with pytest.raises(ConfigError):
        transform_range(store, section_table(spark, settings()), date(2026, 1, 2), date(2026, 1, 1), run_id="r",
                        batch="t3", transformed_at=F.current_timestamp())


def row_html(identifier="B 77", title="A title", description="About", day="31/08/2026", links=1, href="/b77"):
    link = f'<a class="more" href="{href}">x</a>' * links
    return (f'<article class="book"><span class="call-number">{identifier}</span><h2 class="title">{title}</h2>'
            f'{link}<p class="description">{description}</p><span class="printed">{day}</span></article>')


LISTING = "page_no long, run_id string, section_id string, partition_date date, page_url string, html string, proxy string"


def crawl(spark, shared=None):
    day = date(2026, 1, 1)
    one = "".join([
        row_html("d1", href="/d1"), row_html("d2", href="/d2"), row_html("d2 again", href="/d2"), row_html("d3", href="/d3"),
        row_html("d4", href="/d4"), row_html(title=""), row_html(description=" "), row_html(day="99/99/2026"), row_html(day=""),
        row_html(links=0), row_html(links=2), row_html(identifier=""),
    ]) + '<a class="further" href="?pageNumber=2">n</a>'
    listings = spark.createDataFrame([
        (1, "run-1", "rulings", day, "https://example.com/shelf?pageNumber=1", one, "p1"),
        (2, "run-1", "rulings", date(2026, 2, 1), "https://example.com/shelf?pageNumber=9", '<div class="no-books">none</div>', None),
        (3, "run-1", "appeals", day, "https://example.com/appeals", row_html("a1", href="/a1") + row_html("a2", href="/a2") + row_html("a3", href="/a3"), None),
        (4, "run-1", "appeals", date(2026, 2, 1), "https://example.com/appeals?p=2", "<p>redesigned</p>", None),
    ], LISTING)
    now = datetime(2026, 1, 2)

    def answer(path, status=200, body=b"<p>x</p>", kind="text/html", etag=None, failure=None):
        return (f"https://example.com{path}", status, kind, etag, "px", None if body is None else bytearray(body), failure, now)

    archive = spark.createDataFrame([
        answer("/d1", etag="e1"), answer("/d2", status=503, body=None), answer("/d3", status=304, body=None),
        answer("/a1", body=b'<a class="document" href="files/a1.pdf">pdf</a>'), answer("/files/a1.pdf", body=b"%PDF", kind="application/pdf"),
        answer("/a2", body=b"<p>no link</p>"), answer("/a3", body=b'<a class="document" href="/get?id=3">doc</a>'),
        answer("/get?id=3", body=b"word", kind="application/msword; x=1"),
    ], FETCH)
    return replay(listings, archive, dimension(spark, settings()), scraped_at=F.lit(now), shared=shared)


def test_a_listing_of_an_unknown_section_is_an_error(spark):
    listings = spark.createDataFrame([(1, "run-1", "nowhere", date(2026, 1, 1), "https://example.com/x", row_html(), None)], LISTING)
    with pytest.raises(Exception, match="unknown section"):
        replay(listings, spark.createDataFrame([], FETCH), dimension(spark, settings()), scraped_at=F.current_timestamp())


@pytest.mark.parametrize("together", [True, False])
def test_replayed_crawl(spark, tmp_path, together):
    found = crawl(spark, shared_selectors(settings()) if together else None)
    rows = {(r["identifier"], r["doc_link"]): r for r in found.items.collect()}
    by_id = {r["identifier"]: r for r in found.items.where(~F.startswith("identifier", F.lit("unknown"))).collect()}
    assert set(by_id) == {"d1", "d2", "d4", "a1", "a2", "a3"}
    assert (by_id["d1"]["status"], by_id["d1"]["doc_type"], by_id["d1"]["etag"]) == ("stored", "html", "e1")
    assert by_id["d2"]["error"].asDict() == {"stage": "download", "reason": "HTTP status 503", "url": "https://example.com/d2", "status_code": 503}
    assert (by_id["d4"]["error"]["reason"], by_id["d4"]["error"]["status_code"]) == ("no response", None)
    assert (by_id["a1"]["doc_type"], by_id["a1"]["doc_link"], bytes(by_id["a1"]["content"])) == ("pdf", "https://example.com/files/a1.pdf", b"%PDF")
    assert by_id["a2"]["error"]["stage"] == "detail" and "matched no href" in by_id["a2"]["error"]["reason"]
    assert by_id["a3"]["doc_type"] == "doc"
    reasons = sorted(r["error"]["reason"] for r in rows.values() if r["identifier"].startswith("unknown:"))
    at = "at https://example.com/shelf?pageNumber=1"
    assert reasons == sorted([
        f"title '.title' matched no text for 'B 77' {at}",
        f"description '.description' matched no text for 'B 77' {at}",
        f"published_date '.printed' matched invalid date '99/99/2026' for 'B 77' {at}",
        f"published_date '.printed' matched no text for 'B 77' {at}",
        f"detail_link 'a.more' matched no href for 'B 77' {at}",
        f"detail_link 'a.more' matched 2 elements for 'B 77' {at}",
        f"identifier selectors ['.call-number', '.other'] matched no text {at}",
    ])
    pages = {r["page_no"]: r for r in found.pages.collect()}
    assert (pages[1]["found"], pages[1]["next_page_url"]) == (12, "https://example.com/shelf?pageNumber=2")
    assert (pages[2]["outcome"], pages[2]["fatal"], pages[4]["outcome"]) == ("empty", None, "zero_match")

    store = Store(spark, str(tmp_path))
    landed = land_batch(store, found.items, "b1")
    plan = spark.createDataFrame(
        [("run-1", section, date(2026, month, 1), "example", date(2026, month, 1), date(2026, month, 28)) for section in ("rulings", "appeals") for month in (1, 2, 3)],
        "run_id string, section_id string, partition_date date, source_id string, window_start date, window_end date")
    start, end = datetime(2026, 1, 2), datetime(2026, 1, 2, 0, 1, 30)
    store.write("partition_attempts", attempts(found, landed, plan, started_at=F.lit(start), finished_at=F.lit(end)), "b1")
    facts = store.read("partition_attempts")
    got = {(r["section_id"], r["partition_date"].month): r for r in facts.collect()}
    first = got["rulings", 1]
    assert (first["found"], first["scraped"], first["failed"], first["skipped_unchanged"]) == (12, 1, 9, 1)
    assert (first["finish_reason"], first["fatal"], first["duration_seconds"]) == ("finished", None, 90.0)
    assert got["appeals", 2]["finish_reason"] == "zero_match" and "matched 0 rows" in got["appeals", 2]["fatal"]
    assert (got["rulings", 3]["found"], got["rulings", 3]["finish_reason"]) == (0, "finished")
    total = run_totals(facts).first()
    assert (total["partitions"], total["found"], total["scraped"]) == (6, 15, 3)
    document = run_document(facts, "run-1").first()
    assert len(document["partitions"]) == 6 and document["totals"]["failed"] == 10
    assert run_document(facts, "nobody").count() == 0


def listing_with(names, next_href=None):
    rows = "".join(row_html(name, href=f"/{name}") for name in names)
    return rows + (f'<a class="further" href="{next_href}">n</a>' if next_href else "")


def test_crawl_from_the_first_page(spark, tmp_path):
    """Next pages, cycles, failures and two runs, all from the archive."""
    first, second = datetime(2026, 3, 1, 8), datetime(2026, 3, 2, 8)

    def answer(path, body, at, status=200, failure=None):
        return (f"https://example.com{path}", status, "text/html", None, "px", None if body is None else bytearray(body.encode()), failure, at)

    late = first.replace(hour=9)
    archive = [
        answer("/shelf?a=1&p=1", listing_with(["n1", "n2"], "?p=2&a=1"), late),
        answer("/shelf?a=1&p=2", "retry me", first.replace(hour=8, minute=1), 503),
        answer("/shelf?p=2&a=1", listing_with(["n3"], "?a=1&p=3"), late),
        answer("/shelf?a=1&p=3", listing_with(["n1", "n4"], "?p=1&a=1"), late),
        answer("/appeals?x", listing_with(["a1"], "/appeals?gone"), late),
        answer("/n1", "<p>old</p>", late), answer("/n2", None, late, 503), answer("/n2", "<p>2</p>", late.replace(minute=5)),
        answer("/n3", "<p>3</p>", late), answer("/n4", "<p>4</p>", late), answer("/a1", '<a class="document" href="/a1?q=">d</a>', late),
        answer("/a1?q=", "<p>a</p>", late),
        answer("/shelf?a=1&p=1", listing_with(["n1"]), second.replace(hour=9)), answer("/n1", "<p>new</p>", second.replace(hour=9)),
        answer("/n1", "<p>too early</p>", first.replace(hour=1)), answer("/appeals?x", None, second.replace(hour=9), None, "timeout"),
    ]
    archive = spark.createDataFrame(archive, FETCH)
    runs = spark.createDataFrame([("r1", first), ("r2", second)], "run_id string, started_at timestamp")
    day = date(2026, 3, 1)
    starts = spark.createDataFrame(
        [(run, section, day, n, url) for n, (run, section, url) in enumerate(
            (run, section, url) for run in ("r1", "r2")
            for section, url in (("rulings", "https://example.com/shelf?a=1&p=1"), ("appeals", "https://example.com/appeals?x")))],
        "run_id string, section_id string, partition_date date, start_no long, page_url string")
    found = replay_archive(starts, archive, dimension(spark, settings()), scraped_at=F.lit(second), runs=runs)
    pages = {(r["run_id"], r["section_id"], r["page_no"] % (1 << 18)): r for r in found.pages.collect()}
    assert sorted(pages) == [("r1", "appeals", 0), ("r1", "appeals", 1), ("r1", "rulings", 0), ("r1", "rulings", 1), ("r1", "rulings", 2),
                             ("r2", "appeals", 0), ("r2", "rulings", 0)]
    assert [pages["r1", "rulings", n]["found"] for n in range(3)] == [2, 1, 2]
    assert pages["r1", "appeals", 1]["fatal"] == "listing fetch failed: https://example.com/appeals?gone — no response"
    assert pages["r2", "appeals", 0]["fatal"] == "listing fetch failed: https://example.com/appeals?x — timeout"
    items = found.items.collect()
    assert len({r["seq"] for r in items}) == len(items) == 6
    got = {(r["run_id"], r["identifier"]): r for r in items}
    assert bytes(got["r1", "n1"]["content"]) == b"<p>old</p>" and bytes(got["r2", "n1"]["content"]) == b"<p>new</p>"
    assert got["r1", "n2"]["status"] == "stored" and got["r1", "n1"]["seq"] < got["r1", "n3"]["seq"] < got["r1", "n4"]["seq"]

    store = Store(spark, str(tmp_path))
    landed = land_batch(store, found.items, "b1")
    plan = spark.createDataFrame([(run, "rulings", day, "example", day, day) for run in ("r1", "r2", "r3")],
                                 "run_id string, section_id string, partition_date date, source_id string, window_start date, window_end date")
    facts = {(r["run_id"], r["section_id"]): r for r in attempts(
        found, landed, plan, started_at=F.lit(first), finished_at=F.lit(second)).collect()}
    counts = {key: (r["finish_reason"], r["found"], r["scraped"], r["failed"], r["skipped_unchanged"]) for key, r in facts.items()}
    assert counts == {("r1", "rulings"): ("finished", 5, 4, 0, 0), ("r2", "rulings"): ("finished", 1, 1, 0, 0), ("r3", "rulings"): ("finished", 0, 0, 0, 0),
                      ("r1", "appeals"): ("unplanned", 1, 1, 0, 0), ("r2", "appeals"): ("unplanned", 0, 0, 0, 0)}
    assert facts["r1", "appeals"]["fatal"] == "no such window in the plan: appeals 2026-03-01"


def test_reason_and_message_are_of_one_page(spark):
    day = date(2026, 1, 1)
    listings = spark.createDataFrame([
        (1, "r", "rulings", day, "https://example.com/shelf?1", row_html() + '<a class="further">broken</a>', None),
        (2, "r", "rulings", day, "https://example.com/shelf?2", "<p>nothing</p>", None),
        (1, "r", "appeals", day, "https://example.com/appeals?1", "<p>nothing</p>", None),
        (2, "r", "appeals", day, "https://example.com/appeals?2", row_html() + '<a class="further">broken</a>', None),
    ], LISTING)
    found = replay(listings, spark.createDataFrame([], FETCH), dimension(spark, settings()), scraped_at=F.lit(datetime(2026, 1, 2)))
    landed = spark.createDataFrame([], "run_id string, section_id string, partition_date date, scraped long, failed long, skipped_unchanged long")
    plan = spark.createDataFrame([("r", s, day, "example", day, day) for s in ("rulings", "appeals")],
                                 "run_id string, section_id string, partition_date date, source_id string, window_start date, window_end date")
    now = F.lit(datetime(2026, 1, 3))
    got = {r["section_id"]: (r["finish_reason"], r["fatal"]) for r in attempts(found, landed, plan, started_at=now, finished_at=now).collect()}
    assert got["rulings"] == ("listing_failed", "next_page '.further' matched no href at https://example.com/shelf?1")
    assert got["appeals"][0] == "zero_match" and "matched 0 rows" in got["appeals"][1]


def test_settings_are_checked():
    good = settings()
    assert [s["section_id"] for s in sections_of_source(good, "example")] == ["appeals", "rulings"]
    assert good.sections["rulings"]["partition_days"] == 30
    with pytest.raises(ConfigError, match="unknown source"):
        sections_of_source(good, "nobody")
    for bad in ({"partition_days": 0}, {"extra": 1}, {"selectors": {**SELECTORS, "title": "h2 > a"}},
                {"selectors": {k: v for k, v in SELECTORS.items() if k != "title"}}, {"selectors": {**SELECTORS, "odd": "a"}}):
        with pytest.raises(ConfigError):
            settings(**bad)


def many(spark):
    rows = []
    for seq in range(120):
        failed = seq % 7 == 3
        rows.append(item(seq, f"id{seq % 5}", None if failed else f"<p>{seq % 11}</p>".encode(),
                         status="failed" if failed else "stored", doc_type="unknown" if failed else "html"))
    return rows


def test_streams_equal_the_batch(spark, tmp_path):
    rows = many(spark)
    for n in range(4):
        items(spark, rows[n * 30:(n + 1) * 30]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    whole = Store(spark, str(tmp_path / "batch"))
    land_batch(whole, items(spark, rows), "b")
    columns = ["identifier", "version", "status", "file_hash"]
    expected = sorted(map(str, whole.read("landing_documents").select(*columns).collect()))

    def stream():
        return spark.readStream.schema(ITEM).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    store = Store(spark, str(tmp_path / "stream"))
    drain(land_stream(stream(), store, str(tmp_path / "c1")))
    assert sorted(map(str, store.read("landing_documents").select(*columns).collect())) == expected
    assert store.read("landing_documents").select("ingest_batch").distinct().count() == 4

    drain(version_stream(with_stable_content(stream()), str(tmp_path / "versions"), str(tmp_path / "c2")))
    got = spark.read.parquet(str(tmp_path / "versions")).select(*columns)
    assert sorted(map(str, got.collect())) == expected


@pytest.mark.parametrize("keep_for", [None, 1])
def test_change_detector_over_restarts(spark, tmp_path, keep_for):
    """History first, then four micro-batches with a restart before each; forgetting contents changes nothing."""
    rows = many(spark)
    whole = Store(spark, str(tmp_path / "batch"))
    land_batch(whole, items(spark, rows[:30]), "b0")
    history = whole.read("landing_documents").select("identifier", "file_hash", "status", "version", "scraped_at")
    history.write.parquet(str(tmp_path / "history"))
    history = spark.read.parquet(str(tmp_path / "history"))
    land_batch(whole, items(spark, rows[30:]), "b1")
    columns = ["identifier", "version", "status", "file_hash"]
    expected = sorted(map(str, whole.read("landing_documents").where("ingest_batch = 'b1'").select(*columns).collect()))
    out = str(tmp_path / "versions")
    for hour, part in enumerate((rows[30:50], rows[50:80], rows[80:81], rows[81:])):
        at = F.lit("2026-01-02").cast("timestamp") + F.make_interval(hours=F.lit(hour))
        items(spark, part).withColumn("scraped_at", at).write.mode("append").parquet(str(tmp_path / "in"))
        arriving = spark.readStream.schema(ITEM).parquet(str(tmp_path / "in"))
        drain(version_stream(with_stable_content(arriving), out, str(tmp_path / "c"), history=history, keep_for=keep_for))
    got = spark.read.parquet(out).where("ingest_batch >= 0")
    assert sorted(map(str, got.select(*columns).collect())) == expected
    # timers run in batches without new rows
    assert spark.read.parquet(out).where("ingest_batch >= 0").select("ingest_batch").distinct().count() >= 3
