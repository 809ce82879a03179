"""Replay a crawl from an archive: listing pages and fetched documents to items.

Where a crawler works through one listing page after another, this takes all
pages of all sections and windows at once; the follow-up of a link is a join
with the archive on the URL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.urls import request_identity
from paperloom.operators.answers import answers_of_runs
from paperloom.operators.extract import (
    document_links, failed_rows, fetch_outcome, final_type, listing_rows, make_error, next_pages, not_requested,
    page_outcomes, unique_requests, with_row_fields, with_rows, with_sections,
)
from paperloom.operators.runs import fatal_message, seconds_between
from paperloom.plans.frontier import DEEPEST, follow
from paperloom.schemas import ITEM
from paperloom.session import materialise

# Arrival order: page, then row on the page. A page with more rows is refused.
ROWS_PER_PAGE = 1 << 20
KEYS = ["run_id", "section_id", "partition_date"]


@dataclass
class Crawl:
    """What a replay finds: items to land, skips, page findings."""

    items: DataFrame
    skipped: DataFrame
    pages: DataFrame


def _item_columns(rows: DataFrame) -> DataFrame:
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ITEM
    ])


def _with_fetch(requests: DataFrame, url: str, answers: DataFrame) -> DataFrame:
    """Requests with the answer that their run got; an absent one is a failure."""
    keys = [c for c in ("run_id",) if c in answers.columns] + ["identity"]
    given = answers.select(*keys, F.struct("status", "content_type", "etag", "body", "failure", "proxy").alias("answer"))
    joined = requests.withColumn("identity", request_identity(F.col(url))).join(given, keys, "left").drop("identity")
    return joined.withColumn("outcome", fetch_outcome(F.col("answer.status"), F.col("answer.failure")))


def _reason(status: Column, failure: Column) -> Column:
    return F.coalesce(failure, F.concat(F.lit("HTTP status "), status.cast("string")), F.lit("no response"))


def _download_failures(rows: DataFrame, url: str) -> DataFrame:
    """Failed answers as failed items, with the status where there was one."""
    status = F.col("answer.status")
    reason = _reason(status, F.col("answer.failure"))
    return rows.where(F.col("outcome") == "failed").withColumns({
        "error": make_error("download", reason, F.col(url), status),
        "doc_link": F.col(url),
        "doc_type": F.lit("unknown"),
        "status": F.lit("failed"),
        "source_url": F.col("detail_link"),
        "proxy": F.col("answer.proxy"),
    })


def fetch_listings(starts: DataFrame, archive: DataFrame, sections: DataFrame, *, runs: DataFrame | None = None,
                   shared: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Listing pages from the archive, next pages included, and those that could not be had.

    ``starts``: run_id, section_id, partition_date, start_no (unique, below
    2^25), page_url. Pages are numbered by their start and how far they are
    from it.
    """
    # Read for the links and again for the pages; the archive is sorted once.
    answers = materialise(answers_of_runs(archive, runs), "answers")
    pages = follow(starts, answers, sections, shared)
    numbered = pages.withColumn("page_no", F.col("start_no") * F.lit(DEEPEST) + F.col("depth")).drop("start_no", "depth")
    fetched = materialise(_with_fetch(numbered, "page_url", answers), "listings")
    good = F.col("outcome") == "stored"
    listings = fetched.where(good).select("page_no", *KEYS, "page_url", F.make_valid_utf8(F.col("answer.body").cast("string")).alias("html"),
                                          F.col("answer.proxy").alias("proxy"))
    message = F.concat(F.lit("listing fetch failed: "), F.col("page_url"), F.lit(" — "), _reason(F.col("answer.status"), F.col("answer.failure")))
    lost = fetched.where(~good).join(sections.select("section_id", "source_id"), "section_id").select(
        *KEYS, "source_id", "page_no", "page_url", F.lit(0).cast("long").alias("found"), F.lit("listing_failed").alias("outcome"),
        message.alias("fatal"), F.lit(None).cast("string").alias("next_page_url"), F.lit(None).cast("string").alias("next_page_error"))
    return listings, lost


def replay_archive(starts: DataFrame, archive: DataFrame, sections: DataFrame, *, scraped_at: Column,
                   runs: DataFrame | None = None, shared: dict | None = None) -> Crawl:
    """A crawl from the first listing URL of each window; everything else comes from the archive."""
    listings, lost = fetch_listings(starts, archive, sections, runs=runs, shared=shared)
    found = replay(listings, archive, sections, scraped_at=scraped_at, runs=runs, shared=shared)
    return Crawl(found.items, found.skipped, found.pages.unionByName(lost))


def replay(listings: DataFrame, archive: DataFrame, sections: DataFrame, *, scraped_at: Column,
           runs: DataFrame | None = None, shared: dict | None = None) -> Crawl:
    """``listings``: page_no, section_id, partition_date, run_id, page_url, html, proxy.

    ``runs`` (run_id, started_at) says which answers of the archive belong to
    which run; without it the archive is that of one run. ``shared`` are the
    selectors where all sections have the same ones (``config.shared_selectors``).
    """
    archive = answers_of_runs(archive, runs)
    # Pages are parsed once; their findings, without the HTML, are kept.
    paged = with_row_fields(page_outcomes(with_rows(with_sections(listings, sections), shared), shared), shared)
    pages = materialise(next_pages(paged, shared).drop("html", "rows"), "listing")
    # The settings column gives way to the item column of the same name.
    pages = pages.withColumnRenamed("doc_link", "doc_link_rule")
    rows = listing_rows(pages, ["page_no", "run_id", "source_id", "section_id", "partition_date", "proxy",
                                "doc_link_sel", "doc_link_rule"])
    too_many = F.raise_error(F.concat(F.lit("more rows than ROWS_PER_PAGE on page "), F.col("page_no").cast("string")))
    rows = rows.withColumn("seq", F.when(F.col("row_no") < ROWS_PER_PAGE, F.col("page_no") * F.lit(ROWS_PER_PAGE) + F.col("row_no"))
                           .otherwise(too_many.cast("long")))

    good = rows.where(F.col("error_reason").isNull())
    once = unique_requests(good, KEYS, "detail_link", "seq")
    answers = _with_fetch(once, "detail_link", archive)
    located = document_links(
        answers.withColumn("page_url", F.col("detail_link"))
        .withColumn("html", F.when(F.col("outcome") == "stored", F.make_valid_utf8(F.col("answer.body").cast("string"))))
        .withColumn("doc_link", F.col("doc_link_rule"))
    )
    # The archive is joined once; what follows reads the outcome. Bytes of a
    # detail page are kept only where it is the document itself.
    is_document = (F.col("outcome") == "stored") & (F.col("document_url") == F.col("page_url"))
    details = materialise(
        located.withColumn("answer", F.col("answer").withField("body", F.when(is_document, F.col("answer.body"))))
        .drop("html", "doc_link_sel"), "details")
    located = details.where(F.col("outcome") == "stored")
    bad_detail = located.where(F.col("detail_error").isNotNull()).withColumns({
        "error": make_error("detail", F.col("detail_error"), F.col("page_url")),
        "doc_type": F.lit("unknown"),
        "status": F.lit("failed"),
        "source_url": F.col("detail_link"),
        "proxy": F.col("answer.proxy"),
    }).withColumn("doc_link", F.col("page_url"))

    def stored(found: DataFrame) -> DataFrame:
        return found.withColumns({
            "doc_type": final_type(F.col("document_type"), F.col("document_url"), F.col("answer.content_type")),
            "doc_link": F.col("document_url"),
            "source_url": F.col("detail_link"),
            "content": F.col("answer.body"),
            "etag": F.col("answer.etag"),
            "proxy": F.col("answer.proxy"),
            "status": F.lit("stored"),
        })

    whole = located.where(F.col("detail_error").isNull())
    own = stored(whole.where(F.col("document_url") == F.col("page_url")))
    links = whole.where(F.col("document_url") != F.col("page_url")).drop("answer", "outcome")
    links = not_requested(unique_requests(links, KEYS, "document_url", "seq"), details, KEYS, "document_url", "detail_link")
    linked = materialise(_with_fetch(links, "document_url", archive), "linked")
    parts = [
        failed_rows(rows), _download_failures(details, "detail_link"), bad_detail, own,
        stored(linked.where(F.col("outcome") == "stored")), _download_failures(linked, "document_url"),
    ]
    items = None
    for part in parts:
        part = _item_columns(part.withColumn("scraped_at", scraped_at))
        items = part if items is None else items.unionByName(part)
    keys = KEYS
    skipped = details.where(F.col("outcome") == "skipped").select(*keys).unionByName(
        linked.where(F.col("outcome") == "skipped").select(*keys)
    )
    findings = pages.select(*keys, "source_id", "page_no", "page_url", "found", "outcome", "fatal",
                            "next_page_url", "next_page_error")
    return Crawl(items, skipped, findings)


def attempts(crawl: Crawl, landed: DataFrame, plan: DataFrame, *, started_at: Column, finished_at: Column) -> DataFrame:
    """One attempt row per planned window; windows without pages get zeros.

    A window ends with its first page that has no rows (``zero_match``), could
    not be fetched, or has an unclear next link (``listing_failed``); reason and
    message are of the same page. Windows that were crawled but not planned are
    reported as ``unplanned``, with their start as both bounds.
    """
    problem = F.struct(
        "page_no",
        F.when(F.col("outcome") == "zero_match", "zero_match").otherwise("listing_failed").alias("reason"),
        F.coalesce("fatal", "next_page_error").alias("message"),
    )
    pages = crawl.pages.groupBy(*KEYS).agg(
        F.sum("found").alias("found"), F.first("source_id", ignorenulls=True).alias("page_source"),
        F.min(F.when(F.coalesce("fatal", "next_page_error").isNotNull(), problem)).alias("problem"))
    unchanged = crawl.skipped.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("not_modified"))
    zero = F.lit(0).cast("bigint")
    joined = (
        plan.withColumn("_planned", F.lit(True)).join(pages, KEYS, "full_outer").join(unchanged, KEYS, "left")
        .join(landed, KEYS, "left")
    )
    lost = F.concat(F.lit("no such window in the plan: "), F.col("section_id"), F.lit(" "), F.col("partition_date").cast("string"))
    reason = F.when(F.col("_planned").isNull(), "unplanned").otherwise(F.coalesce("problem.reason", F.lit("finished")))
    message = F.when(F.col("_planned").isNull(), lost).otherwise(F.col("problem.message"))
    return joined.select(
        *KEYS, F.coalesce("source_id", "page_source").alias("source_id"),
        F.coalesce("window_start", "partition_date").alias("window_start"), F.coalesce("window_end", "partition_date").alias("window_end"),
        reason.alias("finish_reason"), fatal_message(reason, message).alias("fatal"),
        started_at.alias("started_at"), finished_at.alias("finished_at"),
        seconds_between(started_at, finished_at).alias("duration_seconds"),
        F.coalesce("found", zero).alias("found"), F.coalesce("scraped", zero).alias("scraped"),
        F.coalesce("failed", zero).alias("failed"),
        (F.coalesce("skipped_unchanged", zero) + F.coalesce("not_modified", zero)).alias("skipped_unchanged"),
        finished_at.alias("recorded_at"),
    )
