"""Listing pages to records, failed rows and follow-up requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.dates import read_day
from paperloom.functions.formats import document_type
from paperloom.functions.html import (
    Selector, attribute, clean_texts, has_match, joined, select_all, select_first, select_first_text, select_outer,
    select_text,
)
from paperloom.functions.text import collapse_blanks, let, strip
from paperloom.functions.urls import link_target, request_identity
from paperloom.operators.keyed import first_per_key
from paperloom.operators.once import with_computed
from paperloom.operators.sides import broadcast_if_small

SNIPPET_LENGTH = 300
UNKNOWN_ID_DIGITS = 16


def quoted(text: Column) -> Column:
    """A value in quotes, as error messages show it."""
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    double = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    return F.when(double, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.concat(F.lit("'"), escaped, F.lit("'")))


# Selectors may be given once for all pages, or come with each page from its
# section. Given ones make constant patterns and far smaller plans.
Shared = dict | None


def _selector(name: str, shared: Shared) -> Selector:
    return Selector.of(shared[name]) if shared else Selector.column(F.col(f"{name}_sel"))


def _first_text(row: Column, shared: Shared) -> Column:
    """Text of the first identifier selector that has any, or null."""
    if not shared:
        return select_first_text(row, F.col("identifier_sel"))
    return F.coalesce(*[F.nullif(select_text(row, one), F.lit("")) for one in shared["identifier"]])


def with_sections(pages: DataFrame, sections: DataFrame) -> DataFrame:
    """Pages with the settings of their section; a section without settings is an error, not a lost page."""
    unknown = F.raise_error(F.concat(F.lit("unknown section "), quoted(F.col("section_id"))))
    joined = pages.join(broadcast_if_small(sections.withColumn("_known", F.lit(True))), "section_id", "left")
    return joined.withColumn("source_id", F.when(F.col("_known"), F.col("source_id")).otherwise(unknown.cast("string"))).drop("_known")


def with_rows(pages: DataFrame, shared: Shared = None) -> DataFrame:
    """Pages (html, page_url, section fields) with their listing rows."""
    return pages.withColumn("rows", select_all(F.col("html"), _selector("listing_row", shared)))


def page_outcomes(paged: DataFrame, shared: Shared = None) -> DataFrame:
    """``ok`` with rows, ``empty`` when the page says so, else ``zero_match``."""
    if shared:
        says_empty = has_match(F.col("html"), shared["empty_result"]) if shared["empty_result"] else F.lit(False)
    else:
        says_empty = F.col("empty_result_sel").isNotNull() & has_match(F.col("html"), _selector("empty_result", None))
    outcome = F.when(F.size("rows") > 0, "ok").when(says_empty, "empty").otherwise("zero_match")
    fatal = F.concat(F.lit("listing: listing_row "), quoted(F.col("listing_row")),
                     F.lit(" matched 0 rows at "), F.col("page_url"))
    return (
        paged.withColumn("found", F.size("rows").cast("bigint"))
        .withColumn("outcome", outcome)
        .withColumn("fatal", F.when(F.col("outcome") == "zero_match", fatal))
    )


def next_pages(pages: DataFrame, shared: Shared = None) -> DataFrame:
    """The next page's URL; null on the last page; ambiguity makes the page fatal."""
    found = let(select_all(F.col("html"), _selector("next_page", shared)), lambda links: F.struct(
        F.size(links).alias("count"), attribute(F.get(links, F.lit(0)), "href").alias("href")))
    links = with_computed(pages, _next=found)
    count, href = F.col("_next.count"), F.col("_next.href")
    where = F.concat(F.lit(" at "), F.col("page_url"))
    name = F.concat(F.lit("next_page "), quoted(F.col("next_page")))
    problem = (
        F.when(count > 1, F.concat(name, F.lit(" matched "), count.cast("string"), F.lit(" elements"), where))
        .when((count == 1) & (href == ""), F.concat(name, F.lit(" matched no href"), where))
    )
    target = F.when((count == 1) & (href != ""), link_target(F.col("page_url"), href))
    return links.withColumn("next_page_error", problem).withColumn("next_page_url", target).drop("_next")


def with_row_fields(paged: DataFrame, shared: Shared = None) -> DataFrame:
    """Pages with ``fields``: the raw field values of each of their rows.

    Fields are taken while rows are still in their page's array, so that a
    filter on the outcome cannot repeat the work.
    """
    def found(row: Column, name: str) -> Column:
        return joined(select_outer(row, _selector(name, shared)))

    def fields(row: Column) -> Column:
        return let(select_all(row, _selector("detail_link", shared)), lambda links: F.struct(
            row.alias("row_html"),
            _first_text(row, shared).alias("identifier_text"),
            F.size(links).alias("links"),
            attribute(F.get(links, F.lit(0)), "href").alias("href"),
            clean_texts(found(row, "title"), found(row, "description"), found(row, "published_date")).alias("texts"),
        ))

    return paged.withColumn("fields", F.transform("rows", fields))


# The settings that error messages quote.
MESSAGE_SETTINGS = ["date_parse", "identifier", "title", "description", "published_date", "detail_link"]


def row_fields(paged: DataFrame, keep: list[str]) -> DataFrame:
    """One row per listing row of pages with ``fields``."""
    # The outer form: the plain one makes the planner filter on the array size
    # first, and so cut every page twice.
    exploded = F.posexplode_outer("fields").alias("row_no", "row")
    rows = paged.select(*keep, "page_url", *MESSAGE_SETTINGS, exploded).where(F.col("row_no").isNotNull())
    title, description, date_text = (F.get("row.texts", F.lit(n)) for n in (0, 1, 2))
    day = read_day(strip(date_text), F.col("date_parse"))
    return rows.select(
        *keep, "page_url", *MESSAGE_SETTINGS, "row_no", "row.row_html", "row.identifier_text", "row.links", "row.href",
        title.alias("title_text"), description.alias("description_text"), date_text.alias("date_text"), day.alias("day"),
    )


def _list_text(names: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(names, quoted), ", "), F.lit("]"))


def error_reason() -> Column:
    """The first broken requirement of a listing row, or null."""
    tail = F.concat(F.lit(" for "), quoted(F.col("identifier_text")), F.lit(" at "), F.col("page_url"))

    def lacks(name: str, what: str) -> Column:
        return F.concat(F.lit(f"{name} "), quoted(F.col(name)), F.lit(f" matched {what}"), tail)

    several = F.concat(F.lit("detail_link "), quoted(F.col("detail_link")), F.lit(" matched "),
                       F.col("links").cast("string"), F.lit(" elements"), tail)
    bad_date = F.concat(F.lit("published_date "), quoted(F.col("published_date")), F.lit(" matched invalid date "),
                        quoted(F.col("date_text")), tail)
    no_name = F.concat(F.lit("identifier selectors "), _list_text(F.col("identifier")),
                       F.lit(" matched no text at "), F.col("page_url"))
    return (
        F.when(F.col("identifier_text").isNull(), no_name)
        .when(F.col("links") > 1, several)
        .when(F.coalesce(F.col("href"), F.lit("")) == "", lacks("detail_link", "no href"))
        .when(F.col("title_text") == "", lacks("title", "no text"))
        .when(F.col("description_text") == "", lacks("description", "no text"))
        .when(F.col("date_text") == "", lacks("published_date", "no text"))
        .when(F.col("day").isNull(), bad_date)
    )


def listing_rows(paged: DataFrame, keep: list[str]) -> DataFrame:
    """Every listing row, good or bad; ``error_reason`` is null on good ones."""
    snippet = F.substring(collapse_blanks(F.col("row_html")), 1, SNIPPET_LENGTH)
    return (
        row_fields(paged, keep)
        .withColumn("error_reason", error_reason())
        .withColumn("snippet", F.when(F.col("error_reason").isNotNull(), snippet))
        .select(
            *keep, "page_url", "row_no",
            F.when(F.col("error_reason").isNull(), F.col("identifier_text")).alias("identifier"),
            F.when(F.col("error_reason").isNull(), F.col("title_text")).alias("title"),
            F.when(F.col("error_reason").isNull(), F.col("description_text")).alias("description"),
            F.when(F.col("error_reason").isNull(), F.col("day")).alias("published_date"),
            F.when(F.col("error_reason").isNull(), link_target(F.col("page_url"), F.col("href"))).alias("detail_link"),
            "error_reason", "snippet",
        )
    )


def unknown_identifier(snippet: Column) -> Column:
    digest = F.sha2(F.encode(snippet, "UTF-8"), 256)
    return F.concat(F.lit("unknown:"), F.substring(digest, 1, UNKNOWN_ID_DIGITS))


def make_error(stage: Column | str, reason: Column, url: Column, status_code: Column | None = None) -> Column:
    name = F.lit(stage) if isinstance(stage, str) else stage
    code = status_code if status_code is not None else F.lit(None)
    return F.struct(name.alias("stage"), reason.alias("reason"), url.alias("url"), code.cast("int").alias("status_code"))


def failed_rows(rows: DataFrame) -> DataFrame:
    """Bad listing rows as failed items; the page goes on without them."""
    bad = rows.where(F.col("error_reason").isNotNull())
    return (
        bad.withColumn("identifier", unknown_identifier(F.col("snippet")))
        .withColumn("error", make_error("listing_record", F.col("error_reason"), F.col("page_url")))
        .withColumn("title", F.lit(""))
        .withColumn("description", F.lit(""))
        .withColumn("published_date", F.lit(None).cast("date"))
        .withColumn("source_url", F.col("page_url"))
        .withColumn("doc_link", F.col("page_url"))
        .withColumn("doc_type", F.lit("unknown"))
        .withColumn("status", F.lit("failed"))
    )


def unique_requests(requests: DataFrame, partition: list[str], url: str, order: str) -> DataFrame:
    """Each request once per partition run: the first wins, however its parameters are ordered."""
    known = requests.withColumn("_identity", request_identity(F.col(url)))
    return first_per_key(known, [*partition, "_identity"], order).drop("_identity")


def not_requested(requests: DataFrame, earlier: DataFrame, partition: list[str], url: str, earlier_url: str) -> DataFrame:
    """Requests whose identity is not among the earlier ones of their partition run."""
    seen = earlier.select(*partition, request_identity(F.col(earlier_url)).alias("_identity")).distinct()
    known = requests.withColumn("_identity", request_identity(F.col(url)))
    return known.join(seen, [*partition, "_identity"], "left_anti").drop("_identity")


def allowed_requests(requests: DataFrame, rules: DataFrame, url: str) -> DataFrame:
    """Requests whose path starts with no disallowed prefix of their source.

    ``rules`` has one row per source with all its prefixes in ``disallow``, as
    a robots file does, so this is a join on the source and no comparison of
    every request with every rule of every source.
    """
    path = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    blocked = F.exists(F.coalesce(F.col("disallow"), F.array().cast("array<string>")),
                       lambda prefix: F.startswith(F.when(path == "", F.lit("/")).otherwise(path), prefix))
    return requests.join(broadcast_if_small(rules), "source_id", "left").where(~blocked).drop("disallow")


def document_links(details: DataFrame) -> DataFrame:
    """Where the document of a detail page is, and its type as far as the URL tells.

    Without a ``doc_link`` selector the detail page is the document, and html.
    """
    own = F.col("doc_link_sel").isNull()
    first = select_first(F.col("html"), _selector("doc_link", None))
    links = with_computed(details, _href=F.when(~own, attribute(first, "href")))
    missing = ~own & (F.coalesce(F.col("_href"), F.lit("")) == "")
    problem = F.concat(F.lit("doc_link "), quoted(F.col("doc_link")), F.lit(" matched no href at "), F.col("page_url"))
    links = (
        links.withColumn("detail_error", F.when(missing, problem))
        .withColumn("document_url", F.when(own, F.col("page_url")).when(~missing, link_target(F.col("page_url"), F.col("_href"))))
    )
    return links.withColumn(
        "document_type", F.when(own, F.lit("html")).otherwise(document_type(F.col("document_url")))
    ).drop("_href")


def final_type(known: Column, url: Column, content_type: Column) -> Column:
    """Type of a fetched document: as known, from its URL or header, else ``bin``."""
    return F.coalesce(known, document_type(url, content_type), F.lit("bin"))


def fetch_outcome(status: Column, failure: Column) -> Column:
    """``stored``, ``skipped`` for an unchanged answer, ``failed`` for the rest."""
    return (
        F.when(status == 304, F.lit("skipped"))
        .when(failure.isNotNull() | status.isNull() | ~status.between(200, 299), F.lit("failed"))
        .otherwise(F.lit("stored"))
    )


def retryable(status: Column, codes: Column) -> Column:
    return F.coalesce(F.array_contains(codes, status), F.lit(False))


def unified_items(rows: DataFrame) -> DataFrame:
    """Good and bad listing rows as items in one pass over the rows.

    Good rows wait for their document; bad ones are failed items already.
    """
    bad = F.col("error_reason").isNotNull()

    def either(failed: Column, good: str) -> Column:
        return F.when(bad, failed).otherwise(F.col(good))

    return rows.withColumns({
        "identifier": either(unknown_identifier(F.col("snippet")), "identifier"),
        "title": either(F.lit(""), "title"),
        "description": either(F.lit(""), "description"),
        "source_url": either(F.col("page_url"), "detail_link"),
        "status": F.when(bad, "failed").otherwise("stored"),
        "error": F.when(bad, make_error("listing_record", F.col("error_reason"), F.col("page_url"))),
    })


def found_counts(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Rows found per partition, good and bad, before any de-duplication.

    ``pages`` are those of ``page_outcomes``: the rows are counted, not read.
    """
    return pages.groupBy(*keys).agg(F.sum("found").cast("long").alias("found"))
