"""Follow the next links of listing pages through an archive.

A page has at most one next page, so the links form a table from URL to URL.
Pages reached are found by doubling: what is known of the first 2^k pages of
every listing is joined with the table of 2^k steps, new ones are added, and the
table is joined with itself. A listing of a million pages takes twenty rounds,
a cycle ends where it brings nothing new. Only URLs are moved; each archived
page is parsed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.urls import request_identity
from paperloom.operators.extract import next_pages
from paperloom.operators.keyed import first_per_key
from paperloom.operators.once import with_computed
from paperloom.session import materialise

PARTITION = ["run_id", "section_id", "partition_date"]
# Pages of one listing; a longer one is refused.
DEEPEST = 1 << 18


def next_links(answers: DataFrame, sections: DataFrame, shared: dict | None = None) -> DataFrame:
    """(keys of the answers, selector, identity, next_url) of every HTML answer with exactly one next link."""
    keys = [c for c in ("run_id",) if c in answers.columns]
    html = F.make_valid_utf8(F.col("body").cast("string"))
    fetched = answers.where(F.col("failure").isNull() & F.col("status").between(200, 299) & F.col("body").isNotNull())
    pages = fetched.select(*keys, "identity", F.col("url").alias("page_url"), html.alias("html"))
    if shared:
        pages = pages.withColumn("next_page", F.lit(shared["next_page"]))
    else:
        # selectors are settings: one array for all pages
        selectors = sections.select("next_page", "next_page_sel").distinct().agg(F.collect_list(F.struct("next_page", "next_page_sel")).alias("s"))
        pages = pages.withColumn("_all", selectors.scalar()).select(*keys, "identity", "page_url", "html", F.inline("_all"))
    found = with_computed(next_pages(pages, shared), to_url=F.col("next_page_url")).where(F.col("to_url").isNotNull())
    return found.select(*keys, "next_page", "identity", "to_url", request_identity(F.col("to_url")).alias("to"))


def follow(starts: DataFrame, answers: DataFrame, sections: DataFrame, shared: dict | None = None) -> DataFrame:
    """Every listing page that a partition run comes to: the keys of ``starts``, page_url and depth.

    ``starts``: run_id, section_id, partition_date, start_no, page_url. A URL
    counts once per partition run, with its least depth, whether it was
    archived or not.
    """
    keys = [c for c in ("run_id",) if c in answers.columns]
    jump = materialise(next_links(answers, sections, shared), "links")
    settings = sections.select("section_id", F.lit(shared["next_page"]).alias("next_page") if shared else F.col("next_page"))
    first = starts.select(*PARTITION, "start_no", "page_url", F.lit(0).cast("long").alias("depth"),
                          request_identity(F.col("page_url")).alias("identity")).join(settings, "section_id")
    own = [*PARTITION, "identity"]
    known = materialise(first_per_key(first, own, "start_no"), "pages")
    step = 1
    while True:
        ahead = known.join(jump, [*keys, "next_page", "identity"]).select(
            *PARTITION, "start_no", F.col("to_url").alias("page_url"), (F.col("depth") + step).alias("depth"), F.col("to").alias("identity"), "next_page")
        new = materialise(first_per_key(ahead, own, "start_no", "depth").join(known.select(*own), own, "left_anti"), "pages")
        if new.isEmpty():
            break
        known = materialise(known.unionByName(new.select(*known.columns)), "pages")
        after = jump.select(*keys, "next_page", F.col("identity").alias("to"), F.col("to_url").alias("_url"), F.col("to").alias("_to"))
        jump = materialise(jump.join(after, [*keys, "next_page", "to"]).select(
            *keys, "next_page", "identity", F.col("_url").alias("to_url"), F.col("_to").alias("to")), "links")
        step *= 2
    deep = F.raise_error(F.concat(F.lit("more than "), F.lit(DEEPEST), F.lit(" pages from "), F.col("page_url"))).cast("long")
    return known.select(*PARTITION, "start_no", "page_url", F.when(F.col("depth") < DEEPEST, F.col("depth")).otherwise(deep).alias("depth"))
