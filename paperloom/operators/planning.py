"""Date windows: planning, assignment, listing requests, coverage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.config import ConfigError
from paperloom.functions.urls import QUERY_SAFE, percent_encoded, quote, with_query

# Days of one join key of a date look-up.
STRETCH = 32


def check_range(start: date, end: date) -> None:
    if end < start:
        raise ConfigError(f"end {end} before start {start}")


def build_windows(sections: DataFrame, start: Column, end: Column, days: Column) -> DataFrame:
    """Consecutive inclusive windows of ``days`` days, the last one cut at ``end``.

    A window is named by its first day. A range that ends before it starts, or
    a size below one day, fails the job.
    """
    bad_range = F.concat(F.lit("end "), end.cast("string"), F.lit(" before start "), start.cast("string"))
    bad_size = F.concat(F.lit("days must be >= 1, got "), days.cast("string"))
    # The checks sit in the value itself, so no optimisation can skip them.
    checked = F.when(end < start, F.raise_error(bad_range)).when(days < 1, F.raise_error(bad_size)).otherwise(start)
    starts = F.sequence(checked, end, F.make_dt_interval(days))
    windows = sections.withColumn("_days", days).withColumn("_end", end).withColumn(
        "partition_date", F.explode(starts)
    )
    last = F.least(F.date_add(F.col("partition_date"), F.col("_days") - 1), F.col("_end"))
    return windows.withColumn("window_start", F.col("partition_date")).withColumn("window_end", last).drop("_days", "_end")


def plan_run(sections: DataFrame, start: date, end: date, run_id: str) -> DataFrame:
    """All windows of all sections in one projection, each with its own size."""
    missing = [name for name, value in [("start_date", start), ("end_date", end), ("run_id", run_id)] if not value]
    if missing:
        raise ConfigError("missing required parameters: " + ", ".join(missing))
    check_range(start, end)
    windows = build_windows(sections, F.lit(start), F.lit(end), F.col("partition_days"))
    return windows.select("source_id", "section_id", "partition_date", "window_start", "window_end",
                          F.lit(run_id).alias("run_id"))


def window_of(day: Column, anchor: Column, days: Column) -> Column:
    """First day of the window a date lies in, counted from ``anchor``."""
    # Whole windows passed; pmod keeps dates before the anchor right as well.
    return F.date_sub(day, F.pmod(F.datediff(day, anchor), days))


def assign_windows(records: DataFrame, plan: DataFrame, day: str) -> DataFrame:
    """Records inside a planned window, with that window, found by joining.

    Any plan is fine, also one that no arithmetic describes. A window is spread
    to one row for each stretch of ``STRETCH`` days that it touches, so a record
    meets the few windows of its section and stretch only. The time of day is
    ignored, and a window that ends before it starts holds nothing.
    """
    def stretch(of: Column) -> Column:
        return F.floor(F.unix_date(of) / STRETCH)

    narrow = plan.select(F.col("section_id").alias("_section"), "partition_date", "window_start", "window_end")
    touched = narrow.where("window_start <= window_end").withColumn(
        "_stretch", F.explode(F.sequence(stretch(F.col("window_start")), stretch(F.col("window_end")))))
    date_of = F.col(day).cast("date")
    inside = (F.col("section_id") == F.col("_section")) & (stretch(date_of) == F.col("_stretch"))
    return records.join(touched, inside & date_of.between(F.col("window_start"), F.col("window_end"))).drop("_section", "_stretch")


def request_bounds(start: Column, end: Column, start_inclusive: Column, end_inclusive: Column) -> tuple[Column, Column]:
    """A window as the source wants it: an exclusive bound moves out by a day."""
    return (
        F.when(start_inclusive, start).otherwise(F.date_sub(start, 1)),
        F.when(end_inclusive, end).otherwise(F.date_add(end, 1)),
    )


# Private characters that stand for the values of a listing URL in its template.
_START, _END, _PAGE = "\ue000", "\ue001", "\ue002"


def with_listing_template(sections: DataFrame) -> DataFrame:
    """Sections with their listing URL, its three values left open.

    Taking a URL apart is done once per section, not once per window.
    """
    return sections.withColumn("listing_template", with_query(F.col("url"), [
        (F.col("date_from"), F.lit(_START)), (F.col("date_to"), F.lit(_END)), (F.col("page_param"), F.lit(_PAGE)),
    ]))


def listing_requests(plan: DataFrame, page: Column | None = None) -> DataFrame:
    """Listing URL per planned window. ``plan`` carries the template and source fields."""
    start, end = request_bounds(F.col("window_start"), F.col("window_end"),
                                F.col("start_inclusive"), F.col("end_inclusive"))
    number = (page if page is not None else F.lit(1)).cast("string")

    def shown(day: Column) -> Column:
        return quote(F.call_function("date_format", day, F.col("date_show")), QUERY_SAFE)

    url = F.col("listing_template")
    for mark, value in ((_START, shown(start)), (_END, shown(end)), (_PAGE, number)):
        url = F.replace(url, F.lit(percent_encoded(mark)), value)
    return plan.withColumn("listing_url", url).drop("listing_template")


def coverage(windows: DataFrame, keys: list[str]) -> DataFrame:
    """Windows that leave a gap to, or overlap, the one before them.

    The windows of one section are as few as the days they cover.
    """
    order = Window.partitionBy(*keys).orderBy("window_start", "window_end")
    previous = F.lag("window_end").over(order)
    return (
        windows.withColumn("previous_end", previous)
        .withColumn("gap_days", F.datediff("window_start", "previous_end") - 1)
        .where(F.col("gap_days") != 0)
        .withColumn("finding", F.when(F.col("gap_days") > 0, "gap").otherwise("overlap"))
    )
