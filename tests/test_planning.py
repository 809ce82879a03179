from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from paperloom.config import ConfigError
from paperloom.operators import planning as P


def test_windows_tile_the_range(spark):
    cases = [(f"s{n}", date(2024, 1, 1) + timedelta(days=n), date(2024, 1, 1) + timedelta(days=n + n * 7 % 100), n % 40 + 1) for n in range(60)]
    rows = spark.createDataFrame(cases, "section_id string, a date, b date, n int")
    got = P.build_windows(rows, F.col("a"), F.col("b"), F.col("n")).orderBy("section_id", "window_start").collect()
    for name, first, last, size in cases:
        windows = [(r["window_start"], r["window_end"]) for r in got if r["section_id"] == name]
        assert (windows[0][0], windows[-1][1]) == (first, last)
        lengths = [(b - a).days + 1 for a, b in windows]
        assert lengths[:-1] == [size] * (len(lengths) - 1) and 1 <= lengths[-1] <= size
        assert all((b[0] - a[1]).days == 1 for a, b in zip(windows, windows[1:]))
    assert all(r["partition_date"] == r["window_start"] for r in got)


def test_windows_of_a_short_range(spark):
    rows = spark.createDataFrame([("s", date(2024, 2, 27), date(2024, 3, 2), 2)], "section_id string, a date, b date, n int")
    got = P.build_windows(rows, F.col("a"), F.col("b"), F.col("n")).orderBy("window_start").collect()
    assert [(r["window_start"].isoformat(), r["window_end"].isoformat()) for r in got] == [
        ("2024-02-27", "2024-02-28"), ("2024-02-29", "2024-03-01"), ("2024-03-02", "2024-03-02")]


@pytest.mark.parametrize("start,end,days", [(date(2024, 1, 2), date(2024, 1, 1), 3), (date(2024, 1, 1), date(2024, 1, 2), 0)])
def test_bad_windows_fail(spark, start, end, days):
    rows = spark.createDataFrame([("s", start, end, days)], "section_id string, a date, b date, n int")
    with pytest.raises(Exception, match="before start|must be >= 1"):
        P.build_windows(rows, F.col("a"), F.col("b"), F.col("n")).collect()


def test_plan_names_missing_parameters(spark):
    with pytest.raises(ConfigError, match="end_date, run_id"):
        P.plan_run(spark.range(1), date(2024, 1, 1), None, "")


def test_assigned_windows_agree_with_arithmetic(spark):
    sections = spark.createDataFrame([("x", "a", 3), ("x", "b", 10)], "source_id string, section_id string, partition_days int")
    plan = P.plan_run(sections, date(2024, 1, 1), date(2024, 2, 15), "r")
    records = spark.range(46).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("section_id"),
        F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("day"))
    days = F.when(F.col("section_id") == "a", 3).otherwise(10)
    got = P.assign_windows(records, plan, "day")
    assert got.count() == 46
    assert got.where(F.col("partition_date") != P.window_of(F.col("day"), F.lit(date(2024, 1, 1)), days)).count() == 0


def test_windows_are_assigned_by_date(spark):
    plan = spark.createDataFrame([("a", date(2024, 1, 1), date(2024, 1, 1), date(2024, 3, 31)), ("a", date(2024, 2, 5), date(2024, 2, 5), date(2024, 2, 1))],
                                 "section_id string, partition_date date, window_start date, window_end date")
    records = spark.createDataFrame([("a", "2024-02-03 10:30:00"), ("a", "2024-03-31 23:59:59"), ("a", "2024-04-01 00:00:00"), ("b", "2024-02-03 00:00:00")],
                                    "section_id string, at string").select("section_id", F.col("at").cast("timestamp").alias("day"))
    got = P.assign_windows(records, plan, "day").collect()
    assert sorted((r["day"].isoformat(), r["partition_date"].isoformat()) for r in got) == [
        ("2024-02-03T10:30:00", "2024-01-01"), ("2024-03-31T23:59:59", "2024-01-01")]


@pytest.mark.parametrize("first,last,expected", [
    (True, True, "from=01/01/2026&to=31/01/2026"), (False, False, "from=31/12/2025&to=01/02/2026"),
    (False, True, "from=31/12/2025&to=31/01/2026"), (True, False, "from=01/01/2026&to=01/02/2026")])
def test_listing_requests(spark, first, last, expected):
    plan = spark.createDataFrame(
        [("https://w.example.org/shelf?kind=9&room=4", date(2026, 1, 1), date(2026, 1, 31), first, last, "dd/MM/yyyy", "from", "to", "pageNumber")],
        "url string, window_start date, window_end date, start_inclusive boolean, end_inclusive boolean, date_show string, date_from string, date_to string, page_param string")
    got = P.listing_requests(P.with_listing_template(plan), F.lit(2)).first()["listing_url"]
    assert got == f"https://w.example.org/shelf?kind=9&room=4&{expected}&pageNumber=2"


def test_coverage_finds_gaps_and_overlaps(spark):
    rows = spark.createDataFrame([
        ("a", date(2024, 1, 1), date(2024, 1, 3)), ("a", date(2024, 1, 4), date(2024, 1, 6)),
        ("a", date(2024, 1, 9), date(2024, 1, 12)), ("a", date(2024, 1, 12), date(2024, 1, 14))],
        "section_id string, window_start date, window_end date")
    got = [(r["window_start"].day, r["gap_days"], r["finding"]) for r in P.coverage(rows, ["section_id"]).orderBy("window_start").collect()]
    assert got == [(9, 2, "gap"), (12, -1, "overlap")]
