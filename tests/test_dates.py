"""Formats against the standard library, in both directions."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paperloom.config import ConfigError, date_pattern
from paperloom.functions.dates import engine_pattern, read_day

FORMATS = ["%d/%m/%Y", "%d %b %Y", "%B %d, %Y", "%d.%m.%y", "%Y%m%d", "%j/%Y", "%y-%j", "%d-%m-%Y %H:%M", "%Y-%m-%dT%H:%M:%S", "%d of %B, '%y", "%d%% %m [%Y] {x}#"]


@pytest.mark.parametrize("form", FORMATS)
def test_both_directions(spark, form):
    draw = random.Random(form)
    moments = [datetime(1970, 1, 1) + timedelta(seconds=draw.randrange(3_100_000_000)) for _ in range(40)] + [datetime(1972, 2, 29), datetime(2000, 2, 29), datetime(2068, 12, 31)]
    rows = [(m, m.strftime(form)) for m in moments]
    frame = spark.createDataFrame(rows, "m timestamp, text string")
    got = frame.select("m", "text", F.call_function("date_format", "m", F.lit(engine_pattern(form, False))).alias("shown"),
                       read_day(F.col("text"), F.lit(engine_pattern(form, True))).alias("day")).collect()
    for r in got:
        assert r.shown == r.text and r.day == datetime.strptime(r.text, form).date()


def test_few_digits_case_and_nonsense(spark):
    cases = [("%d/%m/%Y", "1/2/2026", date(2026, 2, 1)), ("%d %b %Y", "3 JAN 2026", date(2026, 1, 3)), ("%d %B %Y", "3 january 2026", date(2026, 1, 3)),
             ("%d/%m/%Y", "31/02/2026", None), ("%d %b %Y", "3 Foo 2026", None), ("%Y%m%d", "2026131", None), ("%j/%Y", "366/2026", None), ("%j/%Y", "7/2026", date(2026, 1, 7))]
    for form, text, expected in cases:
        assert spark.range(1).select(read_day(F.lit(text), F.lit(engine_pattern(form, True)))).first()[0] == expected, (form, text)


@pytest.mark.parametrize("form", ["%A %d %m %Y", "%d/%m", "%Y", "%d %d %m %Y", "%Y %y %j", "%", "%d/%m/%Y %p", "%-d/%m/%Y"])
def test_refused(form):
    with pytest.raises(ConfigError):
        date_pattern(form, True)
