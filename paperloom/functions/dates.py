"""Date formats with percent directives as patterns of the engine, for reading and for writing.

Supported: ``%d %m %Y %y %j %b %B %H %M %S %%`` and any text between; anything
else is refused. Numbers may be written with fewer digits than usual, unless
another number follows directly.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Directive: pattern with any number of digits, pattern with all digits.
NUMBERS = {"d": ("d", "dd"), "m": ("M", "MM"), "Y": ("yyyy", "yyyy"), "y": ("yy", "yy"), "j": ("D", "DDD"),
           "H": ("H", "HH"), "M": ("m", "mm"), "S": ("s", "ss")}
NAMES = {"b": "MMM", "B": "MMMM"}
# Two-digit years from here on are of the twentieth century.
PIVOT = 69


class DateFormatError(ValueError):
    """A format that can't be read or written faithfully."""


def _tokens(date_format: str) -> list[str]:
    """Directives and the text between them, in order."""
    return re.findall(r"%.?|[^%]+", date_format, re.DOTALL)


def _quoted(text: str) -> str:
    """Text that stands for itself; only letters and signs with a meaning need quotes."""
    if not re.search(r"[A-Za-z'\[\]{}#]", text):
        return text
    return "'" + text.replace("'", "''") + "'"


def engine_pattern(date_format: str, reading: bool) -> str:
    """The engine's pattern for a format."""
    tokens = _tokens(date_format)
    out = []
    for i, token in enumerate(tokens):
        if not token.startswith("%"):
            out.append(_quoted(token))
        elif token == "%%":
            out.append("%")
        elif token[1:] in NAMES:
            out.append(NAMES[token[1:]])
        elif token[1:] in NUMBERS:
            beside = [t for t in tokens[max(i - 1, 0):i + 2] if t is not token and t[:1] == "%" and t[1:] in NUMBERS]
            out.append(NUMBERS[token[1:]][0 if reading and not beside else 1])
        else:
            raise DateFormatError(f"unsupported date format {date_format!r}")
    given = {t[1:] for t in tokens if t.startswith("%")}
    whole = given & {"Y", "y"} and ("j" in given or ("d" in given and given & {"m", "b", "B"}))
    if reading and not whole:
        raise DateFormatError(f"date format {date_format!r} names no whole date")
    if any(tokens.count(f"%{d}") > 1 for d in (*NUMBERS, *NAMES)) or {"Y", "y"} <= given:
        raise DateFormatError(f"date format {date_format!r} names a part twice")
    return "".join(out)


def read_day(text: Column, pattern: Column) -> Column:
    """The date that a text says by an engine pattern, or null."""
    day = F.call_function("try_to_date", text, pattern)
    short = F.contains(pattern, F.lit("yy")) & ~F.contains(pattern, F.lit("yyyy"))
    return F.when(short & (F.year(day) >= 2000 + PIVOT), F.add_months(day, -1200)).otherwise(day)
