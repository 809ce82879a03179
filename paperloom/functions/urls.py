"""URL quoting, resolving and query building on columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import let, strip

# Characters a link keeps unescaped, next to letters, digits and "_.-~".
LINK_SAFE = "/:?&=%~"
QUERY_SAFE = "/"

_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def percent_encoded(text: str) -> str:
    """What ``quote`` makes of characters outside ASCII."""
    return "".join(f"%{byte:02X}" for byte in text.encode())


def quote(text: Column, safe: str) -> Column:
    """Percent-encode as UTF-8, leaving the ``safe`` characters alone.

    Texts of characters that stay, nearly all, are only looked at.
    """
    changes = F.rlike(text, F.lit(rf"[^A-Za-z0-9_.~\-{re.escape(safe)}]"))
    out = F.url_encode(text)
    out = F.replace(out, F.lit("+"), F.lit("%20"))
    out = F.replace(out, F.lit("*"), F.lit("%2A"))
    out = F.replace(out, F.lit("%7E"), F.lit("~"))
    # "%" goes last: undone earlier it would form escapes the input never had.
    for char in sorted(set(safe) - {"%", "~"}) + (["%"] if "%" in safe else []):
        out = F.replace(out, F.lit(f"%{ord(char):02X}"), F.lit(char))
    return F.when(changes, out).otherwise(text)


def _merge_path(base_path: Column, path: Column) -> Column:
    """``path`` seen from ``base_path``, dot segments removed."""
    own = F.split(path, "/", -1)
    folder = let(
        F.split(base_path, "/", -1),
        lambda parts: F.when(F.element_at(parts, -1) != "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts),
    )

    def drop_inner_blanks(parts: Column) -> Column:
        return F.filter(parts, lambda part, at: (part != "") | (at == 0) | (at == F.size(parts) - 1))

    segments = F.when(F.startswith(path, F.lit("/")), own).otherwise(let(F.concat(folder, own), drop_inner_blanks))

    def walk(done: Column, segment: Column) -> Column:
        up = F.when(F.size(done) > 0, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
        return (
            F.when(segment == "..", up)
            .when(segment == ".", done)
            .otherwise(F.concat(done, F.array(segment)))
        )

    def join(parts: Column) -> Column:
        kept = F.aggregate(parts, F.array().cast("array<string>"), walk)
        ends_in_dots = F.element_at(parts, -1).isin(".", "..")
        text = F.concat(F.array_join(kept, "/"), F.when(ends_in_dots & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit("")))
        return F.when(F.startswith(text, F.lit("/")), text).otherwise(F.concat(F.lit("/"), text))

    return let(segments, join)


def resolve(base: Column, ref: Column) -> Column:
    """Absolute form of ``ref`` found on the page ``base``."""
    def part(url: Column, group: int) -> Column:
        return F.regexp_extract(url, _PARTS, group)

    has_dots = F.rlike(part(ref, 3), F.lit(r"(?:^|/)\.\.?(?:/|$)"))
    rooted = F.startswith(ref, F.lit("/"))
    scheme, host = part(base, 1), part(base, 2)
    # A rooted path without dot segments needs no walk; that is nearly every link.
    path = F.when(rooted & ~has_dots, part(ref, 3)).otherwise(_merge_path(part(base, 3), part(ref, 3)))
    tail = F.concat(part(ref, 4), part(ref, 5))
    return (
        F.when(ref == "", base)
        .when(part(ref, 1) != "", ref)
        .when(part(ref, 2) != "", F.concat(F.lower(scheme), ref))
        .when(part(ref, 3) == "", F.concat(F.lower(scheme), host, part(base, 3), F.when(part(ref, 4) != "", part(ref, 4)).otherwise(part(base, 4)), part(ref, 5)))
        .otherwise(F.concat(F.lower(scheme), host, path, tail))
    )


def link_target(page_url: Column, href: Column) -> Column:
    """Where a link on a page leads: stripped, quoted, made absolute."""
    return resolve(page_url, quote(strip(href), LINK_SAFE))


def _pair(name: Column, value: Column) -> Column:
    return F.struct(name.alias("name"), value.alias("value"))


def _decoded(text: Column) -> Column:
    plain = F.replace(text, F.lit("+"), F.lit(" "))
    return F.when(F.rlike(text, F.lit("[%+]")), F.coalesce(F.try_url_decode(text), plain)).otherwise(text)


def query_pairs(url: Column) -> Column:
    """Decoded query parameters in order; blank values are dropped."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fields = F.filter(F.split(query, "&", -1), lambda field: F.rlike(field, F.lit("=.")))
    return F.transform(
        fields,
        lambda field: _pair(
            _decoded(F.substring_index(field, "=", 1)),
            _decoded(F.regexp_extract(field, "(?s)^[^=]*=(.*)$", 1)),
        ),
    )


def with_query(url: Column, extra: list[tuple[Column, Column]]) -> Column:
    """``url`` with ``extra`` parameters set.

    A name keeps its first place and takes its last value, whether the earlier
    value stood in the URL or not.
    """
    added = F.array(*[_pair(name, value) for name, value in extra])

    def render(pairs: Column) -> Column:
        names = F.array_distinct(F.transform(pairs, lambda pair: pair["name"]))
        fields = F.transform(
            names,
            lambda name: F.concat(
                quote(name, QUERY_SAFE),
                F.lit("="),
                quote(F.element_at(F.filter(pairs, lambda pair: pair["name"] == name), -1)["value"], QUERY_SAFE),
            ),
        )
        return F.array_join(fields, "&")

    query = let(F.concat(query_pairs(url), added), render)
    front = F.regexp_extract(url, r"^([^?#]*)", 1)
    fragment = F.regexp_extract(url, r"(#.*)$", 1)
    return F.concat(front, F.lit("?"), query, fragment)


def request_identity(url: Column) -> Column:
    """What two URLs share when they ask for the same thing.

    Parameters are decoded, quoted one way and sorted by name and value, blank
    ones included; scheme and host are lower-cased, an empty path is "/", and
    the fragment is left out.
    """
    scheme, host, path, query = (F.regexp_extract(strip(url), _PARTS, group) for group in (1, 2, 3, 4))
    fields = F.filter(F.split(F.substring(query, 2, 1 << 30), "&", -1), lambda field: field != "")
    pairs = F.transform(fields, lambda field: _pair(
        _decoded(F.substring_index(field, "=", 1)), _decoded(F.regexp_extract(field, "(?s)^[^=]*=(.*)$", 1))))
    text = F.array_join(F.transform(F.sort_array(pairs), lambda pair: F.concat(
        quote(pair["name"], QUERY_SAFE), F.lit("="), quote(pair["value"], QUERY_SAFE))), "&")
    front = F.concat(F.lower(scheme), F.lower(host), F.when(path == "", F.lit("/")).otherwise(path))
    return F.when(text == "", front).otherwise(F.concat(front, F.lit("?"), text))
