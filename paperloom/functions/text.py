"""Text clean-up on columns: whitespace, entities, canonical identifiers."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode blanks plus the four ASCII separators that Java's \s leaves out.
BLANK = r"[\s\x1c-\x1f]"

_ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;)|[^&]+|&"


def let(value: Column, body) -> Column:
    """Bind ``value`` to a name inside one expression, so it is computed once.

    ``element_at`` works out its type once; other ways to take the one element
    do so for every row, and deep expressions have deep types.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_let(name: str, value: str, body: str) -> str:
    """``let`` in SQL text."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def sql_apply(body: str, **values: Column) -> Column:
    """Evaluate SQL text on columns, which it sees as fields of ``given``.

    Long expressions are written as text because the engine then parses them in
    one call; putting them together from columns takes thousands of calls.
    """
    given = F.struct(*[value.alias(name) for name, value in values.items()])
    return F.element_at(F.call_function("transform", F.array(given), F.expr(f"given -> {body}")), 1)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{BLANK}+|{BLANK}+$", "")


def sql_collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, {sql_text(f'(?U){BLANK}+')}, ' '))"


def collapse_blanks(text: Column) -> Column:
    """Every run of blanks becomes one space; none at either end."""
    return F.trim(F.regexp_replace(text, rf"(?U){BLANK}+", " "))


# The usual names, tried before the full table.
_COMMON = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": chr(160)}


def _named_entity() -> str:
    """The character of a named ``piece``, looked up in one constant string.

    A map would be folded into the plan once per use, all entries of it.
    """
    table = sql_text("".join(f"\n{name};\t{chr(point)}" for name, point in sorted({**name2codepoint, "apos": 39}.items())))
    place = f"instr({table}, concat('\n', substring(piece, 2), '\t'))"
    return sql_let("place", place, (
        f"CASE WHEN place > 0 THEN substring({table}, place + length(piece) + 1, 1) ELSE piece END"
    ))


def _decode_piece() -> str:
    """What one ``piece`` of text stands for; U+FFFD for no valid code point."""
    digits = f"regexp_extract(piece, {sql_text('^&#[xX]?0*([0-9a-fA-F]+);?$')}, 1)"
    base = "CASE WHEN lower(substring(piece, 1, 3)) = '&#x' THEN 16 ELSE 10 END"
    # More than eight digits cannot be a code point, and would overflow.
    number = f"CASE WHEN length({digits}) > 8 THEN -1L ELSE CAST(conv({digits}, {base}, 10) AS BIGINT) END"
    char = (
        "CASE WHEN (number > 0 AND number < 55296) OR (number > 57343 AND number <= 1114111) "
        "THEN decode(unhex(lpad(hex(number), 8, '0')), 'UTF-32') ELSE '\ufffd' END"
    )
    common = " ".join(f"WHEN piece = {sql_text(name)} THEN {sql_text(char)}" for name, char in _COMMON.items())
    return (
        f"CASE WHEN NOT startswith(piece, '&') THEN piece {common} "
        f"WHEN startswith(piece, '&#') THEN CASE WHEN {digits} = '' THEN piece ELSE {sql_let('number', number, char)} END "
        f"ELSE {_named_entity()} END"
    )


def sql_decode(text: str) -> str:
    pieces = f"regexp_extract_all(coded, {sql_text(_ENTITY)}, 0)"
    joined = f"array_join(transform({pieces}, piece -> {_decode_piece()}), '')"
    return sql_let("coded", text, f"CASE WHEN contains(coded, '&') THEN {joined} ELSE coded END")


def decode_entities(text: Column) -> Column:
    """Character references to characters. Unknown names stay as they are."""
    return sql_apply(sql_decode("given.text"), text=text)


def canonical_identifier(identifier: Column) -> Column:
    """One spelling per document: blanks collapsed, dashes unified, upper case."""
    dashes = F.regexp_replace(collapse_blanks(identifier), r"[\x{2010}-\x{2014}]", "-")
    return F.upper(F.regexp_replace(dashes, rf"(?U){BLANK}*-{BLANK}*", "-"))


def storage_name(identifier: Column) -> Column:
    return F.translate(identifier, "/ ", "__")
