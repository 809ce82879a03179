"""Element selection in HTML text, as column expressions.

A page is cut into tokens by one regular expression. For a selector that names
a tag, only opening and closing tags that can end such an element become tokens
of their own; all text between them stays in one piece, so the token array of a
page is as short as its number of such tags. An element runs from its opening
tag to the closing tag that balances it, counting the same tag only, which makes
the result immune to other tags that are never closed. Rows, cells, list items,
paragraphs and options may lack a closing tag (``IMPLIED_ENDS``): they end where
the next one begins or where what holds them ends, but not at tags of a list,
table or selection of their own. Tokens of a page, joined, give the page.

Pages whose matches are all closed and plain are cut by a single pattern. It
finds the same elements as the tokens do, so markup elsewhere on a page never
changes a match that is complete.

Nothing here shuffles, and all work is linear in the page, but for matches
nested inside other matches.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import sql_apply, sql_collapse, sql_decode, sql_let, sql_text

# Elements that have no content, and elements that may lack their
# closing tag: the tags that end them, and the tags that hold them. A holder
# inside an element shields what it holds; the end of an outer one ends it too.
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link",
             "meta", "param", "source", "track", "wbr")
RAW_TEXT_TAGS = ("script", "style")
_TABLE_PARTS = ("tr", "tbody", "thead", "tfoot")
_BLOCKS = ("address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure",
           "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p",
           "pre", "section", "table", "ul")
IMPLIED_ENDS = {
    "a": (("a",), ()),
    "dd": (("dd", "dt"), ("dl",)),
    "dt": (("dd", "dt"), ("dl",)),
    "li": (("li",), ("menu", "ol", "ul")),
    "option": (("option", "optgroup"), ("datalist", "select")),
    "p": (_BLOCKS + ("dd", "dt", "li", "td", "th") + _TABLE_PARTS, ()),
    "td": (("td", "th") + _TABLE_PARTS, ("table",)),
    "th": (("td", "th") + _TABLE_PARTS, ("table",)),
    "tr": (_TABLE_PARTS, ("table",)),
}

# Greedy runs of a class in an atomic group: Java walks them in one tight loop,
# possessive ones character by character through the whole pattern.
_RUN = "(?>[^<]+)"
_IN_TAG = r"""(?:(?>[^'">]+)|"(?>[^"]*)"|'(?>[^']*)')*+>"""
_OPAQUE = r"<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# Declarations, and tags with an unbalanced quote. "<" before a blank is text.
_ODD_TAG = r"<[!?/a-z](?>[^>]*)>"
EVERY_TOKEN = rf"(?is){_RUN}|{_OPAQUE}|</?[a-z]{_IN_TAG}|{_ODD_TAG}|<"

# Markup to blank out when only text is wanted; raw text keeps its content.
_MARKUP = rf"(?is)<(script|style)\b{_IN_TAG}(.*?)</\1\s*>|<!--.*?-->|</?[a-z]{_IN_TAG}|{_ODD_TAG}"
_MARKUP_AND_RAW_TEXT = rf"(?is){_OPAQUE}|</?[a-z]{_IN_TAG}|{_ODD_TAG}"

_ATTRIBUTE_VALUE = r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+"""

_SIMPLE = re.compile(r"^([a-zA-Z][a-zA-Z0-9]*)?((?:\.[A-Za-z_][\w-]*)*)$")


class SelectorError(ValueError):
    """A selector outside the supported grammar."""


_EDGE = r"(?=[\s/>])"


def _family(tag: str) -> str:
    """The tag and all that can end its element, as a pattern."""
    ends, holders = IMPLIED_ENDS.get(tag, ((), ()))
    return "(?:" + "|".join(dict.fromkeys((tag, *ends, *holders))) + ")"


def _tag_tokens(tag: str) -> str:
    one = rf"</?{_family(tag)}{_EDGE}"
    other = rf"(?!{one})"
    return (
        rf"(?is){one}{_IN_TAG}"
        rf"|(?:{_RUN}|{_OPAQUE}|{other}</?[a-z]{_IN_TAG}|{other}{_ODD_TAG}|{other}<)++|<"
    )


def _before_attribute(name: str) -> str:
    """From the start of a tag to just behind the attribute name."""
    return (
        rf"(?i:[a-z])[^\s/>]*+(?:[\s/]++(?!(?i:{name})[\s=/>])[^\s=/>\"']++{_ATTRIBUTE_VALUE})*+"
        rf"[\s/]++(?i:{name})\s*+=\s*+"
    )


def _has_class(name: str) -> str:
    word = re.escape(name)
    return (
        rf"(?=<{_before_attribute('class')}"
        rf"""(?:"(?:[^"]*?\s)?{word}(?:\s[^"]*)?"|'(?:[^']*?\s)?{word}(?:\s[^']*)?'|{word}(?=[\s>/])))"""
    )


@dataclass(frozen=True)
class Step:
    """One simple selector: its tag ('' for any) and its patterns.

    ``whole`` finds, in one pass, each matching element whose end is plain to
    see, which is nearly every one; of the others it finds the first character
    only. The end is a closing tag, or for elements that may lack it what ends
    them; inside are no tags that could end it, but for lists and tables that
    are closed, one in another at most.
    """

    tag: str
    tokens: str
    opening: str
    whole: str


def _whole_element(checks: str, tag: str) -> str:
    # The cheap look at the tag name comes before the one at the attributes.
    start = rf"(?=<(?i:{tag})[\s/>]){checks}<" if tag else rf"{checks}<"
    name = rf"((?i:{tag})){_EDGE}" if tag else r"([a-zA-Z][^\s/>]*+)"
    family = rf"(?i:{_family(tag)})" if tag else r"(?i:\2)"
    # An odd tag is one piece, as it is among the tokens.
    odd = rf"(?!</?{family}{_EDGE})(?i:{_ODD_TAG})" if tag else rf"(?i:{_ODD_TAG})"
    skip = rf"(?:{_RUN}|</[a-zA-Z]{_IN_TAG}|(?=<[!sS])(?i:{_OPAQUE})|(?!{start})(?:<[a-zA-Z]{_IN_TAG}|{odd}|<))++"
    plain = rf"(?:/?[a-zA-Z]{_IN_TAG}|(?![!?/a-zA-Z]))"
    opaque = r"!--|(?i:script|style)\b"
    ends, holders = IMPLIED_ENDS.get(tag, ((), ()))
    held = ""
    if holders:
        hold = rf"(?i:{'|'.join(holders)}){_EDGE}"
        for _ in range(2):
            held = rf"|<{hold}{_IN_TAG}(?<!/>)(?:{_RUN}|<(?!/?{hold}|{opaque}){plain}{held})*+</{hold}{_IN_TAG}"
    inside = rf"(?:{_RUN}|<(?!/?{family}[\s/>]|{opaque}){plain}{held})*+"
    end = r"</(?i:\2)>"
    if ends:
        # A tag that ends the element is not part of it; a closed holder is the outer one's end.
        opens = "|".join(one for one in ends if one not in VOID_TAGS)
        closes = "|".join((*(one for one in ends if one != tag), *holders)) or "(?!)"
        end = rf"(?:{end}|(?=<(?i:{opens}){_EDGE}{_IN_TAG}(?<!/>))|(?=</(?i:{closes}){_EDGE}{_IN_TAG})|\z)"
    open_ended = "|".join(VOID_TAGS + RAW_TEXT_TAGS + (() if tag else tuple(t for t in IMPLIED_ENDS if t != "a")))
    closed = rf"<(?!(?i:{open_ended})[\s/>]){name}{_IN_TAG}(?<!/>){inside}{end}"
    rest = "<" if tag else rf"(?i:{_ODD_TAG})|<"
    return rf"(?s){skip}|({start[:-1]}{closed}|{start}(?={name.replace('(', '(?:', 1)}{_IN_TAG}))|{rest}"


def _compile_step(part: str) -> Step:
    found = _SIMPLE.match(part)
    if not found or not part:
        raise SelectorError(f"unsupported selector {part!r}")
    tag, classes = found.group(1), [name for name in found.group(2).split(".") if name]
    if tag and tag.lower() in RAW_TEXT_TAGS:
        raise SelectorError(f"raw text elements cannot be selected: {part!r}")
    checks = "".join(_has_class(name) for name in classes)
    if tag:
        opening = rf"(?s)^{checks}<(?i:{tag.lower()})(?=[\s/>])"
        return Step(tag.lower(), _tag_tokens(tag.lower()), opening, _whole_element(checks, tag.lower()))
    return Step("", EVERY_TOKEN, rf"(?s)^{checks}<[a-zA-Z]", _whole_element(checks, ""))


def compile_selector(selector: str) -> tuple[Step, ...]:
    """Steps of ``tag``, ``.class``, ``tag.class`` or two of them in a row.

    Anything else is refused rather than matched wrongly.
    """
    parts = selector.split()
    if not 1 <= len(parts) <= 2:
        raise SelectorError(f"unsupported selector {selector!r}")
    return tuple(_compile_step(part) for part in parts)


SELECTOR_TYPE = "array<struct<tag:string,tokens:string,opening:string,whole:string>>"


def selector_value(selector: str | None):
    """A selector as a value of ``SELECTOR_TYPE``, to be kept in a table."""
    if selector is None:
        return None
    return [(step.tag, step.tokens, step.opening, step.whole) for step in compile_selector(selector)]


class Selector:
    """A selector given as text, or read from a table column."""

    def __init__(self, steps: tuple[Step, ...] = (), value: Column | None = None):
        self.steps = steps
        self.value = value

    @staticmethod
    def of(selector: "str | Selector") -> "Selector":
        return selector if isinstance(selector, Selector) else Selector(compile_selector(selector))

    @staticmethod
    def column(value: Column) -> "Selector":
        return Selector(value=value)


# From here to the public functions, expressions are SQL text. A step is the
# text of its three fields.

def _literal_step(step: Step) -> Step:
    return Step(sql_text(step.tag), sql_text(step.tokens), sql_text(step.opening), sql_text(step.whole))


_FIELD_STEP = Step("step.tag", "step.tokens", "step.opening", "step.whole")


def _tag_list(tags: tuple[str, ...]) -> str:
    return ", ".join(sql_text(tag) for tag in tags)


_NAME = r"^</?([a-zA-Z][^\s/>]*)"
# A slash at the end of a tag that belongs to an unquoted value.
_SLASH_OF_VALUE = r"""=\s*+[^\s"'>]++>$"""


def _describe(tokens: str, step: Step) -> str:
    """Per token: its tag name, whether it opens (1) or closes (-1) something, and whether it matches."""
    # Up to the first bracket, which is behind every name: long pieces of text are not looked at.
    head = "substring_index(token, '>', 1)"
    name = f"CASE WHEN startswith(token, '<') THEN lower(regexp_extract({head}, {sql_text(_NAME)}, 1)) ELSE '' END"
    counts = f"name <> '' AND ({step.tag} = '' OR {step.tag} = name)"
    alone = (f"name IN ({_tag_list(VOID_TAGS + RAW_TEXT_TAGS)}) "
             f"OR (endswith(token, '/>') AND regexp_extract(token, {sql_text(_SLASH_OF_VALUE)}, 0) = '')")
    closing = "startswith(token, '</')"
    # Extracting keeps a pattern compiled from row to row; RLIKE compiles a
    # pattern that is not a constant again for every token.
    marks = (
        f"named_struct('name', name, "
        f"'sign', CASE WHEN name = '' THEN 0 WHEN {closing} THEN -1 WHEN {alone} THEN 0 ELSE 1 END, "
        f"'hit', {counts} AND NOT {closing} AND regexp_extract(token, {step.opening}, 0) <> '')"
    )
    return f"transform({tokens}, token -> {sql_let('name', name, marks)})"


def _one_of(which: int) -> str:
    """Whether the tag of ``mark`` is an end (0) or a holder (1) of the open element."""
    cases = " ".join(f"WHEN '{tag}' THEN mark.name IN ({_tag_list(groups[which])})"
                     for tag, groups in IMPLIED_ENDS.items() if groups[which])
    return f"(CASE acc.name {cases} ELSE false END)"


# What a tag does to the open element: 2 ends it, 3 ends it before the tag,
# others change its depth.
_CHANGE = (
    "CASE WHEN acc.depth = 0 OR mark.sign = 0 THEN 0 "
    "WHEN mark.name = acc.name AND mark.sign = -1 AND acc.depth = 1 THEN 2 "
    f"WHEN acc.name NOT IN ({_tag_list(tuple(IMPLIED_ENDS))}) THEN CASE WHEN mark.name = acc.name THEN mark.sign ELSE 0 END "
    f"WHEN {_one_of(1)} THEN CASE WHEN mark.sign = -1 AND acc.depth = 1 THEN 3 ELSE mark.sign END "
    f"WHEN acc.depth = 1 AND {_one_of(0)} THEN 3 ELSE 0 END"
)


def _outermost(marks: str) -> str:
    """Flat array of start, end, start, end … (1-based) of the outermost matches."""
    def state(at: str, depth: str, start: str, name: str, found: str) -> str:
        return f"named_struct('at', {at}, 'depth', {depth}, 'start', {start}, 'name', {name}, 'found', {found})"

    here = "acc.at + 1"
    none = chr(39) * 2
    before = "CASE WHEN change = 3 THEN concat(acc.found, array(acc.start, acc.at)) ELSE acc.found END"
    opens = "(mark.hit AND (acc.depth = 0 OR change = 3))"
    step = (
        f"CASE WHEN change = 2 THEN {state(here, '0', '0', none, f'concat(acc.found, array(acc.start, {here}))')} "
        f"WHEN {opens} AND mark.sign = 0 THEN {state(here, '0', '0', none, f'concat({before}, array({here}, {here}))')} "
        f"WHEN {opens} THEN {state(here, '1', here, 'mark.name', before)} "
        f"WHEN change = 3 THEN {state(here, '0', '0', none, before)} "
        f"ELSE {state(here, 'acc.depth + change', 'acc.start', 'acc.name', 'acc.found')} END"
    )
    zero = state("0", "0", "0", none, "CAST(array() AS ARRAY<INT>)")
    finish = "CASE WHEN acc.depth > 0 THEN concat(acc.found, array(acc.start, acc.at)) ELSE acc.found END"
    return f"aggregate({marks}, {zero}, (acc, mark) -> {sql_let('change', _CHANGE, step)}, acc -> {finish})"


_STARTS = "filter(flat, (edge, n) -> n % 2 = 0)"
# Text of the ranges in ``flat``.
_CUT = f"transform({_STARTS}, (start, n) -> array_join(slice(tokens, start, flat[n * 2 + 1] - start + 1), ''))"


def _or_whole(html: str, step: Step, usable: str, general: str) -> str:
    """The matches found in one pass where they are complete, else ``general``, which finds the same ones."""
    found = f"filter(regexp_extract_all(page, {step.whole}, 1), one -> one <> '')"
    choose = f"CASE WHEN {usable} AND forall(wholes, one -> one <> '<') THEN wholes ELSE {general} END"
    return sql_let("page", html, sql_let("wholes", found, choose))


def _outer_one(html: str, step: Step) -> str:
    """Outermost matches."""
    cut = sql_let("flat", _outermost(_describe("tokens", step)), _CUT)
    return _or_whole(html, step, "true", sql_let("tokens", f"regexp_extract_all(page, {step.tokens}, 0)", cut))


def _all_one(html: str, step: Step) -> str:
    """All matches in document order, nested ones included.

    A whole element has no tag of its kind inside, so no match either, but
    where the selector names no tag, or in lists and tables that it holds.
    """
    # The match that holds a nested one bounds how far it can reach.
    holder_end = "array_max(transform(outers, (begin, n) -> CASE WHEN begin < start THEN flat[n * 2 + 1] ELSE 0 END))"
    reach = _outermost(f"slice(marks, start, {holder_end} - start + 1)")
    nested = f"array_join(slice(tokens, start, get({reach}, 1)), '')"
    own = "array_join(slice(tokens, start, flat[CAST(place AS INT) * 2 - 1] - start + 1), '')"
    element = sql_let("place", "array_position(outers, start)", f"CASE WHEN place > 0 THEN {own} ELSE {nested} END")
    hits = "filter(transform(marks, (mark, n) -> CASE WHEN mark.hit THEN n + 1 ELSE 0 END), at -> at > 0)"
    every = sql_let("hits", hits, (
        f"CASE WHEN size(hits) * 2 = size(flat) THEN {_CUT} "
        f"ELSE {sql_let('outers', _STARTS, f'transform(hits, start -> {element})')} END"
    ))
    with_flat = sql_let("flat", _outermost("marks"), every)
    with_marks = sql_let("marks", _describe("tokens", step), with_flat)
    general = sql_let("tokens", f"regexp_extract_all(page, {step.tokens}, 0)", with_marks)
    held = [tag for tag, (_, holders) in IMPLIED_ENDS.items() if holders]
    nested = f"instr(lower(substring(one, 2)), concat('<', {step.tag})) > 0"
    alone = f"{step.tag} <> '' AND ({step.tag} NOT IN ({_tag_list(tuple(held))}) OR NOT exists(wholes, one -> {nested}))"
    return _or_whole(html, step, alone, general)


def _inside(fragment: str) -> str:
    """An element without its opening tag."""
    return f"regexp_replace({fragment}, {sql_text(rf'(?is)^</?[a-z]{_IN_TAG}')}, '')"


def _outer_all(html: str, step: Step) -> str:
    """Outermost matches before the last step, all matches at the last one."""
    return f"CASE WHEN step.tokens = last_step THEN {_all_one(html, step)} ELSE {_outer_one(html, step)} END"


def _two_steps(html: str, first: Step, second: Step, last) -> str:
    return f"flatten(transform({_outer_one(html, first)}, part -> {last(_inside('part'), second)}))"


def _by_field(html: str, selector: str, last) -> str:
    """Matches of a selector held in a field: step by step inside what was found.

    The page gets a tag of its own, so that every step can look inside one.
    """
    each = last if last is _outer_one else _outer_all
    found = f"flatten(transform(parts, part -> {each(_inside('part'), _FIELD_STEP)}))"
    walk = f"aggregate({selector}, array(concat('<x>', {html})), (parts, step) -> {found})"
    return walk if last is _outer_one else sql_let("last_step", f"element_at({selector}, -1).tokens", walk)


def _select(html: Column, selector: "str | Selector", last, around: str = "{}") -> Column:
    chosen = Selector.of(selector)
    if chosen.value is not None:
        return sql_apply(around.format(_by_field("given.html", "given.sel", last)), html=html, sel=chosen.value)
    steps = [_literal_step(step) for step in chosen.steps]
    body = last("given.html", steps[0]) if len(steps) == 1 else _two_steps("given.html", *steps, last)
    return sql_apply(around.format(body), html=html)


def select_outer(html: Column, selector: str | Selector) -> Column:
    """Matching elements that lie in no other match: the ones that carry text."""
    return _select(html, selector, _outer_one)


def select_all(html: Column, selector: str | Selector) -> Column:
    """All matching elements in document order."""
    return _select(html, selector, _all_one)


def select_first(html: Column, selector: str | Selector) -> Column:
    """The first matching element, or null."""
    return F.get(select_outer(html, selector), F.lit(0))


def has_match(html: Column, selector: str | Selector) -> Column:
    return F.size(select_outer(html, selector)) > 0


def _text(fragment: str) -> str:
    return sql_collapse(sql_decode(f"regexp_replace({fragment}, {sql_text(_MARKUP)}, ' $2 ')"))


def _joined_text(fragments: str) -> str:
    return _text(f"array_join({fragments}, '<br>')")


def clean_texts(*fragments: Column) -> Column:
    """Array of the texts of several fragments; the clean-up is planned once."""
    texts = f"transform(given.fragments, fragment -> {_text('fragment')})"
    return sql_apply(texts, fragments=F.array(*fragments))


def joined(fragments: Column) -> Column:
    """Several fragments as one, their texts kept apart."""
    return F.array_join(fragments, "<br>")


def text_of(fragment: Column) -> Column:
    """All text in a fragment: blanks collapsed, entities decoded."""
    return sql_apply(_text("given.fragment"), fragment=fragment)


def select_text(html: Column, selector: str | Selector) -> Column:
    """Text under every match of a selector; '' when there is none."""
    return sql_apply(_joined_text("given.parts"), parts=select_outer(html, selector))


def select_first_text(html: Column, selectors: Column) -> Column:
    """Text under the first of several selectors that has any, or null."""
    text = _joined_text(_by_field("given.html", "sel", _outer_one))
    # Later selectors are not evaluated once there is a text.
    return sql_apply(
        f"nullif(aggregate(given.sels, '', (found, sel) -> CASE WHEN found <> '' THEN found ELSE {text} END), '')",
        html=html, sels=selectors,
    )


def has_visible_text(fragment: Column) -> Column:
    """Whether anything but markup, scripts, styles and blanks is inside."""
    bare = f"regexp_replace(given.fragment, {sql_text(_MARKUP_AND_RAW_TEXT)}, '')"
    return sql_apply(f"{sql_collapse(sql_decode(bare))} <> ''", fragment=fragment)


def attribute(fragment: Column, name: str) -> Column:
    """Attribute of a fragment's opening tag, decoded; '' when absent."""
    pattern = rf"""(?s)^<{_before_attribute(name)}(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    raw = "concat(" + ", ".join(f"regexp_extract(given.fragment, {sql_text(pattern)}, {n})" for n in (1, 2, 3)) + ")"
    return sql_apply(sql_decode(raw), fragment=fragment)


def double_quoted(fragment: Column) -> Column:
    """Opening tag with single-quoted attribute values double-quoted."""
    return F.regexp_replace(fragment, r"""(?<==)'([^'"<>]*)'(?=[^<]*>)""", '"$1"')
