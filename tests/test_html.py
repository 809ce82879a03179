"""Selection in HTML: awkward markup, both fixed and column-held selectors."""

import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from paperloom.functions import html as H

CASES = [
    ("nested", '<div class="x"><div>a</div>b</div><div class="x y">c</div>', "div.x",
     ['<div class="x"><div>a</div>b</div>', '<div class="x y">c</div>'], "a b c"),
    ("unclosed container", '<p><div class="content">a<b>q<p>z', "div.content", ['<div class="content">a<b>q<p>z'], "a q z"),
    ("another class", '<div class="contents">a</div>', "div.content", [], ""),
    ("bracket in attribute", "<div title=\"a>b\" class='content'>k</div>t", "div.content",
     ["<div title=\"a>b\" class='content'>k</div>"], "k"),
    ("script", '<script>var x="<div class=\'content\'>no</div>"</script><DIV CLASS="content">yes</DIV>', "div.content",
     ['<DIV CLASS="content">yes</DIV>'], "yes"),
    ("another attribute", '<div data-class="content">no</div><div class=content>y</div>', "div.content",
     ["<div class=content>y</div>"], "y"),
    ("class in a value", '<div title=" class=content ">no</div>', "div.content", [], ""),
    ("tag in a value", '<i title="<span class=\'x\'>no</span>">a</i><span class="x">b</span>', "span.x",
     ['<span class="x">b</span>'], "b"),
    ("bare class", '<p>a<a class="next" href="/q">n</a></p>', ".next", ['<a class="next" href="/q">n</a>'], "n"),
    ("comment and nesting",
     '<!-- <li class="e">x</li> --><ul><li class="e">1<ul><li class="e">2</li></ul></li><li class="e">3</li></ul>', "li.e",
     ['<li class="e">1<ul><li class="e">2</li></ul></li>', '<li class="e">2</li>', '<li class="e">3</li>'], "1 2 3"),
    ("self-ending", '<p class="d">one<p class="d">two <i>x</i>', "p.d", ['<p class="d">one', '<p class="d">two <i>x</i>'], "one two x"),
    ("descendant", '<h2 class="title"><a href="/1">A &amp; B</a></h2><h2><a href="/2">C</a></h2>', "h2.title a",
     ['<a href="/1">A &amp; B</a>'], "A & B"),
    ("void", '<img class="x" src="u"><br/>', "img.x", ['<img class="x" src="u">'], ""),
    ("stray bracket", "a < b <div>c < d</div> e", "div", ["<div>c < d</div>"], "c < d"),
    ("two classes", "<div class='a\tcontent\nb'>1</div>", "div.content.b", ["<div class='a\tcontent\nb'>1</div>"], "1"),
    ("nested bare class", '<div class="k">a<span class="k">b</span></div>', ".k",
     ['<div class="k">a<span class="k">b</span></div>', '<span class="k">b</span>'], "a b"),
    ("three rows without ends", '<ul><li class="e">1<li class="e">2 <i>x</i><li>no<li class="e">3</ul>after', "li.e",
     ['<li class="e">1', '<li class="e">2 <i>x</i>', '<li class="e">3'], "1 2 x 3"),
    ("list in a row without end", '<ol><li class="e">1<ul><li>a<li class="e">b</ul>c<li class="e">2</ol>', "li.e",
     ['<li class="e">1<ul><li>a<li class="e">b</ul>c', '<li class="e">b', '<li class="e">2'], "1 a b c 2"),
    ("cells", '<table><tr class="r"><td class="k">a<td>b<tr class="r"><th>c<td class="k">d<table><tr><td>e</table>f</table>g', "td.k",
     ['<td class="k">a', '<td class="k">d<table><tr><td>e</table>f'], "a d e f"),
    ("rows of a table", '<table><thead><tr class="r"><th>h<tbody><tr class="r"><td>1<tr><td>2</tbody><tr class="r"><td>3</table>z', "tr.r",
     ['<tr class="r"><th>h', '<tr class="r"><td>1', '<tr class="r"><td>3'], "h 1 3"),
    ("terms", '<dl><dt class="t">a<dd>b<dl><dt>c</dl>d<dt class="t">e</dl>f', "dt.t", ['<dt class="t">a', '<dt class="t">e'], "a e"),
    ("paragraph before a block", '<div><p class="d">one<div>two</div></div><section><p class="d">three</section>four', "p.d",
     ['<p class="d">one', '<p class="d">three'], "one three"),
    ("any tag without end", '<ul><li class="k">1<li>2</ul><b class="k">3</b>', ".k", ['<li class="k">1', '<b class="k">3</b>'], "1 3"),
    ("cells of rows", '<table><tr class="r"><td>a<td class="k">b<tr><td class="k">c</table>', "tr.r td", ['<td>a', '<td class="k">b'], "a b"),
    ("slash in a value", '<a class=k href=/x/>one</a><a class=k>two', "a.k", ['<a class=k href=/x/>one</a>', '<a class=k>two'], "one two"),
    ("closed at once", '<b class="k"/>one</b><b class="k">two</b>', "b.k", ['<b class="k"/>', '<b class="k">two</b>'], "two"),
    ("void with text behind", '<img class=k>after<br></img>', ".k", ["<img class=k>"], ""),
    ("closing tag in a value", '<a class=k href=</a>one</a>', "a.k", ['<a class=k href=</a>one</a>'], "one"),
    ("long tag names", f'<{"y" * 90}a class="k">1<{"y" * 90}b>2</{"y" * 90}b></{"y" * 90}a>3', ".k",
     [f'<{"y" * 90}a class="k">1<{"y" * 90}b>2</{"y" * 90}b></{"y" * 90}a>'], "1 2"),
    ("unbalanced quote", '<div class="content>a</div>', "div.content", [], ""),
]


@pytest.mark.parametrize("held", [False, True])
def test_selection(spark, held):
    schema = f"name string, html string, sel {H.SELECTOR_TYPE}"
    for name, html, selector, elements, text in CASES:
        rows = spark.createDataFrame([(name, html, H.selector_value(selector))], schema)
        chosen = H.Selector.column(F.col("sel")) if held else selector
        got = rows.select(H.select_all(F.col("html"), chosen).alias("all"), H.select_text(F.col("html"), chosen).alias("text")).first()
        assert (got["all"], got["text"]) == (elements, text), name


def test_tokens_lose_nothing(spark):
    pieces = ["<div>", "</div>", "<!-- c -->", "x", "<", ">", '"', "'", "<p a='>'>", "<script>1<2</script>", "<br/>", "<!", "&amp;", "<di"]
    draw = random.Random(5)
    texts = ["".join(draw.choice(pieces) for _ in range(30)) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "html string")
    for selector in ("div", ".a"):
        step = H.compile_selector(selector)[0]
        joined = F.array_join(F.regexp_extract_all("html", F.lit(step.tokens), F.lit(0)), "")
        assert rows.where(joined != F.col("html")).count() == 0


class Depth(HTMLParser):
    """Text under div.content by counting divs, with the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        if tag == "div" and (self.depth or "content" in (dict(attrs).get("class") or "").split()):
            self.depth += 1

    def handle_endtag(self, tag):
        if tag == "div" and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if self.depth:
            self.out.append(data)


def test_against_a_depth_count(spark):
    pieces = ['<div class="content">', "<div>", "</div>", "<b>", "</b>", " word ", "&amp;", "<!-- <div> -->", '<i title="</div>">', "<p>"]
    draw = random.Random(11)
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(1, 40))) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, html string")
    got = {r["n"]: r["text"] for r in rows.select("n", H.select_text(F.col("html"), "div.content").alias("text")).collect()}
    for n, text in enumerate(texts):
        parser = Depth()
        parser.feed(text)
        parser.close()
        assert re.sub(r"\s", "", got[n]) == re.sub(r"\s", "", "".join(parser.out)), text


PIECES = ['<li class="k">', "<li>", "</li>", "<ul>", "</ul>", '<p class="k">', "</p>", '<div class="k">', "<div>", "</div>", '<td class="k">',
          "<tr>", "</tr>", "<table>", "</table>", "<a class=k href=/x/>", "</a>", "<a class=k/>", '<b title="', '">', "<!-- ", " -->", "<!x>",
          "<script>", "</script>", "text", "<", "</3", "<img class=k>", "<a class='k' href=</a>", "<br/>", "'", "<DIV CLASS='x k'>", "</Div >"]
SOME = ("li.k", "p.k", "div.k", "td.k", "a.k", "img.k", "div", "tr", ".k", "div.k li", "tr .k")


def _draw(seed, n, most=25):
    draw = random.Random(seed)
    return ["".join(draw.choice(PIECES) for _ in range(draw.randint(1, most))) for _ in range(n)]


def test_both_ways_find_the_same(spark, monkeypatch):
    rows = spark.createDataFrame(list(enumerate(_draw(23, 3000))), "n int, html string").repartition(8)

    def found():
        columns = [F.struct(H.select_outer(F.col("html"), one), H.select_all(F.col("html"), one)).alias(f"s{i}")
                   for i, one in enumerate(SOME)]
        return rows.select("n", "html", *columns)

    usual = {row["n"]: row for row in found().collect()}
    monkeypatch.setattr(H, "_or_whole", lambda html, step, usable, general: H.sql_let("page", html, general))
    for row in found().collect():
        assert row == usual[row["n"]], row["html"]


MORE = ['<dl>', '</dl>', '<dt class="k">', '</dt>', '<dd class="k">', '</dd>', '<th class="k">', '</th>', '<td class="k">', '</td>', '<tr class="k">', '</tr>',
        '<thead>', '</tbody>', '<tbody/>', '<table>', '</table >', '<table/>', '<select>', '</select>', '<option class=k>', '</option >', '<optgroup>',
        '<p class="k">', '<hr>', '</div>', '<h1>', '<td class=k href=a/>', 'text', '<', '<li x="', '">', '<!-- -->', '</3>']


def test_both_ways_without_closing_tags(spark, monkeypatch):
    draw = random.Random(37)
    texts = ["".join(draw.choice(MORE) for _ in range(draw.randint(1, 14))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, html string").repartition(8)

    def found():
        columns = [F.struct(H.select_outer(F.col("html"), one), H.select_all(F.col("html"), one)).alias(f"s{i}")
                   for i, one in enumerate(("dt.k", "dd.k", "th.k", "td.k", "tr.k", "option.k", "p.k"))]
        return rows.select("n", "html", *columns)

    usual = {row["n"]: row for row in found().collect()}
    monkeypatch.setattr(H, "_or_whole", lambda html, step, usable, general: H.sql_let("page", html, general))
    for row in found().collect():
        assert row == usual[row["n"]], row["html"]


def test_one_pattern_finds_elements_without_closing_tags(spark):
    page = "<table><tbody><tr class=r><td class=k>a<td><table><tr class=r><td>b</table>c<tr class=r><td class=k>d</tbody></table>"
    rows = spark.createDataFrame([(page,)], "html string")
    for selector, expected in (("tr.r", ["<tr class=r><td class=k>a<td><table><tr class=r><td>b</table>c", "<tr class=r><td class=k>d"]),
                               ("td.k", ["<td class=k>a", "<td class=k>d"])):
        whole = F.regexp_extract_all("html", F.lit(H.compile_selector(selector)[0].whole), F.lit(1))
        assert rows.select(F.filter(whole, lambda one: one != "")).first()[0] == expected


def test_later_markup_changes_no_complete_row(spark):
    """Whatever follows a list, its rows stay the same."""
    lists = ['<ul><li class="k">a<li class="k">b <b class="k">c</b></ul>', '<ul><li class="k">a</li><li class="k"><a class=k href=/x/>t</a></li></ul>',
             '<table><tr><td class="k">a<td class="k">b<tr><td class="k">c<p class="k">d</table>', '<div class="k"><div>a</div></div><p class="k">b</p>']
    tails = _draw(29, 400)
    rows = spark.createDataFrame([(n % 4, lists[n % 4], tail) for n, tail in enumerate(tails)], "n int, html string, tail string")
    for selector in SOME:
        alone, longer = (H.select_all(page, selector) for page in (F.col("html"), F.concat("html", "tail")))
        changed = rows.where(F.slice(longer, F.lit(1), F.size(alone)) != alone)
        assert changed.count() == 0, (selector, changed.first())


class Lists(HTMLParser):
    """Text of the outermost list items by a stack, with the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.out = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "li":
            if self.open and self.open[-1] == "li":
                self.open.pop()
            if "li" not in self.open:
                self.out.append("")
        self.open.append(tag)

    def handle_endtag(self, tag):
        if tag == "li" and self.open and self.open[-1] == "li":
            self.open.pop()
        elif tag == "ul" and "ul" in self.open:
            while self.open.pop() != "ul":
                pass

    def handle_data(self, data):
        if "li" in self.open:
            self.out[-1] += data


def test_lists_against_a_stack(spark):
    draw, texts = random.Random(31), []
    for _ in range(500):
        # No list is closed that was not opened; any may stay open.
        text, depth = "", 0
        for _ in range(draw.randint(1, 30)):
            piece = draw.choice(["<ul>", "</ul>", "<li>", "<li>", "</li>", "word"]) if depth else "<ul>"
            depth += {"<ul>": 1, "</ul>": -1}.get(piece, 0)
            text += piece
        texts.append(text)
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, html string")
    got = rows.select("n", F.transform(H.select_outer(F.col("html"), "li"), H.text_of).alias("texts")).collect()
    for row in got:
        parser = Lists()
        parser.feed(texts[row["n"]])
        parser.close()
        assert [re.sub(r"\s", "", text) for text in row["texts"]] == parser.out, texts[row["n"]]


def test_long_input_is_no_problem(spark):
    html = "<div class='content' data-x='" + "y" * 200_000 + "'>" + "<p>text</p>" * 20_000 + "</div>"
    rows = spark.createDataFrame([(html,)], "html string")
    assert rows.select(F.length(H.select_first(F.col("html"), "div.content")).alias("n")).first()["n"] == len(html)


def test_attributes(spark):
    html = "<a data-href='no' title=\"href='no'\" HREF = \"/q?x=1&amp;y=2\">n</a>"
    rows = spark.createDataFrame([(html,)], "html string")
    got = rows.select(H.attribute(F.col("html"), "href").alias("href"), H.attribute(F.col("html"), "rel").alias("rel")).first()
    assert (got["href"], got["rel"]) == ("/q?x=1&y=2", "")


@pytest.mark.parametrize("selector", ["h2 > a", "a[href]", "a:first-child", "script", "a b c", "", "*"])
def test_other_selectors_are_refused(selector):
    with pytest.raises(H.SelectorError):
        H.compile_selector(selector)
