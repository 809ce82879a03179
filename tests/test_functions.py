"""Text, URL and content functions against the standard library."""

import hashlib
import random
import re
from urllib.parse import quote, urljoin

from pyspark.sql import functions as F

from paperloom.functions import content as C
from paperloom.functions import formats, text as T, urls as U


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_canonical_identifier(spark):
    samples = ["  ir - sc – 00004740  ", "adj— 1", "A\x1cB - C", "straße", " x　y "]

    got = values(spark, [(s,) for s in samples], "t string", T.canonical_identifier(F.col("t")))
    assert [g[0] for g in got] == ["IR-SC-00004740", "ADJ-1", "A B-C", "STRASSE", "X Y"]


def test_entities(spark):
    text = "a &amp; b &copy;x &foo; &#233; &#xe9 &#x1F600; &#0; &lt;p&gt; & &amp &#99999999999; &#0000000065; &apos;"
    got = values(spark, [(text,)], "t string", T.decode_entities(F.col("t")))
    assert got[0][0] == "a & b ©x &foo; é é \U0001f600 � <p> & &amp � A '"


def test_links_resolve_like_the_standard_library(spark):
    bases = ["http://a.b/c/d?q=1#f", "http://a.b", "http://a.b/", "https://a.b/x/y/", "http://a/b/c/d;p?q"]
    parts = ["", ".", "..", "a", "b c", "é", "x*y", "50%", "a~b", "q?x=1&y=2", "#f", "%2F"]
    draw = random.Random(3)
    refs = ["", "/", "//h/x", "http://z/..", "mailto:x@y", "?y", "/../g", "../../../g", "g/../h", ".."]
    refs += ["/" * draw.randint(0, 1) + "/".join(draw.choice(parts) for _ in range(draw.randint(1, 5))) for _ in range(300)]
    refs = [r for r in refs if not r.startswith("//") or r == "//h/x"]
    pairs = [(b, r) for b in bases for r in refs]
    got = values(spark, pairs, "b string, r string", F.col("b"), F.col("r"), U.link_target(F.col("b"), F.col("r")))
    wrong = [(b, r, u) for b, r, u in got if u != urljoin(b, quote(r.strip(), safe="/:?&=%~"))]
    assert wrong == []


def test_query_parameters_keep_their_place(spark):
    url = "https://w.example.org/shelf?kind=9&room=4&to=x&blank="
    built = U.with_query(F.col("u"), [(F.lit("from"), F.lit("01/01/2026")), (F.lit("to"), F.lit("31/01/2026")),
                                      (F.lit("pageNumber"), F.lit("2"))])
    got = values(spark, [(url,)], "u string", built)
    assert got[0][0] == ("https://w.example.org/shelf?kind=9&room=4&to=31/01/2026"
                         "&from=01/01/2026&pageNumber=2")


def test_document_types(spark):
    rows = [("https://x/a.PDF", None), ("https://x/a.htm?y=.doc", None), ("https://x/a.b/c", "application/PDF; q=1"),
            ("https://x/a.zip", "application/msword"), ("https://x.pdf", "image/png"), ("https://x/a.docx", "text/html")]
    got = values(spark, rows, "u string, c string", formats.document_type(F.col("u"), F.col("c")))
    assert [g[0] for g in got] == ["pdf", "html", "pdf", "doc", None, "docx"]


def test_comments_go_byte_by_byte(spark):
    samples = [b"<p>\xff\xfe<!-- a\nb --> \x80</p><!-- c -->", b"<!-- open", b"", b"a<!-->b-->c"]
    got = values(spark, [(bytearray(s),) for s in samples], "c binary", C.without_comments(F.col("c")), C.content_hash(F.col("c")))
    for sample, (stable, digest) in zip(samples, got):
        assert bytes(stable) == re.sub(rb"<!--.*?-->", b"", sample, flags=re.S)
        assert digest == hashlib.sha256(sample).hexdigest()


def test_quoting_keeps_what_stays(spark):
    texts = ["", "plain-._~/x", "a b", "a+b*c", "%2F%7e~", "ä/ß?&=:", "100%", "x=1&y=2#z", "\n", "[a]", "a\\b", "€"]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = rows.select(*[U.quote(F.col("t"), safe) for safe in (U.LINK_SAFE, U.QUERY_SAFE, "")]).collect()
    for text, row in zip([*texts, None], got):
        assert list(row) == [None if text is None else quote(text, safe=safe) for safe in (U.LINK_SAFE, U.QUERY_SAFE, "")]
