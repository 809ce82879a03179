"""Secret scan with linking of credential parts.

Strong findings stand alone: assignments of a long value, access ids and long
hex strings. Weak candidates do not: a named account, a short or unnamed
secret, an address with a scheme. Parts belong to a scope, a stretch of one
document: each candidate covers ``SCOPE`` characters to either side, and is
reported only if complementary parts lie in that interval: a weak secret with
an identifier, an identifier with a secret, an endpoint with both.

The interval join runs on bins of ``SCOPE`` characters. Parts are first summed
to one row per document, bin and role with the first start and the last end,
which is all that overlap with an interval asks; a candidate meets the few
bins it reaches, so a document with very many parts makes no pairs.

Positions are in code points, ends exclusive. Several matches of one kind are
found left to right without overlap.

Defined results: null and empty texts have no findings; a null id is an id of
its own; repeated rows are scanned one by one; other columns are passed on
(columns with the names of results are replaced); an empty table gives an
empty result. Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.base import fresh, keep, query, table

SCOPE = 200
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"      # AKIA[A-Z0-9]+ of 16 and more: a longest run either way
HEX = r"[0-9a-f]{32,}"
IDENT = r"""\b(?i:user(?:_?name)?|login|account(?:_?id)?|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9][A-Za-z0-9+/_.@=-]+"""
UNNAMED = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/_-])"
ENDPOINT = r"\b[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~%:@\[\]-]+(?:/[A-Za-z0-9._~%/?&=+:@-]*)?"
LONG_VALUE, SHORT_VALUE = 8, 4
# In the order of equal starts.
KINDS = ["assign", "access", "hex", "ident", "weak", "endpoint"]
NONE = "array<struct<start: int, end: int, size: int>>"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """(start, end, size of the group) of all matches, from the lengths of what lies between them."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found, lambda x: F.length(x))
    parts = F.zip_with(F.slice(F.transform(between, lambda x: F.length(x)), 1, F.size(found)),
                       F.arrays_zip(F.transform(found, lambda x: F.length(x)).alias("n"), sizes.alias("size")),
                       lambda gap, m: F.struct(gap.alias("gap"), m["n"].alias("n"), m["size"].alias("size")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(NONE).alias("out"))

    def step(done, p):
        begin = done["at"] + p["gap"]
        row = F.struct(begin.alias("start"), (begin + p["n"]).alias("end"), p["size"].alias("size"))
        return F.struct((begin + p["n"]).alias("at"), F.concat(done["out"], F.array(row)).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(parts, start, step, lambda done: done["out"])).otherwise(F.array().cast(NONE))


def scanned(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``, without its text: doc_id, mark (hash of the text) and the matches of every kind as arrays."""
    text = F.coalesce("text", F.lit(""))
    first = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.inline_outer(F.array(F.struct(
        matches(text, ASSIGN, 2).alias("assigned"), matches(text, ACCESS).alias("access"), matches(text, HEX).alias("hex"),
        matches(text, IDENT).alias("ident"), matches(text, UNNAMED).alias("unnamed"), matches(text, ENDPOINT).alias("endpoint")))))
    return (first.withColumn("assign", F.filter("assigned", lambda m: m["size"] >= LONG_VALUE))
            .withColumn("short", F.filter("assigned", lambda m: m["size"].between(SHORT_VALUE, LONG_VALUE - 1))).drop("assigned"))


def parts(rows: DataFrame) -> DataFrame:
    """(doc_id, mark, kind, role, weak, start, end) of all parts; roles are i, s and e."""
    def of(column: str, kind: int, role: str, weak: bool) -> Column:
        return F.transform(column, lambda m: F.struct(F.lit(kind).alias("kind"), F.lit(role).alias("role"), F.lit(weak).alias("weak"),
                                                      m["start"].alias("start"), m["end"].alias("end")))

    every = F.concat(of("assign", 0, "s", False), of("access", 1, "i", False), of("hex", 2, "s", False), of("ident", 3, "i", True),
                     of("short", 4, "s", True), of("unnamed", 4, "s", True), of("endpoint", 5, "e", True))
    return rows.select("doc_id", "mark", F.inline(every)).distinct()


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts of ``parts`` with the complementary roles in their scope."""
    touched = found.select("doc_id", "mark", "role", "start", "end", F.explode(F.sequence(
        F.expr(f"start div {scope}").cast("long"), F.expr(f"(end - 1) div {scope}").cast("long"))).alias("bin"))
    bins = touched.groupBy("doc_id", "mark", "bin", "role").agg(F.min("start").alias("low"), F.max("end").alias("high"))
    weak = found.where("weak").select("doc_id", "mark", "kind", F.col("role").alias("mine"), "start", "end", F.explode(F.sequence(
        F.expr(f"greatest(start - {scope}, 0) div {scope}").cast("long"), F.expr(f"(end + {scope} - 1) div {scope}").cast("long"))).alias("bin"))
    w, b = weak.alias("w"), bins.alias("b")
    near = w.join(b, F.col("w.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("w.mark") == F.col("b.mark")) & (F.col("w.bin") == F.col("b.bin"))
                  & (F.col("mine") != F.col("role")) & (F.col("low") < F.col("end") + scope) & (F.col("high") > F.col("start") - scope))
    roles = near.groupBy("w.doc_id", "w.mark", "kind", "mine", "start", "end").agg(
        F.max((F.col("role") == "i").cast("int")).alias("i"), F.max((F.col("role") == "s").cast("int")).alias("s"), F.max((F.col("role") == "e").cast("int")).alias("e"))
    whole = "(mine = 's' AND i = 1) OR (mine = 'i' AND s = 1) OR (mine = 'e' AND i = 1 AND s = 1)"
    return roles.where(whole).select("doc_id", "mark", "kind", "start", "end", (F.col("e") == 1).alias("endpoint_near"))


def findings(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: doc_id, mark, ``base`` and ``linked``, sorted arrays of (start, kind number, end).

    Texts are read and matched once; their matches are kept as a table.
    """
    rows, _ = keep(scanned(docs), "matches")
    weak = linked(parts(rows), scope).groupBy("doc_id", "mark").agg(
        F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("linked"))

    def of(column: str, kind: int) -> Column:
        return F.transform(column, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))

    base = F.array_sort(F.concat(of("assign", 0), of("access", 1), of("hex", 2)))
    d, w = rows.select("doc_id", "mark", base.alias("base")).alias("d"), weak.alias("w")
    joined = d.join(w, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.mark") == F.col("w.mark")), "left")
    return joined.select("d.doc_id", "d.mark", "base", F.coalesce("linked", F.array().cast("array<struct<start: int, kind: int, end: int>>")).alias("linked"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` plus ``base`` and ``linked``: sorted arrays of (start, kind number, end)."""
    columns = [c for c in docs.columns if c.lower() not in ("base", "linked")]
    mark, = fresh([*docs.columns, "base", "linked"], "mark")
    d, f = docs.select(*columns).withColumn(mark, F.xxhash64("text")).alias("d"), findings(docs, scope).dropDuplicates(["doc_id", "mark"]).alias("f")
    joined = d.join(f, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col(f"d.{mark}") == F.col("f.mark")))
    return joined.select(*[F.col(f"d.{c}") for c in columns], "f.base", "f.linked")


def spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = findings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    every = F.array_sort(F.concat("base", "linked"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(kinds).cast("long") - F.size(F.array_remove(kinds, i)) for i in range(3)]
    return found.select("doc_id", *[n.alias(f"n_{kind}") for n, kind in zip(counts, KINDS)], F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(every).alias("spans"),
                        F.size("linked").cast("long").alias("n_linked"))
