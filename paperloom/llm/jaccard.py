"""N-gram Jaccard join with PartEnum signatures.

A document's set holds its distinct five-word shingles. Sets of Jaccard
similarity 3/4 or more differ in at most a seventh of their summed sizes. Sizes
are cut into bands whose neighbours are 3/4 apart, so that a pair lies in one
band or in two neighbouring ones; an instance serves one band and the next,
with at most k differences. The instance deals the domain of shingles into
n = k + t parts. A signature is one part of a set; as k differences touch at
most k parts, a pair shares at least t signatures (an empty part is one too).

From this follow two exact prunings. A set with fewer than t shared
signatures has no partner. And of its c shared ones only the c - t + 1 rarest
are needed: of t common signatures the rarest of a pair survives on both
sides. So signatures of a passage that very many documents share fall away,
unless documents consist of little else.

What is left are groups of sets with a common rare signature. In each group
the members are put in several random orders and each is compared with the
next one; almost all links of a group of copies fall into one component that
way, without all pairs. What is still apart is settled in blocks: members that
are outside the largest component of their group are a query set, which is
held against the whole group, a bounded block of sets against another in one
task. Only found links leave the task, so no link between components is lost
and no table of pairs is made. Comparison is exact, on the shingle hashes.

Equal sets are one class; a class is named by a 64-bit hash of its set, and
shingles are 64-bit hashes of their words.

Defined results: null, empty and blank texts have no shingles and are linked
with nothing, also not with each other; fewer than five words are one shingle;
rows with one id are one document, so their texts are linked with each other; a
null id keeps a null component but its text links others; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paperloom.llm import base
from paperloom.llm.base import forget, keep, query, table
from paperloom.llm.components import components
from paperloom.llm.words import LOWERED, codes_of, words

SHINGLE = 5
# Similarity 3/4. Of n parts at least this share is common to a pair.
SPARE = 0.3
ORDERS = 3
CHUNK = 1_000
# Signatures in one bucket; its task holds some 100 bytes for each while it sorts them.
BUCKET = 500_000
# Texts that are cut into shingles at a time, in bytes: a Python worker held some 460 MB for 8 MB of them.
PORTION = 1 << 20
# Shingles of a block of the query set and of a block that it is held against.
QUERY_BLOCK, MEMBER_BLOCK = 200_000, 800_000


def _bands(largest: int = 1 << 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First size of each band, and (k, t) of the instance that serves it and the next."""
    first, k = [], []
    low = 1
    while low < largest:
        high = low * 4 // 3
        first.append(low)
        k.append((high + high * 4 // 3) // 7)
        low = high + 1
    k = np.array(k)
    return np.array(first), k, np.ceil(SPARE * (k + 1)).astype(np.int64)


FIRST, DIFFERENCES, COMMON = _bands()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values without structure."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each text's set, text by text, and their bounds."""
    found = words(texts, LOWERED)
    one = np.array([xxhash.xxh3_64_intdigest(w) for w in found.distinct.to_pylist()], np.uint64)[found.codes]
    n = np.diff(found.bounds)
    doc = found.text_of()
    with np.errstate(over="ignore"):
        power = np.uint64(0x9E3779B97F4A7C15)
        factor = np.uint64(1)
        total = np.zeros(max(len(one) - size + 1, 0), np.uint64)
        for j in range(size):
            total += one[j:j + len(total)] * factor
            factor = factor * power + np.uint64(2)
        at = np.flatnonzero(doc[:len(total)] == doc[size - 1:]) if len(total) else np.zeros(0, np.int64)
        hashes, owner = mixed(total[at]), doc[at]
        for d in np.flatnonzero((n > 0) & (n < size)).tolist():
            few = one[found.bounds[d]:found.bounds[d + 1]]
            value = np.uint64(len(few))
            for w in few:
                value = mixed(value * power + w)
            hashes, owner = np.append(hashes, value), np.append(owner, d)
        code = codes_of(hashes ^ mixed(owner.astype(np.uint64) + power))
    first = np.zeros(int(code.max(initial=-1)) + 1, np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    first = first[np.argsort(owner[first], kind="stable")]
    counts = np.bincount(owner[first], minlength=len(n))
    return hashes[first], np.concatenate([[0], np.cumsum(counts)])


def class_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes), dtype=np.uint64)])
        return mixed(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, text) of all sets. The lowest byte of a signature is its instance."""
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    band = np.searchsorted(FIRST, n, side="right") - 1
    out, texts = [], []
    for shift in (0, 1):
        instance = band - shift
        parts = np.where((n > 0) & (instance >= 0) & (DIFFERENCES[instance] > 0), DIFFERENCES[instance] + COMMON[instance], 0)
        start = np.cumsum(parts) - parts
        mine = np.flatnonzero(parts[owner] > 0)
        part = (mixed(hashes[mine] + np.uint64(1)) % parts[owner[mine]].astype(np.uint64)).astype(np.int64)
        cells = np.zeros(int(parts.sum()), np.uint64)
        with np.errstate(over="ignore"):
            np.add.at(cells, start[owner[mine]] + part, mixed(hashes[mine]))
            text = np.repeat(np.arange(len(n)), parts)
            place = np.arange(len(cells)) - start[text]
            key = mixed(cells + mixed((place.astype(np.uint64) << np.uint64(8)) + instance[text].astype(np.uint64) + np.uint64(1)))
        out.append((key & ~np.uint64(0xFF)) | instance[text].astype(np.uint64))
        texts.append(text)
    return np.concatenate(out), np.concatenate(texts)


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, n_shingles, cls) of every row; mark is a hash of the text."""
    def work(batches):
        for batch in batches:
            hashes, bounds = shingle_sets(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(bounds)), pa.array(class_of(hashes, bounds))],
                                             names=["doc_id", "mark", "n_shingles", "cls"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    return base.by_batch(narrow, work, "doc_id long, mark long, n_shingles long, cls long", PORTION)


def shared_signatures(docs: DataFrame, buckets: int) -> DataFrame:
    """(cls, sig, n) of signatures that n > 1 classes have. Signatures travel in one packed row per slice and bucket."""
    def packed(batches):
        for batch in batches:
            hashes, bounds = shingle_sets(batch.column(0))
            cls = class_of(hashes, bounds)
            _, once = np.unique(cls, return_index=True)
            keepers = np.zeros(len(cls), bool)
            keepers[once] = True
            sig, text = signatures(hashes, bounds)
            sig, text = sig[keepers[text]], text[keepers[text]]
            bucket = ((sig >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((text, bucket))
            sig, text, bucket = sig[order], text[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows = []
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(sig)]):
                owners, counts = np.unique(text[a:b], return_counts=True)
                rows.append((int(bucket[a]), sig[a:b].tobytes(), cls[owners].tobytes(), counts.astype("<u4").tobytes()))
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] + [pa.binary()] * 3)], names=["bucket", "sigs", "owners", "counts"])

    def found(batches):
        sigs, owners = [], []
        for batch in batches:
            for s, o, c in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)]):
                sigs.append(np.frombuffer(s, np.uint64))
                owners.append(np.repeat(np.frombuffer(o, np.int64), np.frombuffer(c, "<u4")))
        if not sigs:
            return
        sig, cls = np.concatenate(sigs), np.concatenate(owners)
        del sigs, owners
        order = np.lexsort((cls, sig))
        sig, cls = sig[order], cls[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])
        sig, cls = sig[new], cls[new]
        _, at, n = np.unique(sig, return_inverse=True, return_counts=True)
        n = n[at]
        more = n > 1
        sig, cls, n = sig[more].view(np.int64), cls[more], n[more]
        for start in range(0, len(sig), 50_000):
            part = slice(start, start + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(cls[part]), pa.array(sig[part]), pa.array(n[part])], names=["cls", "sig", "n"])

    blobs = base.by_batch(docs.select("text"), packed, "bucket long, sigs binary, owners binary, counts binary", 4 << 20)
    return blobs.repartition(buckets, "bucket").mapInArrow(found, "cls long, sig long, n long")


def rare_signatures(shared: DataFrame) -> DataFrame:
    """(sig, cls, n): of each class and instance the rarest shared signatures, all that a pair needs."""
    instance = F.pmod(F.col("sig"), F.lit(256)).cast("int")
    least = F.element_at(F.array(*[F.lit(int(t)) for t in COMMON]), instance + 1)
    own = Window.partitionBy("cls", "instance")
    ranked = (shared.withColumn("instance", instance).withColumn("c", F.count("*").over(own))
              .withColumn("r", F.row_number().over(own.orderBy("n", "sig"))))
    return ranked.where(F.col("r") <= F.col("c") - least + 1).select("sig", "cls", "n")


def neighbours(groups: DataFrame, orders: int = ORDERS) -> DataFrame:
    """(a, b): in each of several random orders, each member of a group and the next.

    A large group is cut into ranges of the order, so no task gets it whole;
    another order has other ranges.
    """
    every = groups.select("sig", "cls", "n", F.explode(F.sequence(F.lit(1), F.lit(orders))).alias("o"))
    place = (F.xxhash64("o", "cls").cast("double") / float(1 << 64)) + 0.5
    every = every.withColumn("place", place).withColumn("chunk", F.floor(F.col("place") * (F.col("n") / CHUNK)).cast("long"))
    after = Window.partitionBy("sig", "o", "chunk").orderBy("place", "cls")
    pairs = every.withColumn("next", F.lead("cls").over(after)).where("next IS NOT NULL")
    return pairs.select(F.least("cls", "next").alias("a"), F.greatest("cls", "next").alias("b")).distinct()


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs of classes whose sets are similar enough."""
    a, b = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    joined = pairs.join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    near = 4 * F.least(F.size("set_a"), F.size("set_b")) >= 3 * F.greatest(F.size("set_a"), F.size("set_b"))
    return joined.where(near).where(7 * common >= 3 * (F.size("set_a") + F.size("set_b"))).select("a", "b")


def blocks(groups: DataFrame, roots: DataFrame, sets: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows for ``across``: each member of a group that is apart once per block it meets."""
    spark = groups.sparkSession
    inside = groups.join(roots, groups["cls"] == roots["node"], "left").select("sig", "cls", F.coalesce("root", "cls").alias("root"))
    apart = inside.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("cls").alias("first")).where("low <> high")
    split, split_path = keep(inside.join(apart.select("sig", "first"), "sig").select("cls", "root", "first").distinct(), "apart")
    wider = components(split.select(F.col("cls").alias("a"), F.col("first").alias("b")))
    members = split.select("cls", "root").distinct().join(wider.withColumnRenamed("root", "whole"), F.col("cls") == F.col("node")).drop("node")
    sized = members.join(sets, "cls").withColumn("size", F.size("set"))
    held, held_path = keep(sized, "members")
    shares = held.groupBy("whole", "root").agg(F.sum("size").alias("n"))
    largest = shares.groupBy("whole").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n"))
    plan = largest.select("whole", F.col("top.root").alias("main"), F.floor((F.col("n") - F.col("top.n")) / QUERY_BLOCK + 1).cast("int").alias("queries"),
                          F.floor(F.col("n") / MEMBER_BLOCK + 1).cast("int").alias("others"))
    every = held.join(plan, "whole")
    row = F.struct("cls", "root", "set")
    asked = every.where("root <> main").select("whole", row.alias("m"), F.lit(True).alias("query"), F.pmod(F.xxhash64("cls"), "queries").alias("q"),
                                               F.explode(F.expr("sequence(0L, others - 1L)")).alias("o"))
    others = every.select("whole", row.alias("m"), F.lit(False).alias("query"), F.explode(F.expr("sequence(0L, queries - 1L)")).alias("q"),
                          F.pmod(F.xxhash64("cls"), "others").alias("o"))
    return asked.unionByName(others).select("whole", "q", "o", "query", "m.cls", "m.root", "m.set"), [split_path, held_path]


def across(rows: DataFrame) -> DataFrame:
    """(a, b): links between components, one for each query and component that it reaches within its block."""
    def work(group):
        cls = group.column("cls").to_numpy()
        root, query = group.column("root").to_numpy(), group.column("query").to_numpy(zero_copy_only=False)
        lists = group.column("set").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(cls)), size)
        code = codes_of(lists.values.to_numpy()[lists.offsets[0].as_py():lists.offsets[-1].as_py()])
        other = ~query[owner]
        order = np.argsort(code[other], kind="stable")
        holder, held = owner[other][order], code[other][order]
        starts = np.searchsorted(held, np.arange(code.max(initial=-1) + 2))
        begin = np.concatenate([[0], np.cumsum(size)])
        a, b = [], []
        for x in np.flatnonzero(query).tolist():
            mine = code[begin[x]:begin[x + 1]]
            low, n = starts[mine], starts[mine + 1] - starts[mine]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            found = holder[np.repeat(low - ends + n, n) + np.arange(total)]
            common = np.bincount(found, minlength=len(cls))
            near = (7 * common >= 3 * (size[x] + size)) & (root != root[x]) & ~query
            hits = np.flatnonzero(near)
            _, once = np.unique(root[hits], return_index=True)
            a += [cls[x]] * len(once)
            b += cls[hits[once]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("whole", "q", "o").applyInArrow(work, "a long, b long")


def sets_of(docs: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, set) of the wanted classes, from one document of each."""
    one = rows.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min(F.struct("doc_id", "mark")).alias("r")).select("r.doc_id", "r.mark").distinct()

    def work(batches):
        for batch in batches:
            hashes, bounds = shingle_sets(batch.column(0))
            values = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(class_of(hashes, bounds)), values], names=["cls", "set"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text").alias("d")
    o = one.alias("o")
    texts = d.join(o, F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("d.mark") == F.col("o.mark")), "left_semi").select("text")
    return base.by_batch(texts, work, "cls long, set array<long>", PORTION).dropDuplicates(["cls"])


def same_documents(rows: DataFrame) -> DataFrame:
    """Links between the classes that rows of one id have: its least one with each other."""
    named = rows.where("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "cls")
    least = named.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("most")).where("a <> most")
    return named.join(least, "doc_id").where("cls <> a").select("a", F.col("cls").alias("b")).distinct()


def grouped(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, mark (hash of its text), n_shingles, root (of its group), component_id."""
    spark = docs.sparkSession
    rows, _ = keep(classes(docs), "classes")
    total = rows.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    buckets = max(total // BUCKET, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared, shared_path = keep(shared_signatures(docs, buckets), "signatures")
    groups, groups_path = keep(rare_signatures(shared), "rare")
    forget(spark, shared_path)
    sets, sets_path = keep(sets_of(docs, rows, groups.select("cls").distinct()), "sets")
    first, first_path = keep(linked(neighbours(groups), sets), "linked")
    roots = components(first)
    rows_apart, used = blocks(groups, roots, sets)
    second, second_path = keep(across(rows_apart), "linked")
    roots = components(first.unionByName(second).unionByName(same_documents(rows)))
    forget(spark, groups_path, sets_path, first_path, second_path, *used)

    named = rows.join(roots, rows["cls"] == roots["node"], "left").select("doc_id", "mark", "n_shingles", F.coalesce("root", "cls").alias("root"))
    lowest = named.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    joined = named.join(lowest, "root", "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "mark", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("root")).alias("root"), own.alias("component_id"))


def similar(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, mark (hash of its text), n_shingles, component_id."""
    return grouped(docs).drop("root")


def one_of_each(docs: DataFrame) -> DataFrame:
    """(doc_id, mark) of the row that stays of each group: the smallest id, null ids last, then the smallest hash.

    A document without shingles is in no group and stays.
    """
    found = grouped(docs).select("doc_id", "mark", "root")
    alone = found.where("root IS NULL").select("doc_id", "mark")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "mark")
    first = found.where("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("first")).select("first.doc_id", "first.mark")
    return first.unionByName(alone).distinct()


SQL = """
    WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w FROM documents),
    s AS (SELECT DISTINCT doc_id, w[i:i + 4] g FROM d, LATERAL (SELECT unnest(generate_series(1, greatest(len(w) - 4, 1))) i) WHERE len(w) > 0),
    n AS (SELECT doc_id, count(*) n FROM s GROUP BY 1),
    p AS (SELECT x.doc_id a, y.doc_id b, count(*) c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id v, doc_id u FROM documents UNION SELECT r.v, e.b FROM r JOIN e ON e.a = r.u)
    SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) n_shingles, m.c component_id
    FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT v, min(u) c FROM r GROUP BY 1) m ON m.v = d.doc_id"""


@query("op8_jaccard_join", SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "documents")).drop("mark")
