"""Vector codes by parts: clustering rounds that skip distances by norm-of-sum bounds.

A vector's components become integers and the vector is cut into equal parts;
each part position has a codebook, and a part's code is the index of its
nearest entry. Rounds assign all parts, then move every entry to the mean of
its parts. All arithmetic is on integers and therefore exact.

What makes a round cheap are bounds on distances, kept with each part: an upper
one to its own entry and a lower one to each group of the other entries. Every
bound has a stamp, the round in which it was a real distance. The history of
the codebooks is kept, so a bound of round s is brought to round t by the
distance between an entry's places in s and t. That net displacement is never
longer than the sum of the steps between (and shorter where an entry turns
back), so bounds hold longer than those that add up drifts. Only where the
bounds can't tell, the distance to the own entry is taken anew, and then groups
that may still hold a nearer entry are scanned exactly.

The rows carry their bounds from round to round in a written table, in map-only
jobs; sums of the entries are updated by the parts that changed, so only one
small row a task is added up. Codebooks (entries times dimension) and their
history are all that the driver sees.

Defined results: rows whose vector is null or has null, NaN or infinite
components are left out. The dimension is that of the longest vector, rounded
up to a multiple of the parts; shorter vectors count as padded with zeros. Seeds
are the first vectors by (vec_id, vector), null ids last; repeated ids are rows
of their own; with fewer rows than entries there are as many entries as rows.
Equal distances go to the lower index. An empty table gives no rows. Other
columns are not read. Vectors so large that a squared distance does not fit
into 63 bits raise an OverflowError.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.base import by_batch, forget, keep, query, table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
GROUPS = 4           # lower bounds per part
GUARD = 1e-9         # relative; far more than the rounding of a square root
FAR = np.iinfo(np.int64).max
PORTION = 4 << 20


class Compressed(NamedTuple):
    rows: DataFrame              # vec_id, label, code (a byte per part), error
    history: list[np.ndarray]    # codebooks of each round, the last one is final: part, entry, position
    scans: list[int]             # distances that each assignment computed


class Shape(NamedTuple):
    parts: int
    width: int    # components of a part
    scale: int
    small: bool   # squared distances are exact in doubles

    @property
    def dimension(self) -> int:
        return self.parts * self.width


def finite(vector: str | Column) -> Column:
    """Neither null nor with a null, NaN or infinite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False))


def integers(vectors: pa.Array, shape: Shape) -> np.ndarray:
    """floor(scale * x) of every component, padded to the dimension."""
    lengths = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * shape.scale).astype(np.int64)
    if (lengths == shape.dimension).all():
        return flat.reshape(-1, shape.dimension)
    out = np.zeros((len(lengths), shape.dimension), np.int64)
    out[np.arange(shape.dimension) < lengths[:, None]] = flat
    return out


def squares(x: np.ndarray, book: np.ndarray, small: bool) -> np.ndarray:
    """Exact squared distances of rows to entries."""
    if small:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - entry) ** 2).sum(1) for entry in book], axis=1)


def _below(values: np.ndarray) -> np.ndarray:
    return np.nextafter((values * (1 - GUARD)).astype(np.float32), np.float32(-np.inf))


def _above(values: np.ndarray) -> np.ndarray:
    return np.nextafter((values * (1 + GUARD)).astype(np.float32), np.float32(np.inf))


class Bounds:
    """What is known of one part of many rows: its entry, an upper and several lower bounds, and their stamps."""

    def __init__(self, code, near, near_round, low, low_round):
        self.code, self.near, self.near_round, self.low, self.low_round = code, near, near_round, low, low_round


def groups_of(entries: int) -> list[slice]:
    step = -(-entries // GROUPS)
    return [slice(a, min(a + step, entries)) for a in range(0, entries, step)]


def assign_all(x: np.ndarray, book: np.ndarray, now: int, small: bool) -> tuple[Bounds, int]:
    """The first round: all distances."""
    d = squares(x, book, small)
    rows = np.arange(len(x))
    code = d.argmin(1)
    near = _above(np.sqrt(d[rows, code].astype(np.float64)))
    d[rows, code] = FAR
    low = np.stack([_below(np.sqrt(d[:, g].min(1).astype(np.float64))) for g in groups_of(len(book))], axis=1)
    stamp = np.full(low.shape, now, np.uint8)
    return Bounds(code.astype(np.uint8), near, stamp[:, 0].copy(), low, stamp), d.size


def assign(x: np.ndarray, known: Bounds, books: np.ndarray, now: int, small: bool) -> int:
    """Bring ``known`` to round ``now``; ``books`` are all codebooks of this part so far. Returns the distances computed."""
    book, groups = books[now], groups_of(books.shape[1])
    moved = np.sqrt(((books[: now + 1] - book).astype(np.float64) ** 2).sum(2)) * (1 + GUARD)  # round, entry
    most = np.stack([moved[:, g].max(1) for g in groups], axis=1)                               # round, group
    low = known.low - most[known.low_round, np.arange(len(groups))]
    near = known.near + moved[known.near_round, known.code]
    unsure = np.flatnonzero((near[:, None] * (1 + GUARD) >= low).any(1))
    if not len(unsure):
        return 0
    part, old = x[unsure], known.code[unsure].astype(np.int64)
    rows = np.arange(len(unsure))
    own = ((part - book[old]) ** 2).sum(1)
    own_root = np.sqrt(own.astype(np.float64))
    known.near[unsure], known.near_round[unsure] = _above(own_root), now
    low = low[unsure]
    open_ = own_root[:, None] * (1 + GUARD) >= low
    d = np.full((len(unsure), len(book)), FAR)
    scans = len(unsure)
    for g, entries in enumerate(groups):
        which = np.flatnonzero(open_[:, g])
        d[which, entries] = squares(part[which], book[entries], small)
        scans += len(which) * (entries.stop - entries.start)
    d[rows, old] = own
    new = d.argmin(1)
    changed = new != old
    best = d[rows, new]
    known.code[unsure] = new
    known.near[unsure] = _above(np.sqrt(best.astype(np.float64)))
    d[rows, new] = FAR
    for g, entries in enumerate(groups):
        # scanned groups have true distances now; the group that an entry was left in gets that entry back
        left = changed & (old >= entries.start) & (old < entries.stop) & ~open_[:, g]
        exact = open_[:, g] | left
        least = _below(np.sqrt(d[:, entries].min(1).astype(np.float64)))
        value = np.where(left, np.minimum(least, _below(low[:, g])), least)
        at = unsure[exact]
        known.low[at, g], known.low_round[at, g] = value[exact], now
    return scans


STATE = "ints binary, code binary, near binary, low binary, stamps binary, moved array<bigint>, scans bigint"


def _rows_of(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Equally long binary values as rows of an array."""
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
    return np.frombuffer(data.tobytes(), dtype).reshape(-1, width).copy()


def _binary(values: np.ndarray) -> pa.Array:
    width = values.dtype.itemsize * values.shape[1]
    bounds = np.arange(len(values) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


class _Layout:
    """A row's bounds as bytes."""

    def __init__(self, shape: Shape, entries: int):
        self.shape, self.groups = shape, len(groups_of(entries))

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, list[Bounds]]:
        parts, groups = self.shape.parts, self.groups
        raw = batch.column("ints")
        wide = len(raw[0].as_py()) // self.shape.dimension
        x = _rows_of(raw, f"<i{wide}", self.shape.dimension).astype(np.int64)
        code = _rows_of(batch.column("code"), np.uint8, parts)
        near = _rows_of(batch.column("near"), "<f4", parts)
        low = _rows_of(batch.column("low"), "<f4", parts * groups).reshape(-1, parts, groups)
        stamps = _rows_of(batch.column("stamps"), np.uint8, parts * (1 + groups)).reshape(-1, parts, 1 + groups)
        return x, [Bounds(code[:, k].copy(), near[:, k].copy(), stamps[:, k, 0].copy(), low[:, k].copy(), stamps[:, k, 1:].copy()) for k in range(parts)]

    def write(self, x: np.ndarray, known: list[Bounds], int_type: str) -> list[pa.Array]:
        n = len(x)
        stamps = np.stack([np.concatenate([b.near_round[:, None], b.low_round], axis=1) for b in known], axis=1)
        return [_binary(x.astype(int_type)), _binary(np.stack([b.code for b in known], axis=1)),
                _binary(np.stack([b.near for b in known], axis=1)),
                _binary(np.stack([b.low for b in known], axis=1).reshape(n, -1)), _binary(stamps.reshape(n, -1))]


class _Moves:
    """Changes of the entries' sums and counts, from one task's rows."""

    def __init__(self, shape: Shape, entries: int):
        self.sums = np.zeros((shape.parts, entries, shape.width + 1), np.int64)
        self.scans = 0

    def add(self, part: int, x: np.ndarray, old: np.ndarray | None, new: np.ndarray) -> None:
        if old is not None:
            which = np.flatnonzero(old != new)
            x, old, new = x[which], old[which], new[which]
        for sign, codes in ((1, new), (-1, old)):
            if codes is not None:
                for entry in np.unique(codes):
                    chosen = x[codes == entry]
                    self.sums[part, entry, :-1] += sign * chosen.sum(0)
                    self.sums[part, entry, -1] += sign * len(chosen)


def _first_round(rows: DataFrame, book: np.ndarray, shape: Shape, int_type: str) -> DataFrame:
    """(vec_id, label, STATE) with every part assigned to a seed; one more row per task holds the sums."""
    layout = _Layout(shape, book.shape[1])

    def work(batches):
        moves, ids = _Moves(shape, book.shape[1]), None
        for batch in batches:
            ids = [batch.schema.field(0).type, batch.schema.field(1).type]
            x = integers(batch.column(2), shape)
            known = []
            for k in range(shape.parts):
                part = x[:, k * shape.width:(k + 1) * shape.width]
                bounds, scans = assign_all(part, book[k], 0, shape.small)
                moves.add(k, part, None, bounds.code)
                moves.scans += scans
                known.append(bounds)
            yield _state(batch, layout.write(x, known, int_type))
        if ids:
            yield _sums(ids, moves)

    return by_batch(rows, work, _schema(rows), PORTION)


def _next_round(state: DataFrame, history: list[np.ndarray], shape: Shape, int_type: str) -> DataFrame:
    """The state after the assignment to the last codebooks of ``history``."""
    layout, books, now = _Layout(shape, history[0].shape[1]), np.stack(history, axis=1), len(history) - 1

    def work(batches):
        moves, ids = _Moves(shape, books.shape[2]), None
        for batch in batches:
            ids = [batch.schema.field(0).type, batch.schema.field(1).type]
            x, known = layout.read(batch)
            for k, bounds in enumerate(known):
                part, old = x[:, k * shape.width:(k + 1) * shape.width], bounds.code.copy()
                moves.scans += assign(part, bounds, books[k], now, shape.small)
                moves.add(k, part, old, bounds.code)
            yield _state(batch, layout.write(x, known, int_type))
        if ids:
            yield _sums(ids, moves)

    return by_batch(state.where("moved IS NULL"), work, _schema(state), PORTION)


def _last_round(state: DataFrame, history: list[np.ndarray], shape: Shape) -> DataFrame:
    """(vec_id, label, code, error, scans) by the final codebooks."""
    layout, books, now = _Layout(shape, history[0].shape[1]), np.stack(history, axis=1), len(history) - 1

    def work(batches):
        for batch in batches:
            x, known = layout.read(batch)
            error, scans = np.zeros(len(x), np.int64), 0
            for k, bounds in enumerate(known):
                part = x[:, k * shape.width:(k + 1) * shape.width]
                scans += assign(part, bounds, books[k], now, shape.small)
                error += ((part - books[k, now][bounds.code]) ** 2).sum(1)
            counted = np.zeros(len(x), np.int64)
            counted[:1] = scans
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _binary(np.stack([b.code for b in known], axis=1)),
                                              pa.array(error), pa.array(counted)], names=["vec_id", "label", "code", "error", "scans"])

    ids = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema.fields[:2])
    return by_batch(state.where("moved IS NULL"), work, f"{ids}, code binary, error bigint, scans bigint", PORTION)


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2]) + ", " + STATE


_NAMES = ["vec_id", "label", "ints", "code", "near", "low", "stamps", "moved", "scans"]


def _state(batch: pa.RecordBatch, columns: list[pa.Array]) -> pa.RecordBatch:
    n = batch.num_rows
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64())], names=_NAMES)


def _sums(ids: list[pa.DataType], moves: _Moves) -> pa.RecordBatch:
    none = pa.nulls(1, pa.binary())
    return pa.RecordBatch.from_arrays([pa.nulls(1, ids[0]), pa.nulls(1, ids[1]), none, none, none, none, none,
                                       pa.array([moves.sums.ravel()], pa.list_(pa.int64())), pa.array([moves.scans])], names=_NAMES)


def _added(state: DataFrame, shape: tuple[int, ...]) -> tuple[np.ndarray, int]:
    """Changes of all tasks, added up in Spark; as Python integers."""
    rows = state.where("moved IS NOT NULL")
    parts = rows.select(F.posexplode("moved").alias("place", "value")).groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out = np.zeros(int(np.prod(shape)), object)
    for r in parts.collect():  # one row for each component of the codebooks
        out[r.place] = int(r.value)
    return out.reshape(shape), rows.agg(F.coalesce(F.sum("scans"), F.lit(0))).first()[0]


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Compressed | None:
    """Codes and errors of all vectors of ``vectors(vec_id, embedding, label)``, and the codebooks. None if there is no vector."""
    spark = vectors.sparkSession
    element = vectors.schema["embedding"].dataType.elementType
    double = F.col("embedding") if isinstance(element, T.DoubleType) else F.col("embedding").cast("array<double>")
    fine = vectors.select("vec_id", "label", double.alias("embedding")).where(finite("embedding"))
    longest, largest = fine.agg(F.max(F.size("embedding")), F.max(F.array_max(F.transform("embedding", F.abs)))).first()
    if longest is None:
        return None
    width = max(1, -(-longest // parts))
    most = int((largest or 0.0) * scale) + 1
    if parts * width * (2 * most) ** 2 >= 1 << 63:
        raise OverflowError(f"components up to {largest} make squared distances beyond 63 bits")
    shape = Shape(parts, width, scale, 4 * width * most ** 2 < 1 << 53)
    int_type = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"

    seeds = fine.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    seed = integers(pa.array([r.embedding for r in seeds], pa.list_(pa.float64())), shape)
    history = [seed.reshape(len(seeds), parts, width).swapaxes(0, 1).copy()]
    state, at = keep(_first_round(fine.select("vec_id", "label", "embedding"), history[0], shape, int_type), "codes")
    totals, scans = np.zeros((parts, len(seeds), width + 1), object), []
    for step in range(rounds):
        if step:
            state, new = keep(_next_round(state, history, shape, int_type), "codes")
            forget(spark, at)
            at = new
        changes, scanned = _added(state, totals.shape)
        totals, scans = totals + changes, [*scans, scanned]
        book = history[-1].copy()
        used = totals[:, :, -1] > 0
        book[used] = (totals[used][:, :-1] // totals[used][:, -1:]).astype(np.int64)
        history.append(book)
    rows, _ = keep(_last_round(state, history, shape), "codes")
    forget(spark, at)
    scans.append(rows.agg(F.sum("scans")).first()[0])
    return Compressed(rows.drop("scans"), history, scans)


def decoded(codes: DataFrame, book: np.ndarray, scale: int = SCALE) -> DataFrame:
    """``codes`` with the vector that each code stands for."""
    parts = F.array(*[F.array(*[F.array(*[F.lit(float(x) / scale) for x in entry]) for entry in part]) for part in book])
    number = lambda k: F.conv(F.substring(F.hex("code"), 2 * k + 1, 2), 16, 10).cast("int")
    return codes.withColumn("embedding", F.concat(*[parts[k][number(k)] for k in range(len(book))]))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, x.part, any_value(x.x) x, arg_min(entry, d * {entries} + entry) entry, min(d) d FROM
            (SELECT rid, x.part, x.x, entry, CAST(list_sum([(x.x[i] - b.x[i]) * (x.x[i] - b.x[i]) FOR i IN range(1, len(x.x) + 1)]) AS HUGEINT) d
             FROM x JOIN b{r} b ON x.part = b.part) x GROUP BY rid, x.part)""")
        if r < rounds:
            steps.append(f"""m{r} AS MATERIALIZED (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) x FROM
            (SELECT part, entry, i, sum(v)::HUGEINT s, count(*)::HUGEINT n FROM (SELECT part, entry, unnest(x) v, generate_subscripts(x, 1) i FROM a{r}) GROUP BY ALL) GROUP BY ALL),
        b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) x FROM b{r} b LEFT JOIN m{r} m USING (part, entry))""")
    return f"""
    WITH e AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 rid, vec_id, label,
            [CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] v
        FROM embeddings WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
    x AS MATERIALIZED (SELECT rid, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] x FROM e, range({parts}) t(part)),
    b0 AS MATERIALIZED (SELECT part, rid entry, x FROM x WHERE rid < {entries}),
    {", ".join(steps)},
    coded AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) code, sum(d)::BIGINT error FROM a{rounds} GROUP BY rid),
    books AS (SELECT sha256(string_agg(v, ',' ORDER BY part, entry, i)) h FROM (SELECT part, entry, unnest(x)::VARCHAR v, generate_subscripts(x, 1) i FROM b{rounds}))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) label_error, h codebooks_sha256
    FROM coded JOIN e USING (rid), books"""


def book_hash(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


@query("op11_vector_codes", _sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compress(table(spark, sf_dir, "embeddings"))
    if found is None:
        return spark.createDataFrame([], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    sums = found.rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = found.rows.alias("r").join(sums.alias("s"), F.col("r.label").eqNullSafe(F.col("s.label")))
    return joined.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(book_hash(found.history[-1])).alias("codebooks_sha256"))
