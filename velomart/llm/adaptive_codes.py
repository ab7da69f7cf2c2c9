"""Vector code compression: product codebooks by k-means with adaptive distance bounds.

Vectors become integers and are cut into parts; each part position has a codebook. Rounds
assign every part to its nearest entry and move the entries to the means of their parts.

Distances to all entries are needed only once. A part then keeps an upper bound of the
distance to its own entry, its b next entries in the order of their lower bounds, and one
outer bound below the distances of all others. When entries move, the bounds loosen by how
far. Where the upper bound stays below the first lower bound nothing is computed; where it
stays below the j-th, the own entry and the first j - 1 are compared; only beyond the outer
bound all are. The bounds are real numbers rounded to the safe side; whatever they leave
open is decided by exact integer distances, ties by the lower index, so the result is that
of comparing everything. b starts at ``START``. Where the outer bound failed for most parts
it doubles, up to ``MOST``; otherwise it shrinks to what nine tenths of the parts that the
bounds could help have needed in the last round.

The table of parts and bounds is written each round in place of the one before. Tasks sum
the parts of each entry before anything is shuffled, so the driver gets the codebooks only:
entries x components numbers, whatever the number of rows.

Rows: a null vector, or one with null or non-finite components, is left out. Rows that
share a vec_id are coded each; among the first rows of the codebooks they stand in the
order of their components. A null vec_id stands after all others. Fewer rows than entries
give fewer entries; an empty table gives no rows. Null labels are equal to each other.
Vectors of different lengths, of a length that does not divide by the number of parts, or
so large that a squared distance exceeds 62 bits raise ValueError. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.llm.select import cut
from velomart.llm.text import batch_of
from velomart.workspace import Tables, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries whose bounds a part keeps at first, at least and at most.
START, LEAST, MOST = 16, 4, 32
#: What a part needed when its bounds said nothing.
ALL = 255
#: Rows that are worked on at once.
AT_ONCE = 2048
#: Labels whose sums may be sent to every task; more are joined by key and salt.
FEW_LABELS, SALTS = 100_000, 32


def _down(x: np.ndarray) -> np.ndarray:
    """Half precision, never above x; infinity stays."""
    finite = np.nextafter(np.minimum(x, 65504).astype(np.float16), np.float16(-np.inf))
    return np.where(np.isinf(x), np.float16(np.inf), np.maximum(finite, np.float16(0)))


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def bounds_of(b: int) -> np.dtype:
    """What a part keeps: upper bound, outer bound, b entries and their lower bounds."""
    return np.dtype([("upper", "<f4"), ("outer", "<f2"), ("ids", "u1", (b,)), ("low", "<f2", (b,))])


class Codebook:
    """Entries of one part position, and exact distances to them.

    Integers are held as doubles where all sums of squares, with the index of an entry
    appended, stay below 2^53, and as 64-bit integers otherwise.
    """

    def __init__(self, entries: np.ndarray, largest: int):
        reach = 4 * entries.shape[1] * max(largest, 1) ** 2 * ENTRIES
        if reach >= 1 << 62:
            raise ValueError("components too large for exact 64-bit distances")
        self.kind = np.float64 if reach < 1 << 53 else np.int64
        self.entries = entries.astype(self.kind)
        self.squares = (self.entries**2).sum(1)

    def all(self, x: np.ndarray) -> np.ndarray:
        return (x**2).sum(1)[:, None] - 2 * (x @ self.entries.T) + self.squares

    def some(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of each row to its own list of entries."""
        gap = self.entries[ids] - x[:, None, :]
        return (gap * gap).sum(2)

    def moved(self, other: Codebook) -> np.ndarray:
        """How far each entry is from that of the other codebook, rounded up."""
        return np.sqrt(((self.entries - other.entries).astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)


def assign_all(book: Codebook, x: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries, and bounds, from all distances."""
    k = len(book.entries)
    kept = min(b, k - 1)
    keys = book.all(x) * ENTRIES + np.arange(k, dtype=book.kind)  # distance, then index
    if kept + 2 < k:
        keys = np.partition(keys, kept + 1, axis=1)[:, : kept + 2]
    keys = np.sort(keys, axis=1)
    ids = (keys % ENTRIES).astype(np.uint8)
    distance = np.sqrt((keys // ENTRIES).astype(np.float64))
    made = np.zeros(len(x), bounds_of(b))
    made["upper"], made["outer"], made["low"] = _up(distance[:, 0]), np.inf, np.inf
    made["ids"][:, :kept], made["low"][:, :kept] = ids[:, 1 : kept + 1], _down(distance[:, 1 : kept + 1])
    if kept + 1 < k:
        made["outer"] = _down(distance[:, kept + 1])
    return ids[:, 0], made


def _ordered(kept: np.ndarray) -> None:
    """Lower bounds so that none exceeds a later one, nor the outer bound."""
    chain = np.concatenate([kept["low"], kept["outer"][:, None]], axis=1)
    kept["low"] = np.minimum.accumulate(chain[:, ::-1], axis=1)[:, ::-1][:, :-1]


def assign_near(book: Codebook, before: Codebook, x: np.ndarray, code: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entries after the entries moved, new bounds, and how many entries were needed."""
    drift = book.moved(before)
    code, kept, b = code.copy(), kept.copy(), kept["ids"].shape[1]
    needed = np.zeros(len(x), np.uint8)
    kept["upper"] = _up(kept["upper"] + drift[code])
    kept["low"] = _down(kept["low"] - drift[kept["ids"]])
    kept["outer"] = _down(kept["outer"] - drift.max())
    _ordered(kept)
    first = kept["low"][:, 0] if b else kept["outer"]
    open_ = np.flatnonzero(kept["upper"] >= np.minimum(first, kept["outer"]))
    if not len(open_):
        return code, kept, needed
    own = book.some(x[open_], code[open_, None])[:, 0]
    kept["upper"][open_] = _up(np.sqrt(own.astype(np.float64)))
    upper = kept["upper"][open_]
    near = (kept["low"][open_] <= upper[:, None]).sum(1)
    far = upper >= kept["outer"][open_]
    needed[open_] = np.where(far, ALL, near)
    rows = open_[far]
    if len(rows):
        code[rows], kept[rows] = assign_all(book, x[rows], b)
    width, done = 1, 0
    while done < b:  # rows that need about as many entries together
        width = min(width, b)
        take = ~far & (near > done) & (near <= width)
        rows = open_[take]
        if len(rows):
            ids = np.concatenate([code[rows, None], kept["ids"][rows, :width]], axis=1)
            keys = book.some(x[rows], ids) * ENTRIES + ids.astype(book.kind)
            last = near[take]
            beyond = np.arange(1, width + 1) > last[:, None]
            # Entries beyond the needed ones keep their place and bound.
            order = keys.copy()
            order[:, 1:][beyond] = np.iinfo(np.int64).max if book.kind is np.int64 else np.inf
            order = np.argsort(order, axis=1, kind="stable")
            ids, keys = np.take_along_axis(ids, order, 1), np.take_along_axis(keys, order, 1)
            distance = np.sqrt((keys // ENTRIES).astype(np.float64))
            code[rows] = ids[:, 0]
            found = kept[rows]
            found["upper"] = _up(distance[:, 0])
            found["ids"][:, :width] = ids[:, 1:]
            found["low"][:, :width] = np.where(beyond, found["low"][:, :width], _down(distance[:, 1:]))
            _ordered(found)
            kept[rows] = found
        done, width = width, 2 * width
    return code, kept, needed


def resized(kept: np.ndarray, b: int) -> np.ndarray:
    """The bounds with b entries: fewer, whose others the outer bound then covers, or more.

    Additional places hold no entry yet. They carry the outer bound, so a part that would
    need them fails that bound too and compares all entries.
    """
    held = kept["ids"].shape[1]
    if b == held:
        return kept
    made = np.zeros(len(kept), bounds_of(b))
    if b > held:
        for name in ("upper", "outer"):
            made[name] = kept[name]
        made["ids"][:, :held], made["low"][:, :held] = kept["ids"], kept["low"]
        made["low"][:, held:] = kept["outer"][:, None]
        return made
    made["upper"], made["ids"], made["low"] = kept["upper"], kept["ids"][:, :b], kept["low"][:, :b]
    made["outer"] = np.minimum(kept["low"][:, b], kept["outer"])
    return made


# Tables

POINTS = "x binary, big long"
STATE = "x binary, code binary, needed binary, bounds binary"


def _rows(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Fixed-size binary values as rows of numbers."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), width)


def _cell(x: np.ndarray) -> bytes:
    """Integers of 32 bits as bytes of the same order."""
    return (x + (1 << 31)).astype(">u4").tobytes()


def _ints(column: pa.Array, width: int) -> np.ndarray:
    return _rows(column, ">u4", width).astype(np.int64) - (1 << 31)


def _with(batch: pa.RecordBatch, values: dict, schema: pa.Schema) -> pa.RecordBatch:
    return batch_of({"vec_id": batch.column("vec_id"), "label": batch.column("label")} | values, schema)


def _schemas(points: DataFrame, fields: str) -> tuple[str, pa.Schema]:
    """vec_id and label as they come, then ``fields``; for Spark and for Arrow."""
    from pyspark.sql.pandas.types import to_arrow_type

    types = {"binary": pa.binary(), "long": pa.int64()}
    own = [(f.name, to_arrow_type(f.dataType)) for f in points.schema if f.name in ("vec_id", "label")]
    more = [tuple(f.strip().split(" ")) for f in fields.split(",")]
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema if f.name in ("vec_id", "label"))
    return f"{names}, {fields}", pa.schema([*own, *((n, types[t]) for n, t in more)])


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, label, the integers of the kept vectors and the largest of them."""
    rows = vectors.where("embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    schema, arrow = _schemas(rows, POINTS)

    def run(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for i in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(i, AT_ONCE)
                column = batch.column("embedding")
                n = column.value_lengths().to_numpy(zero_copy_only=False)
                values = column.flatten()
                x = values.cast(pa.float64()).to_numpy(zero_copy_only=False)
                bad = ~np.isfinite(x)
                at = np.concatenate([[0], np.cumsum(n)])
                spoilt = np.concatenate([[0], np.cumsum(bad)])
                good = np.flatnonzero(spoilt[at[1:]] == spoilt[at[:-1]])
                x = np.floor(np.where(bad, 0, x) * SCALE)
                if np.abs(x).max(initial=0) >= 1 << 31:
                    raise ValueError("components too large for exact 64-bit distances")
                x = x.astype(np.int64)
                cells = [x[at[j] : at[j + 1]] for j in good]
                yield _with(batch.take(pa.array(good)), {"x": [_cell(c) for c in cells], "big": [int(np.abs(c).max(initial=0)) for c in cells]}, arrow)

    return rows.mapInArrow(run, schema)


def first_rows(points: DataFrame, k: int) -> list[bytes]:
    """Cells of the k rows of least vec_id; null ones last, equal ones by their integers."""
    halved = F.shiftright("vec_id", 1)
    high = cut(points, halved, k)
    low = points.where(halved <= high) if high is not None else points.limit(0)
    order = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    found = low.orderBy(*order).limit(k).collect()
    if len(found) < k:
        found += points.where("vec_id is null").orderBy("x").limit(k - len(found)).collect()
    return [bytes(r["x"]) for r in found]


def step(state: DataFrame, books: list[Codebook], before: list[Codebook] | None, b: int, held: int) -> DataFrame:
    """A round's assignment: from all distances, or from the bounds of the round before, of ``held`` entries."""
    schema, arrow = _schemas(state, STATE)
    width = books[0].entries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for i in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(i, AT_ONCE)
                n = batch.num_rows
                x = _ints(batch.column("x"), PARTS * width)
                code, needed, bounds = np.zeros((n, PARTS), np.uint8), np.full((n, PARTS), ALL, np.uint8), []
                if before:
                    old_code = _rows(batch.column("code"), "u1", PARTS)
                    old = _rows(batch.column("bounds"), bounds_of(held), PARTS)
                for p, book in enumerate(books):
                    part = x[:, p * width : (p + 1) * width].astype(book.kind)
                    if before:
                        kept = resized(old[:, p], b)
                        code[:, p], kept, needed[:, p] = assign_near(book, before[p], part, old_code[:, p], kept)
                    else:
                        code[:, p], kept = assign_all(book, part, b)
                    bounds.append(kept)
                bounds = np.stack(bounds, axis=1)
                cells = {"x": batch.column("x"), "code": [r.tobytes() for r in code], "needed": [r.tobytes() for r in needed]}
                yield _with(batch, cells | {"bounds": [r.tobytes() for r in bounds]}, arrow)

    return state.mapInArrow(run, schema)


def summed(state: DataFrame, entries: int, width: int) -> dict[int, int]:
    """By number: rows and sums of components of each entry, then how many parts needed how many entries."""
    cells = width + 1
    histogram = PARTS * entries * cells

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(histogram + ALL + 1, np.int64)
        for whole in batches:
            for i in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(i, AT_ONCE)
                x = _ints(batch.column("x"), PARTS * width)
                code = _rows(batch.column("code"), "u1", PARTS).astype(np.int64)
                for p in range(PARTS):
                    at = (p * entries + code[:, p]) * cells
                    np.add.at(total, at, 1)
                    np.add.at(total, at[:, None] + np.arange(1, cells), x[:, p * width : (p + 1) * width])
                total[histogram:] += np.bincount(_rows(batch.column("needed"), "u1", PARTS).ravel(), minlength=ALL + 1)
        slot = np.flatnonzero(total)
        yield batch_of({"slot": slot, "value": total[slot]}, pa.schema([("slot", pa.int64()), ("value", pa.int64())]))

    rows = state.select("x", "code", "needed").mapInArrow(run, "slot long, value long").groupBy("slot").agg(F.sum("value").alias("value"))
    return {r["slot"]: r["value"] for r in rows.collect()}  # entries x components, and ALL + 1


def moved(entries: np.ndarray, sums: dict[int, int]) -> np.ndarray:
    """Entries at the floor of the mean of their parts; unused ones stay."""
    out = entries.copy()
    parts, k, width = entries.shape
    for p in range(parts):
        for e in range(k):
            at = (p * k + e) * (width + 1)
            n = sums.get(at, 0)
            if n:
                out[p, e] = [sums.get(at + 1 + i, 0) // n for i in range(width)]
    return out


def enough(sums: dict[int, int], entries: int, width: int, b: int, share: float = 0.9) -> int:
    """How many entries to keep next, from how many the parts needed."""
    start = PARTS * entries * (width + 1)
    counts = np.array([sums.get(start + j, 0) for j in range(ALL + 1)])
    if 2 * counts[ALL] > counts.sum():
        return max(b, min(2 * b, MOST))
    return int(min(b, max(LEAST, np.searchsorted(counts[:ALL].cumsum(), share * counts[:ALL].sum()))))


def coded(state: DataFrame, books: list[Codebook]) -> DataFrame:
    """vec_id, label, code and the exact error of each vector."""
    width = books[0].entries.shape[1]
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema if f.name in ("vec_id", "label"))
    arrow = pa.schema([*_schemas(state, STATE)[1]][:2] + [pa.field("code", pa.string()), pa.field("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for i in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(i, AT_ONCE)
                x = _ints(batch.column("x"), PARTS * width)
                code = _rows(batch.column("code"), "u1", PARTS)
                error = np.zeros(batch.num_rows, np.int64)
                for p, book in enumerate(books):
                    part = x[:, p * width : (p + 1) * width].astype(book.kind)
                    error += book.some(part, code[:, p, None])[:, 0].astype(np.int64)
                yield _with(batch, {"code": [r.tobytes().hex() for r in code], "error": error}, arrow)

    return state.mapInArrow(run, f"{names}, code string, error long")


def _of_label(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """The sum of each row's label. A label may hold a third of the rows."""
    same: Column = F.col("label").eqNullSafe(F.col("of"))
    if sums.count() <= FEW_LABELS:
        return rows.join(F.broadcast(sums), same).drop("of")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    copies = sums.withColumn("own", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, same & (F.col("salt") == F.col("own"))).drop("of", "own", "salt")


def compress(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, start: int = START) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each kept vector.

    ``start`` is the number of entries whose bounds a part keeps at first.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    with Tables(spark) as tables:
        points = tables.write(quantised(vectors), "points")
        size = points.agg(F.count(F.lit(1)), F.min(F.length("x")), F.max(F.length("x")), F.max("big")).first()
        if not size[0]:
            return spark.createDataFrame([], schema)
        if size[1] != size[2] or size[1] % (4 * PARTS) or not size[1]:
            raise ValueError("vectors must have one length, which the number of parts divides")
        width = size[1] // 4 // PARTS
        first = _ints(pa.array(first_rows(points, entries), pa.binary()), PARTS * width)
        now = first.reshape(len(first), PARTS, width).transpose(1, 0, 2)
        made = lambda e: [Codebook(part, size[3] + 1) for part in e]
        books, before, b, held = made(now), None, start, start
        state = points
        for last in [False] * rounds + [True]:
            state = tables.write(step(state, books, before, b, held), "state")
            tables.drop("points")
            held = b
            if not last:
                sums = summed(state, len(first), width)
                now = moved(now, sums)
                if before:
                    b = enough(sums, len(first), width, held)
                books, before = made(now), books
        rows = tables.write(coded(state, books), "coded")
        tables.drop("state")
        by_label = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
        digest = hashlib.sha256(",".join(map(str, now.ravel().tolist())).encode()).hexdigest()
        out = _of_label(rows, tables.write(by_label, "label_errors"))
        return materialize(out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")), "codes")
