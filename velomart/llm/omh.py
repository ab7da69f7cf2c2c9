"""Order MinHash fingerprints: sensitive to edits, not only to what a text is made of.

Each byte position begins a k-mer; equal ones are numbered by occurrence. For each of
``SLOTS`` hash functions the two numbered k-mers of least hash are taken in the order
in which the text has them, and the pair is hashed. The share of equal slots estimates
how alike two texts are.

A text shorter than a k-mer is one k-mer; an empty one (null counts as empty) has slots
of zero, alike only with another empty one. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.llm.text import _CODE, batch_of, mix, slices, strings, to_arrow

K = 12
SLOTS = 32
#: Positions that are hashed for all slots at once.
CHUNK = 4096
_ROWS = np.arange(SLOTS)
_ODD = ((mix(_ROWS + 1) >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]
_ADD = (mix(_ROWS + 101) >> np.uint64(32)).astype(np.uint32)[:, None]


def numbered(data: np.ndarray, k: int = K) -> np.ndarray:
    """Hash of the k-mer at each position together with its occurrence number."""
    code = _CODE[data]
    n = len(data) - k + 1
    if n < 1:
        return mix(np.array([sum(int(c) * (2 * i + 3) for i, c in enumerate(code)) & (1 << 64) - 1], np.uint64))
    sums, width, done = code, 1, np.zeros(0, np.uint64)
    h, offset = None, 0
    rest = k
    while rest:  # a polynomial over k bytes from those over 1, 2, 4, ...
        if rest & 1:
            part = sums[offset : offset + n]
            h = part.copy() if h is None else h * np.uint64(pow(_B, width, 1 << 64)) + part
            offset += width
        rest >>= 1
        if rest:
            sums = sums[:-width] * np.uint64(pow(_B, width, 1 << 64)) + sums[width:]
            width *= 2
    h = mix(h)
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    keys = np.sort((h >> bits << bits) | np.arange(n, dtype=np.uint64))
    at = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.ones(n, bool)
    first[1:] = (keys[1:] >> bits) != (keys[:-1] >> bits)
    if not first.all():
        run = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        number = np.arange(n) - run
        again = number > 0
        h[at[again]] = mix(h[at[again]] + number[again].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    return h


_B = 0x9E3779B97F4A7C15 | 1


def signature(text: bytes) -> np.ndarray:
    """``SLOTS`` values of 32 bits."""
    if not text:
        return np.zeros(SLOTS, np.uint32)
    h = numbered(np.frombuffer(text, np.uint8))
    short = (h >> np.uint64(32)).astype(np.uint32)
    values, places = [], []
    for i in range(0, len(h), CHUNK):
        v = (short[None, i : i + CHUNK] + _ADD) * _ODD
        for _ in range(min(2, v.shape[1])):
            least = v.argmin(1)
            values.append(v[_ROWS, least].astype(np.int64))
            places.append(least + i)
            v[_ROWS, least] = np.iinfo(np.uint32).max
    values, places = np.array(values), np.array(places)
    pair = np.sort(np.take_along_axis(places, np.argsort(values, axis=0, kind="stable")[:2], 0), 0)
    last = h[pair[1]] if len(pair) > 1 else np.full(SLOTS, 7, np.uint64)
    slots = h[pair[0]] * np.uint64(3) + last * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mix(slots) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def written(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last third of the characters gives way to as many of the next text."""
    m = len(text) // 3
    return text[: len(text) - m] + following[:m]


def in_turn(docs: DataFrame) -> tuple[DataFrame, int]:
    """Documents dealt out by ranges of doc_id, each range with the document that follows it, and the number of ranges.

    Adds ``turn`` (ranges in descending doc_id) and ``guest`` (true for the document
    that begins the next range). Order is descending doc_id, equal ones by text, null
    last. Ranges come from quantiles; a few hundred ids reach the driver at most, and
    only one document for each range is held twice.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000).alias("q")).first()["q"]
    cuts = sorted(set(found or []))
    # The number of the range, counted from the highest ids; null ids are in the last.
    turn = F.lit(len(cuts) + 1)
    if cuts:
        at = F.array(*(F.lit(c) for c in cuts))
        below = F.size(F.filter(at, lambda c: c < F.col("doc_id")))
        turn = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(len(cuts) - below)
    placed = docs.withColumn("turn", turn.cast("int"))
    heads = [(r["turn"], r["doc_id"]) for r in placed.groupBy("turn").agg(F.max("doc_id").alias("doc_id")).collect()]
    heads.sort()
    owners = [(heads[i - 1][0], *heads[i]) for i in range(len(heads))]  # the last range is followed by the first
    guests = spark.createDataFrame(owners, "owner int, turn int, head long")
    same = (placed["turn"] == guests["turn"]) & placed["doc_id"].eqNullSafe(guests["head"])
    extra = placed.join(F.broadcast(guests), same).select("doc_id", "text", F.col("owner").alias("turn"), F.lit(True).alias("guest"))
    return placed.withColumn("guest", F.lit(False)).unionByName(extra), len(cuts) + 2


ROWS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness to it and to the next one.

    The next of the last document is the first; a single document follows itself. Rows
    that share a doc_id each count, in the order of their texts. An empty table gives no
    rows. Columns other than doc_id and text are not read.
    """
    ranges, n = in_turn(docs)
    # A task reads one range, in order.
    ordered = ranges.repartitionById(n, F.col("turn")).sortWithinPartitions(
        "turn", "guest", F.desc_nulls_last("doc_id"), "text"
    )

    def run(batches):
        arrow = to_arrow(ROWS)
        held = None  # the document that waits for its follower
        for batch in slices(batches):
            rows = []
            for turn, guest, doc_id, text in zip(
                batch.column("turn").to_pylist(), batch.column("guest").to_pylist(),
                batch.column("doc_id").to_pylist(), strings(batch.column("text")),
            ):
                if held and held[0] != turn:
                    held = None
                if guest and not held:
                    continue  # a further row of the id that began the next range
                own = signature(text.encode())
                if held:
                    _, before_id, before, mark = held
                    changed = edited(before, text)
                    data = changed.encode()
                    other = signature(data)
                    rows.append((
                        before_id, len(before), hashlib.sha256(data).hexdigest(), written(mark), written(other),
                        likeness(mark, other), likeness(mark, own),
                    ))
                held = None if guest else (turn, doc_id, text, own)
            if rows:
                yield batch_of(dict(zip(arrow.names, zip(*rows))), arrow)

    return ordered.select("turn", "guest", "doc_id", "text").mapInArrow(run, ROWS)
