"""Best-fit packing of tokenised documents into sequences.

Only lengths matter for what fits where, and there are no more of them than tokens in a
sequence. So Spark counts the pieces of each length, the plan is made from these counts,
whole groups of equal sequences at a time, and Spark then deals the pieces out: the r-th
piece of a length has its place by arithmetic.

The plan: pieces of over a third of the capacity go at most two into a sequence, the
longest with the longest that still fits. Shorter ones, longest first, go to the
sequence with the least room that suffices.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velomart.llm.text import mapped
from velomart.llm.tokens import KEPT_WORDS, encoder, forget
from velomart.workspace import materialize

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first of its pieces, pieces in a sequence, first sequence, offset).

    A row deals the pieces of a length from the given one on: that many to each sequence
    from the given one on, until the next row of the length takes over.
    """
    left = {n: c for n, c in counts.items() if c}
    given: dict[int, int] = defaultdict(int)
    rows, sequences = [], 0
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs (first sequence, how many)
    gaps: list[int] = []

    def deal(length: int, each: int, first: int, many: int, offset: int) -> None:
        rows.append((length, given[length], each, first, offset))
        given[length] += each * many

    def leave(gap: int, first: int, many: int) -> None:
        if gap and many:
            if not room[gap]:
                insort(gaps, gap)
            room[gap].append((first, many))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            mate = next((m for m in large if m <= capacity - n and left[m]), 0)
            many = left[n] if not mate else left[n] // 2 if mate == n else min(left[n], left[mate])
            if mate == n and not many:  # one is left of it
                mate = next((m for m in large if m < n and m <= capacity - n and left[m]), 0)
                many = 1
            deal(n, 1, sequences, many, 0)
            left[n] -= many
            if mate:
                deal(mate, 1, sequences, many, n)
                left[mate] -= many
            leave(capacity - n - mate, sequences, many)
            sequences += many
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        rest = left[n]
        while rest:
            k = bisect_left(gaps, n)
            if k == len(gaps):
                gap, first, many = capacity, sequences, -(-rest // (capacity // n))
                sequences += many
            else:
                gap = gaps[k]
                first, many = room[gap].pop()
                if not room[gap]:
                    gaps.pop(k)
            each = gap // n
            full = min(many, rest // each)
            if full:
                deal(n, each, first, full, capacity - gap)
                leave(gap - each * n, first, full)
                rest -= each * full
            if full < many and rest:
                deal(n, rest, first + full, 1, capacity - gap)
                leave(gap - rest * n, first + full, 1)
                full, rest = full + 1, 0
            leave(gap, first + full, many - full)
    return rows


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, kept: int = KEPT_WORDS, stay: bool = True
) -> DataFrame:
    """Pieces of each document, numbered within their length and task (``part``, ``nth``)."""

    def each(batch: pa.RecordBatch):
        ids, at = encoder(vocabulary, kept).encode(batch.column("text"))
        rows = []
        for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), at, at[1:]):
            own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
            for k in range(0, len(own), capacity):
                cut = own[k : k + capacity]
                rows.append((doc_id, k // capacity, k, len(cut), zlib.crc32(cut.tobytes())))
        doc, piece, start, length, crc = zip(*rows)
        length = np.array(length)
        order = np.argsort(length, kind="stable")
        ranked = length[order]
        nth = np.empty(len(order), np.int64)
        nth[order] = np.arange(len(order)) - np.searchsorted(ranked, ranked)
        met = seen[TaskContext.get().taskAttemptId()]
        nth += met[length]
        np.add.at(met, length, 1)
        yield {
            "doc_id": doc, "piece": piece, "start": start, "length": length, "ids_crc32": crc,
            "part": np.full(len(nth), TaskContext.get().partitionId()), "nth": nth,
        }

    seen: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(capacity + 1, np.int64))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return mapped(texts, PIECES, each, None if stay else forget)


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, kept: int = KEPT_WORDS, stay: bool = True
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty, and gives one piece of the end id. Rows that share a
    doc_id are packed each on its own. An empty table gives no rows. Columns other than
    doc_id and text are not read. ``kept`` bounds the words that a Python worker keeps;
    without ``stay`` it gives them up at the end of each task, for jobs with other stages.
    """
    cut = materialize(pieces(docs, vocabulary, capacity, end_id, kept, stay), "pieces")
    by_part = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 5)
    # One number for length and place, so that one search finds the row.
    width = np.int64(max([1, *counts.values()]) + 1)
    keys = rows[:, 0] * width + rows[:, 1]

    def place(batches):
        for batch in batches:
            length, nth = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = rows[np.searchsorted(keys, length * width + nth, "right") - 1]
            k = nth - row[:, 1]
            made = [pa.array(row[:, 3] + k // row[:, 2]), pa.array(row[:, 4] + k % row[:, 2] * length)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *made], [*names, "sequence_id", "offset"])

    ranked = cut.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth")).drop("part", "nth", "before")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)
