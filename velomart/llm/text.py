"""Texts of Arrow batches as byte arrays: words, hashes and bounded slices."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 21
#: Bytes of an Arrow batch in jobs of several stages.
BATCH_BYTES = 2 * SLICE_BYTES
MASK = (1 << 64) - 1

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session hold ``BATCH_BYTES`` or little more, if it sets no bound itself.

    By default ten thousand rows make a batch, which may be all texts of a task, held on both sides.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(name, spark.conf.get(name, f"{BATCH_BYTES}b"))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each part take about ``SLICE_BYTES`` at most."""
    release()  # what the task before freed after its last slice
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            limit = (ends[first - 1] if first else 0) + SLICE_BYTES
            last = max(first + 1, int(np.searchsorted(ends, limit, "right")))
            yield batch.slice(first, last - first)
            first = last
    release()


def release() -> None:
    """Give back what a task has freed: its worker waits for other stages with all that it holds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def strings(column: pa.Array) -> list[str]:
    """The texts; null counts as empty."""
    return pc.fill_null(column, "").to_pylist()


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and where each begins; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n, (_, offsets, data) = len(column), column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts of a slice, with 64-bit hashes.

    ``starts``/``ends`` are byte positions in the joined texts; words of document i
    are ``at[i]:at[i + 1]``.
    """

    def __init__(self, column: pa.Array, lower: bool = True):
        data, offsets = raw(column)
        self.data, self.offsets = data, offsets
        inside = ~_SPACE[data]
        filled = offsets[:-1][np.diff(offsets) > 0]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        before[filled] = False
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        after[offsets[1:][np.diff(offsets) > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.at = np.searchsorted(self.starts, offsets)
        self.hashes = spans(_LOWER[data] if lower else data, self.starts, self.ends)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words that begin at each word, and whether they stay in its text."""
        n = len(self.hashes)
        out = np.zeros(n, np.uint64)
        if n < k:
            return out, np.zeros(n, bool)
        m = n - k + 1
        for j in range(k):
            out[:m] = out[:m] * np.uint64(_BASE) + self.hashes[j : j + m]
        end = np.repeat(self.at[1:], np.diff(self.at))
        return mix(out), np.arange(n) + k <= end


#: Powers of the base and of its inverse are products of two: of a place in its block, and of the block.
_BLOCK = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers modulo 2^64."""
    grown = np.full(n, base, np.uint64)
    grown[:1] = 1
    return np.cumprod(grown)


_UP, _DOWN = _powers(_BASE, _BLOCK), _powers(_BASE_INVERSE, _BLOCK)


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range: a polynomial modulo 2^64, scrambled."""
    n = len(data)
    blocks = n // _BLOCK + 1
    up, down = (_powers(pow(base, _BLOCK, 1 << 64), blocks) for base in (_BASE, _BASE_INVERSE))
    sums = np.zeros(n + 1, np.uint64)
    # By blocks, so that nothing else is as long as the sums.
    for block, first in enumerate(range(0, n, _BLOCK)):
        own = sums[first + 1 : first + 1 + _BLOCK]
        np.cumsum(_CODE[data[first : first + _BLOCK]] * (_UP[: len(own)] * up[block]), out=own)
        own += sums[first]
    value = (sums[ends] - sums[starts]) * (_DOWN[starts % _BLOCK] * down[starts // _BLOCK])
    return mix(value + (ends - starts).astype(np.uint64))


def word_list(text: str) -> list[bytes]:
    """Words of one text, by the same rule."""
    return text.encode().split()


def mapped(
    docs: DataFrame, schema: str, function: Callable[[pa.RecordBatch], Iterable[dict]],
    at_end: Callable[[], None] | None = None,
) -> DataFrame:
    """``function`` over bounded slices; it gives dictionaries of columns. Each task ends with ``at_end``."""
    arrow = to_arrow(schema)

    def run(batches):
        for part in slices(batches):
            for columns in function(part):
                yield batch_of(columns, arrow)
        if at_end is not None:
            at_end()
            release()

    return docs.mapInArrow(run, schema)


_TYPES = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
}


def to_arrow(schema: str) -> pa.Schema:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.schema([(name, _TYPES[kind]) for name, kind in fields])


def batch_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    made = []
    for field in schema:
        value = columns[field.name]
        if isinstance(value, np.ndarray) and value.dtype == np.uint64:
            value = value.view(np.int64)
        made.append(
            value if isinstance(value, pa.Array) and value.type == field.type else pa.array(value, field.type)
        )
    return pa.RecordBatch.from_arrays(made, schema=schema)
