"""Token ids in files of Simple-8b words.

Four bits of each 64-bit word name how many ids of how many bits it holds. An id of
over 60 bits takes an escape word (selector 0) and the word after it whole. Ids are
coded in blocks of ``BLOCK``; each block begins a word of its own, whose place stands in
the head, so blocks are decoded alone and all words of one selector together.

A record holds whole documents; its layout, little-endian:
  4 bytes ``S8B1``; length of the record; part; ids before it in the part; documents;
  ids; blocks; words: 7 longs. Then doc ids, null flags (one byte each, padded to 8),
  ids per document, ids and words before each block, words.

Files are written by Spark's own writer, one record and a line end after another, on any
store that it can write to, and committed as a whole, so a lost executor leaves none
half written. Each file holds at most ``FILE_RECORDS`` records.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velomart.llm.text import batch_of, slices, to_arrow
from velomart.llm.tokens import encoder
from velomart.workspace import fresh_path, materialize

BLOCK = 4096
RECORD_IDS = 1 << 17
FILE_RECORDS = 64
MAGIC = b"S8B1"
END_ID = 1
#: Ids in a word and bits of each, by selector (fixed values); 0 is the escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks of ``ids``, and how many words lie before each block."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    top = int(ids.max()).bit_length()
    widest = next((s for s in range(1, 16) if BITS[s] >= top), 15)
    best = np.full(n, widest if BITS[widest] >= top else 0, np.int8)
    narrow = ids.astype(np.uint32) if top <= 32 else ids
    if BITS[widest] >= top:  # near the end of a block fewer fit
        c = int(COUNTS[widest])
        starts = np.arange(0, n, BLOCK)
        tail = (np.minimum(starts + BLOCK, n)[:, None] - np.arange(1, c)).ravel()
        tail = tail[tail >= np.repeat(starts, c - 1)]
        room = np.minimum((tail // BLOCK + 1) * BLOCK, n) - tail
        best[tail] = np.array([next((s for s in range(widest, 16) if COUNTS[s] <= r), 15) for r in range(c + 1)])[room]
    fits = np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64)
    for s in range(widest - 1 if BITS[widest] >= top else 15, 0, -1):  # a denser selector takes over where it fits
        fits = fits[narrow[fits] < (1 << int(BITS[s]))]  # ids that fit less room are among those that fit more
        c = int(COUNTS[s])
        if len(fits) < c:
            continue
        head = fits[: len(fits) - c + 1][fits[c - 1 :] - fits[: len(fits) - c + 1] == c - 1]
        best[head[(head & (BLOCK - 1)) + c <= BLOCK]] = s
    count = COUNTS[best].astype(np.uint8).tobytes()
    heads, i = [], 0
    while i < n:
        heads.append(i)
        i += count[i]
    heads = np.array(heads)
    chosen = best[heads]
    size = np.where(chosen == 0, 2, 1)
    place = np.concatenate([[0], np.cumsum(size)])
    words = np.zeros(place[-1], np.uint64)
    for s in range(16):
        at = np.flatnonzero(chosen == s)
        if not len(at):
            continue
        word = np.full(len(at), s, np.uint64) << np.uint64(60)
        if s == 0:
            words[place[at] + 1] = ids[heads[at]]
        elif BITS[s]:
            for j in range(COUNTS[s]):
                word |= ids[heads[at] + j] << np.uint64(j * BITS[s])
        words[place[at]] = word
    starts = np.searchsorted(heads, np.arange(0, n, BLOCK))
    return words, np.append(place[starts], place[-1])


def unpack(words: np.ndarray) -> np.ndarray:
    """Ids of a run of words that begins with a block; all words of a selector at once."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    escaped = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == 0):
        if not escaped[i]:
            escaped[i + 1] = True
    count = np.where(escaped, 0, COUNTS[selector])
    place = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(place[-1], np.uint64)
    for s in range(16):
        at = np.flatnonzero((selector == s) & ~escaped)
        if not len(at):
            continue
        if s == 0:
            out[place[at]] = words[at + 1]
        elif BITS[s]:
            mask = np.uint64((1 << int(BITS[s])) - 1)
            for j in range(COUNTS[s]):
                out[place[at] + j] = (words[at] >> np.uint64(j * BITS[s])) & mask
    return out


def record(doc_ids: list, ids: np.ndarray, sizes: np.ndarray, part: int, before: int) -> bytes:
    words, at = pack(ids)
    null = np.array([d is None for d in doc_ids], np.uint8)
    body = b"".join([
        np.array([0 if d is None else d for d in doc_ids], np.int64).tobytes(),
        null.tobytes() + bytes(-len(null) % 8),
        np.asarray(sizes, np.int64).tobytes(), at.astype(np.int64).tobytes(), words.tobytes(),
    ])
    head = np.array([60 + len(body), part, before, len(doc_ids), len(ids), len(at) - 1, len(words)], np.int64)
    return MAGIC + head.tobytes() + body


def records(data: bytes):
    """Places of the records of a file, and their heads."""
    at = 0
    while at < len(data):
        if data[at : at + 4] != MAGIC:
            raise ValueError("not a record")
        head = np.frombuffer(data, np.int64, 7, at + 4)
        yield at + 60, head
        at += int(head[0]) + 1


def documents(data: bytes, at: int, head: np.ndarray):
    """doc_id, null flag and ids of each document of a record."""
    _, _, _, n, _, blocks, n_words = map(int, head)
    doc_ids = np.frombuffer(data, np.int64, n, at)
    null = np.frombuffer(data, np.uint8, n, at + 8 * n)
    at += 8 * n + n + -n % 8
    sizes = np.frombuffer(data, np.int64, n, at)
    words = np.frombuffer(data, np.uint64, n_words, at + 8 * n + 8 * (blocks + 1))
    ids = unpack(words)
    return doc_ids, null, np.split(ids, np.cumsum(sizes)[:-1])


def ids_between(data: bytes, at: int, head: np.ndarray, first: int, last: int) -> np.ndarray:
    """Ids ``first`` to ``last`` (not included) of a record: only the blocks that hold them are decoded."""
    _, _, _, n, n_ids, blocks, n_words = map(int, head)
    at += 8 * n + n + -n % 8 + 8 * n
    places = np.frombuffer(data, np.int64, blocks + 1, at)
    first, last = max(first, 0), min(last, n_ids)
    if first >= last:
        return np.zeros(0, np.uint64)
    low, high = first // BLOCK, -(-last // BLOCK)
    words = np.frombuffer(data, np.uint64, int(places[high] - places[low]), at + 8 * (blocks + 1) + 8 * int(places[low]))
    return unpack(words)[first - low * BLOCK : last - low * BLOCK]


def write_token_files(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID) -> None:
    """Encode every text, in ascending doc_id (null first; equal ones by text), and write the files."""
    schema = "record binary"

    def run(batches):
        enc, arrow = encoder(vocabulary), to_arrow(schema)
        part, before = TaskContext.get().partitionId(), 0
        keys, runs, sizes, total = [], [], [], 0

        def flush():
            made = record(keys, np.concatenate(runs) if runs else np.zeros(0), np.array(sizes), part, before)
            return batch_of({"record": [made]}, arrow)

        for batch in slices(batches):
            ids, at = enc.encode(batch.column("text"))
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                one = np.append(ids[at[i] : at[i + 1]], np.uint32(end_id))
                keys.append(doc_id)
                runs.append(one)
                sizes.append(len(one))
                total += len(one)
                if total >= RECORD_IDS:
                    yield flush()
                    before += total
                    keys, runs, sizes, total = [], [], [], 0
        if keys:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    (
        ordered.mapInArrow(run, schema)
        .select(F.col("record").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", FILE_RECORDS)
        .text(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    rows = "part long, doc_id long, inner long, n_tokens long, ids_crc32 long"

    def decode(batches):
        arrow = to_arrow(rows)
        for batch in batches:
            for data in batch.column(0):
                view = memoryview(data.as_buffer())
                for at, head in records(view):
                    doc_ids, null, ids = documents(view, at, head)
                    size = np.array([len(x) for x in ids], np.int64)
                    yield batch_of({
                        "part": np.full(len(size), head[1]),
                        "doc_id": pa.array(doc_ids, mask=null.astype(bool)),
                        "inner": int(head[2]) + np.cumsum(size) - size,
                        "n_tokens": size,
                        "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                    }, arrow)

    # The files are read once; what is needed twice are the numbers of each document.
    decoded = materialize(files.mapInArrow(decode, rows), "decoded")
    totals = decoded.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # A row for each part that was written, which is far fewer than documents.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    return decoded.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_output(docs: DataFrame, vocabulary: str, path: str | None = None) -> DataFrame:
    """Write the files to ``path`` and read them back.

    Null text counts as empty and gives the end id alone; equal doc ids keep a row each.
    An empty table gives no rows. Columns other than doc_id and text are not read.
    """
    path = path or fresh_path(docs.sparkSession, "tokens")
    write_token_files(docs, vocabulary, path)
    return read_token_files(docs.sparkSession, path)
