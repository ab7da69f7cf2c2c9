"""Merkle manifest of a dataset: leaf places by rank in bitmaps, levels reduced in slots.

A row of ``documents`` is a leaf. Leaves of a source stand in ascending doc_id, and every
three neighbours become one node until one is left, the source's subroot; subroots, by
source, become the root likewise.

Where a leaf stands is never found by sorting rows. The doc_ids of a source are put into
containers by their upper 48 bits, each the sorted 16-bit rests where these are few and a
bitmap of 65,536 bits otherwise, with a directory of the bits before each block of 512.
Tasks make partial containers, which are merged. Counts of containers add up, 16 bits of
doc_id at a time, to the number of leaves before each container. A leaf's place is that
number plus the rank of its doc_id in its container, by popcount.

Nodes then meet by (source, place div 81) and are put into slots by their place modulo 81;
four levels are reduced there at once, and the digests go on as nodes of the next round.
On the way back each block learns the siblings above it, which with its own are the proofs
of its leaves. So a task holds 81 nodes at a time, however large a source is.

Rows: a null source is a source of its own, before all others. Rows that share a source
and doc_id are leaves each, in the order of their digest; such rows are counted in the
containers and ranked by parts of their digests. Null doc_ids stand before all others of
their source, by the same rule, and are never tampered with. Null and empty text differ
(``-`` and ``0:``). Texts are hashed whole. An empty table gives no rows. Columns other
than the five of ``documents`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomart.llm.text import batch_of
from velomart.workspace import Tables, materialize

FAN, STEP = 3, 4
SLOTS = FAN**STEP
#: More ids than this in a container are kept as a bitmap, which is never shorter than the ids.
ARRAY_IDS = 4095
BLOCK_BITS = 512
#: Blocks of nodes that a task turns into Python values at once.
AT_ONCE = 128

CONTAINER = "source string, bucket long, n long, ids array<int>, bitmap binary, directory array<int>, again array<struct<id:int,more:long>>"
BLOCK = "source string, block long, total long, nodes array<binary>, doc_ids array<long>, tampered array<binary>, digest binary"


def h(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


# Leaves


def leaf(text: Column) -> Column:
    """The digest of a document's row with this text."""

    def field(value: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    values = [F.col(c).cast("string") for c in ("doc_id", "source", "lang", "n_chars")]
    return F.unhex(F.sha2(F.concat(*map(field, [*values, text])).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, the leaf, and the leaf after tampering where that changes it."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.replace(F.col("text"), F.lit("\n"))
    return docs.select(
        F.col("source"), F.col("doc_id").cast("long").alias("doc_id"), leaf(F.col("text")).alias("digest"),
        F.when(chosen & F.contains(F.col("text"), F.lit("\n")), leaf(cut)).alias("tampered"),
    )


# Containers


def _pack(ids: np.ndarray) -> bytes:
    """Sorted distinct 16-bit values, as they are or as 8 KB of bits."""
    if len(ids) <= ARRAY_IDS:
        return ids.astype("<u2").tobytes()
    bits = np.zeros(1 << 16, np.uint8)
    bits[ids] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if len(data) < 1 << 13:
        return np.frombuffer(data, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers of the ids of a batch; ``counts`` only where an id comes more than once."""
    schema = pa.schema([("source", pa.string()), ("bucket", pa.int64()), ("data", pa.binary()), ("counts", pa.binary())])
    for batch in batches:
        coded = batch.column("source").dictionary_encode()
        source = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        missing = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        doc_id = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
        order = np.lexsort((doc_id, ~missing, source))
        source, missing, doc_id = source[order], missing[order], doc_id[order]
        bucket, rest = doc_id >> 16, doc_id & 0xFFFF
        new = np.ones(len(order) + 1, bool)
        new[1:-1] = (source[1:] != source[:-1]) | (missing[1:] != missing[:-1]) | (bucket[1:] != bucket[:-1])
        at, names = np.flatnonzero(new), [*coded.dictionary.to_pylist(), None]
        out = {"source": [], "bucket": [], "data": [], "counts": []}
        for a, b in zip(at, at[1:]):
            ids, n = np.unique(rest[a:b], return_counts=True)
            out["source"].append(names[source[a]])
            out["bucket"].append(None if missing[a] else int(bucket[a]))
            out["data"].append(_pack(ids))
            out["counts"].append(None if n.max() == 1 else n.astype("<i8").tobytes())
        yield batch_of(out, schema)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One container of each (source, bucket), with its directory and what comes again."""
    again = pa.list_(pa.struct([("id", pa.int32()), ("more", pa.int64())]))
    schema = pa.schema([
        ("source", pa.string()), ("bucket", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int32())),
        ("bitmap", pa.binary()), ("directory", pa.list_(pa.int32())), ("again", again),
    ])
    for batch in batches:
        for i in range(0, batch.num_rows, AT_ONCE):
            out = {f.name: [] for f in schema}
            for row in batch.slice(i, AT_ONCE).to_pylist():
                held = np.zeros(1 << 16, np.int64)
                for part in row["parts"]:
                    ids = _unpack(part["data"])
                    held[ids] += 1 if part["counts"] is None else np.frombuffer(part["counts"], "<i8")
                ids = np.flatnonzero(held)
                packed = _pack(ids)
                small = len(ids) <= ARRAY_IDS
                before = np.concatenate([[0], np.cumsum((held > 0).reshape(-1, BLOCK_BITS).sum(1))[:-1]])
                out["source"].append(row["source"])
                out["bucket"].append(row["bucket"])
                out["n"].append(int(held.sum()))
                out["ids"].append(ids if small else None)
                out["bitmap"].append(None if small else packed)
                out["directory"].append(None if small else before)
                more = ids[held[ids] > 1]
                out["again"].append([{"id": int(x), "more": int(held[x] - 1)} for x in more] if len(more) else None)
            yield batch_of(out, schema)


def _before(rows: DataFrame, group: list[str], key: str) -> DataFrame:
    """Rows with the sum of ``n`` of the lesser keys of their group (nulls first)."""
    earlier = Window.partitionBy(*group).orderBy(F.col(key).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def _meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join in which nulls are equal."""
    right = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(right, on).drop(*[f"_{k}" for k in keys])


def containers(rows: DataFrame, tables: Tables) -> DataFrame:
    """Containers of ``source`` and ``doc_id``, with the leaves of the source before each and in all.

    No window holds more than 65,536 rows: counts are summed by 16 bits of the bucket at a time.
    """
    partial = rows.select("source", "doc_id").mapInArrow(_partial, "source string, bucket long, data binary, counts binary")
    # A group's parts hold an id once each, or are as many as there are batches with it.
    grouped = partial.groupBy("source", "bucket").agg(F.collect_list(F.struct("data", "counts")).alias("parts"))
    made = tables.write(grouped.mapInArrow(_merged, CONTAINER), "containers")

    upper, top = F.shiftright("bucket", 16).alias("upper"), F.shiftright("upper", 16).alias("top")
    lower = made.select("source", "bucket", "n", upper)
    middle = lower.groupBy("source", "upper").agg(F.sum("n").alias("n")).select("*", top)
    tops = middle.groupBy("source", "top").agg(F.sum("n").alias("n"))
    total = tops.groupBy("source").agg(F.sum("n").alias("total"))
    tops = _meet(_before(tops, ["source"], "top"), total, ["source"]).select("source", "top", F.col("before").alias("b0"), "total")
    middle = _meet(_before(middle, ["source", "top"], "upper"), tops, ["source", "top"])
    middle = middle.select("source", "upper", (F.col("before") + F.col("b0")).alias("b1"), "total")
    lower = _meet(_before(lower, ["source", "upper"], "bucket"), middle, ["source", "upper"])
    base = lower.select("source", "bucket", (F.col("before") + F.col("b1")).alias("base"), "total")
    return tables.write(_meet(made.drop("n"), base, ["source", "bucket"]), "directory")


def rank() -> Column:
    """How many ids of the row's container are less than its own ``rest``."""
    rest, start = F.col("rest"), F.shiftright("rest", 9) * (BLOCK_BITS // 8)
    whole = F.shiftright("rest", 3)
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), whole + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.expr("shiftleft(1, rest & 7) - 1")
    in_bits = (
        F.get("directory", F.shiftright("rest", 9))
        + F.bitmap_count(F.substring(F.col("bitmap"), start + 1, whole - start))
        + F.bit_count(byte.bitwiseAND(mask))
    )
    return F.when(F.col("ids").isNotNull(), F.array_position("ids", rest) - 1).otherwise(in_bits)


def placed(rows: DataFrame, directory: DataFrame) -> DataFrame:
    """Leaves with their place ``at`` among the ``total`` of their source."""
    rows = rows.withColumn("bucket", F.shiftright("doc_id", 16)).withColumn("rest", F.expr("cast(coalesce(doc_id, 0L) & 65535L as int)"))
    met = _meet(rows, directory, ["source", "bucket"])
    kept = ["source", "total", "doc_id", "digest", "tampered"]
    if directory.where("again is not null").isEmpty():
        return met.select(*kept, (F.col("base") + rank()).alias("at"))
    sooner = F.expr("coalesce(aggregate(filter(again, x -> x.id < rest), 0L, (s, x) -> s + x.more), 0L)")
    met = met.select(*kept, (F.col("base") + rank() + sooner).alias("at"), F.expr("coalesce(exists(again, x -> x.id = rest), false)").alias("shared"))
    # Rows of one id, of which there may be many: by the first bits of their digests, then within these.
    shared = met.where("shared").withColumn("first", F.substring(F.hex("digest"), 1, 3))
    key = ["source", "doc_id"]
    firsts = _before(shared.groupBy(*key, "first").agg(F.count(F.lit(1)).alias("n")), key, "first").drop("n")
    nth = F.row_number().over(Window.partitionBy(*key, "first").orderBy("digest")) - 1
    ranked = _meet(shared.withColumn("nth", nth), firsts, [*key, "first"])
    return (
        met.where("not shared").select(*kept, "at")
        .unionByName(ranked.select(*kept, (F.col("at") + F.col("before") + F.col("nth")).alias("at")))
    )


# Levels


def levels(nodes: list[bytes], total: int) -> list[list[bytes]]:
    """Digests of a block by level: ``STEP`` levels, or fewer where the group's ``total`` nodes are one before."""
    found = [nodes]
    for _ in range(STEP):
        if total == 1:
            break
        nodes = [h(b"".join(x.hex().encode() for x in nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]
        total = -(-total // FAN)
        found.append(nodes)
    return found


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("source", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("nodes", pa.list_(pa.binary())),
        ("doc_ids", pa.list_(pa.int64())), ("tampered", pa.list_(pa.binary())), ("digest", pa.binary()),
    ])
    for batch in batches:
        for i in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(i, AT_ONCE)
            slots, out = part.column("slots"), {f.name: [] for f in schema}
            flat = slots.flatten()
            slot, digest, doc_id, tampered = (flat.field(j).to_pylist() for j in range(4))
            end = 0
            for source, block, total, n in zip(*(part.column(c).to_pylist() for c in ("source", "block", "total")), slots.value_lengths().to_pylist()):
                start, end = end, end + n
                order = [0] * n
                for j in range(start, end):
                    order[slot[j]] = j
                nodes = [digest[j] for j in order]
                out["source"].append(source)
                out["block"].append(block)
                out["total"].append(total)
                out["nodes"].append(nodes)
                out["doc_ids"].append([doc_id[j] for j in order])
                out["tampered"].append([tampered[j] for j in order])
                out["digest"].append(levels(nodes, total)[-1][0])
            yield batch_of(out, schema)


def reduced(nodes: DataFrame, tables: Tables, name: str) -> list[DataFrame]:
    """Blocks of nodes (source, at, total, digest, doc_id, tampered), a table for each round.

    A source's last block is the one whose ``total`` is at most ``SLOTS``; its digest is the subroot.
    """
    rounds = []
    while True:
        slot = F.struct(F.expr(f"cast(at % {SLOTS} as int)").alias("slot"), "digest", "doc_id", "tampered")
        grouped = nodes.groupBy("source", F.expr(f"at div {SLOTS}").alias("block")).agg(
            F.first("total").alias("total"), F.collect_list(slot).alias("slots")
        )
        blocks = tables.write(grouped.mapInArrow(_reduced, BLOCK), f"{name}{len(rounds)}")
        rounds.append(blocks)
        rest = blocks.where(F.col("total") > SLOTS)
        if rest.isEmpty():
            return rounds
        nodes = rest.select(
            "source", F.col("block").alias("at"), F.expr(f"(total + {SLOTS - 1}) div {SLOTS}").alias("total"), "digest",
            F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("tampered"),
        )


def last_blocks(rounds: list[DataFrame]) -> DataFrame:
    found = rounds[0].where(F.col("total") <= SLOTS)
    for blocks in rounds[1:]:
        found = found.unionByName(blocks.where(F.col("total") <= SLOTS))
    return found


# Proofs


def siblings(found: list[list[bytes]], i: int) -> bytes:
    """The others of the run of node i on each level: a byte of how many stand before and after, then these."""
    out = []
    for nodes in found[:-1]:
        first = i - i % FAN
        run = nodes[first : first + FAN]
        out.append(bytes([(i - first) * FAN + len(run) - 1 - (i - first)]))
        out.extend(x for j, x in enumerate(run, first) if j != i)
        i //= FAN
    return b"".join(out)


def steps(path: bytes) -> list[tuple[bytes, bytes]]:
    """For each level the hexadecimal digests before and after the node's own."""
    out, at = [], 0
    while at < len(path):
        before, after = divmod(path[at], FAN)
        middle, end = at + 1 + 32 * before, at + 1 + 32 * (before + after)
        out.append((path[at + 1 : middle].hex().encode(), path[middle:end].hex().encode()))
        at = end
    return out


def fold(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that this leaf and the siblings on its way give."""
    for before, after in path:
        digest = h(before + digest.hex().encode() + after)
    return digest


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of each node of a block: its own siblings, then what the block itself has above it."""
    schema = pa.schema([("source", pa.string()), ("at", pa.int64()), ("path", pa.binary()), ("subroot", pa.binary())])
    for batch in batches:
        for i in range(0, batch.num_rows, AT_ONCE):
            out = {f.name: [] for f in schema}
            for row in batch.slice(i, AT_ONCE).select(["source", "block", "total", "nodes", "path", "subroot"]).to_pylist():
                found = levels(row["nodes"], row["total"])
                for j in range(len(row["nodes"])):
                    out["source"].append(row["source"])
                    out["at"].append(row["block"] * SLOTS + j)
                    out["path"].append(siblings(found, j) + row["path"])
                    out["subroot"].append(row["subroot"])
            yield batch_of(out, schema)


CHILD = "source string, at long, path binary, subroot binary"


def _proofs(root: bytes):
    schema = pa.schema([
        ("doc_id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_()),
    ])

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, AT_ONCE):
                out = {f.name: [] for f in schema}
                for row in batch.slice(i, AT_ONCE).to_pylist():
                    found, above = levels(row["nodes"], row["total"]), steps(row["path"])
                    rest = b"".join(a + b for a, b in above)
                    known: dict[bytes, bytes] = {}  # roots of digests of this block
                    for j, (leaf, changed) in enumerate(zip(row["nodes"], row["tampered"])):
                        own = steps(siblings(found, j))
                        top = fold(leaf if changed is None else changed, own)
                        if top not in known:
                            known[top] = fold(top, above)
                        out["leaf"].append(leaf.hex())
                        out["proof_sha256"].append(h(b"".join(a + b for a, b in own) + rest).hex())
                        out["folded_root"].append(known[top].hex())
                        out["verified"].append(known[top] == root)
                    out["doc_id"] += row["doc_ids"]
                    out["subroot"] += [row["subroot"].hex()] * len(row["nodes"])
                    out["root"] += [root.hex()] * len(row["nodes"])
                yield batch_of(out, schema)

    return run


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def numbered(subroots: DataFrame, tables: Tables) -> DataFrame:
    """Sources with their place in the order of their bytes, nulls first.

    Ranges of sources are counted; only these counts, one for each partition, meet in one place.
    """
    ranged = subroots.repartitionByRange(F.col("source").asc_nulls_first()).withColumn("part", F.spark_partition_id())
    ranged = tables.write(ranged, "ranges")
    parts = _before(ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")), [], "part").drop("n")
    nth = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_first())) - 1
    return ranged.withColumn("nth", nth).join(parts, "part").select("source", "digest", (F.col("nth") + F.col("before")).alias("at"))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    spark = docs.sparkSession
    with Tables(spark) as tables:
        rows = tables.write(leaves(docs), "leaves")
        rounds = reduced(placed(rows, containers(rows, tables)), tables, "blocks")
        tables.drop("leaves", "containers", "directory")

        sources = tables.write(numbered(last_blocks(rounds).select("source", "digest"), tables), "sources")
        n = sources.count()
        if not n:
            return spark.createDataFrame([], PROOF)
        one = sources.select(
            F.lit("").alias("source"), "at", F.lit(n).cast("long").alias("total"), "digest",
            F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("tampered"),
        )
        top = reduced(one, tables, "top")
        root = bytes(top[-1].first()["digest"])

        # From the root down: what stands above the block of each round.
        paths = top[-1].select("source", "block").select("*", F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"))
        for k in range(len(top) - 1, -1, -1):
            paths = tables.write(_meet(top[k], paths, ["source", "block"]).mapInArrow(_children, CHILD), f"way{k}").withColumnRenamed("at", "block")
        of_source = paths.select(F.col("block").alias("at"), "path").join(sources, "at").select("source", "path", F.col("digest").alias("subroot"))
        of_source = tables.write(of_source, "above")
        paths = None
        for k in range(len(rounds) - 1, -1, -1):
            last = _meet(rounds[k].where(F.col("total") <= SLOTS), of_source, ["source"])
            if paths is not None:
                inner = _meet(rounds[k].where(F.col("total") > SLOTS), paths, ["source", "block"])
                last = last.unionByName(inner)
            if k:
                paths = tables.write(last.mapInArrow(_children, CHILD), f"down{k}").withColumnRenamed("at", "block")
        return materialize(last.select("doc_ids", "total", "nodes", "tampered", "path", "subroot").mapInArrow(_proofs(root), PROOF), "manifest")
