"""N-gram Jaccard join by prefix trees.

Texts are sets of hashes of n-grams of words, in one order over all texts: rare n-grams
first. How often each is found is counted over all texts by a sketch of fixed size, whose
cells several n-grams share (any order gives the same links, so counts may be too high). Sets with J >= t share an n-gram among the first n - ceil(t n) + 1 of
each, so Spark brings sets together by these n-grams only, never by all pairs.

Where sets meet, they are stored in a prefix tree. A set walks the tree once; what it
shares with a path is counted once for all sets below it, and a subtree is left when even
its best length could no longer reach the threshold with what remains of both.

Only reachability is asked for, so sets known to be linked are not compared again:
1. Equal sets are one class from the start.
2. Each class meets one other: of the first classes of its n-grams, the one that shares
   most of them. What links becomes one component; groups of near copies collapse here,
   in work linear in their rows, and a text travels once.
3. Sizes allow a link within a factor of t, so an n-gram brings together only sets of one
   band of sizes or of neighbouring ones. Also c shared ones among the first p n-grams
   allow c + max(n - p) in all. By these bounds classes are near or not, first with the
   first class of every n-gram and band; where these still join classes not connected so,
   all their classes meet in trees of their first n-grams.
4. The classes that are connected by being near, but not linked, meet with whole sets.
A cell of over ``CELL`` classes or ``CELL_GRAMS`` n-grams is cut into blocks, and each two blocks meet.
Within a tree, what has joined the first set's component is no longer walked: its links to
the rest are found from the rest. Texts are kept packed by the first pass; the rows that
must meet are looked up in it by number, sent to all tasks while they take ``SENT`` bytes
at most and by a shuffle beyond.
Links are exact up to collisions of 64-bit hashes.

Rows: null or blank text has an empty set, links with nothing and is its own component.
Each row is a node of its own text: rows that share a doc_id are linked only if their texts
are, and the component's id is the least doc_id of its rows. A null doc_id takes no part and
gets a null component. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.llm.graph import components
from velomart.llm.text import SLICE_BYTES, Words, batch_of, mapped, mix, raw, release, slices, to_arrow
from velomart.workspace import Tables, materialize

#: Classes that meet in one tree.
CELL = 400
#: N-grams of the whole sets that meet in one tree.
CELL_GRAMS = 2_000_000
#: Measured bytes of looked-up row numbers up to which they are broadcast.
SENT = 32 << 20
#: Cells of the sketch by bits of the hash, cells that travel together, and parts that are added up at once.
SKETCH_BITS, CHUNK, ADDED = 24, 1 << 16, 32
#: Share of a task's rows from which a key is dealt by class too, among so many salts.
FULL, SALTS = 0.25, 64
#: Classes that a task remembers.
SEEN = 1 << 19
_BAND = np.uint64(0x9E3779B97F4A7C15)


def ngram_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Distinct n-gram hashes of each text, ascending; a shorter text is one n-gram."""
    words = Words(column)
    h, whole = words.shingles(k)
    out = []
    for a, b in zip(words.at, words.at[1:]):
        if a == b:
            out.append(h[:0])
        elif b - a < k:
            code = np.uint64(b - a)
            for x in words.hashes[a:b]:
                code = mix(np.array([code]) * np.uint64(0x9E3779B97F4A7C15) + x)[0]
            out.append(np.array([code], np.uint64))
        else:
            out.append(np.unique(h[a : b - k + 1]))
    return out


def class_of(grams: np.ndarray) -> int:
    """A number for the set: equal sets have equal ones."""
    return int(mix(np.array([mix(grams).sum(dtype=np.uint64) + np.uint64(len(grams))]))[0].view(np.int64))


def cell_of(grams: np.ndarray) -> np.ndarray:
    """Each n-gram's place in the sketch: the upper bits of its hash."""
    return (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


class Order:
    """All n-grams in one order: by how often their cell of the sketch was met, then by hash."""

    def __init__(self, counts: np.ndarray):
        """``counts`` of all cells; they are kept as steps of a quarter of a doubling, a byte each."""
        self.steps = np.empty(len(counts), np.uint8)
        for at in range(0, len(counts), CHUNK):  # all at once would take several times the sketch
            part = slice(at, at + CHUNK)
            self.steps[part] = np.round(4 * np.log2(np.maximum(counts[part], 1)))
        self.total = int(counts.sum(dtype=np.int64))

    def sort(self, grams: np.ndarray) -> np.ndarray:
        """The ascending set in this order."""
        return grams[np.argsort(self.steps[cell_of(grams)], kind="stable")]

    def often(self, grams: np.ndarray, limit: float) -> np.ndarray:
        """Whether each n-gram may come more often than that."""
        return self.steps[cell_of(grams)] > 4 * math.log2(max(limit, 1))


class Node:
    __slots__ = ("segment", "children", "ends", "longest", "least", "rest", "label")

    def __init__(self, segment: np.ndarray):
        self.segment, self.children, self.ends = segment, [], []


class Trie:
    """Sets, or the first parts of sets, as ascending numbers; paths without a branch are one node.

    ``sizes`` are those of the whole sets, ``rests`` how much of each is not in the tree.
    """

    def __init__(self, sets: list[np.ndarray], labels: list[int], sizes: list[int], rests: list[int]):
        self.sets, self.labels, self.sizes, self.rests = sets, labels, sizes, rests
        self.root = Node(np.zeros(0, np.int64))
        stack = [(self.root, sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes()), 0)]
        while stack:
            node, own, depth = stack.pop()
            node.longest = max(len(sets[i]) for i in own)
            node.least, node.rest = min(sizes[i] for i in own), max(rests[i] for i in own)
            found = {labels[i] for i in own}
            node.label = found.pop() if len(found) == 1 else None
            node.ends = [i for i in own if len(sets[i]) == depth]
            own = [i for i in own if len(sets[i]) > depth]
            at = 0
            while at < len(own):
                first, stop = sets[own[at]][depth], at
                while stop < len(own) and sets[own[stop]][depth] == first:
                    stop += 1
                a, b = sets[own[at]][depth:], sets[own[stop - 1]][depth:]
                n = min(len(a), len(b))
                differ = np.flatnonzero(a[:n] != b[:n])
                n = int(differ[0]) if len(differ) else n
                child = Node(a[:n])
                node.children.append(child)
                stack.append((child, own[at:stop], depth + n))
                at = stop

    def similar(self, i: int, inside: np.ndarray, num: int, den: int):
        """Sets of another label that may have den * |x & y| >= num * |x | y|; whole sets do have it."""
        x, n, rest, label = self.sets[i], self.sizes[i], self.rests[i], self.labels[i]
        stack = [(self.root, 0, 0)]
        while stack:
            node, shared, depth = stack.pop()
            if node.label is not None and node.label == label:
                continue
            used = 0
            if len(node.segment):
                shared += int(np.count_nonzero(inside[node.segment]))
                depth += len(node.segment)
                used = int(np.searchsorted(x, node.segment[-1], "right"))
            reach = shared + min(len(x) - used, node.longest - depth) + max(rest, node.rest)
            if (num + den) * min(reach, n) < num * (n + node.least):
                continue
            for j in node.ends:
                m = self.sizes[j]
                if self.labels[j] != label and num * max(n, m) <= den * min(n, m) and (num + den) * (shared + max(rest, self.rests[j])) >= num * (n + m):
                    yield j
            stack += [(c, shared, depth) for c in node.children]


def tree_links(
    ids: list[int], labels: list[int], sets: list[np.ndarray], order: Order, num: int, den: int, sizes: list[int] | None = None
) -> list[tuple[int, int]]:
    """Links that join sets of different labels; enough of them to reach whatever all links reach.

    With ``sizes``, ``sets`` are those of their first n-grams that others hold too, and
    the links are the ones that are still possible.
    """
    if len(set(labels)) < 2:
        return []
    rests = [0 if sizes is None else -(-num * n // den) - 1 for n in sizes or ids]
    grams, held = np.unique(np.concatenate(sets), return_counts=True)
    rank = np.empty(len(grams), np.int64)
    rank[np.searchsorted(grams, order.sort(grams))] = np.arange(len(grams))
    if sizes is None:  # whole sets: the rarest among these first, so that what differs is met at once
        by_count = np.lexsort((rank, held))
        rank[by_count] = np.arange(len(grams))
        few = min(map(len, sets))
        own = [int((held[np.searchsorted(grams, s)] > 1).sum()) for s in sets]
        could = [i for i, n in enumerate(own) if (num + den) * n >= num * (len(sets[i]) + few)]
        ids, labels, sets = ([x[i] for i in could] for x in (ids, labels, sets))
        if len(set(labels)) < 2:
            return []
        rests = [0] * len(ids)
    ranked = [np.sort(rank[np.searchsorted(grams, s)]) for s in sets]
    parent = {x: x for x in labels}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    trie = Trie(ranked, labels, sizes or [len(s) for s in sets], rests)
    inside = np.zeros(len(grams), bool)
    links, apart = [], len(parent)
    begin = labels.index(Counter(labels).most_common(1)[0][0])
    for i in [begin, *range(begin), *range(begin + 1, len(ranked))]:
        if i != begin and top(labels[i]) == top(labels[begin]):
            continue
        own = ranked[i]
        inside[own] = True
        for j in trie.similar(i, inside, num, den):
            a, b = top(labels[i]), top(labels[j])
            if a != b:
                parent[a] = b
                links.append((ids[i], ids[j]))
                apart -= 1
                if apart == 1:
                    return links
        inside[own] = False
    return links


def pack(column: pa.Array) -> list[bytes]:
    """Each text compressed by itself; null counts as empty."""
    data, at = raw(column)
    whole, packer = data.tobytes(), zstandard.ZstdCompressor(level=3)
    return [packer.compress(whole[a:b]) for a, b in zip(at, at[1:])]


def unpacked(batches):
    """Batches with ``packed`` back as ``text``, in parts of about ``SLICE_BYTES`` of text."""
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        i = batch.schema.get_field_index("packed")
        column, others = batch.column(i), batch.drop_columns(["packed"])
        first, texts, size = 0, [], 0
        for at, value in enumerate(column):
            texts.append(unpacker.decompress(value.as_py()))
            size += len(texts[-1])
            if size >= SLICE_BYTES or at + 1 == batch.num_rows:
                text = pa.array(texts, pa.binary()).cast(pa.string())
                yield others.slice(first, at + 1 - first).append_column("text", text)
                first, texts, size = at + 1, [], 0


def _shapes(docs: DataFrame, k: int) -> DataFrame:
    """Rows ``kind`` 0: document, class and size of its set, number of the row and packed text.

    Rows ``kind`` 1: the sketch of a task, in chunks (``x``) of packed counts; ``y`` is the task.
    """
    schema = "kind int, x long, y long, n long, row long, packed binary"

    def run(batches):
        arrow, task = to_arrow(schema), TaskContext.get().partitionId()
        row, met = task << 33, np.zeros(1 << SKETCH_BITS, np.uint32)
        any_text = False
        for batch in slices(batches):
            sets = ngram_sets(batch.column("text"), k)
            yield batch_of({
                "kind": np.zeros(len(sets), np.int32), "x": batch.column("doc_id"),
                "y": [class_of(s) for s in sets], "n": [len(s) for s in sets],
                "row": np.arange(row, row + len(sets)), "packed": pack(batch.column("text")),
            }, arrow)
            row += len(sets)
            any_text = True
            cells, n = np.unique(cell_of(np.concatenate(sets)), return_counts=True)
            met[cells] += n.astype(np.uint32)
        if any_text:
            chunks = met.reshape(-1, CHUNK)
            filled = np.flatnonzero(chunks.any(axis=1))
            zero = np.zeros(len(filled), np.int64)
            yield batch_of({
                "kind": np.ones(len(filled), np.int32), "x": filled, "y": zero + task, "n": zero, "row": zero,
                "packed": [_packed_counts(chunks[c]) for c in filled],
            }, arrow)

    return docs.mapInArrow(run, schema)


def _packed_counts(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<u4").tobytes())


def _counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<u4")


def _sketch(shapes: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches, added up in a tree so that no task holds many; its size is fixed."""
    schema = "x long, y long, packed binary"

    def run(batches):
        arrow = to_arrow(schema)
        for batch in batches:
            out = {"x": [], "y": [], "packed": []}
            for x, y, parts in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "parts"))):
                total = np.zeros(CHUNK, np.uint64)
                for part in parts:
                    total += _counts(part)
                out["x"].append(x)
                out["y"].append(y)
                out["packed"].append(_packed_counts(np.minimum(total, (1 << 32) - 1)))
            yield batch_of(out, arrow)

    now = shapes.where("kind = 1").select("x", "y", "packed")
    tasks = (now.agg(F.max("y")).first()[0] or 0) + 1
    while tasks > 1:
        grouped = now.groupBy("x", F.expr(f"y div {ADDED}").alias("y")).agg(F.collect_list("packed").alias("parts"))
        now = grouped.mapInArrow(run, schema)
        tasks = -(-tasks // ADDED)
    met = np.zeros((1 << SKETCH_BITS) // CHUNK * CHUNK, np.uint32).reshape(-1, CHUNK)
    for r in now.collect():  # a row for each chunk
        met[r["x"]] = _counts(r["packed"])
    return met.ravel()


def _with_texts(cells: DataFrame, classes: DataFrame, shapes: DataFrame, tables: Tables) -> DataFrame:
    """``cells`` (cell, class, label) with the packed text of one row of each class."""
    wanted = tables.write(cells.join(classes.select("class", "row"), "class"), "wanted")
    rows = wanted.count()
    width = 8 * len(wanted.columns)
    kept = shapes.where("kind = 0 and n > 0").select("row", "packed")
    return kept.join(F.broadcast(wanted) if rows * width <= SENT else wanted, "row").drop("row")


KEY = "gram long, class long, n long, salt long"
MET = "gram long, class long, n long, hub long, hub_n long"


def _limit(order: Order, num: int, den: int, tasks: int) -> float:
    """Number of an n-gram from which it alone would be a good part of what a task reads of the first n-grams."""
    return FULL * 2 * (1 - num / den) * order.total / tasks


def _prefixes(docs: DataFrame, k: int, order, num: int, den: int, limit: float) -> DataFrame:
    """The first n-grams of each set by its band of sizes and the next one: key, class, size, and a salt for frequent ones.

    ``n`` is twice the size, and one more in the next band.

    A task that meets a class again passes over it.
    """

    def run(batches):
        arrow, seen = to_arrow(KEY), set()
        for batch in slices(batches):
            first, owner, size = [], [], []
            for s in ngram_sets(batch.column("text"), k):
                if not len(s) or (c := class_of(s)) in seen:
                    continue
                seen.add(c)
                first.append(order.value.sort(s)[: len(s) - (-(-num * len(s) // den)) + 1])
                owner.append(c)
                size.append(len(s))
            if len(seen) > SEEN:
                seen.clear()
            if not first:
                continue
            each = [len(f) for f in first]
            grams, owners, sizes = np.concatenate(first), np.repeat(np.array(owner, np.int64), each), np.repeat(np.array(size, np.int64), each)
            band = np.floor(np.log(sizes) / math.log(den / num) + 1e-9).astype(np.uint64)
            salt = pa.array(owners % SALTS, pa.int64(), mask=~order.value.often(grams, limit))
            for upper, b in enumerate((band, band + np.uint64(1))):
                yield batch_of({"gram": mix(grams + b * _BAND), "class": owners, "n": 2 * sizes + upper, "salt": salt}, arrow)

    return docs.select("text").mapInArrow(run, KEY)


def _first_of_keys(batches):
    """Rows sorted by key (gram, class, n, salted or not) to ``MET``: of the keys of several classes, with the least class.

    Classes that are all in the next band of their own have met in that one, and are left out here. Salted keys stand in several tasks and pass without it.
    """
    arrow, held = to_arrow(MET), np.zeros((4, 0), np.int64)

    def met(rows: np.ndarray):
        new = np.append(True, rows[0, 1:] != rows[0, :-1])
        run = np.cumsum(new) - 1
        kept = np.flatnonzero((np.bincount(run)[run] > 1) | (rows[3] == 1))
        gram, owner, n, salted = rows[:, kept[np.lexsort((rows[1, kept], run[kept]))]]
        once = np.append(True, (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])) if len(gram) else np.zeros(0, bool)
        gram, owner, n, salted = gram[once], owner[once], n[once], salted[once] == 1
        upper, n = n & 1, n >> 1
        new = np.append(True, gram[1:] != gram[:-1]) if len(gram) else np.zeros(0, bool)
        first, run = np.flatnonzero(new), np.cumsum(new) - 1
        several = salted
        if len(gram):
            size = np.bincount(run)
            several = several | ((size > 1) & (np.bincount(run, upper) < size))[run]
        hub = first[run]
        out = {"gram": gram, "class": owner, "n": n}
        for name, values in (("hub", owner[hub]), ("hub_n", n[hub])):
            out[name] = pa.array(values[several], pa.int64(), mask=salted[several])
        return batch_of({**out, **{c: out[c][several] for c in ("gram", "class", "n")}}, arrow)

    for batch in batches:
        rows = np.array([c.to_numpy() for c in batch.columns])
        held = np.concatenate([held, rows], 1) if held.shape[1] else rows
        if not held.shape[1]:
            continue
        whole = int(np.searchsorted(held[0], held[0, -1]))  # the last key may go on
        if whole:
            yield met(held[:, :whole])
            held = held[:, whole:]
    if held.shape[1]:
        yield met(held)
    del held
    release()


def _shared(prefixes: DataFrame, tables: Tables) -> DataFrame:
    """``MET`` of all keys that several classes have, each class once."""
    n = max(8, int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = prefixes.select("gram", "class", "n", F.when(F.col("salt").isNull(), 0).otherwise(1).cast("long").alias("salted"), "salt")
    together = keyed.repartition(n, "gram", "salt").sortWithinPartitions("gram")
    met = tables.write(together.select("gram", "class", "n", "salted").mapInArrow(_first_of_keys, MET), "keys")
    often = met.where("hub is null").select("gram", "class", "n").distinct()
    if often.isEmpty():
        return met
    first = often.groupBy("gram").agg(F.min(F.struct("class", "n")).alias("p"), F.max("class").alias("last")).where("p.class <> last")
    first = tables.write(first.select("gram", F.col("p.class").alias("hub"), F.col("p.n").alias("hub_n")), "first")
    return tables.write(met.where("hub is not null").unionByName(often.join(first, "gram")), "met")


def _meet(rows: DataFrame, order, num: int, den: int, k: int) -> DataFrame:
    """Links within each ``cell`` of rows (cell, class, label, and packed text or size and grams)."""
    schema = "a long, b long"
    whole = "packed" in rows.columns
    names = ["cell", "class", "label", "packed"] if whole else ["cell", "class", "label", "n", "grams"]

    def run(batches):
        arrow = to_arrow(schema)
        cell, own, found = None, [], []

        def close():
            if len(own) < 2:
                return []
            ids, labels, sets, sizes = zip(*own)
            return tree_links(ids, labels, sets, order.value, num, den, None if whole else sizes)

        for batch in unpacked(batches) if whole else batches:
            if whole:
                sets = ngram_sets(batch.column("text"), k)
                sizes = [0] * len(sets)
            else:
                sets = [np.sort(np.array(g, np.int64).view(np.uint64)) for g in batch.column("grams").to_pylist()]
                sizes = batch.column("n").to_pylist()
            for c, *row in zip(*(batch.column(x).to_pylist() for x in names[:3]), sets, sizes):
                if c != cell:
                    found += close()
                    cell, own = c, []
                if not own or own[-1][0] != row[0]:
                    own.append(row)
            if found:
                yield batch_of(dict(zip(("a", "b"), zip(*found))), arrow)
                found = []
        found += close()
        if found:
            yield batch_of(dict(zip(("a", "b"), zip(*found))), arrow)

    n = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    together = rows.repartition(n, "cell").sortWithinPartitions("cell", "class")
    return together.select(*names).mapInArrow(run, schema)


def _cells(rows: DataFrame, limit: int) -> DataFrame:
    """Cut cells whose ``weight`` sums to over ``limit`` into blocks, and let each two blocks meet.

    Rows: cell, class, label, weight. A class is in as many cells as there are blocks.
    """
    size = rows.groupBy("cell").agg(F.sum("weight").alias("m"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("m") / limit)).cast("int")
    cut = rows.join(size, "cell").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("class", "cell"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cut = cut.select("cell", "class", "label", "own", other.alias("other"))
    return cut.select(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "class", "label")


def jaccard_join(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of each row; two texts link when den * |x & y| >= num * |x | y|."""
    spark = docs.sparkSession
    with Tables(spark) as tables:
        return _joined(docs, k, num, den, tables)


def without_near_copies(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents, all columns, with one row of each component: that of the least doc_id, then hash of the text.

    Rows, not doc_ids, are told apart, so a row is not lost because another of its doc_id is
    a copy. Of rows with equal doc_id and text one stays, by a hash of all columns. Rows
    without a word or without a doc_id all stay. Exact up to collisions of 64-bit hashes.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.col("doc_id").cast("long"), "text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("own"), key.alias("doc_id"), "text")
    with Tables(docs.sparkSession) as tables:
        joined = jaccard_join(rows.select("doc_id", "text"), k, num, den).where("n_shingles > 0")
        nodes = joined.groupBy("doc_id").agg(F.first("component_id").alias("component"), F.count(F.lit(1)).alias("n"))
        own = rows.select("own", "doc_id").where("doc_id is not null").distinct()
        nodes = tables.write(nodes.join(own, "doc_id"), "nodes")
        first = nodes.groupBy("component").agg(F.min(F.struct("own", "doc_id")).alias("f")).select("f.doc_id")
        several = nodes.where("n > 1").select("doc_id", "n").join(first, "doc_id")
        gone = nodes.select("doc_id").join(first, "doc_id", "left_anti").withColumn("copies", F.lit(0))
        marks = tables.write(gone.unionByName(several.select("doc_id", F.lit(1).alias("copies"))), "marks")
        marks = marks.select(F.col("doc_id").alias("near_copy_key_"), F.col("copies").alias("near_copies_"))
        met = docs.withColumn("near_copy_key_", key).join(marks, "near_copy_key_", "left")
        whole = F.struct(*(F.col(c) for c in docs.columns))
        once = (
            met.where("near_copies_ = 1").groupBy("near_copy_key_")
            .agg(F.min_by(whole, F.xxhash64(*docs.columns)).alias("row_")).select("row_.*")
        )
        return materialize(met.where("near_copies_ is null").select(*docs.columns).unionByName(once), "without_copies")


def _joined(docs: DataFrame, k: int, num: int, den: int, tables: Tables) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shapes = tables.write(_shapes(docs, k), "shapes")
    rows = shapes.where("kind = 0").select(F.col("x").alias("doc_id"), F.col("y").alias("class"), "n", "row")
    order = spark.sparkContext.broadcast(Order(_sketch(shapes)))  # a byte for each cell
    with_id = rows.where("doc_id is not null and n > 0")
    classes = with_id.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.min("row").alias("row"))
    classes = tables.write(classes, "classes")

    limit = _limit(order.value, num, den, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    met = _shared(_prefixes(docs.where("doc_id is not null"), k, order, num, den, limit), tables)

    # Each class with the first class of each of its n-grams, where sizes and the number of
    # n-grams shared so (twice those of the same band) allow a link.
    rest = lambda n: F.floor((num * F.col(n) + (den - 1)) / den) - 1
    reach = F.col("count") + F.greatest(rest("n"), rest("hub_n"))
    alike = num * F.greatest("n", "hub_n") <= den * F.least("n", "hub_n")
    fit = alike & ((num + den) * reach >= num * (F.col("n") + F.col("hub_n")))
    stars = met.where("class <> hub").groupBy("class", "n", "hub", "hub_n").count().where(fit)
    stars = tables.write(stars.select("class", "n", "hub", "count"), "stars")
    best = stars.groupBy("class", "n").agg(F.max_by("hub", F.struct("count", "hub")).alias("hub"))
    full = F.greatest(F.count(F.lit(1)) / CELL, F.sum("n") / CELL_GRAMS)
    portions = best.groupBy("hub").agg(F.ceil(full).cast("int").alias("portions"))
    placed = best.join(portions, "hub").withColumn("portion", F.pmod(F.xxhash64("class"), F.col("portions")).cast("int"))
    cell = F.xxhash64("hub", "portion").alias("cell")
    own = placed.select(cell, "class", F.col("class").alias("label"))
    hubs = placed.select("hub", "portion").distinct().select(cell, F.col("hub").alias("class"), F.col("hub").alias("label"))
    links = tables.write(_meet(_with_texts(own.unionByName(hubs), classes, shapes, tables), order, num, den, k), "links")
    label = tables.write(components(links), "labels")

    # N-grams that still join classes not yet thought near: all their classes meet.
    thought = components(links.unionByName(stars.select(F.col("class").alias("a"), F.col("hub").alias("b"))))
    thought = thought.select(F.col("node").alias("class"), F.col("component").alias("thought"))
    labelled = (
        met.select("gram", "class", "n").join(thought, "class", "left")
        .select("gram", "class", "n", F.coalesce("thought", "class").alias("label"))
    )
    labelled = tables.write(labelled, "labelled")
    open_ = labelled.groupBy("gram").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("members"), F.count(F.lit(1)).alias("m"),
    ).where("low <> high")
    once = open_.groupBy("members", "m").agg(F.min("gram").alias("gram")).select("gram")
    banded = labelled.join(once, "gram").select(F.col("gram").alias("cell"), "class", "label", F.lit(1).alias("weight"))
    firsts = met.groupBy("class", "n").agg(F.collect_list("gram").alias("grams"))  # no more than its first n-grams
    cells = _cells(tables.write(banded, "banded"), CELL).join(firsts, "class")
    near = tables.write(_meet(cells, order, num, den, k), "near")

    # What is near in the end, where it holds more than one component of links.
    own_thought = labelled.select("class", "label", F.col("n").alias("weight")).distinct()
    ends = own_thought.select(F.col("class").alias("a"), F.col("label").alias("la"))
    others = own_thought.select(F.col("class").alias("b"), F.col("label").alias("lb"))
    group = components(near.join(ends, "a").join(others, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))
    group = group.select(F.col("node").alias("label"), F.col("component").alias("found"))
    own_label = (
        own_thought.join(group, "label", "left").withColumn("cell", F.coalesce("found", "label")).drop("label", "found")
        .join(label.withColumnRenamed("node", "class"), "class", "left")
        .select("cell", "class", F.coalesce("component", "class").alias("label"), "weight")
    )
    open_cells = own_label.groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    whole = tables.write(_cells(own_label.join(open_cells.select("cell"), "cell"), CELL_GRAMS), "whole")
    more = _meet(_with_texts(whole, classes, shapes, tables), order, num, den, k)

    label = components(links.unionByName(more))
    of_class = classes.join(label.withColumnRenamed("node", "class"), "class").select("class", "doc_id", "component")
    first = of_class.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = of_class.join(first, "component").select("class", "component_id")
    result = (
        rows.join(classes.select("class", F.col("doc_id").alias("own")), "class", "left").join(of_class, "class", "left")
        .select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.coalesce("component_id", "own")).otherwise(F.col("doc_id")).alias("found"),
        )
    )
    return materialize(result.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("found")).alias("component_id")), "joined")
