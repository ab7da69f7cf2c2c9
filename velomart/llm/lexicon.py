"""BPE with a lexicon of frequent words: a minimal acyclic transducer that is memory-mapped.

Spark counts the pieces of all texts. The most frequent are encoded and compiled into an
automaton in which words share both prefixes and suffixes; the numbers on the arcs of a
word's path add up to its place in a list of id sequences. The file is written to the
shared folder, sent to the executors by Spark, and mapped there. Pieces that it lacks are
merged, many at once, by the vocabulary's own ranks.

Rows: null text counts as empty; equal doc ids keep a row each; an empty table gives no
rows. Columns other than doc_id and text are not read. Special tokens that a text spells
out become their ids, as in the library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.llm.select import least
from velomart.llm.text import batch_of, mapped, slices, strings, to_arrow
from velomart.llm.tokens import END, Encoder
from velomart.workspace import Tables, work_dir

#: Words of the lexicon, and pieces that a task counts before it passes the counts on.
WORDS = 50_000
COUNTED = 300_000
#: Characters of the longest word of the lexicon, which bounds its file; longer ones are merged.
LONGEST = 256
#: Pieces that are merged side by side, the cells (pieces by characters) that these fill at most,
#: and characters from which a piece is merged on its own.
TOGETHER, CELLS, LONG = 2048, 1 << 19, 2048


class Merges:
    """Exact byte-pair merging of many pieces at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.size = len(self.vocab)
        v = self.vocab
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([v[a] * self.size + v[b] for a, b in pairs], np.int64)
        made = np.array([v[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order, made[order]
        self.pairs: dict[int, tuple[int, int]] = {}  # filled when a long piece comes

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging each pair; no merge has the last rank."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        found = (self.key[at] == key) & (a >= 0) & (b >= 0)
        return np.where(found, self.rank[at], len(self.key)), self.made[at]

    def merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end, and how many each piece has. Memory is in proportion to the pieces."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(pieces)
        part: list[int] = []

        def merged() -> None:
            for j, ids in zip(part, self._together([pieces[j] for j in part])):
                out[j] = ids
            part.clear()

        for i in sorted(range(len(pieces)), key=lambda i: len(pieces[i])):
            if len(pieces[i]) >= LONG:
                out[i] = self._alone(pieces[i])
                continue
            if part and (len(part) == TOGETHER or (len(part) + 1) * len(pieces[i]) > CELLS):
                merged()
            part.append(i)
        if part:
            merged()
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), np.array([len(x) for x in out], np.int64)

    def _alone(self, piece: str) -> np.ndarray:
        """One long piece: pairs wait in a heap by rank, then place, and neighbours are linked."""
        if not self.pairs:
            self.pairs.update(zip(self.key.tolist(), zip(self.rank.tolist(), self.made.tolist())))
        ids = [*map(self.vocab.__getitem__, piece[:-1]), self.vocab[piece[-1] + END]]
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]

        def pair(at: int):
            key = ids[at] * self.size + ids[after[at]]
            if found := self.pairs.get(key):
                return found[0], at, key, found[1]

        waiting = [p for at in range(n - 1) if (p := pair(at))]
        heapq.heapify(waiting)
        while waiting:
            _, at, key, made = heapq.heappop(waiting)
            right = after[at]
            # Either side may have been merged since.
            if ids[at] < 0 or right < 0 or ids[at] * self.size + ids[right] != key:
                continue
            ids[at], ids[right] = made, -1
            after[at] = after[right]
            if after[at] >= 0:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] >= 0 and (p := pair(left)):
                    heapq.heappush(waiting, p)
        return np.array([x for x in ids if x >= 0], np.uint32)

    def _together(self, pieces: list[str]) -> list[np.ndarray]:
        n, width, none = len(pieces), max(map(len, pieces)), len(self.key)
        ids = np.full((n, width + 1), -1, np.int64)
        v = self.vocab
        for r, p in enumerate(pieces):
            ids[r, : len(p)] = [*(v[c] for c in p[:-1]), v[p[-1] + END]]
        rank = np.full((n, width), none, np.int64)
        rank[:, :] = self._ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel())[0].reshape(n, width)
        columns, live = np.arange(width), np.arange(n)
        while len(live):
            own = rank[live]
            at = own.argmin(1)  # the first of the least rank
            go = own[np.arange(len(live)), at] < none
            live, at = live[go], at[go]
            if not len(live):
                break
            _, made = self._ranks(ids[live, at], ids[live, at + 1])
            right = columns[None, :] > at[:, None]
            moved = ids[live]
            moved[:, :-1] = np.where(right, moved[:, 1:], moved[:, :-1])
            moved[:, -1] = -1
            moved[np.arange(len(live)), at] = made
            ids[live] = moved
            ranks = rank[live]
            ranks[:, :-1] = np.where(right[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = none
            ranks[np.arange(len(live)), at] = self._ranks(made, moved[np.arange(len(live)), at + 1])[0]
            has = at > 0
            before = at[has] - 1
            ranks[np.flatnonzero(has), before] = self._ranks(moved[np.flatnonzero(has), before], made[has])[0]
            rank[live] = ranks
        return [row[row >= 0].astype(np.uint32) for row in ids]


class Builder:
    """Minimal automaton from words in ascending order, built as they come."""

    def __init__(self):
        self.edges: list[dict[int, int]] = [{}]
        self.final = [False]
        self.known: dict[tuple, int] = {}
        self.path: list[tuple[int, int, int]] = []  # state, label, next
        self.last = b""

    def add(self, word: bytes) -> None:
        common = 0
        for a, b in zip(word, self.last):
            if a != b:
                break
            common += 1
        self._settle(common)
        state = self.path[-1][2] if self.path else 0
        for c in word[common:]:
            self.edges.append({})
            self.final.append(False)
            self.edges[state][c] = len(self.edges) - 1
            self.path.append((state, c, len(self.edges) - 1))
            state = len(self.edges) - 1
        self.final[state] = True
        self.last = word

    def _settle(self, keep: int) -> None:
        """Replace the ends of the last word by equal states that are known."""
        while len(self.path) > keep:
            state, label, following = self.path.pop()
            key = (self.final[following], *sorted(self.edges[following].items()))
            self.edges[state][label] = self.known.setdefault(key, following)

    def arrays(self) -> dict[str, np.ndarray]:
        """Arcs by state and label, with what each adds to the word's number."""
        self._settle(0)
        count: dict[int, int] = {}

        def words_below(root: int) -> None:
            stack = [root]
            while stack:
                s = stack[-1]
                open_ = [t for t in self.edges[s].values() if t not in count]
                if open_:
                    stack += open_
                else:
                    count[s] = self.final[s] + sum(count[t] for t in self.edges[s].values())
                    stack.pop()

        words_below(0)
        name = {s: i for i, s in enumerate(sorted(count))}
        key, target, adds = [], [], []
        for s in sorted(count):
            before = int(self.final[s])
            for label, t in sorted(self.edges[s].items()):
                key.append(name[s] << 8 | label)
                target.append(name[t])
                adds.append(before)
                before += count[t]
        final = np.zeros(len(name), np.int64)
        final[[name[s] for s in count if self.final[s]]] = 1
        return {"key": np.array(key, np.int64), "target": np.array(target, np.int64), "adds": np.array(adds, np.int64), "final": final}


def compile_lexicon(pieces: list[str], merges: Merges) -> bytes:
    """The file: five lengths, then arcs (key, target, adds), final states, list starts, ids; all longs."""
    builder, ordered = Builder(), sorted((p.encode(), p) for p in set(pieces))
    for data, _ in ordered:
        builder.add(data)
    a = builder.arrays()
    flat, sizes = merges.merge([p for _, p in ordered])
    parts = [a["key"], a["target"], a["adds"], a["final"], np.cumsum(np.append(0, sizes)), flat.astype(np.int64)]
    head = np.array([len(x) for x in parts], np.int64)
    return b"".join(x.astype(np.int64).tobytes() for x in [head, *parts])


class Lexicon:
    def __init__(self, path: str):
        data = np.memmap(path, np.int64, "r")
        at = np.cumsum(np.append(6, data[:6]))
        self.key, self.target, self.adds, self.final, self.at, self.ids = (data[a:b] for a, b in zip(at, at[1:]))

    def find(self, pieces: list[str]) -> np.ndarray:
        """The number of each word, -1 if it is not there; all walk one byte at a time together."""
        data = [p.encode() for p in pieces]
        size = np.fromiter(map(len, data), np.int64, len(data))
        flat = np.frombuffer(b"".join(data), np.uint8)
        first = np.cumsum(size) - size
        state, number, live = np.zeros(len(data), np.int64), np.zeros(len(data), np.int64), np.ones(len(data), bool)
        if not len(self.key):
            return np.full(len(data), -1)
        for step in range(int(size.max()) if len(size) else 0):
            on = np.flatnonzero(live & (size > step))
            if not len(on):
                break
            key = state[on] << 8 | flat[first[on] + step]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[at] == key
            live[on[~hit]] = False
            state[on[hit]] = self.target[at[hit]]
            number[on[hit]] += self.adds[at[hit]]
        return np.where(live & (self.final[state] == 1), number, -1)

    def sequences(self, numbers: np.ndarray) -> list[np.ndarray]:
        return [self.ids[self.at[i] : self.at[i + 1]] for i in numbers]


class LexiconEncoder(Encoder):
    """Cuts texts as the vocabulary does; ids come from the lexicon or from merging."""

    def __init__(self, vocabulary: str, lexicon: str):
        super().__init__(vocabulary)
        self.merges, self.lexicon = Merges(vocabulary), Lexicon(lexicon)
        self.found = self.merged = 0
        names = {**{i: t for t, i in self.merges.vocab.items()}, **{i: t.content for i, t in self.whole.get_added_tokens_decoder().items()}}
        self.names = [names[i].encode() for i in range(len(names))]

    def _merge(self, pieces: list[str]) -> None:
        number = self.lexicon.find(pieces)
        known, unseen = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
        self.found += len(known)
        self.merged += len(unseen)
        first = len(self.pieces)
        start = self.lexicon.at[number[known]]
        size = self.lexicon.at[number[known] + 1] - start
        total = np.append(0, np.cumsum(size))
        ids = self.lexicon.ids[np.repeat(start - total[:-1], size) + np.arange(total[-1])]
        flat, sizes = self.merges.merge([pieces[i] for i in unseen])
        self.piece_ids.add(np.concatenate([ids.astype(np.uint32), flat]), np.concatenate([size, sizes]))
        self.pieces.update(zip((pieces[i] for i in np.concatenate([known, unseen])), range(first, first + len(pieces)), strict=True))

    def decode(self, ids: np.ndarray) -> bytes:
        """Names of the tokens with blanks between, as the vocabulary has no decoder."""
        return b" ".join(map(self.names.__getitem__, ids.tolist()))


def piece_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """How often each piece occurs in all texts."""
    schema = "piece string, n long"

    def run(batches):
        cutter, arrow, words = Encoder(vocabulary), to_arrow(schema), Counter()

        def counted():
            ordered, cut = cutter.cut_words(list(words))
            pieces: Counter = Counter()
            for word, own in zip(ordered, _runs(cut)):
                for p in own:
                    pieces[p] += words[word]
            return batch_of({"piece": list(pieces), "n": list(pieces.values())}, arrow)

        for batch in slices(batches):
            for text in strings(batch.column("text")):
                words.update(text.encode().split())
            if len(words) > COUNTED:
                yield counted()
                words.clear()
        if words:
            yield counted()

    return docs.select("text").mapInArrow(run, schema).groupBy("piece").agg(F.sum("n").alias("n"))


def frequent_pieces(docs: DataFrame, vocabulary: str, words: int) -> list[str]:
    """The most frequent pieces of up to ``LONGEST`` characters; of equally frequent ones those of least hash."""
    with Tables(docs.sparkSession) as tables:
        counts = tables.write(piece_counts(docs, vocabulary).where(F.length("piece") <= LONGEST), "pieces")
        # Rising with falling counts; a hash parts the many pieces of one count.
        key = F.expr("((2147483647L - least(n, 2147483647L)) << 31) | (xxhash64(piece) & 2147483647L)")
        return [r["piece"] for r in least(counts, key, [key, F.col("piece")], words).select("piece").collect()]


def _runs(cut: list[str]):
    own: list[str] = []
    for p in cut:
        if p == " ":
            yield own
            own = []
        elif p[-1] != " ":
            own.append(p)


def publish(spark, data: bytes) -> str:
    """Write the file to the shared folder and have Spark bring it to every executor."""
    name = f"lexicon-{uuid.uuid4().hex}"
    folder = work_dir(spark)
    system, path = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
    system.create_dir(path)
    with system.open_output_stream(f"{path}/{name}") as f:
        f.write(data)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


_encoders: dict[tuple[str, str], LexiconEncoder] = {}


def _encoder(vocabulary: str, name: str) -> LexiconEncoder:
    if (vocabulary, name) not in _encoders:
        _encoders.clear()
        _encoders[vocabulary, name] = LexiconEncoder(vocabulary, SparkFiles.get(name))
    return _encoders[vocabulary, name]


def encode_decode(docs: DataFrame, vocabulary: str, words: int = WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document."""
    top = frequent_pieces(docs, vocabulary, words)
    name = publish(docs.sparkSession, compile_lexicon(top, Merges(vocabulary)))

    def each(batch: pa.RecordBatch):
        enc = _encoder(vocabulary, name)
        ids, at = enc.encode(strings(batch.column("text")))
        runs = [ids[a:b] for a, b in zip(at, at[1:])]
        yield {
            "doc_id": batch.column("doc_id"), "n_tokens": np.diff(at),
            "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in runs],
            "decoded_sha256": [hashlib.sha256(enc.decode(x)).hexdigest() for x in runs],
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), schema, each)
