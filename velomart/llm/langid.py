"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy.

The network reads windows: the bytes of a word between white space, words of over
``WINDOW`` bytes in pieces. Two recurrent passes give every byte position a distribution
over the languages; a document's is the mean over all its positions. Equal windows have
equal outputs, so each distinct window of a slice of texts is run once and counted.

Rows: null text and text without a letter is ``und`` with score 0. Rows that share a
doc_id are predicted each on their own. If nothing can be learned (no row with a
language) all are ``und``. Only doc_id, text and, for learning, lang are read.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.llm.text import batch_of, mapped, release, slices, strings, to_arrow

WINDOW = 24
UNDEFINED = "und"
#: Windows kept with their outputs by one task; what is kept only saves time.
KEPT = 200_000


_BYTES = np.arange(256)[:, None]


def windows(text: str) -> list[bytes]:
    words = text.encode().split()
    if any(len(w) > WINDOW for w in words):
        return list(chain.from_iterable([w[i : i + WINDOW] for i in range(0, len(w), WINDOW)] for w in words))
    return words


def has_letter(text: str) -> bool:
    return next(filter(str.isalpha, text), None) is not None


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class BiGRU:
    """Two gated recurrent layers, one from each end, and a label for every position."""

    def __init__(self, labels: list[str], hidden: int = 16, seed: int = 5):
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0] if shape[0] != 256 else 4)).astype(np.float32)
        self.labels, self.hidden = labels, hidden
        self.p = {}
        for d in "fb":
            self.p |= {
                f"E{d}": make(256, 3 * hidden), f"U{d}": make(hidden, 2 * hidden), f"V{d}": make(hidden, hidden),
                f"W{d}": make(hidden, len(labels)),
            }
        self.p["b"] = np.zeros(len(labels), np.float32)

    @staticmethod
    def padded(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        length = np.fromiter(map(len, items), np.int64, len(items))
        width = int(length.max())
        data = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in items), np.uint8)
        return data.reshape(len(items), width), np.arange(width) < length[:, None]

    def _run(self, x: np.ndarray, live: np.ndarray, d: str, keep: bool = False):
        """States after each step; a step on padding leaves the state as it is."""
        n, width, h = *x.shape, self.hidden
        E, U, V = (self.p[k + d] for k in "EUV")
        state, states, tape = np.zeros((n, h), np.float32), np.zeros((width, n, h), np.float32), []
        for t in range(width) if d == "f" else range(width - 1, -1, -1):
            e = E[x[:, t]]
            gates = _sigmoid(e[:, : 2 * h] + state @ U)
            z, r = gates[:, :h], gates[:, h:]
            c = np.tanh(e[:, 2 * h :] + (r * state) @ V)
            on = None if live is None else live[:, t, None]
            new = state + z * (c - state)
            if on is not None:
                new = np.where(on, new, state)
            if keep:
                tape.append((t, state, z, r, c, on))
            state = states[t] = new
        return states, tape

    def positions(self, x: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Distribution over labels at each position: positions x windows x labels."""
        logits = sum(self._run(x, live, d)[0] @ self.p["W" + d] for d in "fb") + self.p["b"]
        e = np.exp(logits - logits.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    def pooled(self, items: list[bytes], at_once: int = 1024) -> np.ndarray:
        """For each window the sum of its positions' distributions."""
        out = np.zeros((len(items), len(self.labels)), np.float32)
        length = np.fromiter(map(len, items), np.int64, len(items))
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for same in np.split(order, cuts) if len(items) else []:  # equal lengths need no padding
            for i in range(0, len(same), at_once):
                part = same[i : i + at_once]
                data = np.frombuffer(b"".join([items[j] for j in part]), np.uint8)
                out[part] = self.positions(data.reshape(len(part), -1), None).sum(0)
        return out

    def gradients(self, x: np.ndarray, live: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the cross entropy at all positions, by backpropagation through time."""
        runs = {d: self._run(x, live, d, True) for d in "fb"}
        logits = sum(runs[d][0] @ self.p["W" + d] for d in "fb") + self.p["b"]
        e = np.exp(logits - logits.max(-1, keepdims=True))
        delta = e / e.sum(-1, keepdims=True)
        delta[:, np.arange(len(y)), y] -= 1
        delta *= live.T[:, :, None] / live.sum()
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["b"] = delta.sum((0, 1))
        h = self.hidden
        for d in "fb":
            states, tape = runs[d]
            g["W" + d] = np.einsum("tnh,tnl->hl", states, delta)
            inward = delta @ self.p["W" + d].T
            U, V = self.p["U" + d], self.p["V" + d]
            back = np.zeros_like(states[0])
            for t, state, z, r, c, on in reversed(tape):
                total = back + inward[t]
                live_part = total * on
                dc = live_part * z * (1 - c * c)
                dz = live_part * (c - state) * z * (1 - z)
                drs = dc @ V.T
                dr = drs * state * r * (1 - r)
                dg = np.concatenate([dz, dr], 1)
                g["E" + d] += (_BYTES == x[:, t]).astype(np.float32) @ np.concatenate([dg, dc], 1)
                g["U" + d] += state.T @ dg
                g["V" + d] += (r * state).T @ dc
                back = total * ~on + live_part * (1 - z) + drs * r + dg @ U.T
        return g

    def train(self, items: list[bytes], y: np.ndarray, rounds: int, batch: int = 256, rate: float = 0.01, seed: int = 3) -> None:
        """Adam over batches in random order; the rate falls linearly to a tenth."""
        rng = np.random.default_rng(seed)
        m, v, step = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2)), None, 0
        m, v = m
        per_round = -(-len(items) // batch)
        for _ in range(rounds):
            order = rng.permutation(len(items))
            for i in range(0, len(items), batch):
                part = order[i : i + batch]
                x, live = self.padded([items[j] for j in part])
                step += 1
                now = rate * (1 - 0.9 * step / (rounds * per_round))
                for k, g in self.gradients(x, live, y[part]).items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)


def sample_windows(docs: DataFrame, documents: int, per_document: int) -> list[tuple[str, bytes]]:
    """Windows of a bounded sample: ``documents`` per language, ``per_document`` of each at most.

    The row of the least hash stands for each of ``documents`` classes of rows, so every
    part of the table is drawn from. Within a document windows are drawn by hash too.
    """
    known = docs.where("lang is not null and text is not null").withColumn("h", F.xxhash64("doc_id", F.length("text")))
    least = known.groupBy("lang", F.pmod("h", F.lit(documents)).alias("class")).agg(F.min("h").alias("h"))
    # documents x languages rows.
    chosen = F.broadcast(least.select("lang", "h")) if least.count() <= 100_000 else least.select("lang", "h")

    def each(batch: pa.RecordBatch):
        from zlib import crc32

        lang, window = [], []
        for name, text in zip(batch.column("lang").to_pylist(), strings(batch.column("text"))):
            own = sorted(set(windows(text)), key=lambda w: (crc32(w), w))[:per_document]
            lang += [name] * len(own)
            window += own
        yield {"lang": lang, "window": window}

    # Rows that share a hash give one text, so that repeated ones don't widen the sample.
    one = known.join(chosen, ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    rows = mapped(one.select("lang", "text"), "lang string, window binary", each)
    return sorted((r["lang"], bytes(r["window"])) for r in rows.collect())


def fit(docs: DataFrame, documents: int = 128, per_document: int = 40, hidden: int = 16, rounds: int = 6) -> BiGRU | None:
    """Learn from rows with text and lang; ``documents`` x ``per_document`` windows a language bound the sample."""
    rows = sample_windows(docs, documents, per_document)
    if not rows:
        return None
    labels = sorted({lang for lang, _ in rows})
    counts = np.array([sum(lang == x for lang, _ in rows) for x in labels])
    rng, index = np.random.default_rng(1), {x: i for i, x in enumerate(labels)}
    y = np.array([index[lang] for lang, _ in rows])
    # Languages of fewer windows are repeated to the same number.
    extra = [rng.choice(np.flatnonzero(y == i), counts.max() - c) for i, c in enumerate(counts)]
    at = np.concatenate([np.arange(len(rows)), *extra])
    network = BiGRU(labels, hidden)
    network.train([rows[i][1] for i in at], y[at], rounds)
    return network


class Predictor:
    """The network with the outputs of windows that a task has met."""

    def __init__(self, network: BiGRU):
        self.network, self.kept = network, {}
        self.known = np.zeros((1 << 12, len(network.labels)), np.float32)

    def shares(self, texts: list[str]) -> np.ndarray:
        """For each text the sum of its positions' distributions."""
        own = [windows(t) for t in texts]
        flat = list(chain.from_iterable(own))
        new = set(flat).difference(self.kept)
        if len(self.kept) + len(new) > KEPT:
            self.kept.clear()
            new = set(flat)
        if new:
            new, n = list(new), len(self.kept)
            if n + len(new) > len(self.known):
                grown = np.zeros((2 * (n + len(new)), self.known.shape[1]), np.float32)
                grown[:n] = self.known[:n]
                self.known = grown
            self.known[n : n + len(new)] = self.network.pooled(new)
            self.kept.update(zip(new, range(n, n + len(new))))
        index = np.fromiter(map(self.kept.__getitem__, flat), np.int64, len(flat))
        sums = np.zeros((len(flat) + 1, self.known.shape[1]))
        np.cumsum(self.known[index], axis=0, dtype=np.float64, out=sums[1:])
        at = np.cumsum([0, *map(len, own)])
        return sums[at[1:]] - sums[at[:-1]]

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        share = self.shares(texts)
        pred, score = [UNDEFINED] * len(texts), np.zeros(len(texts))
        total, best = share.sum(1), share.argmax(1)
        for i in np.flatnonzero(total > 0):
            if has_letter(texts[i]):
                pred[i] = self.network.labels[best[i]]
                score[i] = min(1.0, max(0.0, share[i, best[i]] / total[i]))
        return pred, score


def _nothing(texts: list[str]) -> tuple[list[str], np.ndarray]:
    return [UNDEFINED] * len(texts), np.zeros(len(texts))


def predict(docs: DataFrame, network: BiGRU | None) -> DataFrame:
    """doc_id, lang_pred and score (the mean share of that language over all positions)."""
    schema = "doc_id long, lang_pred string, score double"

    def run(batches):
        predictor, arrow = Predictor(network) if network else _nothing, to_arrow(schema)
        for batch in slices(batches):
            pred, score = predictor(strings(batch.column("text")))
            yield batch_of({"doc_id": batch.column("doc_id"), "lang_pred": pred, "score": score}, arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def keep_known(docs: DataFrame, network: BiGRU | None, least: float) -> DataFrame:
    """The rows, all columns, whose text has a language with a score of at least ``least``.

    Without a network no language is known: then the rows with a letter.
    """

    def run(batches):
        predictor = Predictor(network) if network else None
        for batch in slices(batches):
            if predictor is None:
                yield batch.filter(pa.array([has_letter(t) for t in strings(batch.column("text"))], pa.bool_()))
                continue
            pred, score = predictor(strings(batch.column("text")))
            yield batch.filter(pa.array([p != UNDEFINED and s >= least for p, s in zip(pred, score)], pa.bool_()))
        del predictor
        release()

    return docs.mapInArrow(run, docs.schema)


def held_out(remainder: int, modulus: int):
    """Rows kept from learning: crc32 of the doc_id as text leaves this remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from rows that are not held out and predict all: doc_id, held_out, lang_pred, score."""
    network = fit(docs.select("doc_id", "text", "lang").where(~held_out(2, 4)))
    return predict(docs, network).withColumn("held_out", held_out(2, 4))
