"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

A document of label 1 is preferred to one of label 0. Its worth is a linear function of
counts of its text, fitted by logistic loss on the difference of the features of each
pair, so that only order is learned. The worth from which a document passes is a quantile
of the worth of labelled rows: the one that gives the most of them their label. The score
is the model's own probability that the document is preferred to one of that worth.

Features do not depend on a vocabulary: shares of pairs of neighbouring kinds of
characters, word and line lengths, and shares of lines, words and word triples that the
text repeats.

Rows: null and empty text have features of zero and get the score of these. Rows that
share a doc_id are scored each on their own text; for learning such a doc_id counts once,
with its least text and least label. A null doc_id is scored, never learned from. Very
long texts are read whole, one at a time. Equal worth is equal score; ties of candidate
quantiles go to the middle one. Without labels of both kinds there are no pairs: every
score is 1, so that nothing is lost. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.llm.langid import held_out
from velomart.llm.select import least
from velomart.llm.text import Words, batch_of, slices, spans, to_arrow
from velomart.workspace import Tables, materialize

KINDS = 16
PAIRS = KINDS * KINDS
WIDTH = PAIRS + 7
#: Worth is counted in bins of this width, up to this many to either side.
BIN, BINS = 0.02, 5_000


def _kinds() -> np.ndarray:
    kind = np.full(256, 11, np.uint8)
    for k, chars in enumerate(
        (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\v\f", b".", b",", b"!?", b"#*$%&", b"|<>", b"()[]{}'\"`")
    ):
        kind[list(chars)] = k
    kind[[c for c in range(32) if kind[c] == 11]] = 12
    kind[0xC0:] = 13
    kind[0x80:0xC0] = 14
    return kind


KIND = _kinds()


def _repeated(groups: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """For each of n groups, how many of its values it holds more than once, less one each."""
    if not len(values):
        return np.zeros(n)
    order = np.lexsort((values, groups))
    g, v = groups[order], values[order]
    again = (g[1:] == g[:-1]) & (v[1:] == v[:-1])
    return np.bincount(g[1:][again], minlength=n).astype(float)


def features(column: pa.Array) -> np.ndarray:
    """A row of ``WIDTH`` numbers for each text."""
    n, words = len(column), Words(column, lower=False)
    data, offsets = words.data, words.offsets
    size = np.diff(offsets)
    text = np.repeat(np.arange(n), size)
    kind = KIND[data].astype(np.int64)
    inside = text[1:] == text[:-1]
    code = (text[:-1] * PAIRS + kind[:-1] * KINDS + kind[1:])[inside]
    shares = np.bincount(code, minlength=n * PAIRS).reshape(n, PAIRS) / np.maximum(size, 1)[:, None]

    n_words = np.diff(words.at)
    of_word = np.repeat(np.arange(n), n_words)
    triples, whole = words.shingles(3)
    ends = np.flatnonzero((data == 10) | np.append(~inside, True)[: len(data)])
    starts = np.append(0, ends[:-1] + 1)[: len(ends)]
    # The break itself is no part of a line, so the last line equals an earlier one.
    stops = ends + (data[ends] != 10)
    filled = stops > starts
    starts, stops = starts[filled], stops[filled]
    of_line = text[starts]
    n_lines = np.bincount(of_line, minlength=n)
    some_words, some_lines = np.maximum(n_words, 1), np.maximum(n_lines, 1)
    letters = np.bincount(of_word, words.ends - words.starts, minlength=n)
    return np.column_stack([
        np.sqrt(shares),
        np.log1p(n_words), letters / some_words / 10, np.log1p(n_words / some_lines),
        _repeated(of_word, words.hashes, n) / some_words,
        _repeated(of_word[whole], triples[whole], n) / some_words,
        _repeated(of_line, spans(data, starts, stops), n) / some_lines,
        (n_words == 0).astype(float),
    ])


def sample(docs: DataFrame, labels: DataFrame, rows_each: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of label 1 and of label 0: of either the ``rows_each`` doc_ids of least hash at most."""
    known = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .withColumn("h", F.shiftright(F.xxhash64("doc_id"), 1))
    )
    with Tables(docs.sparkSession) as tables:
        known = tables.write(known, "labelled")
        chosen = [least(known.where(F.col("quality") == q), F.col("h"), [F.col("h"), F.col("doc_id")], rows_each) for q in (0, 1)]
        ids = tables.write(chosen[0].unionByName(chosen[1]), "chosen").select("doc_id", "quality")  # 2 x rows_each rows
        texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
        schema = "doc_id long, quality int, row binary"

        def run(batches):
            arrow = to_arrow(schema)
            for batch in slices(batches):
                made = features(batch.column("text")).astype("<f4")
                yield batch_of(
                    {"doc_id": batch.column("doc_id"), "quality": batch.column("quality"), "row": [r.tobytes() for r in made]}, arrow
                )

        longs = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "text")
        rows = sorted((r[0], r[1], bytes(r[2])) for r in longs.mapInArrow(run, schema).collect())
    take = lambda q: np.array([np.frombuffer(x, "<f4") for _, y, x in rows if y == q], float).reshape(-1, WIDTH)
    return take(1), take(0)


def learn(better: np.ndarray, worse: np.ndarray, pairs: int = 200_000, penalty: float = 1e-4, rate: float = 0.05, seed: int = 3) -> np.ndarray:
    """Weights, for features as they are, from ``pairs`` pairs drawn at random."""
    both = np.vstack([better, worse])
    scale = np.maximum(both.std(0), 1e-3)
    rng, w = np.random.default_rng(seed), np.zeros(WIDTH)
    m, v, batch = np.zeros(WIDTH), np.zeros(WIDTH), 1_000
    for step in range(1, pairs // batch + 1):
        x = (better[rng.integers(len(better), size=batch)] - worse[rng.integers(len(worse), size=batch)]) / scale
        lost = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))  # the probability of the other order
        g = penalty * w - x.T @ lost / batch
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w / scale


def worth(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    schema = "doc_id long, worth double"

    def run(batches):
        arrow = to_arrow(schema)
        for batch in slices(batches):
            yield batch_of({"doc_id": batch.column("doc_id"), "worth": features(batch.column("text")) @ weights}, arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def quantile(worths: DataFrame, labels: DataFrame) -> float:
    """The worth that gives the most labelled rows their label, from their counts by bin."""
    known = worths.join(labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id")
    at = F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("worth") / BIN))).cast("int")
    rows = known.groupBy(at.alias("bin"), (F.col("quality") > 0).alias("good")).count().collect()  # 2 (2 BINS + 1) rows at most
    counts = np.zeros((2, 2 * BINS + 2))
    for r in rows:
        counts[int(r["good"]), r["bin"] + BINS] += r["count"]
    # Right at a cut before bin i: bad ones below it and good ones from it on.
    right = np.append(0, counts[0].cumsum())[:-1] + counts[1][::-1].cumsum()[::-1]
    best = np.flatnonzero(right == right.max())
    return float((best[len(best) // 2] - BINS) * BIN)


def classify(docs: DataFrame, labels: DataFrame, rows_each: int = 6_000, pairs: int = 200_000) -> DataFrame:
    """doc_id, held_out, score, predicted and worth of every row.

    ``rows_each`` bounds the labelled rows of either label that pairs are drawn from and
    ``pairs`` their number; the quantile is taken from all labelled rows, and all are scored.
    """
    labels = labels.where(~held_out(1, 3)).select("doc_id", "quality")
    better, worse = sample(docs, labels, rows_each)
    learned = bool(len(better) and len(worse))
    worths = materialize(worth(docs, learn(better, worse, pairs) if learned else np.zeros(WIDTH)), "worth")
    score = 1 / (1 + F.exp(F.lit(quantile(worths, labels)) - F.col("worth"))) if learned else F.lit(1.0)
    return worths.select("doc_id", held_out(1, 3).alias("held_out"), score.alias("score"), "worth").select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "worth"
    )
