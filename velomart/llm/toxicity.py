"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, turns look-alike letters into Latin ones and digits used as letters
into these, and leaves one blank between words. Terms are runs of five or six characters
within a word with its blanks, and whole words. Their weights (log odds) come from a
bounded sample of labelled rows; near copies in it count once. Matches inside an exception phrase
do not count. A text's weight, for its length and as a sum, becomes a probability by a
logistic fit on another part of the sample.

Rows: null and empty text match nothing and get the score of no match. Rows that share a
doc_id are scored each on their own. If labels of one kind are missing, every score is 0.
Only doc_id, text and, for learning, labels are read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.llm.select import least
from velomart.llm.text import Words, batch_of, mapped, slices, strings, to_arrow
from velomart.workspace import materialize

#: Letters of other scripts by the Latin letter that they look like (fixed values).
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "ո": "n", "ս": "u", "α": "a", "ε": "e", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ⅼ": "l",
}
#: Digits and signs by the letter that they stand for (fixed values).
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
#: Phrases in which a listed word is harmless (fixed values).
EXCEPTIONS = ("clown fish", "trash can", "trash bin", "stupid simple", "pond scum", "oxy moron")
GRAMS = (5, 6)
LONGEST_WORD = 24
#: Entries that a task counts before it passes them on.
COUNTED = 60_000
#: Words that are passed on together.
PASSED_ON = 20_000


def _folding() -> dict[int, str]:
    fold = {ord(k): v for k, v in {**LOOK_ALIKES, **DIGITS}.items()}
    fold |= {ord(k.upper()): v for k, v in LOOK_ALIKES.items() if len(k.upper()) == 1}
    fold |= {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}  # full width
    for start in (0x1D400, 0x1D434, 0x1D468, 0x1D5A0, 0x1D5D4, 0x1D608, 0x1D63C, 0x1D670):  # mathematical alphabets
        fold |= {start + i: chr(97 + i % 26) for i in range(52)}
    fold |= {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}  # invisible
    return fold


FOLD = _folding()


def fold(text: str) -> str:
    return f" {' '.join(text.lower().translate(FOLD).split())} "


def terms(words: set[str]) -> set[str]:
    """Terms of folded words."""
    found: set[str] = set()
    for word in words:
        own = f" {word} "
        for k in GRAMS:
            found.update([own[i : i + k] for i in range(len(own) - k + 1)])
        if len(word) <= LONGEST_WORD:
            found.add(own)
    return found


def learnable(docs: DataFrame, labels: DataFrame, toxic: int, clean: int) -> DataFrame:
    """A bounded sample of labelled texts: those of least hash of either kind, near copies once.

    Three minimal hashes of word triples stand for a text; one that shares any of them
    with a text before it is left out.
    """
    known = labels.where("toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    key, order = F.shiftright(F.xxhash64("doc_id"), 1), [F.xxhash64("doc_id")]
    ids = least(known.where("toxic = 1"), key, order, toxic).unionByName(least(known.where("toxic = 0"), key, order, clean))
    drawn = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # toxic + clean rows at most

    def each(batch: pa.RecordBatch):
        column = batch.column("text")
        h, whole = Words(column).shingles(3)
        at = Words(column).at
        least = [[], [], []]
        for i, (a, b) in enumerate(zip(at, at[1:])):
            own = h[a:b][whole[a:b]]
            for j, salt in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)):
                least[j].append(int((own * np.uint64(salt)).min()) >> 1 if len(own) else i)
        yield {c: batch.column(c) for c in ("doc_id", "toxic", "text")} | dict(zip(("m1", "m2", "m3"), least))

    schema = "doc_id long, toxic int, text string, m1 long, m2 long, m3 long"
    drawn = materialize(mapped(drawn.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic", "text"), schema, each), "sample")
    seen: set[int] = set()
    kept = []
    for r in drawn.select("doc_id", "m1", "m2", "m3").orderBy("doc_id").collect():
        own = {r["m1"], r["m2"], r["m3"]}
        if not own & seen:
            kept.append((r["doc_id"],))
        seen |= own
    chosen = docs.sparkSession.createDataFrame(kept, "doc_id long")
    return drawn.drop("m1", "m2", "m3").join(F.broadcast(chosen), "doc_id")


def lexicon(sample: DataFrame, least_docs: int, least_weight: float, size: int) -> dict[str, float]:
    """Terms that mark toxic texts of the sample, with their weights.

    In toxic texts a word counts once in the same company (the words beside it), for the
    text of least doc_id that has it, so that a passage that is copied does not make its
    rare words look toxic. A term's count is taken lower by its own uncertainty before it is
    weighed. Counts are sums over all texts, so the weights do not depend on how the texts
    are dealt to tasks.
    """
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return {}
    least_docs = max(least_docs, math.ceil(0.004 * totals[1]))
    once = (
        sample.where("toxic = 1").mapInArrow(_in_company, COMPANY)
        .groupBy("company").agg(F.min(F.struct("doc_id", "text", "word")).alias("first")).select("first.*")
        .groupBy("doc_id", "text").agg(F.collect_set("word").alias("words"))
        .mapInArrow(_count_words("toxic"), COUNTS)
    )
    clean = sample.where("toxic = 0").select("text").mapInArrow(_count_words("clean"), COUNTS)
    sure = F.col("toxic") - F.sqrt("toxic")
    weight = F.log((sure + 0.5) / (totals[1] + 1)) - F.log((F.col("clean") + 0.5) / (totals[0] + 1))
    rows = (
        once.unionByName(clean)
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= least_docs)
        .withColumn("weight", weight)
        .where(F.col("weight") >= least_weight)
        .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "term").limit(size)
        .collect()
    )
    return {r["term"]: r["weight"] for r in rows}


COMPANY = "doc_id long, text long, word string, company binary"
COUNTS = "term string, toxic long, clean long"


def _in_company(batches):
    """Each word of a text with a digest of it and the words beside it; ``text`` tells texts of one doc_id apart."""
    arrow = to_arrow(COMPANY)
    nothing = lambda: {"doc_id": [], "text": [], "word": [], "company": []}
    for batch in slices(batches):
        out = nothing()
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text"))):
            if len(out["word"]) > PASSED_ON:
                yield batch_of(out, arrow)
                out = nothing()
            words = fold(text).split()
            number = int.from_bytes(_digest(text), "little", signed=True)
            found = {_digest(f"{a} {w} {b}"): w for a, w, b in zip(["", *words], words, [*words[1:], ""])}
            out["doc_id"] += [doc_id] * len(found)
            out["text"] += [number] * len(found)
            out["word"] += found.values()
            out["company"] += found
        yield batch_of(out, arrow)


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode(), digest_size=8).digest()


def _count_words(kind: str):
    """In how many texts each term is: of lists of folded words, or of texts."""

    def run(batches):
        arrow, found = to_arrow(COUNTS), Counter()

        def counted():
            n, zero = list(found.values()), [0] * len(found)
            return batch_of({"term": list(found), "toxic": n if kind == "toxic" else zero, "clean": n if kind == "clean" else zero}, arrow)

        for batch in batches if kind == "toxic" else slices(batches):
            # One text's words at a time.
            words = (x.as_py() for x in batch.column("words")) if kind == "toxic" else (fold(t).split() for t in strings(batch.column("text")))
            for own in words:
                found.update(terms(set(own)))
                if len(found) > COUNTED:
                    yield counted()
                    found.clear()
        yield counted()

    return run


class Matcher:
    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.automaton = ahocorasick.Automaton()
        for term, weight in weights.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in exceptions:
            self.automaton.add_word(fold(phrase), (len(fold(phrase)), None))
        self.automaton.make_automaton()

    def features(self, text: str) -> tuple[float, float]:
        """Weight for each hundred characters and weight in all, on log scales."""
        text = fold(text)
        hits = list(self.automaton.iter(text)) if len(self.automaton) else []
        spans = [(end - n + 1, end) for end, (n, weight) in hits if weight is None]
        total = 0.0
        for end, (n, weight) in hits:
            if weight is not None and not any(a <= end - n + 1 and end <= b for a, b in spans):
                total += weight
        return math.log1p(100 * total / len(text)), math.log1p(total)


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> np.ndarray:
    """Coefficients by Newton's steps; the last is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(features: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ w[:-1] + w[-1], -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, toxic: int = 6_000, clean: int = 9_000, size: int = 4_000):
    """A matcher and its logistic fit; ``toxic`` and ``clean`` bound the labelled rows, ``size`` the lexicon."""
    sample = materialize(learnable(docs, labels, toxic, clean), "learned")
    part = F.pmod(F.xxhash64(F.col("doc_id") + 11), F.lit(10))
    weights = lexicon(sample.where(part < 7), 3, 2.5, size)
    if not weights:
        return None
    matcher = Matcher(weights)
    rows = sample.where(part >= 7).select(F.col("toxic").alias("doc_id"), "text")
    found = features(rows, weights).toPandas().to_numpy()  # numbers of the sample's rows
    if len(set(found[:, 0])) < 2:
        found = np.vstack([found, [[0, 0, 0], [1, *matcher.features(max(weights, key=weights.get))]]])
    return weights, logistic(found[:, 1:], found[:, 0])


def features(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    schema = "doc_id long, density double, total double"

    def run(batches):
        matcher, arrow = Matcher(weights), to_arrow(schema)
        for batch in slices(batches):
            made = np.array([matcher.features(t) for t in strings(batch.column("text"))])
            yield batch_of({"doc_id": batch.column("doc_id"), "density": made[:, 0], "total": made[:, 1]}, arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id and score of each document."""
    weights, w = model if model else ({}, np.array([0.0, 0.0, -30.0]))
    line = F.col("density") * float(w[0]) + F.col("total") * float(w[1]) + float(w[2])
    return features(docs, weights).select("doc_id", (1 / (1 + F.exp(-line))).alias("score"))


def keep_clean(docs: DataFrame, model) -> DataFrame:
    """The rows, all columns, of a score under a half."""
    if not model:
        return docs
    weights, w = model

    def run(batches):
        matcher = Matcher(weights)
        for batch in slices(batches):
            made = np.array([matcher.features(t) for t in strings(batch.column("text"))])
            yield batch.filter(pa.array(probability(made, w) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled rows that are not held out and score all: doc_id, held_out, score, predicted."""
    from velomart.llm.langid import held_out

    model = learn(docs, labels.where(~held_out(0, 5)))
    return score(docs, model).select(
        "doc_id", held_out(0, 5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
