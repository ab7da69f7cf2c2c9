"""Quality rules: an isolation forest over rule statistics of documents.

Every document gets simple counts. Random trees, grown on a bounded sample of labelled
rows, cut the space of these counts at random values; unusual documents are cut off
after few steps. The score from which a document is rejected comes from all labelled
rows: of those that reject at most ``good_lost`` of the good ones, the one that tells good
from bad best. Both are of rows that pass the base rules, as no others need the verdict.

Rows: null and empty text have no words, so ``base_failed`` holds. Texts are read whole,
whatever their length. Rows that share a doc_id are scored each on their own text. Without
labelled rows of both kinds nothing is rejected but by the base rules. Where scores tie, all
rows or none are rejected. Other columns are not read. A null doc_id stays. An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from velomart.llm.select import least
from velomart.llm.text import mapped, strings
from velomart.workspace import Tables, materialize

#: Characters that count as symbols (fixed values).
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_upper", "n_digits", "n_exclaims", "n_lines", "n_distinct",
)
STATS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)


def counts(text: str) -> tuple[int, ...]:
    data = text.encode()
    left = lambda chars: len(data) - len(data.translate(None, chars))
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words), len(text) - left(BLANKS), left(SYMBOLS), len(lines) - len(set(lines)), repeated(words),
        left(UPPER), left(DIGITS), data.count(b"!"), len(lines), len(set(words)),
    )


def repeated(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    seen: set = set()
    again = {w for w in windows if w in seen or seen.add(w)} if len(set(windows)) < len(windows) else ()
    if not again:
        return 0
    covered = np.zeros(len(words), bool)
    at = np.array([i for i, w in enumerate(windows) if w in again])
    for j in range(3):
        covered[at + j] = True
    return int(covered.sum())


def statistics(docs: DataFrame) -> DataFrame:
    def each(batch: pa.RecordBatch):
        made = np.array([counts(t) for t in strings(batch.column("text"))], np.int64)
        yield {"doc_id": batch.column("doc_id")} | {c: made[:, i] for i, c in enumerate(COUNTS)}

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), STATS, each)


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Shares that do not depend on length, and the length itself on a log scale."""
    c = {k: np.asarray(v, np.float64) for k, v in c.items()}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1), np.maximum(c["n_lines"], 1)
    return np.column_stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["n_upper"] / chars, c["n_digits"] / chars, c["n_exclaims"] / words,
        np.log1p(words / lines), c["n_distinct"] / words ** 0.8,
    ])


def _usual_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of a binary search tree of n keys."""
    n = np.maximum(np.asarray(n, np.float64), 1)
    return np.where(n > 1, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, 0.0)


class IsolationForest:
    def __init__(self, rows: np.ndarray, trees: int = 200, size: int = 256, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.size = min(size, len(rows))
        self.height = int(np.ceil(np.log2(max(self.size, 2))))
        self.trees = [self._grow(rows[rng.choice(len(rows), self.size, False)], rng) for _ in range(trees)]

    def _grow(self, rows: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        nodes: list[list[float]] = []

        def split(part: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([0, np.inf, at, at, depth + float(_usual_path(len(part)))])
            low, high = part.min(0), part.max(0)
            open_ = np.flatnonzero(high > low)
            if depth < self.height and len(part) > 1 and len(open_):
                f = int(rng.choice(open_))
                cut = rng.uniform(low[f], high[f])
                left = part[:, f] <= cut
                if 0 < left.sum() < len(part):
                    nodes[at][:4] = [f, cut, split(part[left], depth + 1), split(part[~left], depth + 1)]
            return at

        split(rows, 0)
        made = np.array(nodes)
        return made[:, 0].astype(int), made[:, 1], made[:, 2].astype(int), made[:, 3].astype(int), made[:, 4]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path over the usual path: near 1 is unusual."""
        total, each = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, left, right, path in self.trees:
            at = np.zeros(len(rows), int)
            for _ in range(self.height):
                at = np.where(rows[each, feature[at]] <= cut[at], left[at], right[at])
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / max(float(_usual_path(self.size)), 1e-9))


def fit(known: DataFrame, sample_rows: int, junk_share: float) -> IsolationForest | None:
    """A forest on a bounded sample of labelled rows, fixed by hash, with few of those labelled as junk."""
    key = F.xxhash64("doc_id", *COUNTS).bitwiseAND(F.lit((1 << 63) - 1))
    pick = lambda quality, n: least(known.where(F.col("quality") == quality), key, [key, F.col("doc_id")], n).toPandas()
    good = pick(1, sample_rows)
    if not len(good):
        return None
    junk = pick(0, int(len(good) * junk_share))
    return IsolationForest(np.vstack([features({c: x[c] for c in COUNTS}) for x in (good, junk) if len(x)]))


def score(rows: DataFrame, forest: IsolationForest) -> DataFrame:
    def each(batches):
        for batch in batches:
            values = features({c: batch.column(c).to_numpy() for c in COUNTS})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(forest.score(values))], [*batch.schema.names, "score"]
            )

    return rows.mapInArrow(each, StructType([*rows.schema.fields, StructField("score", DoubleType())]))


def threshold(scored: DataFrame, good_lost: float, bins: int = 2000) -> float:
    """From counts of labelled rows by bin of the score: the best one that spares the good."""
    rows = scored.groupBy(F.floor(F.col("score") * bins).alias("bin"), "quality").count().collect()
    good, junk = np.zeros(bins + 1), np.zeros(bins + 1)
    for r in rows:
        (good if r["quality"] == 1 else junk)[r["bin"]] += r["count"]
    if not good.sum() or not junk.sum():
        return float("inf")
    lost = np.append(good[::-1].cumsum()[::-1] / good.sum(), 0)
    caught = np.append(junk[::-1].cumsum()[::-1] / junk.sum(), 0)
    return float(np.argmax(np.where(lost <= good_lost, caught - lost, -1))) / bins


def quality_rules(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, junk_share: float = 0.02, good_lost: float = 0.02
) -> DataFrame:
    """Base rules and the forest's verdict for each document.

    ``sample_rows`` bounds the labelled rows that the forest is grown on; counts,
    threshold and scores cover all rows.
    """
    stats = materialize(statistics(docs), "statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    with Tables(docs.sparkSession) as tables:
        quality = labels.where("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        known = tables.write(stats.where(~failed).join(quality, "doc_id"), "known")
        forest = fit(known, sample_rows, junk_share)
        limit = float("inf") if forest is None else threshold(score(known, forest), good_lost)
    scored = stats.withColumn("score", F.lit(0.0)) if forest is None else score(stats, forest)
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("score") < limit)).alias("kept"), "score",
    )
