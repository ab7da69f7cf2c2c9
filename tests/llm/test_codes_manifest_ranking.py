"""Vector codes, the Merkle manifest and the ranking classifier against plain versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from velomart.llm import adaptive_codes, merkle, ranking, select
from velomart.llm.text import table
from velomart.workspace import Tables

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "digest string, at long, total long, bucket long, x long, worth double, quality int, block long, path string, h long"


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


# 11


def plain_codes(rows, k=256, rounds=4):
    rows = [r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])]
    x = np.array([[math.floor(1024 * v) for v in r[1]] for r in rows], np.int64)
    d = x.shape[1] // 4
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, x[i].tolist()))[:k]
    books = [x[first][:, p * d : (p + 1) * d].copy() for p in range(4)]

    def assign(p):
        gaps = ((x[:, None, p * d : (p + 1) * d] - books[p][None]) ** 2).sum(2)
        return gaps.argmin(1), gaps.min(1)

    for _ in range(rounds):
        for p in range(4):
            code, _ = assign(p)
            for e in range(len(books[p])):
                if (code == e).any():
                    books[p][e] = x[code == e][:, p * d : (p + 1) * d].sum(0) // (code == e).sum()
    found = [assign(p) for p in range(4)]
    error = sum(g for _, g in found)
    by_label = {}
    for r, e in zip(rows, error):
        by_label[r[2]] = by_label.get(r[2], 0) + int(e)
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    return [(r[0], "".join(f"{c[i]:02x}" for c, _ in found), int(error[i]), by_label[r[2]], digest) for i, r in enumerate(rows)]


def vectors(spark, rows, more=""):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int" + more)


def read(df):
    return [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_codes_equal_brute_force(spark, sf):
    df = table(spark, f"/root/testdata/{sf}", "embeddings")
    same(adaptive_codes.compress(df).collect(), plain_codes(read(df)))


@pytest.mark.parametrize(("entries", "start", "grid"), [(8, 2, 3), (40, 5, 4), (256, 4, 6), (3, 16, 2), (1, 4, 3)])
def test_codes_with_many_ties(spark, entries, start, grid):
    """Few different values: distances tie, entries coincide and stay unused."""
    rng = random.Random(entries)
    rows = [(rng.randrange(250), [float(rng.randrange(grid)) / 512 for _ in range(8)], rng.choice([None, 1, 2])) for _ in range(700)]
    df = vectors(spark, rows)
    same(adaptive_codes.compress(df, entries, 4, start).collect(), plain_codes(read(df), entries))


def test_codes_of_clusters_use_the_bounds(spark, monkeypatch):
    """Well-parted clusters: bounds decide for nearly all parts, with the same result."""
    rng = np.random.default_rng(5)
    centres = rng.uniform(-1, 1, (30, 16))
    rows = [(i, (centres[rng.integers(30)] + rng.normal(0, 0.002, 16)).tolist(), 1) for i in range(900)]
    df, seen = vectors(spark, rows), []
    plain = adaptive_codes.enough
    monkeypatch.setattr(adaptive_codes, "enough", lambda sums, k, w, b: seen.append(sums) or plain(sums, k, w, b))
    same(adaptive_codes.compress(df, 32).collect(), plain_codes(read(df), 32))
    at = 4 * 32 * 5  # how many parts needed none, and how many all entries
    assert seen[-1].get(at, 0) > 0.7 * 4 * 900
    assert seen[-1].get(at + adaptive_codes.ALL, 0) < 0.2 * 4 * 900


def test_bounds_never_lose_the_nearest():
    rng = np.random.default_rng(1)
    for trial in range(40):
        k, b = int(rng.integers(1, 40)), int(rng.integers(1, 20))
        x = rng.integers(-30, 30, (200, 3))
        entries = rng.integers(-30, 30, (k, 3))
        kind = adaptive_codes.Codebook(entries, 64).kind
        code, kept = adaptive_codes.assign_all(adaptive_codes.Codebook(entries, 64), x.astype(kind), b)
        for _ in range(5):
            after = entries + rng.integers(-4, 5, entries.shape) * (rng.random((k, 1)) < 0.4)
            books = [adaptive_codes.Codebook(e, 64) for e in (after, entries)]
            kept = adaptive_codes.resized(kept, int(rng.integers(1, 20)))
            code, kept, _ = adaptive_codes.assign_near(*books, x.astype(kind), code, kept)
            gaps = ((x[:, None] - after[None]) ** 2).sum(2)
            assert (code == gaps.argmin(1)).all(), trial
            distance = np.sqrt(gaps)
            held = np.take_along_axis(distance, kept["ids"].astype(int), 1)
            assert (kept["upper"] >= distance.min(1)).all()
            real = kept["low"].astype(float) < kept["outer"][:, None].astype(float)
            assert (kept["low"].astype(float) <= held)[real].all()
            entries = after


def test_codes_of_awkward_rows(spark):
    good = [0.1, -0.2, 0.3, 0.4]
    rows = [
        (1, good, 3, 9, "x"), (1, good, 3, 9, "x"), (1, [0.5] * 4, None, 9, "x"), (2, None, 3, 9, "x"), (3, [0.1, None, 0.2, 0.3], 3, 9, "x"),
        (4, [0.1, float("nan"), 0.2, 0.3], 3, 9, "x"), (5, [float("inf"), 0.1, 0.2, 0.3], 3, 9, "x"), (None, [0.9] * 4, None, 9, "x"),
        (None, [-0.9] * 4, 3, 9, "x"), (-7, [0.2] * 4, 4, 9, "x"),
    ]
    df = vectors(spark, rows, ", error long, code string")
    for k in (256, 5, 2):
        same(adaptive_codes.compress(df, k).collect(), plain_codes(read(df), k))
    assert adaptive_codes.compress(df.limit(0)).collect() == []
    assert adaptive_codes.compress(df.where("vec_id between 2 and 5")).collect() == []


def test_codes_of_large_components_are_exact(spark):
    """Beyond the range of doubles integers are used; beyond 64 bits an error is raised."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.integers(-(1 << 15), 1 << 15, 8)], 1) for i in range(60)]
    df = vectors(spark, rows)
    same(adaptive_codes.compress(df, 16).collect(), plain_codes(read(df), 16))
    with pytest.raises(Exception, match="too large"):
        adaptive_codes.compress(vectors(spark, [(1, [3e9] * 4, 1)])).collect()
    with pytest.raises(ValueError, match="one length"):
        adaptive_codes.compress(vectors(spark, [(1, [0.1] * 4, 1), (2, [0.1] * 8, 1)]))


def test_salted_labels_give_the_same(spark, monkeypatch):
    df = table(spark, SF, "embeddings")
    want = plain_codes(read(df))
    monkeypatch.setattr(adaptive_codes, "FEW_LABELS", 0)
    same(adaptive_codes.compress(df).collect(), want)


def test_least_rows_are_the_least(spark, monkeypatch):
    from pyspark.sql import functions as F

    for values in ([5] * 4000 + list(range(4000)), [1 << 62, -(1 << 61), 0, None, 7] * 800, list(range(0, 1 << 40, 1 << 28))):
        df = spark.createDataFrame([(v,) for v in values], "k long")
        real = sorted(v for v in values if v is not None)
        for k in (1, 17, 2500, 10**6):
            got = [r["k"] for r in select.least(df, F.col("k"), [F.col("k")], k).collect()]
            assert sorted(got) == real[:k]
            high = select.cut(df, F.col("k"), k)
            assert sum(v <= high for v in real) >= min(k, len(real))
    assert select.cut(df.limit(0), F.col("k"), 3) is None


# 12


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    """doc_id, text, lang, source, n_chars to the manifest, by lists."""

    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))

    def tree(nodes):
        found = [nodes]
        while len(nodes) > 1:
            nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
            found.append(nodes)
        return found

    def way(found, i):
        out = []
        for nodes in found[:-1]:
            first = i - i % 3
            out.append((nodes[first:i], nodes[i + 1 : first + 3]))
            i //= 3
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((leaf(r, r[1]), r))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for own in groups.values():
        own.sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
    trees = {s: tree([x for x, _ in groups[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (own, r) in enumerate(groups[s]):
            path = way(trees[s], i) + way(top, k)
            now = own
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                now = leaf(r, r[1].replace("\n", ""))
            for before, after in path:
                now = sha("".join([*before, now, *after]))
            proof = sha("".join(x for before, after in path for x in before + after))
            out.append((r[0], own, trees[s][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return out


def doc_rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_manifest_equals_plain(spark, sf):
    df = table(spark, f"/root/testdata/{sf}", "documents")
    got = merkle.manifest(df).collect()
    same(got, plain_manifest(doc_rows(df)))
    assert 0 < sum(r["verified"] for r in got) < len(got)


def test_manifest_of_awkward_rows(spark):
    long = "word\n" * 300_000
    rows = [
        (1, "a\nb", "en", "s", 3), (1, "a\nb", "en", "s", 3), (1, "other", None, "s", None), (2, None, "en", "s", 0), (3, "", "en", "s", 0),
        (None, "x\ny", "en", "s", 1), (None, "z", "de", "s", 1), (None, "z", "de", "s", 1), (4, long, "en", None, len(long)), (-5, "below\n", "en", "s", 1),
        (5, "é日本\n", "en", "é", 4), (6, "p", "en", "", 1), (1 << 62, "far\n", "en", "s", 1), (-(1 << 62), "far\n", "en", "s", 1), (7, "q\nq", "en", "lone", 3),
    ]
    df = spark.createDataFrame([(*r, "d", 1, 2, 3, 4, 0.5, 6, 7, "p", 8) for r in rows], f"{COLUMNS}, {EXTRA}")
    same(merkle.manifest(df).collect(), plain_manifest(rows))
    assert merkle.manifest(df.limit(0)).collect() == []
    one = df.where("source = 'lone'")
    got = merkle.manifest(one).collect()
    same(got, plain_manifest([rows[-1]]))
    assert got[0]["root"] == got[0]["leaf"]


@pytest.mark.parametrize("n", [2, 3, 4, 80, 81, 82, 243, 244, 6562])
def test_manifest_of_every_shape(spark, n):
    """Sizes about the powers of three and of the slots of a block."""
    rows = [(i * 37, f"t\n{i}", "en", "a", i) for i in range(n)] + [(5, "alone", "en", "b", 1)]
    same(merkle.manifest(spark.createDataFrame(rows, COLUMNS)).collect(), plain_manifest(rows))


def test_manifest_of_many_sources(spark):
    rows = [(i, "t", "en", f"s{i % 400}", i) for i in range(900)]
    same(merkle.manifest(spark.createDataFrame(rows, COLUMNS)).collect(), plain_manifest(rows))


def test_ranks_in_bitmaps_arrays_and_repeats(spark):
    """Places equal the positions in sorted order: dense ids (bitmaps), sparse ones, and ids held often."""
    rng = random.Random(2)
    ids = [("dense", i) for i in range(-9_000, 70_000, 2)] + [("far", rng.randrange(-(1 << 63), 1 << 63)) for _ in range(500)]
    ids += [("again", i % 50) for i in range(3_000)] + [("dense", 400)] * 1_200 + [("again", None)] * 700
    rng.shuffle(ids)
    rows = [(s, i, hashlib.sha256(f"{s} {i} {n}".encode()).digest(), None) for n, (s, i) in enumerate(ids)]
    df = spark.createDataFrame(rows, "source string, doc_id long, digest binary, tampered binary").repartition(7)
    with Tables(spark) as tables:
        directory = merkle.containers(df, tables)
        assert directory.where("bitmap is not null").count() >= 2
        got = {bytes(r["digest"]): (r["at"], r["total"]) for r in merkle.placed(df, directory).collect()}
    for source in ("dense", "far", "again"):
        own = sorted((r for r in rows if r[0] == source), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[r[2]] for r in own] == [(k, len(own)) for k in range(len(own))]


# 13


def plain_features(text):
    """The features of one text, a character at a time."""
    data = text.encode()
    kind = [int(ranking.KIND[b]) for b in data]
    pairs = np.zeros(ranking.PAIRS)
    for a, b in zip(kind, kind[1:]):
        pairs[a * ranking.KINDS + b] += 1
    words, lines = data.split(), [x for x in data.split(b"\n") if x]
    triples = list(zip(words, words[1:], words[2:]))
    w, n = max(len(words), 1), max(len(lines), 1)
    more = lambda x: len(x) - len(set(x))
    rest = [
        math.log1p(len(words)), sum(map(len, words)) / w / 10, math.log1p(len(words) / n), more(words) / w, more(triples) / w,
        more(lines) / n, float(not words),
    ]
    return np.concatenate([np.sqrt(pairs / max(len(data), 1)), rest])


def test_features_equal_plain_ones(spark):
    texts = [r["text"] for r in table(spark, SF, "documents").select("text").collect()]
    texts += [None, "", " \n\t\n ", "a", "\n", "a\na", "a\n\nb\na\n", "日本 日本 ü\n" * 5, "x" * 100_000, "one two three " * 4]
    got = ranking.features(pa.array(texts, pa.string()))
    want = np.array([plain_features(t or "") for t in texts])
    assert np.allclose(got, want)


def test_pairs_put_the_better_first():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, ranking.WIDTH))
    side = x[:, 3] + 0.5 * x[:, 7] > 0
    w = ranking.learn(x[side], x[~side], pairs=100_000)
    worth = x @ w
    order = (worth[side][:, None] > worth[~side][None]).mean()
    assert order > 0.97


def test_quantile_is_the_best_cut(spark):
    rng = random.Random(6)
    rows = [(i, round(rng.gauss(1.5 if i % 3 else -1.5, 1), 3)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(400)] + [(1, None), (9_999, 1)], "doc_id long, quality int")
    limit = ranking.quantile(spark.createDataFrame(rows, "doc_id long, worth double"), labels)
    right = lambda t: sum((w >= t) == (i % 3 > 0) for i, w in rows)
    assert right(limit) == max(right(k * ranking.BIN) for k in range(-400, 400))


def test_held_out_rows_are_ranked_well(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = {r["doc_id"]: r for r in ranking.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    known = [(got[r["doc_id"]], r["quality"]) for r in labels.collect() if r["doc_id"] in got]
    held = [(r["predicted"], y) for r, y in known if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r, _ in known)
    assert sum(p == y for p, y in held if y == 1) >= 0.98 * sum(y == 1 for _, y in held)
    assert sum(p == y for p, y in held if y == 0) >= 0.95 * sum(y == 0 for _, y in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_held_out_labels_and_other_columns_are_not_read(spark):
    from pyspark.sql import functions as F

    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    want = ranking.classify(docs, labels).collect()
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    flipped = labels.withColumn("quality", F.when(hidden, 1 - F.col("quality")).otherwise(F.col("quality")))
    others = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string"))
    same(ranking.classify(others, flipped).collect(), [tuple(r) for r in want])


def test_ranking_of_awkward_rows(spark):
    rows = [(1, "good text here. " * 30), (1, "good text here. " * 30), (2, None), (3, ""), (None, "BAD!! " * 50), (4, "BAD!! " * 50), (5, "more good words, indeed. " * 9000), (6, "WORSE!! " * 40)]
    docs = spark.createDataFrame([(i, t, None, None, None, "d", 1, 2, 3, 4, 0.5, 6, 7, "p", 8) for i, t in rows], f"{COLUMNS}, {EXTRA}")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 0, 0), (5, 1, 0), (6, 0, None), (None, 1, 1), (2, None, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    got = ranking.classify(docs, labels).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows)
    assert all(0 <= r["score"] <= 1 for r in got)
    by_text = {}
    for r in got:
        by_text.setdefault(dict(rows).get(r["doc_id"]), set()).add(r["score"])
    assert all(len(v) == 1 for v in by_text.values())
    assert ranking.classify(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in ranking.classify(docs, labels.limit(0)).collect()} == {1.0}
    assert {r["predicted"] for r in ranking.classify(docs, labels.where("quality = 1")).collect()} == {1}
