"""Operators against brute force on small fixtures, and on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from velomart.llm import (
    chains,
    graph,
    langid,
    lexicon,
    licenses,
    omh,
    packing,
    quality,
    simple8b,
    tokens,
    toxicity,
    trie_join,
)
from velomart.llm.text import table

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns of the operators' own results, to clash with them.
EXTRA = "score double, kept boolean, cell long, class long, part long, label string"
VOCABULARY = tokens.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def messy(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "Ünder", "gamma", "delta", "epsilon", "it's", "日本語"]
    long = " ".join(f"{rng.choice(words)}{rng.randrange(5000)}" for _ in range(6000))
    base = " ".join(f"{rng.choice(words)}{rng.randrange(900)}" for _ in range(300))
    near = base.split()
    near[40] = "changed"
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, " ".join(near), "de", None, None),
        (4, None, None, None, None), (5, "", "en", "b", 0), (6, " \n\t ", "de", "b", 4), (7, long, "de", "c", 9), (8, "a", None, "c", 1),
        (9, "A b", "en", "c", 3), (10, "<|endoftext|> x Σ́ \x85 ΣΑΣ", "en", "c", 3), (None, base + " more", "en", "d", 2),
        (11, "the idiot and the m0ron. " * 30, "en", "d", 3), (12, "Shti " * 400, "en", "d", 3), (7, "another text of the same id", "de", "c", 9),
    ]
    return spark.createDataFrame([(*r, 0.5, None, 3, None, 7, "x") for r in rows], f"{COLUMNS}, {EXTRA}")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i == 11)) for i in range(1, 13)] + [(None, 1, 0), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def order(pairs):
    return sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1]))


# 1
def plain_counts(text):
    words = [w for w in text.encode().split()]
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {i + j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    lines = text.split("\n")
    dup = sum(bool(x.encode().strip()) and x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), dup, len(again))


@pytest.mark.parametrize("name", ["messy", "docs"])
def test_quality_counts(request, labels, name):
    df = request.getfixturevalue(name)
    got = quality.quality_rules(df, labels).collect()
    want = Counter((i, *plain_counts(t)) for i, t in texts(df))
    assert Counter((r[0], r[1], r[2], r[3], r[4], r[5]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_forest_finds_the_odd_ones():
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.normal(size=(500, 4)), rng.normal(6, 1, size=(5, 4))])
    score = quality.IsolationForest(rows).score(rows)
    assert score[500:].min() > np.quantile(score[:500], 0.97)


def test_quality_without_rows_or_labels(nothing, docs, labels):
    assert quality.quality_rules(nothing, labels).count() == 0
    got = quality.quality_rules(docs, labels.limit(0)).collect()
    assert all(r["kept"] != r["base_failed"] for r in got)


# 2
def plain_scan(pairs):
    import re

    found = {}
    for doc_id, text in pairs:
        low = text.translate(str.maketrans(licenses.UPPER, licenses.LOWER))
        for unit in {low, *re.split(r"\n[ \t\r]*\n", low), *low.split("\n")}:
            w = re.findall("[a-z0-9]+", unit)
            grams = list(zip(w, w[1:]))
            for name, t in licenses.TEMPLATES.items():
                other = {tuple(g.split(" ")) for g in licenses.template_bigrams(t)}
                dice = 2 * len(set(grams) & other) / (len(grams) + len(other)) if grams else 0
                if dice >= licenses.LEAST:
                    best, n = found.get((doc_id, name), (0, 0))
                    found[doc_id, name] = (max(best, dice), n + 1)
    return found


def test_license_scan(spark, docs, messy, nothing):
    full = licenses.TEMPLATES["MIT-text"]
    own = spark.createDataFrame(
        [(1, full, 0), (2, "x\n\n" + full.replace("free of charge", "gratis") + "\n\nend", 0), (3, full[:300], 0), (4, None, 0), (5, "", 1)],
        "doc_id long, text string, dice int",
    )
    for df in (own, docs.where("contains(text, 'icense')"), messy):
        got = {(r["doc_id"], r["license_id"]): (r["dice"], r["n_units"]) for r in licenses.license_scan(df).collect()}
        assert got == plain_scan(texts(df))
    assert licenses.license_scan(own).where("doc_id in (1, 2)").count() >= 2
    assert licenses.license_scan(nothing).count() == 0
    assert not any("Python" in line or "Arrow" in line for line in licenses.license_scan(docs)._jdf.queryExecution().toString().split("\n"))


# 3
@pytest.mark.parametrize("n", [0, 1, 2, 4095, 4096, 4097, 9000])
@pytest.mark.parametrize("top", [1, 2, 60, 49_408, 2**31, 2**60, 2**64 - 1])
def test_simple8b_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n, np.uint64)
    ids[n // 3 : n // 2] = 0
    words, at = simple8b.pack(ids)
    assert (simple8b.unpack(words) == ids).all()
    for b in range(len(at) - 1):
        assert (simple8b.unpack(words[at[b] : at[b + 1]]) == ids[b * simple8b.BLOCK : (b + 1) * simple8b.BLOCK]).all()


@pytest.mark.parametrize("name", ["messy", "docs", "nothing"])
def test_token_files(request, library, name):
    df = request.getfixturevalue(name)
    got = sorted(simple8b.token_output(df, VOCABULARY).collect(), key=lambda r: r["start"])
    start = 0
    for r, (doc_id, text) in zip(got, order(texts(df)), strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        assert tuple(r) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


# 4
def test_gradients():
    net = langid.BiGRU(["a", "b", "c"], 4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, live = net.padded([b"abc", b"zq", b"hello"])
    y = np.array([0, 2, 1])
    loss = lambda: -(np.log(net.positions(x, live)[:, np.arange(3), y]) * live.T).sum() / live.sum()
    for k, g in net.gradients(x, live, y).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = net.p[k][at]
        net.p[k][at] = kept + 1e-4
        high = loss()
        net.p[k][at] = kept - 1e-4
        assert abs((high - loss()) / 2e-4 - g[at]) < 1e-4
        net.p[k][at] = kept


def test_language_id(docs, messy, nothing):
    got = langid.identify(docs).collect()
    want = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in held]) > 0.9
    odd = langid.identify(messy).collect()
    assert len(odd) == messy.count()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in odd if r["doc_id"] in (4, 5, 6))
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "und") for r in odd)
    assert langid.identify(nothing).count() == 0


def test_language_without_labels_or_with_repeats(spark):
    rows = [(1, "some words", None, "s", 0), (2, " 12 ", None, "s", 0), (3, None, None, "s", 0)]
    df = spark.createDataFrame(rows, COLUMNS)
    assert langid.fit(df) is None
    assert [r["doc_id"] for r in langid.keep_known(df, None, 0.4).collect()] == [1]
    same = spark.createDataFrame([(1, "one two three", "en", "s", 0)] * 50, COLUMNS)
    assert langid.sample_windows(same, 8, 40) == langid.sample_windows(same.limit(1), 8, 40)


# 5
@pytest.mark.parametrize("name", ["messy", "docs", "nothing"])
@pytest.mark.parametrize("words", [0, 200, 50_000])
def test_bpe_lexicon(request, library, name, words):
    if words != 200 and name == "docs":
        pytest.skip("one size of the lexicon is enough here")
    df = request.getfixturevalue(name)
    want = Counter()
    for doc_id, text in texts(df):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    assert Counter(map(tuple, lexicon.encode_decode(df, VOCABULARY, words).collect())) == want


def test_lexicon_numbers(tmp_path):
    merges = lexicon.Merges(VOCABULARY)
    words = sorted({"tap", "taps", "top", "tops", "stop", "stops", "a", "theha", "!"})
    path = tmp_path / "lexicon"
    path.write_bytes(lexicon.compile_lexicon(words, merges))
    found = lexicon.Lexicon(str(path))
    number = found.find([*words, "ta", "topss", "zzz", ""])
    assert sorted(number[: len(words)]) == list(range(len(words))) and (number[len(words) :] == -1).all()
    flat, sizes = merges.merge(words)
    for w, own, want in zip(words, found.sequences(number[: len(words)]), np.split(flat, np.cumsum(sizes)[:-1])):
        assert list(own) == list(want), w
    builder = lexicon.Builder()
    for w in words:
        builder.add(w.encode())
    assert len(builder.arrays()["final"]) < sum(map(len, words))  # beginnings and ends are shared


# 6
def plain_components(pairs, k, num, den):
    def grams(text):
        w = text.encode().lower().split()
        return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])

    sets = {}
    for i, t in pairs:
        if i is not None:
            sets.setdefault(i, set()).add(grams(t))
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if any(x and den * len(x & y) >= num * len(x | y) for x in sets[i] for y in sets[j]):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return Counter((i, len(grams(t)), None if i is None else find(i)) for i, t in pairs)


def clusters(spark):
    """Groups of near copies about the threshold, and a passage that many share."""
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(3000)}"
    shared, rows = [word() for _ in range(40)], []
    for g in range(8):
        base = [word() for _ in range(rng.choice([12, 60, 120]))]
        for _ in range(25):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = word()
            rows.append((len(rows) * 7 % 1009, " ".join(own)))
    rows += [(2000 + i, " ".join(shared + [word() for _ in range(20)])) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize(("k", "num", "den"), [(3, 90, 100), (5, 80, 100)])
def test_jaccard_join(spark, docs, messy, nothing, monkeypatch, k, num, den):
    monkeypatch.setattr(trie_join, "ADDED", 2)
    made = clusters(spark)
    one_text = messy.where("not (doc_id <=> 7 and length(text) < 100)")
    for df in (made, one_text, docs) if k == 3 else (made, docs):
        got = Counter(map(tuple, trie_join.jaccard_join(df, k, num, den).collect()))
        assert got == plain_components(texts(df), k, num, den)
    assert trie_join.jaccard_join(nothing, k, num, den).count() == 0


def test_jaccard_join_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie_join, "CELL", 5)
    monkeypatch.setattr(trie_join, "CELL_GRAMS", 500)
    made = clusters(spark)
    assert Counter(map(tuple, trie_join.jaccard_join(made).collect())) == plain_components(texts(made), 3, 90, 100)


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9), (9, 7), (5, 5)]
    got = {tuple(r) for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 100) for i in range(100, 141)} | {(3, 3), (7, 3), (9, 3)}


# 7
@pytest.mark.parametrize("seed", range(12))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    counts = {int(n): int(c) for n, c in zip(rng.integers(1, 2049, 60), rng.integers(1, 30, 60))}
    check_packed([(n, *at) for n, c in counts.items() for at in dealt(packing.plan(counts), n, c)], sum(n * c for n, c in counts.items()))


def dealt(rows, n, count):
    own = sorted(r for r in rows if r[0] == n)
    for i in range(count):
        _, first, each, sequence, offset = [r for r in own if r[1] <= i][-1]
        yield sequence + (i - first) // each, offset + (i - first) % each * n


def check_packed(pieces, total):
    """(length, sequence, offset) of all pieces: gapless, within capacity, few sequences."""
    held: dict = {}
    for n, s, at in pieces:
        held.setdefault(s, []).append((at, n))
    for own in held.values():
        end = 0
        for at, n in sorted(own):
            assert at == end
            end += n
        assert end <= packing.CAPACITY
    assert len(held) <= 11 / 9 * max(total / packing.CAPACITY, sum(2 * n > packing.CAPACITY for n, _, _ in pieces)) + 1


@pytest.mark.parametrize("name", ["messy", "docs", "nothing"])
def test_packing(request, library, name):
    df = request.getfixturevalue(name)
    got = packing.pack(df, VOCABULARY).collect()
    want = Counter()
    for doc_id, text in texts(df):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            cut = ids[k : k + 2048]
            want[doc_id, k // 2048, k, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    assert Counter((r[0], r[1], r[2], r[3], r[4]) for r in got) == want
    if got:
        check_packed([(r["length"], r["sequence_id"], r["offset"]) for r in got], sum(r["length"] for r in got))


# 8
def planted(spark):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(100_000)}"
    passage, rows = [word() for _ in range(80)], []
    for i in range(30):
        own = [word() for _ in range(rng.randrange(60, 200))]
        if i % 3 == 0:
            fuzzy = list(passage)
            for j in range(7, 80, 17) if i else ():
                fuzzy[j] = word()
            at = rng.randrange(len(own))
            own[at:at] = fuzzy
        if i % 3 == 1:
            own[5:5] = passage[:30]  # too short
        rows.append((i, " ".join(own), "en", "s", 0))
    return spark.createDataFrame(rows, COLUMNS)


def test_repeated_passages(spark, messy, nothing):
    df = planted(spark)
    got = chains.repeated_passages(df).collect()
    assert {r["doc_id"] for r in got} == set(range(3, 30, 3))
    assert {r["source_doc_id"] for r in got} == {0}
    assert all(78 <= r["n_words"] <= 82 and r["similarity"] > 0.9 for r in got)
    found = {(r["doc_id"], r["source_doc_id"]) for r in chains.repeated_passages(messy).collect()}
    assert {(2, 1), (3, 1)} <= found and all(a in (2, 3) for a, _ in found)
    assert chains.repeated_passages(nothing).count() == 0


def test_exact_runs_are_all_found(docs):
    """Every document that holds 50 words in a row of an earlier one has such a passage."""
    earlier, want = set(), set()
    for doc_id, text in order(texts(docs)):
        w = text.encode().lower().split()
        own = set(zip(*(w[i:] for i in range(50))))
        if own & earlier:
            want.add(doc_id)
        earlier |= own
    assert want and want <= {r["doc_id"] for r in chains.repeated_passages(docs).collect()}


def uncovered(df, passages, n=50):
    """Documents with a word of ``n`` words in a row of an earlier document that lies in no passage; those with such words."""
    earlier, spans, lost, seen = set(), {}, set(), set()
    for r in passages:
        spans.setdefault(r["doc_id"], []).append((r["start_word"], r["n_words"]))
    for doc_id, text in order(texts(df)):
        w = text.encode().lower().split()
        own = [hash(tuple(w[i : i + n])) for i in range(len(w) - n + 1)]
        held, want = np.zeros(len(w), bool), np.zeros(len(w), bool)
        for first, m in spans.get(doc_id, ()):
            held[first : first + m] = True
        for i, g in enumerate(own):
            if g in earlier:
                want[i : i + n] = True
        if want.any():
            seen.add(doc_id)
        if (want & ~held).any():
            lost.add(doc_id)
        earlier.update(own)
    return lost, seen


def check_equal(df, passages):
    """Passages said to be equal are, word by word."""
    words = {d: t.encode().lower().split() for d, t in texts(df)}
    for r in passages:
        if r["similarity"] == 1.0:
            a, b, n = r["start_word"], r["source_start_word"], r["n_words"]
            assert n >= 50 and words[r["doc_id"]][a : a + n] == words[r["source_doc_id"]][b : b + n]


def test_periodic_runs(spark):
    rng = random.Random(8)
    some = lambda n: [f"w{rng.randrange(100_000)}" for _ in range(n)]
    line, period = some(7), some(23)
    rows = [
        ["Of"] * 393, ["Of"] * 393, some(30) + ["Of"] * 1000 + some(9), line * 20, some(5) + line[3:] + line * 30, line * 4,
        some(40) + period * 3 + some(20) + period * 9, period[4:] + period * 12 + some(11),
    ]
    df = spark.createDataFrame([(i, " ".join(w), "en", "s", 0) for i, w in enumerate(rows)], COLUMNS)
    got = chains.repeated_passages(df).collect()
    lost, seen = uncovered(df, got)
    assert seen == {1, 2, 4, 7} and not lost
    check_equal(df, got)
    assert len(got) < 30
    left = {r["doc_id"]: r["text"] for r in chains.without_repeats(df).collect()}
    assert left[1] == "" and left[0] == " ".join(rows[0])
    assert "Of" not in left[2].split() and len(left[2].split()) == 39


def test_runs_held_in_parts_by_earlier_documents(spark):
    rng = random.Random(9)
    some = lambda n: [f"w{rng.randrange(100_000)}" for _ in range(n)]
    p, q = some(80), some(60)
    rows = [
        some(50), some(20) + p[:40] + some(20), some(9) + p[40:] + some(30), some(33) + p + some(20), some(61) + p,
        q[:30] + some(30), q[30:] + some(40), some(8) + q, q + some(8), some(30) + q + some(3),
    ]
    df = spark.createDataFrame([(i, " ".join(w), "en", "s", 0) for i, w in enumerate(rows)], COLUMNS)
    got = chains.repeated_passages(df).collect()
    lost, seen = uncovered(df, got)
    assert seen == {4, 8, 9} and not lost
    assert {(r["doc_id"], r["source_doc_id"], r["n_words"]) for r in got} == {(4, 3, 80), (8, 7, 60), (9, 7, 60)}
    check_equal(df, got)


@pytest.mark.parametrize("edits, least", [(5, 0.9), (10, 0.7)])
def test_passages_with_edits_at_random(spark, edits, least):
    rng = random.Random(5)
    some = lambda n: [f"w{rng.randrange(1_000_000)}" for _ in range(n)]
    rows = []
    for i in range(0, 100, 2):
        p = some(50)
        q = list(p)
        for j in rng.sample(range(1, 49), edits):
            q[j] = some(1)[0]
        rows += [(i + k, " ".join(some(30) + own + some(30)), "en", "s", 0) for k, own in enumerate((p, q))]
    got = chains.repeated_passages(spark.createDataFrame(rows, COLUMNS)).collect()
    assert all(r["doc_id"] == r["source_doc_id"] + 1 and r["similarity"] >= 0.8 for r in got)
    assert len({r["doc_id"] for r in got}) >= least * 50


def test_no_word_of_an_equal_run_is_lost(docs):
    lost, seen = uncovered(docs, chains.repeated_passages(docs).collect())
    assert seen and not lost


def test_passages_are_cut_once(spark, messy, nothing):
    df = planted(spark)
    left = {r["doc_id"]: r["text"] for r in chains.without_repeats(df).collect()}
    for doc_id, text in texts(df):
        if doc_id % 3 or not doc_id:
            assert left[doc_id] == text
        else:
            assert 76 <= len(text.split()) - len(left[doc_id].split()) <= 84
    odd = chains.without_repeats(messy)
    assert odd.columns == messy.columns and odd.count() == messy.count()
    assert odd.where("doc_id = 4").first()["text"] is None
    assert chains.without_repeats(nothing).count() == 0


def test_long_gaps_are_compared_whole():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.choice(b"abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        row = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, u in enumerate(a):
            for j, v in enumerate(b):
                row[i + 1][j + 1] = row[i][j] + 1 if u == v else max(row[i][j + 1], row[i + 1][j])
        assert chains._common(a, b) == row[-1][-1]
    a = [b"%d" % i for i in range(142)]
    b = [*a[:50], b"new", *a[50:]]
    assert chains.align(a, b, [(0, 0), (136, 137)]) == [(0, 142, 0, 143, 142)]


def test_chain_and_cut():
    x = np.array([0, 6, 12, 40, 50, 200])
    y = np.array([100, 106, 113, 20, 151, 300])
    best = chains.chain(x, y)[0]
    assert best[:3] == [0, 1, 2] and 3 not in best
    assert chains.cut("a  b\nc d", [(1, 2)]) == "a  d"
    assert chains.cut(" a b ", [(0, 2)]) == " "


# 9
@pytest.mark.parametrize("name", ["messy", "docs", "nothing"])
def test_fingerprints(request, name):
    df = request.getfixturevalue(name)
    got = omh.fingerprints(df).collect()
    rows = sorted(texts(df), key=lambda p: (-(p[0] if p[0] is not None else -1), p[1]))
    want = Counter()
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        changed = omh.edited(text, following)
        want[doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), omh.written(omh.signature(text.encode()))] += 1
    assert Counter((r[0], r[1], r[2], r[3]) for r in got) == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    if name == "docs":
        assert np.mean([r["near_edited"] > r["near_next"] for r in got]) > 0.9


def plain_signature(text: bytes):
    """The definition, without sorting or chunks."""
    if not text:
        return [0] * omh.SLOTS
    h = omh.numbered(np.frombuffer(text, np.uint8))
    out = []
    for j in range(omh.SLOTS):
        v = ((h >> np.uint64(32)).astype(np.uint32) + omh._ADD[j]) * omh._ODD[j]
        pair = sorted(np.argsort(v, kind="stable")[:2])
        last = h[pair[1]] if len(pair) > 1 else np.uint64(7)
        one = np.array([h[pair[0]]]) * np.uint64(3) + np.array([last]) * np.uint64(0xC2B2AE3D27D4EB4F)
        out.append(int(omh.mix(one)[0] >> np.uint64(32)) | 1)
    return out


def test_signature_and_occurrences():
    text = b"abcdefghijklmnop" * 700
    assert list(omh.signature(text)) == plain_signature(text)
    assert list(omh.signature(b"short")) == plain_signature(b"short")
    h = omh.numbered(np.frombuffer(b"x" * 40, np.uint8))
    assert len(set(h.tolist())) == len(h)  # equal k-mers differ by their number
    a, b = b"one two three four five six seven " * 3, b"seven six five four three two one " * 3
    assert omh.likeness(omh.signature(a), omh.signature(b)) < 0.2


# 10
def test_folding_and_exceptions():
    assert toxicity.fold("1D10T  ⅿ ｉｄｉоｔ") == " idiot ⅿ idiot "
    m = toxicity.Matcher({"idiot": 2.0, "clown": 1.0}, ("clown fish",))
    assert m.features("an 1di0t")[1] > 0 and m.features("a clown fish")[1] == 0
    assert m.features("a clown")[1] > 0 and m.features("")[1] == 0
    assert m.features("idiot")[0] > m.features("idiot" + " word" * 90)[0]


def test_toxicity(spark, labels, messy, nothing):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    marks = table(spark, "/root/testdata/sf0.01", "labels")
    got = toxicity.toxicity(df, marks)
    assert got.count() == df.count()
    held = got.where("held_out").join(marks, "doc_id").toPandas()
    assert (held.predicted == held.toxic).mean() > 0.93
    odd = toxicity.toxicity(messy, labels).collect()
    assert len(odd) == messy.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in odd)
    assert toxicity.toxicity(nothing, labels).count() == 0


# Pipeline
def test_pipeline(spark, docs):
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, now, SF)
        path_rows = corpus_pipeline.materialize(made, name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert path_rows.columns == docs.columns
        seen[name], now = (now, path_rows), path_rows
    before, after = seen["ngram_jaccard_join"]
    groups = plain_components(texts(before), 5, 80, 100)
    assert {r["doc_id"] for r in after.collect()} == {i for i, _, c in groups if i == c}
    before, after = seen["substring_dedup"]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(r["doc_id"] for r in before.collect())
    before, after = seen["best_fit_packing"]
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}


@pytest.mark.parametrize("name", ["messy", "nothing"])
def test_pipeline_on_awkward_rows(request, spark, name):
    now = request.getfixturevalue(name)
    for stage, function in corpus_pipeline.STAGES:
        made = corpus_pipeline.materialize(function(spark, now, SF), stage)
        assert stage == "best_fit_packing" or made.columns == now.columns
        now = made
