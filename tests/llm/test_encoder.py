"""The encoder that keeps words: equal to the library whatever is kept, and its end."""

import pyarrow as pa
import pytest

from velomart.llm import tokens

TEXTS = [
    "", " ", "\n\n a b \t", "a\x0bb\x0c c", "<|endoftext|> a<|x b", "é x y", "\x00 \x1c a", "don't  stop",
    "same same same", "é  x y", "日本語 " * 3, "w" * 5000,
    " ".join(f"w{i % 37}" for i in range(400)),
]


@pytest.mark.parametrize("kept", [2, 30, 100_000])
def test_ids_do_not_depend_on_what_is_kept(kept):
    enc = tokens.Encoder(tokens.vocabulary_path(), kept)
    want = [e.ids for e in enc.whole.encode_batch(TEXTS, add_special_tokens=False)]
    for part in (TEXTS, TEXTS[::-1], TEXTS):
        expected = want if part is TEXTS else want[::-1]
        ids, at = enc.encode(part)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == expected
    assert [len(x) for x in enc.encode([])] == [0, 1]


def test_frequent_words_stay_and_the_rest_goes():
    enc = tokens.Encoder(tokens.vocabulary_path(), 40)
    for i in range(30):
        enc.encode([f"often only{i} once{i} x{i} y{i}"])
    assert b"often" in enc.words or b"often" in enc.old_words
    assert b"only0" not in enc.words and b"only0" not in enc.old_words
    assert len(enc.words) + len(enc.old_words) <= 40


def test_forgotten_encoders_are_made_again():
    first = tokens.encoder(tokens.vocabulary_path(), 10)
    assert tokens.encoder(tokens.vocabulary_path(), 10) is first
    tokens.forget()
    assert tokens.encoder(tokens.vocabulary_path(), 10) is not first


class Counted(dict):
    """Counts its lookups."""

    lookups = 0

    def get(self, *args):
        self.lookups += 1
        return super().get(*args)

    def __contains__(self, key):
        self.lookups += 1
        return super().__contains__(key)

    def __getitem__(self, key):
        self.lookups += 1
        return super().__getitem__(key)


def test_a_known_word_costs_one_lookup_a_slice():
    enc = tokens.Encoder(tokens.vocabulary_path())
    want = enc.encode(TEXTS)
    enc.words = Counted(enc.words)
    got = enc.encode(TEXTS)
    assert [x.tolist() for x in got] == [x.tolist() for x in want]
    assert enc.words.lookups == len(enc.words)


def test_texts_may_come_as_a_column():
    enc = tokens.Encoder(tokens.vocabulary_path())
    want = enc.encode(["", "a é b", "x"])
    got = enc.encode(pa.array([None, "a é b", "x"]))
    assert [x.tolist() for x in got] == [x.tolist() for x in want]


def test_pieces_are_shown_as_the_vocabulary_writes_them():
    every = "".join(map(chr, range(33, 0x3000)))
    pieces = [c for c in every] + [every, "a", "é" * 3, "日本", "𝒳"]
    want = [p if p.isascii() else p.encode().decode("latin-1").translate(tokens.BYTES) for p in pieces]
    # What is shown otherwise below 128 never stands in a piece of a plain word.
    want = [w.replace(chr(tokens.BYTES[127]), "\x7f") for w in want]
    tokens._make_visible(pieces)
    assert pieces == want
