"""Token ids by the tokenizers library, with the ids of words kept between texts.

White space always separates tokens in this vocabulary, and every word is cut into
pieces that are merged on their own. So the library encodes each new piece once and
texts are put together from the words' ids. Equal words of a slice are looked up once.

What is kept is bounded and only saves time. Words are kept in two halves: when the newer
one is full it becomes the older one, whose words move to the newer when they are found
again, so frequent words stay and those found once go.
"""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer, pre_tokenizers

#: Words kept by one Python worker.
KEPT_WORDS = 700_000
#: The cut of the vocabulary's own pre-tokenizer (fixed values).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same cut of ASCII text in lower case.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ a-z0-9]+| ")
END = "</w>"
#: Words that normalising changes in case only: no marks to compose, no other white space.
PLAIN = r"^[\x21-\x7e\x{a1}-\x{24f}]*$"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, path: str, kept: int = KEPT_WORDS):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        size = self.whole.get_vocab_size()
        self.ends = np.zeros(size, bool)
        for token, i in self.whole.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith(END)
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.cut = regex.compile(PIECES + "| ")
        self.kept = kept
        self.clear()

    def clear(self) -> None:
        self.words: dict[bytes, int] = {}
        self.word_ids = _Lists()
        self._age()

    def _age(self) -> None:
        """The newer half of the words becomes the older one."""
        self.old_words, self.old_ids = self.words, self.word_ids
        self.words, self.word_ids = {}, _Lists()
        self.pieces: dict[str, int] = {" ": 0}
        self.piece_ids = _Lists()
        self.piece_ids.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _keep(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Add words to the newer half; where they stand."""
        self.word_ids.add(ids, sizes)
        first = len(self.words)
        self.words.update(zip(words, range(first, first + len(words)), strict=True))
        return np.arange(first, first + len(words))

    def _slow_cut(self, word: bytes) -> list[str]:
        text = self.whole.normalizer.normalize_str(word.decode())
        return [p for p, _ in self.whole.pre_tokenizer.pre_tokenize_str(text)]

    def _merge(self, pieces: list[str]) -> None:
        lines = [" ".join(pieces[i : i + 500]) for i in range(0, len(pieces), 500)]
        ids = [e.ids for e in self.bare.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), np.uint32)
        stops = np.flatnonzero(self.ends[flat]) + 1
        self.piece_ids.add(flat, np.diff(stops, prepend=0))
        first = len(self.pieces)
        self.pieces.update(zip(pieces, range(first, first + len(pieces)), strict=True))

    def cut_words(self, words: list[bytes]) -> tuple[list[bytes], list[str]]:
        """The words in another order, and their pieces, with a blank after each word's."""
        order, cut = self._cut_in_order(words)
        return [words[i] for i in order.tolist()], cut

    def _cut_in_order(self, words: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Which word comes when, and the pieces of all, with a blank after each word's."""
        coded = pa.array(words, pa.large_binary())
        texts = coded.cast(pa.large_string())
        shown = pc.and_not(pc.match_substring_regex(texts, PLAIN), pc.match_substring(texts, "<|"))
        ascii_ = pc.string_is_ascii(texts)
        plain, wide, odd = pc.and_(shown, ascii_), pc.and_not(shown, ascii_), pc.invert(shown)
        cut = _cut_all(ASCII_PIECES, coded.filter(plain))
        beyond = _cut_all(self.cut, coded.filter(wide))
        _make_visible(beyond)
        cut += beyond
        rest = np.flatnonzero(odd)
        for w in map(words.__getitem__, rest.tolist()):
            if any(s in w for s in self.special):  # their strings are tokens of their own
                cut.append(w.decode() + " ")
            else:
                cut += self._slow_cut(w)
            cut.append(" ")
        return np.concatenate([np.flatnonzero(plain), np.flatnonzero(wide), rest]), cut

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """Keep the ids of new words; where they stand."""
        order, cut = self._cut_in_order(words)
        known = self.pieces
        # A piece stands many times in a slice: it is looked up among the slice's own first.
        own = dict.fromkeys(cut)
        for key in own:
            if len(key) > 1 and key[-1] == " " and key not in known:
                special = self.whole.encode(key[:-1], add_special_tokens=False).ids
                known[key] = len(known)
                self.piece_ids.add(np.array(special, np.uint32), np.array([len(special)]))
        if new := [p for p in own if p not in known]:
            self._merge(new)
        own = {p: known[p] for p in own}
        index = np.fromiter(map(own.__getitem__, cut), np.int64, len(cut))
        ids, at = self.piece_ids.gather(index)
        places = np.empty(len(words), np.int64)
        places[order] = self._keep([words[i] for i in order.tolist()], ids, np.diff(at[1:][index == 0], prepend=0))
        return places

    def _places(self, words: list[bytes]) -> np.ndarray:
        """Where the ids of these words, all different, stand among those of the newer half."""
        places = _found(self.words, words)
        rest = np.flatnonzero(places < 0)
        if len(rest) and len(self.words) + len(rest) > self.kept // 2:
            self._age()
            rest = np.arange(len(words))
        if len(rest) and self.old_words:
            old = _found(self.old_words, [words[i] for i in rest.tolist()])
            again = rest[old >= 0]
            if len(again):
                ids, at = self.old_ids.gather(old[old >= 0])
                places[again] = self._keep([words[i] for i in again.tolist()], ids, np.diff(at))
            rest = rest[old < 0]
        if len(rest):
            places[rest] = self._learn([words[i] for i in rest.tolist()])
        return places

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end, and where each text's begin; null counts as empty."""
        # At either end of a text the split may leave an empty word, which has no ids.
        split = pc.ascii_split_whitespace(pc.fill_null(pa.array(texts).cast(pa.large_string()), ""))
        coded = split.flatten().dictionary_encode()
        places = self._places(_listed(coded.dictionary.cast(pa.large_binary())))
        ids, at = self.word_ids.gather(places[coded.indices.to_numpy()])
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        return ids, at[np.cumsum([0, *sizes])]


def _found(numbers: dict[bytes, int], words: list[bytes]) -> np.ndarray:
    """The number of each word, -1 if it has none."""
    return np.fromiter(map(numbers.get, words, repeat(-1)), np.int64, len(words))


def _joined(words: pa.Array) -> bytes:
    ends = pa.array([0, len(words)], pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(ends, words), pa.scalar(b" ", words.type))[0].as_py()


def _listed(words: pa.Array) -> list[bytes]:
    """Words without blanks as a list, by one cut of all of them."""
    return _joined(words).split(b" ") if len(words) else []


def _cut_all(cutter, words: pa.Array) -> list[str]:
    """Pieces of the words in lower case, with a blank after each word's."""
    return cutter.findall(_joined(words).decode().lower() + " ") if len(words) else []


def _make_visible(pieces: list[str]) -> None:
    """Put for each piece its UTF-8 bytes as the vocabulary writes them. No piece holds a line end."""
    at = [i for i, p in enumerate(pieces) if not p.isascii()]
    if not at:
        return
    data = np.frombuffer("\n".join([pieces[i] for i in at]).encode(), np.uint8)
    high = data >= 128
    place = np.arange(len(data)) + np.cumsum(high) - high
    out = np.empty(len(data) + int(high.sum()), np.uint8)
    out[place] = LEAD[data]
    out[place[high] + 1] = TRAIL[data[high]]
    for i, p in zip(at, out.tobytes().decode().split("\n"), strict=True):
        pieces[i] = p


def _byte_characters() -> dict[int, int]:
    """Printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(rest)}


BYTES = _byte_characters()
#: The first and second byte in UTF-8 of what a byte from 128 on is shown as; those below stand for themselves.
LEAD, TRAIL = np.arange(256, dtype=np.uint8), np.zeros(256, np.uint8)
for _byte in range(128, 256):
    LEAD[_byte], TRAIL[_byte] = chr(BYTES.get(_byte, _byte)).encode()


class _Lists:
    """Growing lists of ids, one after the other."""

    def __init__(self):
        self.flat, self.at = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)
        self.n = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        filled = self.at[self.n]
        self.flat, self.at = _room(self.flat, filled + len(ids)), _room(self.at, self.n + len(sizes) + 1)
        self.flat[filled : filled + len(ids)] = ids
        self.at[self.n + 1 : self.n + len(sizes) + 1] = filled + np.cumsum(sizes)
        self.n += len(sizes)

    def gather(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen lists on end, and where each begins."""
        first = self.at[index]
        size = self.at[index + 1] - first
        total = np.zeros(len(index) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        return self.flat[np.repeat(first - total[:-1], size) + np.arange(total[-1])], total


def _room(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    grown = np.zeros(max(size, 2 * len(values)), values.dtype)
    grown[: len(values)] = values
    return grown


_encoders: dict[str, Encoder] = {}


def encoder(path: str, kept: int = KEPT_WORDS) -> Encoder:
    """The worker's encoder of a vocabulary, which keeps so many words."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    _encoders[path].kept = kept
    return _encoders[path]


def forget() -> None:
    """Give up the worker's encoders; the next text makes a new one."""
    _encoders.clear()
