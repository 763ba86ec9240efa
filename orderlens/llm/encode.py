"""Whole texts encoded with the tokenizers library, in bounded memory.

A byte-level vocabulary splits text before it merges, and some places always
are such a split: before a blank that a non-blank follows, and around a stop or
comma between a letter and white space.  So a batch of texts is cut there, equal
parts are found by their hashes, each distinct part goes through the library once, and its
ids are kept in a bounded cache; the ids of a text are those of its parts in a row.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import partial
from itertools import compress
from operator import is_
from typing import TYPE_CHECKING

import numpy as np

from .words import mix, powers

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Parts in each of the two generations of a worker's cache (it changes no result).
CACHE_PARTS = 250_000
#: Characters of a text, or of a slice of a long one, that are encoded at a time.
SLICE = 1 << 20
#: The id that ends a document.
END_ID = 0

_is_none = partial(is_, None)
_BREAK = re.compile(r" (?=[A-Za-z])")


def _table(*values: int) -> bytes:
    return bytes(i in values for i in range(256))


def _marks(raw: np.ndarray, table: bytes) -> np.ndarray:
    """Which bytes are in a table.  Much faster than an index of bytes into an array."""
    return np.frombuffer(raw.tobytes().translate(table), bool)


def _same(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, ascending, where one of each is, and of each key its place among the distinct ones (what
    ``np.unique`` gives with a slower, stable sort)."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(new) - 1
    return ordered[new], order[new], of


_WHITE = _table(*range(9, 14), 32)
_MAYBE_WHITE = _table(*range(9, 14), *range(28, 33))  # what any library takes for white space
_LETTER = _table(*range(65, 91), *range(97, 123))
#: What makes a letter of Latin-1 (not the signs of multiplication and division) after the byte 0xC3.
_LATIN = _table(*(b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)))
_STOP = _table(44, 46)
#: The characters by which a byte-level vocabulary spells bytes that are no visible character of Latin-1.
_SPELLED = {b: chr(256 + i) for i, b in enumerate([*range(33), *range(127, 161), 173])}
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(30).integers(1, 1 << 63, 256, dtype=np.uint64)


def cuts(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where parts begin in texts that stand one after the other, each up to its end."""
    starts = np.concatenate([[0], ends])[:-1]
    starts, ends = starts[starts < ends], ends[starts < ends]  # empty texts have no part
    white, odd = np.append(_marks(raw, _WHITE)[1:], True), np.append(_marks(raw, _MAYBE_WHITE)[1:], True)
    white[ends - 1] = odd[ends - 1] = True
    letter = np.append(False, _marks(raw, _LETTER)[:-1])
    letter[starts] = False
    stop = np.flatnonzero(_marks(raw, _STOP) & white & letter)
    first = np.zeros(len(raw) + 1, bool)
    first[np.flatnonzero((raw == 32) & ~odd)] = True
    first[stop] = first[stop + 1] = first[starts] = True
    return np.flatnonzero(first[:-1])


def slices(text: str) -> Iterator[str]:
    """A long text cut before blanks that a letter follows."""
    at = 0
    while len(text) - at > SLICE and (found := _BREAK.search(text, at + SLICE)):
        yield text[at:found.start()]
        at = found.start()
    yield text[at:]


def _hashes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The hash of each part; a part ends where the next one begins."""
    n = len(raw)
    return mix(np.add.reduceat(_BYTES[raw] * powers(_BASE, n)[:n], starts) * powers(_INVERSE, n)[starts])


def _edges(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number made of the length and the first and last eight bytes of each part."""
    words = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))
    size = ends - starts
    used = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * np.uint64(8) - np.uint64(8) * np.minimum(size, 8).astype(np.uint64))
    return mix(words[starts] & used) + (words[np.maximum(ends - 8, starts)] & used) * np.uint64(_BASE) + size.astype(np.uint64)


class PieceCache:
    """Texts to the bytes of unsigned 32-bit little-endian ids, part by part.

    A subclass says how words and other pieces are encoded."""

    def __init__(self):
        import public_tokenizers
        import regex

        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.known: dict[bytes, bytes] = {}  # by parts
        self.older: dict[bytes, bytes] = {}  # the generation before
        self.others: dict[str, bytes] = {}  # by pieces

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word: a blank or a line feed, then letters only."""
        raise TypeError("a subclass encodes")

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece."""
        raise TypeError("a subclass encodes")

    def _pieces(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that are no single word."""
        found = [self.pieces(t) for t in texts]
        new = list({p for x in found for p in x}.difference(self.others))
        long = {}
        spaced = [p for p in new if p[0] == " " and p[1:].isalpha()]
        bare = [p for p in new if p.isalpha()]
        rest = [p for p in new if not (p if p[0] != " " else p[1:]).isalpha()]
        ids = self.encode_words([*spaced, *("\n" + p for p in bare)]) if spaced or bare else []
        feed = len(self.encode_pieces(["\n"])[0]) if bare else 0
        ids = [*ids[:len(spaced)], *(x[feed:] for x in ids[len(spaced):]), *self.encode_pieces(rest)]
        for piece, x in zip([*spaced, *bare, *rest], ids, strict=True):
            (self.others if len(piece) < 64 else long)[piece] = x
        return [b"".join([self.others[p] if p in self.others else long[p] for p in x]) for x in found]

    def _learn(self, missing: list[bytes]) -> list[bytes]:
        """The ids of distinct parts, which the cache takes up; empty where a part should not have been cut
        off, as its blank is followed by white space beyond ASCII."""
        older = self.older
        out = [older.get(p) for p in missing]
        new, words, mixed, others = [], [], [], []
        for i in compress(range(len(out)), map(_is_none, out)):
            text = missing[i].decode()
            if text[0] in " \n" and text[1:].isalpha():
                new.append(i)
                words.append(text)
            elif text[0] == " " and text[1:2] > "\x7f" and text[1].isspace():
                out[i] = b""
            else:
                mixed.append(i)
                others.append(text)
        for places, ids in ((new, self.encode_words(words) if words else []), (mixed, self._pieces(others))):
            for i, x in zip(places, ids, strict=True):
                out[i] = x
        self.known.update(zip(missing, out, strict=True))
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; a long one goes slice by slice."""
        short = [t if len(t) <= SLICE else "" for t in texts]
        out = self._encode(short)
        for i, t in enumerate(texts):
            if len(t) > SLICE:
                out[i] = b"".join(self._encode([x])[0] if len(x) <= 2 * SLICE else self._pieces([x])[0]
                                  for x in slices(t))
        return out

    def _distinct(self, data: bytes, keys: np.ndarray, check: np.ndarray, starts: np.ndarray, ends: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and of each of the distinct parts where its own begin there and their number."""
        parts = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        ids = list(map(self.known.get, parts))
        unknown = list(compress(range(len(ids)), map(_is_none, ids)))
        for i, x in zip(unknown, self._learn([parts[i] for i in unknown]), strict=True):
            ids[i] = x
        sizes = np.array(list(map(len, ids)), np.int64) // 4
        return np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes, sizes

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_PARTS:
            self.older, self.known = self.known, {}
        if len(self.others) > CACHE_PARTS // 4:
            self.others.clear()
        each = [t.encode() for t in texts]
        data = b"".join(each)
        if not data:
            return [b""] * len(texts)
        raw, stops = np.frombuffer(data, np.uint8), np.cumsum([len(x) for x in each])
        starts = cuts(raw, stops)
        ends = np.append(starts[1:], len(raw))
        check = _edges(data, starts, ends)
        keys, first, of = _same(_hashes(raw, starts))
        if (check[first][of] != check).any():  # two parts share a hash
            return self._pieces(texts)
        flat, at, sizes = self._distinct(data, keys, check[first], starts[first], ends[first])
        n = sizes[of]
        before = np.concatenate([[0], np.cumsum(n)])
        packed = flat[np.repeat(at[of] - before[:-1], n) + np.arange(before[-1])].tobytes()
        edges = (4 * before[np.searchsorted(starts, np.concatenate([[0], stops]))]).tolist()
        out = [packed[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        for i in np.unique(np.searchsorted(stops, starts[sizes[of] == 0], "right")).tolist():  # cut at a wrong place
            (out[i],) = self._pieces([texts[i]])
        return out


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Words:
    """Ids of words by the words' hashes, which are sorted; arrays, so no word is an object of its own."""

    def __init__(self):
        self.keys, self.check = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.at, self.sizes, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def find(self, keys: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The place of each word, -1 if it is not there."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[place] == keys) & (self.check[place] == check), place, -1)

    def add(self, keys: np.ndarray, check: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> None:
        """Take up words, sorted by hash, in place of others with the same hash."""
        at = len(self.flat) + np.cumsum(sizes) - sizes
        place = np.searchsorted(self.keys, keys)
        stay = np.ones(len(self.keys) + 1, bool)
        stay[place[np.append(self.keys, np.uint64(0))[place] == keys]] = False
        stay = stay[:-1]
        place -= np.concatenate([[0], np.cumsum(~stay)])[place]
        for name, new in (("keys", keys), ("check", check), ("at", at), ("sizes", sizes)):
            setattr(self, name, np.insert(getattr(self, name)[stay], place, new))
        self.flat = np.concatenate([self.flat, flat])

    def ids(self, places: np.ndarray) -> np.ndarray:
        return self.flat[_ranges(self.at[places], self.sizes[places])]


class Encoder(PieceCache):
    """Encodes with the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        #: The same model for plain words that are spelled byte by byte already, where a blank begins each.
        self.plain_tokenizer = Tokenizer(self.tokenizer.model)
        self.plain_tokenizer.pre_tokenizer = Split(_SPELLED[32], "merged_with_next")
        size = self.tokenizer.get_vocab_size()
        #: Bytes of each token.
        self.lengths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.plain, self.plain_before = Words(), Words()  # two generations: a blank, then letters of Latin-1

    def _distinct(self, data: bytes, keys: np.ndarray, check: np.ndarray, starts: np.ndarray, ends: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = np.frombuffer(data, np.uint8)
        letter = _marks(raw, _LETTER).copy()
        pair = (raw[:-1] == 0xC3) & _marks(raw, _LATIN)[1:]
        letter[:-1] |= pair
        letter[1:] |= pair
        letters = np.append(0, np.cumsum(letter, dtype=np.int32))
        plain = (raw[starts] == 32) & (ends - starts > 1) & (letters[ends] - letters[starts] == ends - starts - 1)
        own, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        at, sizes = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        flat, at[others], sizes[others] = super()._distinct(data, keys[others], check[others], starts[others], ends[others])
        places = self._plain_words(raw, keys[own], check[own], starts[own], ends[own])
        at[own], sizes[own] = self.plain.at[places] + len(flat), self.plain.sizes[places]
        return np.concatenate([flat, self.plain.flat]), at, sizes

    def _plain_words(self, raw: np.ndarray, keys: np.ndarray, check: np.ndarray, starts: np.ndarray, ends: np.ndarray
                     ) -> np.ndarray:
        """The places of distinct words in ``plain``, which takes up those that it does not have."""
        if len(self.plain.keys) > CACHE_PARTS:
            self.plain_before, self.plain = self.plain, Words()
        missing = np.flatnonzero(self.plain.find(keys, check) < 0)
        found = self.plain_before.find(keys[missing], check[missing])
        again, new = missing[found >= 0], missing[found < 0]
        if len(again):
            places = found[found >= 0]
            self.plain.add(keys[again], check[again], self.plain_before.sizes[places], self.plain_before.ids(places))
        if len(new):
            sizes = ends[new] - starts[new]
            text = raw[_ranges(starts[new], sizes)].tobytes().decode("latin-1").translate(_SPELLED)
            ids, stops = self._joined(text, np.cumsum(sizes), self.plain_tokenizer)
            self.plain.add(keys[new], check[new], np.diff(stops, prepend=0), ids)
        return self.plain.find(keys, check)

    def _joined(self, text: str, ends: np.ndarray, tokenizer: Tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that stand one after the other, each up to its end in bytes, and where those of each end."""
        got = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(got[0].ids, np.uint32)
        return ids, np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1

    def encode_words(self, words: list[str]) -> list[bytes]:
        """All words in one call; the ids are split again by the tokens' bytes."""
        ids, stops = self._joined("".join(words), np.cumsum([len(w.encode()) for w in words]), self.tokenizer)
        at = (4 * stops).tolist()
        data = ids.astype("<u4").tobytes()
        return [data[a:b] for a, b in zip([0, *at], at, strict=False)]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes()
                for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


_made: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder."""
    if path not in _made:
        _made[path] = Encoder(path)
    return _made[path]


def forget() -> None:
    """Drop this worker's encoder."""
    _made.clear()


def in_turn(texts: list[str], chars: int = 1 << 20):
    """Index ranges of consecutive texts with about ``chars`` characters each."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
