"""Hashes of the words and word shingles of whole texts, many texts at a time."""

from __future__ import annotations

import numpy as np

#: Bytes that part words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Longer texts are read in slices cut at a blank.
SLICE = 4 << 20


def _byte_hashes() -> np.ndarray:
    """A fixed random number for each byte; A-Z have those of a-z, blanks have 0."""
    table = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
    table[65:91] = table[97:123]
    table[list(BLANKS)] = 0
    return table


_TABLE = _byte_hashes()
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64, at least n of them."""
    if base not in _powers or len(_powers[base]) < n:
        size = max(1 << 16, n + n // 4)
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return _powers[base]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each number over all its 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and its hash."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~_BLANK[raw]
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[raw] * powers(_BASE, len(raw))[:len(raw)],
                                                              dtype=np.uint64)])
    return starts, mix((total[ends] - total[starts]) * powers(_INVERSE, len(raw))[starts])


def _cuts(data: bytes) -> list[bytes]:
    """Slices of a long text that no word crosses."""
    out, at = [], 0
    while len(data) - at > SLICE:
        end = max((data.rfind(bytes([b]), at, at + SLICE) for b in BLANKS), default=-1)
        if end < at:  # one endless word: up to the next blank
            end = min((p for b in BLANKS if (p := data.find(bytes([b]), at + SLICE)) >= 0), default=len(data) - 1)
        out.append(data[at:end + 1])
        at = end + 1
    return [*out, data[at:]]


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word (A-Z read as a-z) and the number of its text."""
    if sum(map(len, texts)) > 2 * SLICE:
        found = [np.concatenate([_word_hashes(c)[1] for c in _cuts(t)]) for t in texts]
        return np.concatenate(found), np.repeat(np.arange(len(texts)), [len(x) for x in found])
    starts, hashes = _word_hashes(b" ".join(texts) + b" ")
    firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(firsts, starts, "right") - 1


def shingles(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of k words of each text, sorted by text and hash: hashes, text numbers.

    A text with fewer words has its whole sequence as one shingle, one without words none.
    """
    word, text = words(texts)
    sums = np.zeros(max(0, len(word) - k + 1), np.uint64)
    for i in range(k):
        sums += word[i:i + len(sums)] * np.uint64(powers(_BASE, k + 1)[i + 1])
    whole = text[:len(sums)] == text[k - 1:] if len(sums) else np.zeros(0, bool)
    hashes, owner = mix(sums[whole]), text[:len(sums)][whole]
    counts = np.bincount(text, minlength=len(texts))
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        ends = np.cumsum(counts)
        few = []
        for t in short:
            own = word[ends[t] - counts[t]:ends[t]]
            few.append((own * powers(_BASE, k + 1)[1:len(own) + 1]).sum(dtype=np.uint64) + np.uint64(len(own)))
        hashes = np.concatenate([hashes, mix(np.array(few, np.uint64))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def in_blocks(texts: list[bytes], size: int = 1 << 20, most: int = 1_000):
    """Ranges of consecutive texts of about ``size`` bytes together."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size or i + 1 - start == most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
