"""Two tokenizers aligned by bytes, and how many documents hold each linked pair of ids.

A text behind one blank is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B).
Where an A and a B token end at the same byte, a group ends; tokens whose bytes overlap are linked.

The text is cut at blanks where neither vocabulary has a token on both sides: before a blank that
follows a non-blank, and has white space neither before it nor behind it on both sides at once.  Equal
parts are aligned once for a task.  Then, in two passes:

1. Documents are dealt to blocks and aligned; a block lists its distinct pairs of ids with the number of its
   documents that hold each, and of each document the places of its pairs among these.  Pairs are spread by hash over ``SHARDS`` shards, so a shard has at most
   (size of A) * (size of B) / SHARDS of them, about, whatever the corpus.
2. A shard's distinct pairs, brought together by a tree of unions, get a minimal perfect hash
   (``MinimalHash``).  Blocks add their numbers to dense vectors indexed by it, ``BRANCHES`` vectors for a
   shard, which are then summed: a tree again.
3. Each block looks its pairs up, by the hash and with the stored key compared.
4. The second pass adds up each document's links, with the pairs' counts of its block at hand; no text is
   moved or aligned again.

Only the highest count of each A id reaches the driver: a number for each entry of the vocabulary.

Defined results: a null or empty text, or one whose joined token bytes are not the text's (U+2581 stands for
a blank in B), has no token: all numbers 0, no group; special tokens' spellings are plain text; texts of any
length are read whole, slice by slice; rows that repeat a doc_id are documents of their own; a null doc_id comes
back as null; equal counts are all highest; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch
from .blocks import BlockNames, by_block
from .memory import trimmed
from .words import mix

#: Shards of the pairs, and vectors of a shard that blocks add to.
SHARDS, BRANCHES = 1 << 10, 8
#: Bytes of text of a block, and characters of a text that are aligned at a time, about.
BLOCK, SLICE = 8 << 20, 1 << 20
#: Parts that a task keeps aligned.
KNOWN = 500_000
#: Pairs that a task holds before it passes their union on.
HELD = 1 << 21

_CUT = re.compile(r" (?:(?<=\S )|(?<=[^ ] )(?=\S))")


def slices(text: str) -> Iterator[list[str]]:
    """The parts of a text, each without the blank before it; a list for each slice."""
    at = 0
    while len(text) - at > SLICE and (found := _CUT.search(text, at + SLICE)):
        yield _CUT.split(text[at:found.start()])
        at = found.end()
    yield _CUT.split(text[at:])


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable bytes for themselves, the
    others by the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + i)] = b
    return out


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    """An array with room for so many values."""
    if size <= len(values):
        return values
    out = np.zeros(max(size, 2 * len(values)), values.dtype)
    out[:len(values)] = values
    return out


class Aligner:
    """Parts of texts aligned, each once.  Part i has ``n_a[i]``, ``n_b[i]`` tokens (-1 where the tokens do
    not give its bytes), ``n_groups[i]`` groups with the text ``groups[i]``, and the links
    ``pairs[first[i]:first[i + 1]]``."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.exact_a = self.a.normalizer is None
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = byte_alphabet()
        self.bytes_a = [bytes(of.get(c, 32) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size())]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("a piece holds a blank behind another character: parts cannot be cut at blanks")
        self.bytes_b = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode()
                        for i, n in enumerate(names)]
        self.blank = self.b.piece_to_id("▁")
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Ids as text, each with what may follow it: "," or, as the last of its side, "|" or ";".
        self.named = [f"{i}{c}" for n, last in ((len(self.bytes_a), "|"), (len(names), ";")) for c in ("," + last)
                      for i in range(n)]
        self.named_size = np.array([len(x) for x in self.named], np.int64)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.n_a, self.n_b, self.n_groups, self.first, self.used = (np.zeros(1 << 12, np.int64) for _ in range(5))
        self.pairs = np.zeros(1 << 14, np.int64)

    def prune(self) -> None:
        """Forget all parts but those used most often since they were learned, half of KNOWN at most."""
        used = self.used[:len(self.index)]
        keep = np.sort(np.argsort(used, kind="stable")[-KNOWN // 2:])
        keep = keep[used[keep] > 1]
        parts, groups = list(self.index), self.groups
        old = [x[keep] for x in (self.n_a, self.n_b, self.n_groups, self.used)]
        n_links, (pairs, _) = self.first[keep + 1] - self.first[keep], self.links(keep)
        self.forget()
        self._add([parts[i] for i in keep.tolist()], *old[:3], n_links, pairs, [groups[i] for i in keep.tolist()])
        self.used[:len(keep)] = old[3] // 2

    def learn(self, parts: set[str]) -> None:
        """Have these parts aligned."""
        new = parts.difference(self.index)
        plain = [p for p in new if p and not (p[0].isspace() or p[-1].isspace() or " " in p or "▁" in p)]
        if plain:
            # Neither vocabulary has a token over the blank between two such parts: all go as one text.
            text = " ".join(plain)
            a = np.array(self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.int64)
            b = np.array(self.b.encode(text, num_threads=1), np.int64)
            data = (" " + text).encode()
            ends = np.append(np.flatnonzero(np.frombuffer(data, np.uint8) == 32)[1:], len(data))  # blanks stand between parts
            of_a, of_b = (np.searchsorted(np.cumsum(size[i]), ends) + 1 for size, i in ((self.size_a, a), (self.size_b, b)))
            # A spells every byte; with a normaliser it might not, nor does B where it changes a character.
            if (self.exact_a or b"".join([self.bytes_a[i] for i in a.tolist()]) == data) \
                    and b"".join([self.bytes_b[i] for i in b.tolist()]) == data \
                    and all((np.cumsum(size[ids])[of - 1] == ends).all()
                            for size, ids, of in ((self.size_a, a, of_a), (self.size_b, b, of_b))):
                self._take(plain, a, np.diff(of_a, prepend=0), b, np.diff(of_b, prepend=0))
        odd = list(new.difference(self.index))
        encoded = [x.ids for x in self.a.encode_batch_fast([" " + p for p in odd], add_special_tokens=False)]
        # An empty part is the blank alone.
        pieces = [x or [self.blank] for x in self.b.encode(odd, num_threads=1)] if odd else []
        good = []
        for part, a, b in zip(odd, encoded, pieces, strict=True):
            data = (" " + part).encode()
            if b"".join([self.bytes_a[i] for i in a]) == data == b"".join([self.bytes_b[i] for i in b]):
                good.append((part, a, b))
            else:
                self._add([part], *(np.array([-1], np.int64) for _ in range(3)), np.zeros(1, np.int64),
                          np.zeros(0, np.int64), [""])
        if good:
            self._take([p for p, _, _ in good], np.array([i for _, x, _ in good for i in x], np.int64),
                       np.array([len(x) for _, x, _ in good]), np.array([i for _, _, x in good for i in x], np.int64),
                       np.array([len(x) for _, _, x in good]))

    def _take(self, parts: list[str], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> None:
        """Align parts whose tokens stand one after the other."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = _distinct(np.concatenate([ends_a, ends_b]), "stable")  # up to each of them one A and one B token overlap
        pairs = a[np.searchsorted(ends_a, ends)] << 32 | b[np.searchsorted(ends_b, ends)]
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        part_ends = ends_a[np.cumsum(n_a) - 1]
        n_links = np.diff(np.searchsorted(ends, part_ends, "right"), prepend=0)
        n_groups = np.diff(np.searchsorted(common, part_ends, "right"), prepend=0)
        # The groups' text: A's ids of a group, then B's, each with its mark.
        size_a, size_b = len(self.bytes_a), len(self.bytes_b)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        last_a, last_b = common[group_a] == ends_a, common[group_b] == ends_b
        mark = np.concatenate([a + size_a * last_a, 2 * size_a + b + size_b * last_b])
        order = np.lexsort((np.concatenate([np.zeros(len(a), np.int8), np.ones(len(b), np.int8)]),
                            np.concatenate([group_a, group_b])))
        mark = mark[order]
        text = "".join([self.named[i] for i in mark.tolist()])
        stops = np.cumsum(self.named_size[mark])[np.cumsum(n_a + n_b) - 1].tolist()
        self._add(parts, n_a, n_b, n_groups, n_links, pairs,
                  [text[x:y - 1] for x, y in zip([0, *stops], stops, strict=False)])

    def _add(self, parts: list[str], n_a: np.ndarray, n_b: np.ndarray, n_groups: np.ndarray, n_links: np.ndarray,
             pairs: np.ndarray, groups: list[str]) -> None:
        at, m = len(self.index), len(parts)
        start = int(self.first[at])
        self.n_a, self.n_b, self.n_groups, self.first, self.used = (
            _grown(x, at + m + 1) for x in (self.n_a, self.n_b, self.n_groups, self.first, self.used))
        self.n_a[at:at + m], self.n_b[at:at + m], self.n_groups[at:at + m] = n_a, n_b, n_groups
        self.first[at + 1:at + m + 1] = start + np.cumsum(n_links)
        self.pairs = _grown(self.pairs, start + len(pairs))
        self.pairs[start:start + len(pairs)] = pairs
        self.groups.extend(groups)
        self.index.update(zip(parts, range(at, at + m), strict=True))

    def links(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links of parts one after the other, and where each part's begin."""
        n = self.first[at + 1] - self.first[at]
        before = np.cumsum(n) - n
        return self.pairs[np.repeat(self.first[at] - before, n) + np.arange(int(n.sum()))], before


_made: dict[tuple[str, str], Aligner] = {}


def aligner_of(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner; it stays from one task to the next of its stage."""
    if (path_a, path_b) not in _made:
        _made[path_a, path_b] = Aligner(path_a, path_b)
    return _made[path_a, path_b]


def forget() -> None:
    """Drop this worker's aligner."""
    _made.clear()


def _distinct(values: np.ndarray, kind: str | None = None) -> np.ndarray:
    """The distinct ones of some numbers, sorted; "stable" merges sorted runs."""
    values = np.sort(values, kind=kind)
    return values[np.concatenate([[True], values[1:] != values[:-1]])[:len(values)]]


def _chunks(texts: list[str | None]) -> Iterator[tuple[list[int], list[list[str]]]]:
    """Parts of the texts, some megabytes of text at a time: the text's place and the parts of each slice."""
    places, some, held = [], [], 0
    for i, text in enumerate(texts):
        for parts in slices(text) if text else ():
            places.append(i)
            some.append(parts)
            held += sum(map(len, parts)) if len(text) > SLICE else len(text)
            if held >= SLICE:
                yield places, some
                places, some, held = [], [], 0
    if some:
        yield places, some


class MinimalHash:
    """A minimal perfect hash of distinct numbers: level by level, a number that is alone in its slot
    is placed, the others go on.  A number's index is the count of placed slots before its own."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        at, self.ranks = 0, []
        for bits in levels:
            self.ranks.append(at + np.cumsum(bits) - bits)
            at += int(bits.sum())
        self.size = at

    @staticmethod
    def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys.view(np.uint64) ^ mix(np.array([level + 1], np.uint64))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> MinimalHash:
        levels = []
        while len(keys):
            size = 2 * len(keys)
            slots = cls._slots(keys, len(levels), size)
            alone = np.bincount(slots, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[slots]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Their indexes; -1 for some numbers that were not hashed, any index for others."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            slots = self._slots(keys[todo], level, len(bits))
            hit = bits[slots]
            out[todo[hit]] = ranks[slots[hit]]
            todo = todo[~hit]
        return out

    def packed(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<i8")
        return sizes.tobytes() + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def unpacked(cls, data: bytes) -> MinimalHash:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes, at, levels = np.frombuffer(data, "<i8", n, 8), 8 + 8 * n, []
        for size in sizes.tolist():
            held = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, held, at), count=size).astype(bool))
            at += held
        return cls(levels)


def _i64(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8")


def _shard(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.view(np.uint64)) >> np.uint64(40)).astype(np.int64) % SHARDS


def _by_shard(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of keys, shard by shard."""
    shard = _shard(keys)
    order = np.argsort(shard, kind="stable")
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(shard[order])) + 1, [len(order)]])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b > a:
            yield int(shard[order[a]]), order[a:b]


def _rows(names: list[str], types: list[pa.DataType], rows: list[tuple], at_once: int = 256) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), at_once):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows[a:a + at_once], strict=True), types, strict=True)], names=names)


_L, _I, _B, _S = pa.int64(), pa.int32(), pa.binary(), pa.string()
#: What the first pass knows of a document.
_SUMS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def _first_pass(path_a: str, path_b: str):
    """Documents to the rows of blocks: kind 0 has pairs with numbers of documents by shard; kind 1 a document's
    sums and its links: places among the block's pairs, in order (keys, as differences), and how often each."""
    columns = ["block", "kind", "shard", "keys", "counts", "doc_id", *_SUMS]
    types = [_L, _I, _I, _B, _B, _L, *[_L] * 4, _S]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, aligner = BlockNames(), aligner_of(path_a, path_b)
        docs, pairs, times, held = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            block = name()
            keys, of, counts = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            yield from _rows(columns, types, [(block, 0, shard, keys[some].tobytes(), counts[some].astype("<i8").tobytes(),
                                               None, *[None] * 5) for shard, some in _by_shard(keys)])
            sizes = np.array([len(x) for x in pairs], np.int64)
            starts, ends = (np.cumsum(sizes) - sizes).tolist(), np.cumsum(sizes).tolist()
            for at in range(0, len(docs), 256):
                yield from _rows(columns, types, [
                    (block, 1, None, np.diff(of[x:y], prepend=0).astype("<i4").tobytes(), n.astype("<i4").tobytes(), *doc)
                    for x, y, n, doc in zip(starts[at:at + 256], ends[at:at + 256], times[at:at + 256],
                                            docs[at:at + 256], strict=True)])

        for batch in batches:
            for a, b in _ranges(batch.column("text")):
                ids, texts = batch.column("doc_id")[a:b].to_pylist(), batch.column("text")[a:b].to_pylist()
                own: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in texts]
                sums, digests, void = np.zeros((b - a, 4), np.int64), [None] * (b - a), set()
                for places, some in _chunks(texts):
                    if len(aligner.index) > KNOWN:
                        aligner.prune()
                    aligner.learn(set().union(*some))
                    for i, parts in zip(places, some, strict=True):
                        at = list(map(aligner.index.__getitem__, parts))
                        text = ";".join([aligner.groups[x] for x in at])
                        at = np.array(at, np.int64)
                        aligner.used[at] += 1
                        if (aligner.n_a[at] < 0).any():
                            void.add(i)
                        links = np.sort(aligner.links(at)[0])
                        sums[i] += [aligner.n_a[at].sum(), aligner.n_b[at].sum(), aligner.n_groups[at].sum(), len(links)]
                        first = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]])[:len(links)])
                        own[i].append((links[first], np.diff(first, append=len(links))))
                        if digests[i] is None:
                            digests[i] = hashlib.sha256(text.encode())
                        else:
                            digests[i].update((";" + text).encode())
                for i, (doc, row, d) in enumerate(zip(ids, sums.tolist(), digests, strict=True)):
                    there = i not in void and d is not None
                    docs.append((doc, *row, d.hexdigest()) if there else (doc, 0, 0, 0, 0, ""))
                    keys, n = _added(own[i]) if there else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                    pairs.append(keys)
                    times.append(n)
                held += sum(len(t or "") + 100 for t in texts)
                if held >= BLOCK:
                    yield from flush()
                    docs, pairs, times, held = [], [], [], 0
        if docs:
            yield from flush()

    return run


def _added(slices: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Of a text's slices the distinct pairs, and how often they are linked in all."""
    if len(slices) == 1:
        return slices[0]
    keys, of = np.unique(np.concatenate([k for k, _ in slices]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, of, np.concatenate([n for _, n in slices]))
    return keys, sums


def _ranges(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about SLICE bytes each."""
    start = held = 0
    for i in range(len(texts)):
        held += texts[i].as_buffer().size if texts[i].is_valid else 0
        if held >= SLICE:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _unions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys to fewer, with each key of a shard once among about HELD keys."""
    held, n = {}, 0

    def flush() -> Iterator[pa.RecordBatch]:
        yield from _rows(["shard", "keys"], [_I, _B],
                         [(s, np.unique(np.concatenate(k)).tobytes()) for s, k in held.items()])

    for batch in batches:
        for shard, keys in zip(batch.column("shard").to_pylist(), batch.column("keys").to_pylist(), strict=True):
            held.setdefault(shard, []).append(_i64(keys))
            n += len(keys) // 8
            if n >= HELD:
                yield from flush()
                held, n = {}, 0
    if held:
        yield from flush()


def _groups(batches: Iterator[pa.RecordBatch], *by: str) -> Iterator[tuple[bool, dict]]:
    """Rows that come sorted by some columns, each with whether it is the first of its group."""
    now = None
    for batch in batches:
        for a in range(0, len(batch), 64):
            for row in batch.slice(a, 64).to_pylist():
                here = tuple(row[c] for c in by)
                yield here != now, row
                now = here


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by shard: each shard's minimal perfect hash, and its keys in the hash's order."""
    shard, keys, held = None, np.zeros(0, np.int64), []

    def made() -> Iterator[pa.RecordBatch]:
        every = np.unique(np.concatenate([keys, *held]))
        found = MinimalHash.of(every)
        ordered = np.empty_like(every)
        ordered[found(every)] = every
        yield from _rows(["shard", "hash", "keys"], [_I, _B, _B], [(shard, found.packed(), ordered.tobytes())])

    for first, row in _groups(batches, "shard"):
        if first:
            if shard is not None:
                yield from made()
            shard, keys, held = row["shard"], np.zeros(0, np.int64), []
        held.append(_i64(row["keys"]))
        if sum(map(len, held)) > HELD:
            keys, held = np.unique(np.concatenate([keys, *held])), []
    if shard is not None:
        yield from made()


def _found(table: MinimalHash, keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Indexes of pairs, whose stored keys are compared."""
    at = table(asked)
    if (at < 0).any() or (keys[at] != asked).any():
        raise ValueError("a pair is not in its shard's hash")
    return at


def _dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by (shard, branch, kind), a hash before its blocks' pairs: a dense vector of counts."""
    sums = None
    for first, row in _groups(batches, "shard", "branch"):
        if first:
            if sums is not None:
                yield from _rows(["shard", "counts"], [_I, _B], [(shard, sums.tobytes())])
            shard, table, keys = row["shard"], MinimalHash.unpacked(row["hash"]), _i64(row["keys"])
            sums = np.zeros(len(keys), "<i8")
        else:
            sums[_found(table, keys, _i64(row["keys"]))] += _i64(row["counts"])
    if sums is not None:
        yield from _rows(["shard", "counts"], [_I, _B], [(shard, sums.tobytes())])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by (shard, kind): each shard's hash and keys with the sum of its vectors."""
    now, sums = None, None
    for first, row in _groups(batches, "shard"):
        if first:
            if now is not None:
                yield from _rows(["shard", "hash", "keys", "counts"], [_I, _B, _B, _B], [(*now, sums.tobytes())])
            now, sums = (row["shard"], row["hash"], row["keys"]), np.zeros(len(row["keys"]) // 8, "<i8")
        else:
            sums += _i64(row["counts"])
    if now is not None:
        yield from _rows(["shard", "hash", "keys", "counts"], [_I, _B, _B, _B], [(*now, sums.tobytes())])


def _highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The highest count of each A id among the rows of a shard."""
    for _, row in _groups(batches, "shard"):
        a, counts = _i64(row["keys"]) >> 32, _i64(row["counts"])
        order = np.argsort(a, kind="stable")
        first = np.flatnonzero(np.diff(a[order], prepend=-1))
        yield pa.RecordBatch.from_arrays([pa.array(a[order][first]), pa.array(np.maximum.reduceat(counts[order], first))],
                                         names=["a", "most"])


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by (shard, branch, kind), a shard's counts before its blocks' pairs: the pairs' counts by block."""
    out = []
    for first, row in _groups(batches, "shard", "branch"):
        if first:
            table, keys, counts = MinimalHash.unpacked(row["hash"]), _i64(row["keys"]), _i64(row["counts"])
        else:
            out.append((row["block"], row["keys"], counts[_found(table, keys, _i64(row["keys"]))].tobytes()))
            if len(out) == 256:
                yield from _rows(["block", "keys", "counts"], [_L, _B, _B], out)
                out = []
    yield from _rows(["block", "keys", "counts"], [_L, _B, _B], out)


def _second_pass(most: np.ndarray):
    """Sorted by (block, kind), the pairs' counts before documents: each document's links with their counts."""
    names = ["doc_id", *_SUMS[:4], "n_best", "count_sum", _SUMS[4]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        counts, best = np.zeros(0, np.int64), np.zeros(0, bool)
        for _, first, part in by_block(batches):
            if first:
                held, counts, best = [], np.zeros(0, np.int64), np.zeros(0, bool)
            if part.column("kind")[0].as_py() == 0:
                held.extend(zip(part.column("keys").to_pylist(), part.column("counts").to_pylist(), strict=True))
                continue
            if held:
                keys, counts = _i64(b"".join(k for k, _ in held)), _i64(b"".join(c for _, c in held))
                order = np.argsort(keys)
                keys, counts, held = keys[order], counts[order], []
                best = counts == most[keys >> 32]
            n_best, total = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            for i, (places, times) in enumerate(zip(part.column("keys"), part.column("counts"), strict=True)):
                at, n = (np.frombuffer(x.as_buffer(), "<i4").astype(np.int64) for x in (places, times))
                at = np.cumsum(at)
                n_best[i], total[i] = n[best[at]].sum(), (n * counts[at]).sum()
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in names[:5]), pa.array(n_best), pa.array(total), part.column(names[-1])], names=names)

    return run


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their A id),
    count_sum (over links, of the documents that hold the pair linked), groups_sha256."""
    spark = docs.sparkSession
    none = {c: F.lit(None).cast(t) for c, t in (("hash", "binary"), ("counts", "binary"), ("block", "long"),
                                                ("keys", "binary"))}
    own = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    blocks = scratch.materialise(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            trimmed(_first_pass(path_a, path_b), encodes=True),
            f"block long, kind int, shard int, keys binary, counts binary, {own}"), "pair-blocks")
    pairs = blocks.filter("kind = 0").select("block", "shard", "keys", "counts",
                                             F.expr(f"cast(pmod(xxhash64(block), {BRANCHES}) as int)").alias("branch"))

    # Level by level: within tasks, by branch of a shard, by shard.
    unions = "shard int, keys binary"
    by_branch = (pairs.select("shard", "keys").mapInArrow(trimmed(_unions), unions)
                 .withColumn("branch", (F.rand(seed=13) * BRANCHES).cast("int"))
                 .repartition("shard", "branch").select("shard", "keys").mapInArrow(trimmed(_unions), unions))
    hashes = scratch.materialise(
        by_branch.repartition("shard").sortWithinPartitions("shard")
        .mapInArrow(trimmed(_hashes), "shard int, hash binary, keys binary"), "pair-hashes")

    branches = F.explode(F.sequence(F.lit(0), F.lit(BRANCHES - 1))).alias("branch")
    partial = (hashes.select("shard", branches, F.lit(0).alias("kind"), "hash", "keys", none["counts"].alias("counts"))
               .unionByName(pairs.select("shard", "branch", F.lit(1).alias("kind"), none["hash"].alias("hash"), "keys", "counts"))
               .repartition("shard", "branch").sortWithinPartitions("shard", "branch", "kind")
               .mapInArrow(trimmed(_dense), "shard int, counts binary"))
    totals = scratch.materialise(
        hashes.select("shard", F.lit(0).alias("kind"), "hash", "keys", none["counts"].alias("counts"))
        .unionByName(partial.select("shard", F.lit(1).alias("kind"), none["hash"].alias("hash"),
                                    none["keys"].alias("keys"), "counts"))
        .repartition("shard").sortWithinPartitions("shard", "kind")
        .mapInArrow(trimmed(_summed), "shard int, hash binary, keys binary, counts binary"), "pair-counts")

    highest = (totals.select("shard", "keys", "counts").mapInArrow(trimmed(_highest), "a long, most long")
               .groupBy("a").agg(F.max("most").alias("most")).collect())  # one row per A id at most
    most = np.zeros(max((r["a"] for r in highest), default=0) + 1, np.int64)
    for r in highest:
        most[r["a"]] = r["most"]

    back = (totals.select("shard", branches, F.lit(0).alias("kind"), none["block"].alias("block"), "hash", "keys", "counts")
            .unionByName(pairs.select("shard", "branch", F.lit(1).alias("kind"), "block", none["hash"].alias("hash"), "keys",
                                      none["counts"].alias("counts")))
            .repartition("shard", "branch").sortWithinPartitions("shard", "branch", "kind")
            .mapInArrow(trimmed(_looked_up), "block long, keys binary, counts binary"))
    both = (back.select("block", F.lit(0).alias("kind"), "keys", "counts")
            .unionByName(blocks.filter("kind = 1").select("block", "kind", "keys", "counts", "doc_id", *_SUMS),
                         allowMissingColumns=True))
    return (both.repartition("block").sortWithinPartitions("block", "kind")
            .mapInArrow(trimmed(_second_pass(most)),
                        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                        "groups_sha256 string"))
