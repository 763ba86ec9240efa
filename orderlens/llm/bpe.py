"""Byte-level BPE by backtracking over longest matches.

Bytes are mapped to Latin-1 characters, so an Aho-Corasick automaton over the
vocabulary yields, in one pass over a piece, the longest token that starts at
each byte.  A sequence of tokens is the one that merging by rank produces
exactly if each two neighbours are compatible, that is, no merge joins bytes
across their border.  Encoding therefore goes left to right with the
longest match, takes the next shorter token where neighbours are not compatible,
and steps back from positions where no token fits; positions that failed
are marked, so each is left once at most.  Compatibility is memoised.

Two tokens are compatible if no node ``x`` on the right edge of the first one's
merge tree and ``y`` on the left edge of the second one's form a token that
ranks before the merges that consume ``x`` and ``y``.

Defined results: a null text is empty and has no id; lone surrogates cannot
occur in Spark strings; texts of any length are encoded whole, piece by piece;
repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import PieceCache, in_turn

#: Remembered pairs of neighbours of a worker.
MEMO_PAIRS = 1_000_000
_NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Bpe(PieceCache):
    """Encodes and decodes by ranks."""

    def __init__(self, path: str):
        import ahocorasick

        super().__init__()
        self.ranks = read_ranks(path)
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.decimal = [str(i) for i in range(len(self.bytes))]
        self.shorter_of: dict[int, int] = {}
        self.parts_of: dict[int, tuple[int, int] | None] = {}
        self.edges: dict[tuple[int, int], list[tuple[bytes, int]]] = {}
        self.memo: dict[tuple[int, int], bool] = {}

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix; -1 if there is none."""
        if (found := self.shorter_of.get(token)) is None:
            data = self.bytes[token]
            found = next((self.ranks[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in self.ranks), -1)
            self.shorter_of[token] = found
        return found

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte."""
        if token not in self.parts_of:
            data, self.parts_of[token] = self.bytes[token], None
            for n in range(1, len(data)):
                a, b = self.ranks.get(data[:n], _NEVER), self.ranks.get(data[n:], _NEVER)
                if a < token and b < token and self.compatible(a, b, token):
                    self.parts_of[token] = (a, b)
                    break
        return self.parts_of[token]

    def edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The nodes on the left (0) or right (1) edge of a token's merge tree, each with
        the rank of the merge that consumes it."""
        if (found := self.edges.get((token, side))) is None:
            found, consumed = [], _NEVER
            node: int | None = token
            while node is not None:
                found.append((self.bytes[node], consumed))
                consumed, below = node, self.parts(node)
                node = below[side] if below else None
            self.edges[token, side] = found
        return found

    def compatible(self, a: int, b: int, below: int = _NEVER) -> bool:
        """Whether merges of a rank under ``below`` leave the border between a and b."""
        key = (a, b)
        if below == _NEVER and (known := self.memo.get(key)) is not None:
            return known
        get, left = self.ranks.get, self.edge(b, 0)
        fits = True
        for x, x_consumed in self.edge(a, 1):
            for y, y_consumed in left:
                rank = get(x + y, _NEVER)
                # Of equal merges the left one comes first: x's own before the border's, the border's before y's.
                if rank < below and rank < x_consumed and rank <= y_consumed:
                    fits = False
        if below == _NEVER:
            if len(self.memo) > MEMO_PAIRS:
                self.memo.clear()
            self.memo[key] = fits
        return fits

    def ids(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        size = len(piece)
        longest, reach = [-1] * size, [0] * size
        for last, (n, rank) in self.automaton.iter(piece.decode("latin-1")):
            start = last - n + 1
            if n > reach[start]:
                reach[start], longest[start] = n, rank
        out: list[int] = []
        dead = bytearray(size + 1)
        lengths, at, token = self.bytes, 0, longest[0]
        while True:
            end = at + len(lengths[token])
            if not dead[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                if end == size:
                    return out
                at, token = end, longest[end]
                continue
            token = self.shorter(token)
            if token < 0:
                dead[at] = 1
                token = out.pop()
                at -= len(lengths[token])

    def encode_words(self, words: list[str]) -> list[bytes]:
        (feed,) = self.encode_pieces(["\n"])
        return [feed + x if w[0] == "\n" else x
                for w, x in zip(words, self.encode_pieces([w.lstrip("\n") for w in words]), strict=True)]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        return [np.array(self.ids(p.encode()), "<u4").tobytes() for p in pieces]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_made: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    """This worker's encoder."""
    if path not in _made:
        _made[path] = Bpe(path)
    return _made[path]


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id, ids of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .token_files import id_lists

        codec = bpe(ranks)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in in_turn(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], id_lists(codec(texts[a:b]))], names=["doc_id", "ids"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, ids array<int>"))


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id, data (the bytes) of lists of ids; a null list has no byte."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe(ranks)
        for batch in batches:
            data = [codec.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())],
                                             names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, then decode what was encoded, in one pass."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe(ranks)
        name = codec.decimal.__getitem__
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in in_turn(texts):
                sizes, listed, back = [], [], []
                for packed in codec(texts[a:b]):
                    ids = np.frombuffer(packed, "<u4").tolist()
                    sizes.append(len(ids))
                    listed.append(hashlib.sha256(" ".join(map(name, ids)).encode()).hexdigest())
                    back.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], pa.array(sizes, pa.int64()), pa.array(listed), pa.array(back)],
                    schema=schema)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
