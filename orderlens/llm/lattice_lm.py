"""Documents scored by a subword lattice that sums over all segmentations.

A text is its words, A-Z lower-cased, each behind one blank, and one end.  The pieces of an existing
vocabulary, with its scores, weigh every segmentation of a word; a word seen in training is one more
piece, spanning the whole word.  The scores of the vocabulary are ranks, so a score s first stands for a
probability in proportion to 1 / (``ZIPF`` - s); ``ROUNDS`` rounds of expectation maximisation over the
distinct training words refine it (each word once: what training saw often has a piece of its own).  A forward recursion in log space sums the segmentations.  Since no other piece
holds a blank, the lattice of a text falls into those of its words, and equal words are summed once.

The model has one component for each of the ``COMPONENTS`` commonest languages of training documents and
one for all other rows.  A component knows its words' counts c of N tokens with V distinct ones:

    p(word) = N / (N + V) * c / N + V / (N + V) * (sum over segmentations into vocabulary pieces)

and a document's probability is the sum over the components of their share of training documents times
their product over the document's tokens.  All these are probabilities; no language is used to score.

Plan: documents are dealt to blocks, each with the list of its distinct words (``blocks``).  An aggregate
over these words, which combines before its shuffle, gives the counts; each distinct word's probabilities are
computed once and go back to the blocks that hold it, there to be summed by document.  Only sums for
the pieces of the vocabulary (a fixed number) and for the components reach the driver.

Defined results: a null or empty text is the end alone; texts of any length are read whole, slice by
slice, and words longer than ``PART`` bytes are learned from in parts but scored whole; rows that
repeat a doc_id are documents of their own; a null doc_id counts as the empty text when training rows are
chosen; a null language is one of the others; without training rows the counts are zero and the vocabulary's scores
alone weigh; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch
from .blocks import BlockNames, by_block
from .memory import trimmed

#: Languages with a component of their own, at most; all others share one.
COMPONENTS = 15
#: Rounds of expectation maximisation.
ROUNDS = 2
#: Rank offset of Zipf's law, and the pseudo-counts that the vocabulary's scores stand for.
ZIPF, PRIOR = 2.7, 1_000.0
#: First share of the end among the pieces.
END = 1e-3
#: Bytes of text of a block, about, and bytes of a text that are split at a time.
BLOCK, SLICE = 16 << 20, 4 << 20
#: Words whose values a task packs at a time.
HELD = 1 << 20
#: Bytes of a word, and of words together, whose lattices are computed at a time.
PART, TOGETHER = 4_096, 1 << 17

_WHITE = b" \t\n\v\f\r"


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learned from: crc32 of the id as text is 2 modulo 7."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """The pieces that words can be made of and their first probabilities, which sum to 1 - END."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    rank: dict[bytes, float] = {}
    for i in range(size):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        name = model.id_to_piece(i)
        data = bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
        if data != data.lower() or any(w in data[1:] for w in _WHITE) or data[:1] in _WHITE[1:]:
            continue
        at = size if model.is_byte(i) else min(-model.get_score(i), size)
        rank[data] = min(at, rank.get(data, at))
    pieces = sorted(rank)
    weights = np.array([1 / (ZIPF + rank[p]) for p in pieces])
    return pieces, weights / weights.sum() * (1 - END)


class Lattice:
    """All segmentations into pieces; ``logs`` has the pieces' natural logarithms by component."""

    def __init__(self, pieces: list[bytes], logs: np.ndarray):
        import ahocorasick

        self.logs = logs
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.automaton = ahocorasick.Automaton()
        for i, p in enumerate(pieces):
            self.automaton.add_word(p.decode("latin-1"), i)
        self.automaton.make_automaton()

    def _edges(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Of words behind a blank each, all pieces found: piece, start, end; and of each word its
        first place and the place behind it, where word i has places of its own."""
        ends = np.cumsum([len(w) + 2 for w in words])
        found = self.automaton.iter("".join(" " + w.decode("latin-1") for w in words))
        at = np.fromiter(chain.from_iterable(found), np.int64).reshape(-1, 2)
        # Word i has one place more than bytes, so places are shifted by i.
        word = np.searchsorted(np.cumsum([len(w) + 1 for w in words]), at[:, 0], "right")
        end, piece = at[:, 0] + 1 + word, at[:, 1]
        return piece, end - self.sizes[piece], end, np.concatenate([[0], ends[:-1]]), ends - 1

    @staticmethod
    def _waves(place: np.ndarray, word: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Edges by the distance of ``place`` from their word's start, the least first: the edges, where
        each place's edges begin among them, and these places."""
        step = place - start[word]
        # Edges come by word, so a stable sort of the distances keeps the edges of a place together; short
        # integers are sorted by their digits.
        order = np.argsort(step.astype(np.int16) if len(step) and step.max() < 1 << 15 else step, kind="stable")
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(step[order])) + 1, [len(order)]])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            some = order[a:b]
            new = np.concatenate([[0], np.flatnonzero(np.diff(place[some])) + 1])
            yield some, new, place[some[new]]

    def forward(self, words: list[bytes], logs: np.ndarray | None = None) -> tuple[np.ndarray, tuple]:
        """Log sums of all segmentations up to every place, by component, and the edges."""
        logs = self.logs if logs is None else logs
        piece, start, end, first, last = edges = self._edges(words)
        word = np.searchsorted(last, end)
        sums = np.full((len(logs), int(last[-1]) + 1), -np.inf)
        sums[:, first] = 0
        for some, new, places in self._waves(end, word, first):
            sums[:, places] = np.logaddexp.reduceat(sums[:, start[some]] + logs[:, piece[some]], new, axis=1)
        return sums, edges

    def totals(self, words: list[bytes]) -> np.ndarray:
        """The log probability of each word, by component: shape (words, components)."""
        out = np.empty((len(words), len(self.logs)))
        for some in _together(words):
            if len(words[some[0]]) > PART:
                out[some[0]] = self._long(words[some[0]])
                continue
            sums, (*_, last) = self.forward([words[i] for i in some])
            out[some] = sums[:, last].T
        return out

    def _long(self, word: bytes) -> np.ndarray:
        """The forward recursion over a long word, which keeps only the places that a piece can reach back to."""
        reach = int(self.sizes.max())
        sums = np.full((reach + 1, len(self.logs)), -np.inf)
        sums[0] = 0
        at = 0  # the last place computed, in row at % (reach + 1)
        for end, piece in self.automaton.iter(" " + word.decode("latin-1")):
            while at < end + 1:
                at += 1
                sums[at % (reach + 1)] = -np.inf
            here = at % (reach + 1)
            np.logaddexp(sums[here], sums[(at - self.sizes[piece]) % (reach + 1)] + self.logs[:, piece], out=sums[here])
        return sums[at % (reach + 1)]

    def expected(self, words: list[bytes], component: int) -> np.ndarray:
        """How often each piece is expected in the segmentations of words."""
        logs = self.logs[component:component + 1]
        out = np.zeros(len(self.sizes))
        for some in _together(words):
            texts = [words[i] for i in some]
            sums, (piece, start, end, first, last) = self.forward(texts, logs)
            word = np.searchsorted(last, end)
            back = np.full(sums.shape[1], -np.inf)
            back[last] = 0
            # The same recursion from the ends: distances of starts from their word's end.
            for edge, new, places in self._waves(-start, word, -last):
                back[-places] = np.logaddexp.reduceat(back[end[edge]] + logs[0, piece[edge]], new)
            share = np.exp(sums[0, start] + logs[0, piece] + back[end] - sums[0, last][word])
            out += np.bincount(piece, share, minlength=len(out))
        return out


def _together(words: list[bytes]) -> Iterator[np.ndarray]:
    """Indexes of words of similar length, some hundred kilobytes at a time; a word over PART alone."""
    order = np.argsort(np.array([len(w) for w in words], np.int64), kind="stable")
    start = held = 0
    for at, i in enumerate(order.tolist()):
        if held and (held + len(words[i]) > TOGETHER or len(words[i]) > PART):
            yield order[start:at]
            start, held = at, 0
        held += len(words[i]) + 1
    if len(order):
        yield order[start:]


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a list for each slice."""
    at = 0
    while len(data) - at > SLICE:
        end = max(data.rfind(bytes([w]), at, at + SLICE) for w in _WHITE) + 1
        if end <= at:  # one endless word
            end = min((p for w in _WHITE if (p := data.find(bytes([w]), at + SLICE)) >= 0), default=len(data))
        yield data[at:end].lower().split()
        at = end
    yield data[at:].lower().split()


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(values.astype("<u4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<u4")


def _blocks_schema(n: int) -> str:
    return ("block long, kind int, place int, word string, " + "".join(f"c{k} long, " for k in range(n))
            + "doc_id long, held_out boolean, n_words long, places binary, counts binary")


def _blocked(n: int):
    """Documents to the rows of blocks: kind 0 has a block's words with their training counts by
    component, kind 1 its documents as places in the list of words with counts."""
    def flush(block: int, index: dict, docs: list) -> Iterator[pa.RecordBatch]:
        names = list(index)
        counts = []
        for k in range(n):
            own = [(p, c) for _, held, of, _, p, c in docs if of == k and not held]
            counts.append(np.bincount(np.concatenate([p for p, _ in own]), np.concatenate([c for _, c in own]),
                                      minlength=len(names)).astype(np.int64) if own else np.zeros(len(names), np.int64))
        for a in range(0, len(names), 10_000):
            some = pa.array(names[a:a + 10_000], pa.binary()).cast(pa.string())
            m = len(some)
            none = [pa.nulls(m, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, block)), pa.array(np.zeros(m, np.int32)),
                 pa.array(np.arange(a, a + m, dtype=np.int32)), some, *(pa.array(c[a:a + m]) for c in counts), *none],
                names=columns)
        for a in range(0, len(docs), 1_000):
            some = docs[a:a + 1_000]
            m = len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, block)), pa.array(np.ones(m, np.int32)), pa.nulls(m, pa.int32()),
                 pa.nulls(m, pa.string()), *(pa.nulls(m, pa.int64()) for _ in range(n)),
                 pa.array([d[0] for d in some], pa.int64()), pa.array([d[1] for d in some], pa.bool_()),
                 pa.array([d[3] for d in some], pa.int64()), pa.array([_packed(d[4]) for d in some], pa.binary()),
                 pa.array([_packed(d[5]) for d in some], pa.binary())], names=columns)

    columns = ["block", "kind", "place", "word", *(f"c{k}" for k in range(n)),
               "doc_id", "held_out", "n_words", "places", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = BlockNames()

        def fresh() -> defaultdict:
            found: defaultdict = defaultdict()
            found.default_factory = found.__len__
            return found

        index, docs, held = fresh(), [], 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, (doc, out, of) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "component")),
                                                   strict=True)):
                data = texts[i].as_py() or b""
                found: Counter = Counter()
                for some in _words(data):
                    found.update(some)
                places = np.fromiter(map(index.__getitem__, found), np.int64, len(found))
                counts = np.fromiter(found.values(), np.int64, len(found))
                order = np.argsort(places)
                docs.append((doc, out, of, int(counts.sum()), places[order].astype(np.int32), counts[order].astype(np.uint32)))
                held += len(data) + 100
                if held >= BLOCK:
                    yield from flush(name(), index, docs)
                    index, docs, held = fresh(), [], 0
        if docs:
            yield from flush(name(), index, docs)

    return run


def _expectations(pieces: list[bytes], logs: np.ndarray):
    """Training words to the expected counts of pieces by component, one row for each piece that a task met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, logs)
        sums = np.zeros(logs.shape)
        for batch in batches:
            words = batch.column("word").cast(pa.binary()).to_pylist()
            for k in range(len(logs)):
                counts = batch.column(f"c{k}").to_numpy()
                some = []
                for i in np.flatnonzero(counts).tolist():
                    parts = [words[i][a:a + PART] for a in range(0, len(words[i]), PART)]
                    some.extend(parts)
                if some:
                    sums[k] += lattice.expected(some, k)
        of, piece = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(of.astype(np.int32)), pa.array(piece.astype(np.int32)),
                                          pa.array(sums[of, piece])], names=["component", "piece", "n"])

    return run


def _scored(pieces: list[bytes], logs: np.ndarray, tokens: np.ndarray, distinct: np.ndarray):
    """Words to their training count and their log probabilities by component, packed."""
    whole = tokens / np.maximum(tokens + distinct, 1)
    # A component without tokens has the lattice alone.
    with np.errstate(divide="ignore"):
        known, parts = np.log(whole / np.maximum(tokens, 1)), np.log1p(-whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, n = Lattice(pieces, logs), len(logs)
        for batch in batches:
            words = batch.column("word").cast(pa.binary()).to_pylist()
            counts = np.stack([batch.column(f"c{k}").to_numpy() for k in range(n)], axis=1)
            with np.errstate(divide="ignore"):
                found = np.logaddexp(np.log(counts) + known, lattice.totals(words) + parts).astype("<f4")
            offsets = pa.py_buffer((np.arange(len(words) + 1) * 4 * n).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(counts.sum(axis=1)),
                 pa.BinaryArray.from_buffers(pa.binary(), len(words), [None, offsets, pa.py_buffer(found.tobytes())])],
                names=["word", "c", "logs"])

    return run


def _packed_back(n: int):
    """Words' values to rows with the values of many words of a block: places, counts and log probabilities, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            block, place, c, logs = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((place, block))
            block, place, c, logs = block[order], place[order].astype("<i4"), c[order].astype("<i8"), logs[order]
            ends = [*(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            parts = list(zip([0, *ends], ends, strict=False))
            for at in range(0, len(parts), 256):
                some = parts[at:at + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[[a for a, _ in some]]),
                     *(pa.array([x[a:b].tobytes() for a, b in some], pa.binary()) for x in (place, c, logs))],
                    names=["block", "place", "c", "logs"])

        for batch in batches:
            held.append((batch.column("block").to_numpy(), batch.column("place").to_numpy(), batch.column("c").to_numpy(),
                         np.frombuffer(b"".join(batch.column("logs").to_pylist()), "<f4").reshape(-1, n)))
            size += len(batch)
            if size >= HELD:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return run


def _summed(shares: np.ndarray, ends: np.ndarray, n_end: int, total: int, distinct: int):
    """Rows by block, words first, to one row per document."""
    n = len(shares)
    floor = math.log10(total + distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        logs = counts = None
        for _, first, part in by_block(batches):
            if first:
                parts, logs, counts = [], np.zeros((0, n)), np.zeros(0, np.int64)
            if part.column("kind")[0].as_py() == 0:
                parts.extend(zip(*(part.column(c).to_pylist() for c in ("place", "c", "logs")), strict=True))
                continue
            if parts:
                place, c, found = (np.frombuffer(b"".join(x), t)
                                   for x, t in zip(zip(*parts, strict=True), ("<i4", "<i8", "<f4"), strict=True))
                logs, counts = np.empty((len(place), n)), np.empty(len(place), np.int64)
                counts[place], logs[place] = c, found.reshape(-1, n)
                parts = []
            gain = np.log10(counts + 1)
            known, base, score = [], [], []
            for where, often in zip(part.column("places").to_pylist(), part.column("counts").to_pylist(), strict=True):
                where, often = _unpacked(where), _unpacked(often).astype(np.int64)
                size = int(often.sum()) + 1
                known.append(int(often[counts[where] > 0].sum()) + (n_end > 0))
                base.append(float((gain[where] * often).sum()) + math.log10(n_end + 1) - size * floor)
                by = shares + ends + often @ logs[where]
                most = by.max()
                score.append((most + math.log(np.exp(by - most).sum())) / math.log(10))
            m = len(part)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(part.column("n_words").to_numpy() + 1),
                 pa.array(known, pa.int64()), pa.array(np.full(m, total)), pa.array(base, pa.float64()),
                 pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def scores(docs: DataFrame, path: str, label: str = "lang") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (words with one added to each
    count), score (the lattice's log10 probability)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       held_out().alias("held_out"), F.col(label).cast("string").alias("label"))
    common = (rows.filter("NOT held_out AND label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "label").limit(COMPONENTS).collect())
    names, n = [r["label"] for r in common], len(common) + 1
    component = F.lit(n - 1)
    for k, name in enumerate(names):
        component = F.when(F.col("label").eqNullSafe(F.lit(name)), F.lit(k)).otherwise(component)
    placed = rows.withColumn("component", component.cast("int"))
    blocks = scratch.materialise(placed.select("doc_id", "text", "held_out", "component")
                                 .mapInArrow(trimmed(_blocked(n)), _blocks_schema(n)), "word-blocks")

    words = blocks.filter("kind = 0").select("block", "place", "word", *(f"c{k}" for k in range(n)))
    totals = scratch.materialise(
        words.groupBy("word").agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(n))), "word-counts")
    ends = [0] * n
    for r in placed.filter("NOT held_out").groupBy("component").agg(F.count(F.lit(1)).alias("n")).collect():
        ends[r["component"]] = r["n"]
    any_count = " + ".join(f"c{k}" for k in range(n))
    sums = totals.agg(*(F.sum(f"c{k}").alias(f"n{k}") for k in range(n)),
                      *(F.count_if(F.col(f"c{k}") > 0).alias(f"v{k}") for k in range(n)),
                      F.count_if(F.expr(f"{any_count} > 0")).alias("v")).first()
    n_ends = np.array(ends, np.float64)
    tokens = np.array([sums[f"n{k}"] or 0 for k in range(n)]) + n_ends
    distinct = np.array([sums[f"v{k}"] for k in range(n)]) + (n_ends > 0)

    pieces, first = vocabulary(path)
    shares, end = np.tile(first, (n, 1)), np.full(n, END)
    trained = totals.filter(f"{any_count} > 0")
    for _ in range(ROUNDS):
        found = (trained.mapInArrow(trimmed(_expectations(pieces, np.log(shares))), "component int, piece int, n double")
                 .groupBy("component", "piece").agg(F.sum("n").alias("n")).collect())  # pieces x components at most
        expected = np.zeros(shares.shape)
        for r in found:
            expected[r["component"], r["piece"]] = r["n"]
        size = expected.sum(axis=1) + (n_ends > 0) + PRIOR
        shares, end = (expected + PRIOR * first) / size[:, None], ((n_ends > 0) + PRIOR * END) / size

    scored = scratch.materialise(
        totals.mapInArrow(trimmed(_scored(pieces, np.log(shares), tokens, distinct)), "word string, c long, logs binary"),
        "word-scores")
    back = (words.select("block", "place", "word").join(scored, "word").select("block", "place", "c", "logs")
            .mapInArrow(trimmed(_packed_back(n)), "block long, place binary, c binary, logs binary")
            .select("block", F.lit(0).alias("kind"), "place", "c", "logs", F.lit(None).cast("long").alias("doc_id"),
                    F.lit(None).cast("boolean").alias("held_out"), F.lit(None).cast("long").alias("n_words"),
                    F.lit(None).cast("binary").alias("places"), F.lit(None).cast("binary").alias("counts")))
    none = F.lit(None).cast("binary")
    own = blocks.filter("kind = 1").select("block", "kind", none.alias("place"), none.alias("c"), none.alias("logs"),
                                           "doc_id", "held_out", "n_words", "places", "counts")
    whole = tokens / np.maximum(tokens + distinct, 1)
    ending = np.log(whole * n_ends / np.maximum(tokens, 1) + (1 - whole) * end)
    run = _summed(np.log((n_ends + 1) / (n_ends + 1).sum()), ending, int(n_ends.sum()), int(tokens.sum()),
                  int(sums["v"]) + int(n_ends.sum() > 0))
    return (back.unionByName(own).repartition("block").sortWithinPartitions("block", "kind")
            .mapInArrow(trimmed(run), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                      "base_score double, score double"))
