"""Language ID by nearest centroid.

A text is a TF-IDF vector of hashed letter trigrams (UTF-8 bytes in lower
case, all that is no letter read as one blank), sublinear in the counts and
normalised to length one.  For each language the vectors of a bounded,
hash-ordered sample of labelled rows are clustered by spherical k-means into several
centroids; document frequencies are counted over all labelled rows.  A text
gets the language of the centroid with the largest cosine.  Its distance to
it, one minus the cosine, decides on rejection.  Every fourth sample row makes no centroid: it
and pieces of it tell how far texts of that language and about as many different trigrams are
from its centroids, at most (of pieces a high quantile); farther by a margin is rejected.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and rejected; a null label or id never trains; a row's label and source are never
read for its prediction; texts of any length are read whole; equal cosines
go to the language first in the alphabet; an empty table gives an empty result; a training table
without usable rows raises; other columns are kept, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .memory import trimmed

UNDETERMINED = "und"
#: Dimensions that trigrams are hashed to.
DIMENSIONS = 8192
#: Rows of all languages together, at most, whose vectors the centroids are fitted to.
SAMPLE_ROWS = 1_600
#: Centroids of a language.
CENTROIDS = 3
#: Which part of the way from the largest distance of texts of its kind to one a distance may go; at LIMIT
#: all is rejected.  The largest of pieces is this quantile.
MARGIN, LIMIT, QUANTILE = 0.65, 0.95, 0.98
#: One sample row of so many is kept from the centroids; languages with fewer such rows than ALONE share their limits.
KEPT, ALONE = 4, 20
#: Languages that a model can hold.
LANGUAGES = 250

_LETTER = regex.compile(r"\p{L}")
_SLICE = 1 << 20


def _byte_map() -> np.ndarray:
    table = np.full(256, 32, np.uint32)
    for b in range(256):
        if b >= 128 or 97 <= b <= 122:
            table[b] = b
        elif 65 <= b <= 90:
            table[b] = b + 32
    return table


_BYTES = _byte_map()


def _slots(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The dimension of the trigram at each byte of ``data``, and whether it counts
    (not if it has two blanks in a row)."""
    b = _BYTES[np.frombuffer(data, np.uint8)]
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    blank = b == 32
    counts = ~((blank[:-2] & blank[1:-1]) | (blank[1:-1] & blank[2:]))
    return ((code * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64), counts


def counts(texts: list[str]) -> np.ndarray:
    """Trigram counts, a row for each text; memory is bounded by the number of texts."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    held: list[bytes] = []
    size, first = 0, 0

    def flush(last: int) -> None:
        if not held:
            return
        lengths = np.array([len(x) for x in held], np.int64)
        slot, good = _slots(b"".join(held))
        row = np.repeat(np.arange(len(held)), lengths)[:-2]
        ends = np.cumsum(lengths)
        pos = np.arange(len(row))
        good &= pos + 3 <= ends[row]  # no trigram across two texts
        flat = np.bincount(row[good] * DIMENSIONS + slot[good], minlength=len(held) * DIMENSIONS)
        out[first:last] += flat.reshape(len(held), DIMENSIONS)

    for i, text in enumerate(texts):
        data = b" " + text.lower().encode() + b" "
        if len(data) > _SLICE:  # a long text goes slice by slice
            flush(i)
            for at in range(0, len(data) - 2, _SLICE):
                slot, good = _slots(data[at:at + _SLICE + 2])
                out[i] += np.bincount(slot[good], minlength=DIMENSIONS)
            held, size, first = [], 0, i + 1
            continue
        held.append(data)
        size += len(data)
        if size > _SLICE:
            flush(i + 1)
            held, size, first = [], 0, i + 1
    flush(len(texts))
    return out


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors."""
    out = np.log1p(counts(texts)) * idf
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm == 0, 1, norm)


def _kinds(found: np.ndarray) -> np.ndarray:
    """The kind of each vector: half octaves of the number of different trigrams."""
    return (2 * np.log2(np.maximum((found > 0).sum(axis=1), 1))).astype(np.int64)


KINDS = int(2 * np.log2(DIMENSIONS)) + 1


def _pieces(text: str) -> list[str]:
    """A text, and pieces of it from its start and its middle."""
    sizes = [int(2 ** (k / 2)) for k in range(2, 2 * max(1, len(text)).bit_length()) if int(2 ** (k / 2)) < len(text)]
    return [text, *(text[:n] for n in sizes), *(text[len(text) // 2:][:n] for n in sizes if 2 * n < len(text))]


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    languages: tuple[str, ...]  # of each centroid
    centroids: np.ndarray
    reach: dict[str, np.ndarray]  # the largest distance that is not rejected, by the text's kind

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        known = [bool(t) and _LETTER.search(t) is not None for t in texts]
        found = vectors([t if k else "" for t, k in zip(texts, known, strict=True)], self.idf)
        kinds = _kinds(found)
        cosines = found @ self.centroids.T
        best = np.argmax(np.round(cosines, 6), axis=1)
        score = np.clip(np.round(cosines[np.arange(len(texts)), best].astype(float), 6), 0, 1)
        found = [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
        return (found, [float(s) if k else 0.0 for s, k in zip(score, known, strict=True)],
                [not k or bool(1 - s > self.reach[x][kind]) for x, s, k, kind in zip(found, score, known, kinds, strict=True)])


def _kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the row nearest the mean, then the farthest ones."""
    centres = [rows[np.argmax(rows @ rows.mean(axis=0))]]
    while len(centres) < min(k, len(rows)):
        centres.append(rows[np.argmin(np.max(rows @ np.array(centres).T, axis=1))])
    found = np.array(centres)
    for _ in range(rounds):
        own = np.argmax(rows @ found.T, axis=1)
        sums = np.array([rows[own == i].sum(axis=0) if (own == i).any() else found[i] for i in range(len(found))])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        found = sums / np.where(norm == 0, 1, norm)
    return found


def _each(texts: list[str], n: int = 256) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``n`` texts and about two million characters."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held > 2 * _SLICE or i + 1 - start == n:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def fit(labelled: DataFrame) -> Model:
    """A model of ``labelled``: rows with doc_id, text and lang."""
    rows = (labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
            .filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & has_letter()))
    languages = [r["lang"] for r in rows.select("lang").distinct().limit(LANGUAGES + 1).collect()]
    if not 0 < len(languages) <= LANGUAGES:
        raise ValueError(f"1 to {LANGUAGES} languages can be learned; there are {len(languages)}")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _each(texts):
                total += (counts(texts[a:b]) > 0).sum(axis=0)
            n += len(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, DIMENSIONS), pa.int32()), pa.array(np.concatenate([[n], total]))], names=["slot", "n"])

    # Bounded: a row for each dimension.
    df = {r["slot"]: r["n"] for r in rows.select("text").mapInArrow(trimmed(frequencies), "slot int, n long")
          .groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    idf = np.log((1 + df[-1]) / (1 + np.array([df[i] for i in range(DIMENSIONS)]))).astype(np.float32) + 1

    each = SAMPLE_ROWS // len(languages)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (rows.select("doc_id", "lang").withColumn("nth", F.row_number().over(order))
              .filter(F.col("nth") <= each).groupBy("doc_id").agg(F.min("nth").alias("nth")))
    fitted, kept = chosen.filter(F.col("nth") % KEPT != 0), chosen.filter(F.col("nth") % KEPT == 0)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _each(texts):
                found = vectors(texts[a:b], idf).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang")[a:b], batch.column("doc_id")[a:b], pa.array([v.tobytes() for v in found])],
                    names=["lang", "doc_id", "vector"])

    # Bounded: SAMPLE_ROWS ids, and as many vectors; repeated ids give no more rows than that.
    sample = (rows.join(F.broadcast(fitted), "doc_id").select("doc_id", "lang", "text")
              .mapInArrow(trimmed(sampled), "lang string, doc_id long, vector binary").limit(2 * SAMPLE_ROWS).collect())
    names, centroids = [], []
    for lang in sorted(languages):
        own = sorted((r["doc_id"], bytes(r["vector"])) for r in sample if r["lang"] == lang)
        if not own:
            continue
        matrix = np.array([np.frombuffer(v, np.float16) for _, v in own], np.float32)
        found = _kmeans(matrix, CENTROIDS)
        names += [lang] * len(found)
        centroids.append(found)
    model = Model(idf, tuple(names), np.concatenate(centroids).astype(np.float32), {})

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = model.centroids[[x == lang for x in model.languages]]
                texts = [t for t in _pieces(text) if _LETTER.search(t)]
                for a, b in _each(texts):
                    found = vectors(texts[a:b], idf)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * (b - a)), pa.array(_kinds(found)), pa.array([int(i == 0) for i in range(a, b)]),
                         pa.array((1 - (found @ own.T).max(axis=1)).astype(float))], names=["lang", "kind", "whole", "far"])

    # Bounded: a row for each language and kind.
    far = (rows.join(F.broadcast(kept), "doc_id").filter(F.col("lang").isin(sorted(set(names)))).select("lang", "text")
           .mapInArrow(trimmed(judged), "lang string, kind long, whole long, far double")
           .groupBy("lang", "kind").agg(
               F.greatest(F.max(F.when(F.col("whole") == 1, F.col("far"))),
                          F.percentile(F.when(F.col("whole") == 0, F.col("far")), F.lit(QUANTILE))).alias("far"),
               F.sum("whole").alias("n")).collect())
    return Model(idf, model.languages, model.centroids, _reach(
        sorted(set(names)), [(r["lang"], r["kind"], r["far"], r["n"]) for r in far]))


def _reach(languages: list[str], far: list[tuple[str, int, float, int]]) -> dict[str, np.ndarray]:
    """Limits by language and kind, of the largest distance and the whole texts of each.  A kind's limit
    is no smaller than that of longer texts; kinds shorter than all that were seen have LIMIT."""
    largest = {x: np.full(KINDS, -1.0) for x in languages}
    rows = dict.fromkeys(languages, 0)
    for lang, kind, distance, n in far:
        largest[lang][kind] = max(largest[lang][kind], distance)
        rows[lang] += n
    shared = np.max([*largest.values()], axis=0)
    reach = {}
    for lang in languages:
        own = largest[lang] if rows[lang] >= ALONE else shared
        seen = np.flatnonzero(own >= 0)
        limits = np.full(KINDS, LIMIT)
        if len(seen):
            limits = np.maximum.accumulate(own[::-1])[::-1]
            limits[seen[-1]:] = own[seen[-1]]
            limits = np.minimum(limits + MARGIN * (1 - limits), LIMIT)
            limits[:seen[0]] = LIMIT
        reach[lang] = limits
    return reach


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and rejected."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _each(texts):
                found, score, rejected = shared.value.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c)[a:b] for c in kept), pa.array(found), pa.array(score, pa.float64()),
                     pa.array(rejected)], names=[*kept, "lang_pred", "score", "rejected"])

    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = (StructType(list(rows.schema)).add("lang_pred", "string").add("score", "double")
              .add("rejected", "boolean"))
    return rows.mapInArrow(trimmed(run), schema)


def has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def held_out() -> Column:
    """Whether a row is outside the training rows: the CRC-32 of its id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
