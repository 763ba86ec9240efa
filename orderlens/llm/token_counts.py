"""Token counts of sections by offset-mapped attribution.

A document's fields are joined by a line feed and encoded whole, once.  Each
token spans bytes of that text; the spans are interval-joined to the
sections (lines, each with its line feed) by a merge of both sorted lists.  A token that
crosses a border goes by the rule asked for:

* ``first``: to the section of its first byte;
* ``last``: to the section of its last byte;
* ``most``: to the section with most of its bytes, of equal ones to the first;
* ``share``: to each section by the share of its bytes there.

So with any rule a document's counts add up to its tokens.

Defined results: a null field is empty; each field has one section at least, also an
empty one; a document of any length is encoded whole; repeated rows give repeated
results; an empty table gives an empty result; columns other than doc_id and the fields
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import encoder, in_turn
from .memory import trimmed

RULES = ("first", "last", "most", "share")

_SCHEMA = pa.schema([("doc_id", pa.int64()), ("field", pa.string()), ("section", pa.int32()),
                     ("start_char", pa.int64()), ("end_char", pa.int64()), ("n_tokens", pa.float64()),
                     ("n_crossing", pa.int64())])
_DDL = ("doc_id long, field string, section int, start_char long, end_char long, n_tokens double, "
        "n_crossing long")


def attribute(ends: np.ndarray, borders: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens by section, and how many of those that touch it cross a border of it.

    ends: where each token ends, in bytes; borders: where each section ends."""
    starts = np.concatenate([[0], ends])[:-1]
    n = len(borders)
    first = np.minimum(np.searchsorted(borders, starts, "right"), n - 1)
    last = np.minimum(np.searchsorted(borders, ends - 1, "right"), n - 1)
    inside = first == last
    crossing = np.zeros(n, np.int64)
    out = np.bincount(first[inside], minlength=n).astype(float)
    for i in np.flatnonzero(~inside):  # a token has few bytes, so it crosses few borders
        touched = np.arange(first[i], last[i] + 1)
        lows = np.maximum(np.concatenate([[0], borders[:-1]])[touched], starts[i])
        held = np.minimum(borders[touched], ends[i]) - lows
        crossing[touched[held > 0]] += 1
        if rule == "first":
            out[first[i]] += 1
        elif rule == "last":
            out[last[i]] += 1
        elif rule == "most":
            out[touched[np.argmax(held)]] += 1
        else:
            out[touched] += held / (ends[i] - starts[i])
    return out, crossing


def token_counts(docs: DataFrame, tokenizer: str, fields: tuple[str, ...] = ("text",),
                 rule: str = "first") -> DataFrame:
    """One row per document, field and section: doc_id, field, section (from 0), start_char,
    end_char (in its field), n_tokens, n_crossing."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    names = [f"f{i}" for i in range(len(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            values = [[v or "" for v in batch.column(c).to_pylist()] for c in names]
            wholes = ["\n".join(x) for x in zip(*values, strict=True)]
            ids = batch.column("doc_id").to_pylist()
            for a, b in in_turn(wholes):
                columns: list[list] = [[] for _ in _SCHEMA]
                for i, packed in zip(range(a, b), encode(wholes[a:b]), strict=True):
                    ends = np.cumsum(encode.lengths[np.frombuffer(packed, "<u4")])
                    labels, sections, lows, highs = [], [], [], []
                    for name, value in zip(fields, (v[i] for v in values), strict=True):
                        lines = value.split("\n")
                        size = np.array([len(x) + 1 for x in lines], np.int64)
                        size[-1] -= 1
                        high = np.cumsum(size)
                        labels += [name] * len(lines)
                        sections += range(len(lines))
                        lows += (high - size).tolist()
                        highs += high.tolist()
                    data = wholes[i].encode()
                    feeds = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
                    n, crossing = attribute(ends, np.append(feeds, max(len(data), 1)), rule)
                    for column, more in zip(columns, ([ids[i]] * len(labels), labels, sections, lows, highs,
                                                      n.tolist(), crossing.tolist()), strict=True):
                        column += more
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _SCHEMA.types, strict=True)], schema=_SCHEMA)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        *[F.col(f"`{f}`").cast("string").alias(n) for f, n in zip(fields, names, strict=True)])
            .mapInArrow(trimmed(run, encodes=True), _DDL))
