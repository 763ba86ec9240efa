"""Lexical search, lattice scores and alignments against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import align, lattice_lm, lexical_rank, memory, queries, scratch

DOCS = "doc_id long, text string"
WORDS = ["the", "on", "Haus", "mañana", "été", "a", "ing", "tion", "x1", "über", "over", "lap", "日本", "zz-top"]


def corpus(n=120, seed=5):
    rnd = random.Random(seed)
    docs = []
    for i in range(n):
        words = [rnd.choice(WORDS) + rnd.choice(["", "", rnd.choice(WORDS)]) for _ in range(rnd.randint(0, 40))]
        docs.append((i, rnd.choice([" ", "  ", "\n", ", "]).join(words)))
    docs += [(n, None), (n + 1, ""), (n + 2, "!!! ..."), (3, "a repeated id the on"), (None, "the on a"),
             *((n + 10 + i, docs[0][1] + " the on a lap") for i in range(90))]
    return docs


# ---- lexical search

def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def ranked_by_hand(docs, items, k):
    found = [(d, Counter(plain_terms(t))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n_docs, total = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = {}
    for i, text in items:
        if i is not None:
            asked.setdefault(i, Counter()).update(plain_terms(text))
    out = set()
    for i, q in asked.items():
        scored = []
        for d, c in found:
            m = 75 + 25 * c.total() * n_docs // total
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, n in q.items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out |= {(i, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k])}
    return out


ITEMS = [(0, "the on Haus the"), (1, "MAÑANA x1 nowhere"), (2, None), (3, ""), (4, "zz"), (4, "top lap"), (None, "the"),
         (5, "nowhere at all"), (6, " ".join(WORDS) * 3)]


@pytest.mark.parametrize(("leaf", "docs_of_tree", "block"), [(64, 16_384, 16_384), (2, 64, 8), (3, 70, 1)])
def test_search_is_brute_force(spark, monkeypatch, leaf, docs_of_tree, block):
    monkeypatch.setattr(lexical_rank, "LEAF", leaf)
    monkeypatch.setattr(lexical_rank, "TREE_DOCS", docs_of_tree)
    monkeypatch.setattr(lexical_rank, "BLOCK_TERMS", block)
    docs = corpus()
    frame = spark.createDataFrame(docs, DOCS).withColumn("term", F.lit(1)).withColumn("n", F.lit("x"))
    got = lexical_rank.search(frame, spark.createDataFrame(ITEMS, "item_id long, text string"), k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == ranked_by_hand(docs, ITEMS, 7)


def test_tree_prunes_and_finds_the_best():
    rnd = np.random.default_rng(3)
    n, v = 2_000, 40
    rows = [np.unique(rnd.integers(0, v, rnd.integers(1, 12)) * rnd.integers(0, 2, 1)) for _ in range(n)]
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    term, tf = np.concatenate(rows), rnd.integers(1, 9, ptr[-1])
    m = rnd.integers(75, 400, n)
    tree = lexical_rank.Tree(term, tf, ptr, m, v)
    assert len(tree.low) > 10
    for asked in ([0, 3], [39], [5, 6, 7, 8]):
        dense = np.zeros(v, np.int64)
        dense[asked] = 1 + np.arange(len(asked))
        best = []
        tree.search(np.array(asked), dense[asked], dense, best, 20, lambda s, d: (-s, int(d)))
        plain = [(-int(sum(dense[t] * (10**9 * int(f) // (1000 * int(f) + 12 * int(m[i])))
                           for t, f in zip(term[ptr[i]:ptr[i + 1]], tf[ptr[i]:ptr[i + 1]], strict=True))), i) for i in range(n)]
        assert best == sorted(x for x in plain if x[0] < 0)[:20]


def test_terms_in_slices(monkeypatch):
    text = ("Ab c" * 40 + " " + "x" * 300 + " é9 ").encode() * 3
    whole = list(lexical_rank.terms(text))[0]
    monkeypatch.setattr(lexical_rank, "SLICE", 16)
    parts = list(lexical_rank.terms(text))
    assert len(parts) > 10 and [t for p in parts for t in p] == whole


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert lexical_rank.search(docs, items).count() == 0
    assert lexical_rank.search(docs, spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
    assert lexical_rank.search(spark.createDataFrame([(1, "a")], DOCS), items).count() == 0


# ---- lattice scores

def segmentations(word, shares):
    """The sum over all ways to cut, by recursion on the first piece."""
    if not word:
        return 1.0
    return sum(p * segmentations(word[len(s):], shares) for s, p in shares.items() if word.startswith(s))


def test_forward_sums_all_segmentations():
    shares = {bytes([c]): 0.01 for c in b" abcde"} | {b"ab": 0.2, b" a": 0.1, b"bcd": 0.05, b" abc": 0.07, b"aa": 0.3}
    pieces = sorted(shares)
    logs = np.log(np.array([[shares[p] for p in pieces], [1 / len(pieces)] * len(pieces)]))
    lattice = lattice_lm.Lattice(pieces, logs)
    words = [b"a", b"ab", b"abcde", b"aaaaaa", b"", b"edcba", b"abcabcab"]
    got = lattice.totals(words)
    for w, row in zip(words, got, strict=True):
        assert row[0] == pytest.approx(math.log(segmentations(b" " + w, shares)))
        assert row[1] == pytest.approx(math.log(segmentations(b" " + w, {p: 1 / len(pieces) for p in pieces})))
        assert lattice._long(w) == pytest.approx(row)
    # Expected counts: the derivative of the log sum by each log share.
    expected = lattice.expected(words, 0)
    for i, p in enumerate(pieces):
        eps = 1e-6
        more = dict(shares)
        more[p] *= math.exp(eps)
        slope = sum(math.log(segmentations(b" " + w, more) / segmentations(b" " + w, shares)) for w in words) / eps
        assert expected[i] == pytest.approx(slope, rel=1e-3, abs=1e-4)


def test_long_words_are_scored_whole(monkeypatch):
    pieces, first = lattice_lm.vocabulary(queries.PIECES)
    lattice = lattice_lm.Lattice(pieces, np.log(first)[None, :])
    words = [b"hello" * 9, b"x", "日本語".encode() * 20]
    whole = lattice.totals(words)
    monkeypatch.setattr(lattice_lm, "PART", 8)
    assert lattice.totals(words) == pytest.approx(whole)


def test_vocabulary_is_a_distribution():
    pieces, first = lattice_lm.vocabulary(queries.PIECES)
    assert len(pieces) == len(set(pieces)) and first.sum() == pytest.approx(1 - lattice_lm.END)
    assert {bytes([b]) for b in range(256) if not 65 <= b <= 90 and b not in b"\t\n\v\f\r"} <= set(pieces)


def scored_by_hand(rows, rounds):
    """The model in plain Python: counts by component, expectation maximisation on Lattice, products."""
    def tokens(text):
        return re.findall("[^ \t-\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    held = [zlib.crc32(str(d if d is not None else "").encode()) % 7 == 2 for d, _, _ in rows]
    langs = Counter(g for (_, _, g), h in zip(rows, held, strict=True) if not h and g is not None)
    names = [g for g, _ in sorted(langs.items(), key=lambda x: (-x[1], x[0]))]
    n = len(names) + 1
    counts, ends = [Counter() for _ in range(n)], [0] * n
    for (_, t, g), h in zip(rows, held, strict=True):
        if not h:
            k = names.index(g) if g in names else n - 1
            counts[k].update(tokens(t))
            ends[k] += 1
    every = sum(counts, Counter())
    total, n_end = every.total() + sum(ends), sum(ends)
    v = len(every) + (n_end > 0)
    pieces, first = lattice_lm.vocabulary(queries.PIECES)
    models = []
    for k in range(n):
        shares, end = first, lattice_lm.END
        for _ in range(rounds):
            got = lattice_lm.Lattice(pieces, np.log(shares)[None, :]).expected([w.encode() for w in counts[k]], 0) \
                if counts[k] else np.zeros(len(pieces))
            size = got.sum() + (ends[k] > 0) + lattice_lm.PRIOR
            shares, end = (got + lattice_lm.PRIOR * first) / size, ((ends[k] > 0) + lattice_lm.PRIOR * lattice_lm.END) / size
        models.append((lattice_lm.Lattice(pieces, np.log(shares)[None, :]), end, counts[k].total() + ends[k],
                       len(counts[k]) + (ends[k] > 0)))
    out = {}
    for (d, t, _), h in zip(rows, held, strict=True):
        words = tokens(t)
        base = sum(math.log10((every[w] + 1) / (total + v + 1)) for w in words) + math.log10((n_end + 1) / (total + v + 1))
        by = []
        for k, (lattice, end, n_tokens, distinct) in enumerate(models):
            mass = n_tokens / max(n_tokens + distinct, 1)
            s = math.log((ends[k] + 1) / (n_end + n)) + math.log(mass * ends[k] / max(n_tokens, 1) + (1 - mass) * end)
            lat = lattice.totals([w.encode() for w in words])[:, 0] if words else []
            s += sum(np.logaddexp(math.log(mass * counts[k][w] / n_tokens) if counts[k][w] else -math.inf,
                                  math.log(1 - mass) + x) for w, x in zip(words, lat, strict=True))
            by.append(s)
        score = (max(by) + math.log(sum(math.exp(b - max(by)) for b in by))) / math.log(10)
        out.setdefault((d, t), (h, len(words) + 1, sum(every[w] > 0 for w in words) + (n_end > 0), total, base, score))
    return out


def test_scores_are_the_models(spark, monkeypatch):
    monkeypatch.setattr(lattice_lm, "BLOCK", 3_000)
    rows = [(d, t, [None, "en", "fr"][i % 3]) for i, (d, t) in enumerate(corpus())]
    rows.append((777, "Wort\u00a0mit\x1cZeichen " + "q" * 9_000, "de"))
    frame = spark.createDataFrame(rows, DOCS + ", lang string").repartition(3).withColumn("place", F.lit(0))
    got = lattice_lm.scores(frame, queries.PIECES).collect()
    want = scored_by_hand(rows, lattice_lm.ROUNDS)
    texts = {}
    for d, t, _ in rows:
        texts.setdefault(d, []).append(t)
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(d) for d, _, _ in rows)
    for r in got:
        near = [w for t in texts[r["doc_id"]] if (w := want[r["doc_id"], t])[1] == r["n_tokens"]
                and abs(w[5] - r["score"]) < 1e-5 * (1 + abs(w[5]))]
        assert near, r
        assert tuple(r)[1:5] == near[0][:4] and r["base_score"] == pytest.approx(near[0][4])


def test_scores_beat_the_base_on_held_out_documents(spark):
    got = lattice_lm.scores(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), queries.PIECES)
    r = got.filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > r["b"]


def test_scores_without_training_rows_or_rows(spark):
    odd = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = lattice_lm.scores(spark.createDataFrame([(odd, "ab c", "en")], DOCS + ", lang string"), queries.PIECES).collect()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (True, 3, 0, 0, 0.0)
    assert math.isfinite(r["score"]) and r["score"] < 0
    assert lattice_lm.scores(spark.createDataFrame([], DOCS + ", lang string"), queries.PIECES).count() == 0


# ---- alignments

TEXTS = ["Hello, world", " two  blanks   here ", "tab\tand\n newline\n  x ", "été über 日本語 🙂🙂", "a▁b", "<s> </s> <|endoftext|> x",
         "", None, " ", "  ", "\n", "x" * 500, "don't  I'll \u00a0 b\u3000 c \x1c d", "a \x1c b", "\x00 \x00", "e\u0301 \u0301 x"]


def aligned_by_hand(rows):
    a_model, b_model = Tokenizer.from_file(queries.BPE_JSON), sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    a_model.encode_special_tokens = True
    of = align.byte_alphabet()
    def ends(parts):
        return np.cumsum([len(p) for p in parts]).tolist()
    found = []
    for d, t in rows:
        if not t:
            found.append((d, None))
            continue
        a, b = a_model.encode(" " + t, add_special_tokens=False).ids, b_model.encode(t)
        a_bytes = [bytes(of[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i)
                   else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        data = (" " + t).encode()
        if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            found.append((d, None))
            continue
        ea, eb = ends(a_bytes), ends(b_bytes)
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b))
                 if max(([0] + ea)[i], ([0] + eb)[j]) < min(ea[i], eb[j])]
        both = sorted(set(ea) & set(eb))
        groups, low = [], 0
        for e in both:
            groups.append(",".join(str(a[i]) for i in range(len(a)) if low < ea[i] <= e) + "|"
                          + ",".join(str(b[j]) for j in range(len(b)) if low < eb[j] <= e))
            low = e
        found.append((d, (len(a), len(b), len(groups), links, ";".join(groups))))
    count = Counter(p for _, x in found if x for p in set(x[3]))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(((d, 0, 0, 0, 0, 0, 0, "") if x is None else
                   (d, x[0], x[1], x[2], len(x[3]), sum(count[p] == best[p[0]] for p in x[3]), sum(count[p] for p in x[3]),
                    hashlib.sha256(x[4].encode()).hexdigest()) for d, x in found), key=str)


def test_parts_in_slices(monkeypatch):
    text = " ".join(t for t in TEXTS if t) * 3
    whole = list(align.slices(text))
    monkeypatch.setattr(align, "SLICE", 20)
    parts = list(align.slices(text))
    assert len(whole) == 1 and len(parts) > 10 and [p for s in parts for p in s] == whole[0]
    assert " ".join(whole[0]) == text


@pytest.mark.parametrize("block", [16 << 20, 500])
def test_alignments_are_the_libraries(spark, monkeypatch, block):
    monkeypatch.setattr(align, "BLOCK", block)
    rnd = random.Random(8)
    texts = TEXTS + ["".join(rnd.choice(["ab", " ", "  ", "é", "\n", " x", ".", "日", "\t", "ing", "0"]) for _ in range(rnd.randint(1, 60)))
                     for _ in range(60)] + [t for _, t in corpus(30)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, "a repeated id"), (None, "no id")]
    frame = spark.createDataFrame(rows, DOCS).repartition(3).withColumn("block", F.lit(1))
    got = sorted((tuple(r) for r in align.alignments(frame, queries.BPE_JSON, queries.PIECES).collect()), key=str)
    assert got == aligned_by_hand(rows)


def test_documents_are_aligned_once(monkeypatch):
    """The first pass leaves sums and places of links; no text goes on to be aligned again."""
    monkeypatch.setattr(align, "SLICE", 40)
    rows = [(7, " ".join(t for t in TEXTS if t and t.isascii()) * 2), (8, None), (None, "the lap the")]
    batch = pa.RecordBatch.from_pylist([{"doc_id": d, "text": t} for d, t in rows],
                                       pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
    out = [r for b in align._first_pass(queries.BPE_JSON, queries.PIECES)(iter([batch])) for r in b.to_pylist()]
    align.forget()
    docs = {r["doc_id"]: r for r in out if r["kind"] == 1}
    assert "text" not in out[0] and set(docs) == {7, 8, None} and len({r["block"] for r in out}) == 1
    keys = np.sort(np.concatenate([np.frombuffer(r["keys"], "<i8") for r in out if r["kind"] == 0]))
    for d, _, _, _, n_links, _, _, digest in aligned_by_hand(rows):
        places, times = (np.frombuffer(docs[d][c], "<i4") for c in ("keys", "counts"))
        assert (docs[d]["n_links"], docs[d]["groups_sha256"], times.sum()) == (n_links, digest, n_links)
        assert len(set(keys[np.cumsum(places)].tolist())) == len(places)


def test_tasks_that_do_not_align_drop_the_aligner():
    align.aligner_of(queries.BPE_JSON, queries.PIECES)
    assert list(memory.trimmed(lambda b: b, encodes=True)(iter([1]))) == [1] and align._made
    assert list(memory.trimmed(lambda b: b)(iter([1]))) == [1] and not align._made


def test_pruned_parts_stay_aligned(monkeypatch):
    monkeypatch.setattr(align, "KNOWN", 6)
    aligner = align.Aligner(queries.BPE_JSON, queries.PIECES)
    words = [f"w{i}" for i in range(20)] + ["a▁b", "über"]
    aligner.learn(set(words))
    want = {p: (aligner.n_a[i], aligner.n_groups[i], aligner.groups[i], aligner.links(np.array([i]))[0].tolist())
            for p, i in aligner.index.items()}
    aligner.used[[aligner.index[w] for w in ("w3", "über", "w7")]] = 5
    aligner.prune()
    assert set(aligner.index) == {"w3", "über", "w7"}
    aligner.learn(set(words))
    assert {p: (aligner.n_a[i], aligner.n_groups[i], aligner.groups[i], aligner.links(np.array([i]))[0].tolist())
            for p, i in aligner.index.items()} == want


def test_minimal_hash():
    rnd = np.random.default_rng(4)
    for n in (0, 1, 2, 1_000, 50_000):
        keys = np.unique(rnd.integers(0, 1 << 60, n))
        made = align.MinimalHash.of(keys)
        again = align.MinimalHash.unpacked(made.packed())
        assert sorted(made(keys).tolist()) == list(range(len(keys))) and made.size == len(keys)
        assert (again(keys) == made(keys)).all()
    with pytest.raises(ValueError):
        align._found(made, keys, np.array([-5]))


def test_alignment_of_an_empty_table(spark):
    assert align.alignments(spark.createDataFrame([], DOCS), queries.BPE_JSON, queries.PIECES).count() == 0


def test_scratch_is_shared(spark):
    assert scratch.root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
