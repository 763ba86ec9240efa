"""Encoding, BPE, token files, packing and token counts against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import bpe, encode, packing, queries, scratch, token_counts, token_files

JSON, RANKS = queries.BPE_JSON, queries.BPE_RANKS
DOCS = "doc_id long, text string"

ODD = ["", " ", "   ", "  a  b\n c ", "\n\n x", "aaaaaaaaaaaa" * 300, "日本語テキスト🙂🙂 don't I'll  x ",
       "a\x1cb \x1c c d e　f", "'s's  's ", "\x00\x00 \x00", "====" * 500 + "  ", "x " * 5 + " ",
       "!" * 3000, "abcabcabd" * 100, "Word. Word, word's WORD.\nNext", "<|endoftext|> x <|endoftext|>"]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(1)
    out = list(ODD)
    for _ in range(300):
        out.append("".join(rnd.choice("ab e'\n.,1é日 \t") for _ in range(rnd.randint(0, 60))))
        out.append("".join(rnd.choice(["the", "ing", "tion", " ", "re", "er", "a", "==", "0", "ß", "  "])
                           for _ in range(rnd.randint(0, 60))))
    return out


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False)


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_piecewise_encoding_is_the_librarys(texts, reference):
    got = encode.Encoder(JSON)(texts)
    assert [ids_of(x) for x in got] == [reference(t).ids for t in texts]


def test_long_texts_go_slice_by_slice(texts, reference, monkeypatch):
    monkeypatch.setattr(encode, "SLICE", 40)
    long = " ".join(texts) + "y" * 500
    assert "".join(encode.slices(long)) == long and len(list(encode.slices(long))) > 10
    got = encode.Encoder(JSON)([long, "a short one", "x" * 300])
    assert [ids_of(x) for x in got] == [reference(t).ids for t in (long, "a short one", "x" * 300)]


def test_encoding_with_a_tiny_cache(texts, reference, monkeypatch):
    monkeypatch.setattr(encode, "CACHE_PARTS", 3)
    e = encode.Encoder(JSON)
    for _ in range(2):
        for t in texts[:60]:
            assert ids_of(e([t])[0]) == reference(t).ids


def test_plain_words_make_no_objects(reference, monkeypatch):
    rnd = random.Random(5)
    made = [" ".join("".join(rnd.choice("abcdeéßÀÿ") for _ in range(rnd.randint(1, 9))) for _ in range(200)) for _ in range(20)]
    made += ["a × b ÷ c ×d ÷é", " é\u0301a ñ\u00a0x", "é è", "\u00c3\u0097 Ã× ã·"]
    e = encode.Encoder(JSON)
    for cache in (encode.CACHE_PARTS, 30):
        monkeypatch.setattr(encode, "CACHE_PARTS", cache)
        for _ in range(2):
            for a in range(0, len(made), 3):
                assert [ids_of(x) for x in e(made[a:a + 3])] == [reference(t).ids for t in made[a:a + 3]]
    e = encode.Encoder(JSON)
    e(made[:1])
    assert len(e.known) <= 1  # the first word, which has no blank


def test_plain_words_are_spelled_for_the_model(reference):
    """They pass no byte-level step: no word of Latin-1 letters reaches the whole tokenizer."""
    letters = [chr(i) for i in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)] if i not in (0xD7, 0xF7)]
    rnd = random.Random(8)
    words = [" " + "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 12))) for _ in range(3000)] + [" " + x for x in letters]
    e = encode.Encoder(JSON)
    whole, seen = e.tokenizer, []

    class Seen:
        def encode_batch_fast(self, batch, **options):
            seen.extend(batch)
            return whole.encode_batch_fast(batch, **options)

    e.tokenizer = Seen()
    assert ids_of(e(["".join(words)])[0]) == reference("".join(words)).ids and not seen
    e.tokenizer = whole
    assert [ids_of(x) for x in e(words + ["1" + w for w in words[::9]])] == [
        reference(w).ids for w in words + ["1" + w for w in words[::9]]]


def test_same_finds_one_of_each_key():
    rnd = np.random.default_rng(3)
    for n, kinds in ((1, 1), (500, 7), (500, 1 << 62)):
        keys = rnd.integers(0, kinds, n).astype(np.uint64) << np.uint64(1)
        distinct, where, of = encode._same(keys)
        assert (distinct == np.unique(keys)).all() and (keys[where] == distinct).all() and (distinct[of] == keys).all()


def test_words_with_one_hash_are_told_apart(reference, monkeypatch):
    real = encode._hashes
    monkeypatch.setattr(encode, "_hashes", lambda *a: real(*a) % np.uint64(61))
    made = [f"x {w}" for w in "one two three four five six seven eight nine ten eleven twelve a b c d e f g h".split()]
    e = encode.Encoder(JSON)
    for _ in range(2):
        for t in made * 3:
            assert ids_of(e([t])[0]) == reference(t).ids
    assert (np.diff(e.plain.keys.astype(np.int64)) > 0).all()


def test_bpe_is_tiktokens(texts):
    codec = bpe.Bpe(RANKS)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    for text, packed in zip(texts, codec(texts), strict=True):
        ids = ids_of(packed)
        assert ids == enc.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_bpe_backtracks_on_a_vocabulary_without_the_greedy_answer(tmp_path):
    import base64

    # Longest match takes "abc" first, which leaves "d"; merging makes "ab" + "cd".
    tokens = [bytes([b]) for b in range(256)] + [b"cd", b"ab", b"abc"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)) + b"\n")
    codec = bpe.Bpe(str(path))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rnd = random.Random(2)
    for _ in range(500):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 12)))
        assert codec.ids(word.encode()) == enc.encode_ordinary(word)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, part string, row int, rank int, ids string, part_a int")


def with_extra(rows):
    return [(i, t, "x", 1, 2, "y", 3) for i, t in rows]


ROWS = [(5, "some text here"), (1, None), (2, ""), (7, "x " * 3000), (7, "x " * 3000), (7, "other"), (None, "no id"),
        (3, "A short one. " * 20)]


def test_digests_of_bpe(spark, texts):
    rows = list(enumerate(texts)) + [(None, None)]
    got = bpe.digests(frame(spark, with_extra(rows)), RANKS).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[None].n_tokens == 0
    assert all(by[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(texts))
    ids = bpe.encode(frame(spark, with_extra(rows)), RANKS)
    back = {r.doc_id: bytes(r.data) for r in bpe.decode(ids, RANKS).collect()}
    assert back[None] == b"" and all(back[i] == t.encode() for i, t in enumerate(texts))


def test_token_files_round_trip(spark, reference):
    path = scratch.new_path(spark, "t")
    token_files.write_tokens(frame(spark, with_extra(ROWS)), path, JSON)
    got = token_files.read_documents(spark, path).orderBy("start").collect()
    ids = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in ids]
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids)
        start += r.n_tokens
    want = sorted([*reference(t or "").ids, 0] for _, t in ROWS)
    assert sorted(list(r.ids) for r in got) == want
    sums = token_files.checksums(token_files.read_documents(spark, path)).collect()
    assert sorted(r.ids_crc32 for r in sums) == sorted(zlib.crc32(np.array(x, "<u4").tobytes()) for x in want)
    # selective reads
    some = token_files.read_documents(spark, path, doc_ids=[3, 5])
    assert sorted(r.doc_id for r in some.collect()) == [3, 5]
    assert {r.start for r in some.collect()} <= {r.start for r in got}
    first = got[2]
    # Any range gives the documents that touch it, and the scan of the ids gets it as pushed filters.
    every = token_files.read_metadata(spark, path).collect()
    total = max(r.start + r.n_tokens for r in every)
    for a, b in ((0, 1), (total - 1, total), (total // 3, total // 2), (0, total), (total, total + 5), (5, 5)):
        ranged = token_files.read_documents(spark, path, token_range=(a, b))
        assert sorted((r.start, len(r.ids)) for r in ranged.collect()) == sorted(
            (r.start, r.n_tokens) for r in every if r.start < b and r.start + r.n_tokens > a)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = token_files.read_documents(spark, path, token_range=(total // 3, total // 2))._jdf.queryExecution().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "ids#" in x and "PushedFilters" in x)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(part," in scan and "LessThan(part_start," in scan
    part = token_files.read_documents(spark, path, token_range=(first.start, first.start + 1)).collect()
    assert first.start in {r.start for r in part} and len(part) == 1
    meta = token_files.read_metadata(spark, path)
    assert "ids" not in meta.columns and meta.count() == len(ROWS)


def test_token_files_of_an_empty_table(spark):
    path = scratch.new_path(spark, "t")
    token_files.write_tokens(frame(spark, []), path, JSON)
    assert token_files.read_documents(spark, path).count() == 0


def bins_by_hand(sizes, window):
    """Best-fit decreasing, one piece at a time."""
    left = []
    for s in sorted(sizes, reverse=True):
        fits = [(r, i) for i, r in enumerate(left) if r >= s]
        if fits:
            left[min(fits)[1]] -= s
        else:
            left.append(window - s)
    return left


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    window = rnd.choice([8, 16, 100])
    sizes = [rnd.randint(1, window - 1) for _ in range(rnd.randint(1, 300))]
    rows, windows = packing.plan({s: sizes.count(s) for s in set(sizes)}, window)
    used = {}
    for size, rank, n, first, offset, each in rows.tolist():
        for j in range(n):
            used.setdefault(first + j // each, []).append((offset + j % each * size, size))
    for own in used.values():  # gapless and within the window
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= window
    assert sorted(window - sum(s for _, s in x) for x in used.values()) == sorted(bins_by_hand(sizes, window))
    assert len(used) == windows
    for s in set(sizes):  # each rank once
        ranks = sorted(r for size, rank, n, *_ in rows.tolist() if size == s for r in range(rank, rank + n))
        assert ranks == list(range(sizes.count(s)))


def test_packing_places_each_id_once(spark, reference):
    got = packing.pack(frame(spark, with_extra(ROWS)), JSON, window=64).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    want = sorted((i, len(reference(t or "").ids) + 1) for i, t in ROWS if i is not None)
    assert sum(r.length for r in got) == sum(n for _, n in want) + len(reference("no id").ids) + 1
    pieces = sorted((r.start, r.length, r.ids_crc32) for r in got if r.doc_id == 3)
    ids = np.array([*reference(dict(ROWS)[3]).ids, 0], "<u4")
    assert pieces == [(a, len(ids[a:a + 64]), zlib.crc32(ids[a:a + 64].tobytes())) for a in range(0, len(ids), 64)]
    whole = packing.sequences(frame(spark, with_extra(ROWS)), JSON, window=64).collect()
    assert sum(r.n_tokens for r in whole) == sum(r.length for r in got)
    assert all(len(r.input_ids) == 64 or len(r.input_ids) & (len(r.input_ids) - 1) == 0 for r in whole)
    assert packing.pack(frame(spark, []), JSON).count() == 0
    assert packing.sequences(frame(spark, []), JSON).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, reference, rule):
    rows = [(1, "first line\nsecond, longer line\n", "t"), (2, None, None), (3, "a\n\n\nb \n c" * 40, "é🙂\nx"),
            (3, "a", "b"), (None, "q", "q"), (4, "🙂\n🙂" * 30, "")]
    docs = spark.createDataFrame(rows, "doc_id long, body string, `ti tle` string")
    got = token_counts.token_counts(docs, JSON, fields=("ti tle", "body"), rule=rule).collect()
    totals = sorted(len(reference(f"{t or ''}\n{b or ''}").ids) for _, b, t in rows)
    assert abs(sum(r.n_tokens for r in got) - sum(totals)) < 1e-6
    four = [r for r in got if r.doc_id == 1]
    assert [(r.field, r.section, r.start_char, r.end_char) for r in sorted(four, key=lambda r: (r.field != "ti tle", r.section))] == [
        ("ti tle", 0, 0, 1), ("body", 0, 0, 11), ("body", 1, 11, 31), ("body", 2, 31, 31)]
    assert token_counts.token_counts(docs.limit(0), JSON, fields=("body",)).count() == 0


def test_token_counts_follow_the_librarys_offsets(spark, reference, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {}
    for r in token_counts.token_counts(docs, JSON, rule="first").collect():
        got.setdefault(r.doc_id, {})[r.section] = r.n_tokens
    for i, text in enumerate(texts):
        ends = np.cumsum([len(x) + 1 for x in text.split("\n")])
        starts = [o[0] for o in reference(text).offsets]
        want = np.bincount(np.searchsorted(ends, starts, "right") if starts else np.array([], int), minlength=len(ends))
        assert [got[i][k] for k in range(len(ends))] == want.tolist(), repr(text)


def test_attribution_rules():
    ends, borders = np.array([2, 5, 9]), np.array([3, 9])  # the second token has one byte before the border
    assert token_counts.attribute(ends, borders, "first")[0].tolist() == [2, 1]
    assert token_counts.attribute(ends, borders, "last")[0].tolist() == [1, 2]
    assert token_counts.attribute(ends, borders, "most")[0].tolist() == [1, 2]
    share, crossing = token_counts.attribute(ends, borders, "share")
    assert np.allclose(share, [1 + 1 / 3, 1 + 2 / 3]) and crossing.tolist() == [1, 1]
    with pytest.raises(ValueError):
        token_counts.token_counts(None, JSON, rule="other")


def test_queries_over_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    packed = queries.op1_packing(spark, sf)
    assert packed.select("doc_id").distinct().count() == n
    one = packed.agg(F.sum("length").alias("ids"), F.countDistinct("sequence_id").alias("s")).first()
    files = queries.op2_token_files(spark, sf)
    assert files.count() == n
    assert files.agg(F.sum("n_tokens")).first()[0] == one["ids"]
    assert one["ids"] / (1024 * one["s"]) > 0.98
