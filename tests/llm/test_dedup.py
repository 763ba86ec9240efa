"""Exact and near duplicates, and repeated passages, against brute force."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import components, exact_dedup, near_dedup, queries, skew, suffix_dedup, words

# More columns than the operators need, some named like theirs.
DDL = "doc_id long, text string, id long, tie long, n int, fp_a long, kept binary, uid string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, bytearray(b"5"), "6") for i, t in rows], DDL)


def duck(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return con.execute(sql).fetchall()


# -- exact -----------------------------------------------------------------

def test_fingerprints_compose():
    rnd = random.Random(4)
    for _ in range(50):
        a, b = rnd.randbytes(rnd.randint(0, 300)), rnd.randbytes(rnd.randint(0, 300))
        whole = exact_dedup.fingerprint(a + b)
        parts = zip(exact_dedup.fingerprint(a), exact_dedup.fingerprint(b), exact_dedup.PRIMES, strict=True)
        assert whole == tuple((exact_dedup.shifted(x, len(b), p) + y) % p for x, y, p in parts)


ROWS = ([(i, "same text") for i in range(40)] + [(100, None), (101, ""), (102, " "), (7000, "é" * 50_000 + "a"),
        (7001, "é" * 50_000 + "a"), (7002, "é" * 50_000 + "b"), (7003, "é" * 33_000), (8000, "alone")])


@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_exact_duplicates(spark, monkeypatch, chunk):
    rows = ROWS if chunk > 7 else ROWS[:43] + [(50, "0123456789"), (51, "0123456789"), (52, "0123456780")]
    monkeypatch.setattr(exact_dedup, "CHUNK", chunk)
    got = exact_dedup.exact_duplicates(frame(spark, rows)).drop("uid").collect()
    assert sorted(map(tuple, got)) == sorted(duck(rows, queries.ORACLE_SQL["op3_exact_dedup"]))


def test_exact_duplicates_of_repeated_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "b"), (None, "c"), (2, None), (2, "")]
    got = exact_dedup.exact_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == 4
    assert {r.keep_id for r in got if r.text_sha256 == hashlib.sha256(b"b").hexdigest()} == {1}
    kept = exact_dedup.drop_exact_duplicates(frame(spark, rows))
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "c"), (1, "a"), (1, "b"), (2, "")]
    assert kept.columns == [c.split()[0] for c in DDL.split(", ")]
    assert exact_dedup.exact_duplicates(frame(spark, [])).count() == 0
    assert exact_dedup.drop_exact_duplicates(frame(spark, [])).count() == 0


def test_large_groups_of_copies_go_before_the_shuffle(spark, monkeypatch):
    rows = [*((i % 30, "hot") for i in range(90)), *((i, "warm") for i in range(200, 204)),
            (None, "hot"), (None, "lone"), (None, "nobody"), (None, "nobody"), (300, None), (301, "")]
    for least in (1, 10, 1_000):
        monkeypatch.setattr(skew, "HOT_ROWS", least)
        kept = exact_dedup.drop_exact_duplicates(frame(spark, rows)).collect()
        assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [
            (0, "lone"), (0, "nobody"), (29, "hot"), (203, "warm"), (301, "")]
        got = exact_dedup.exact_duplicates(frame(spark, rows)).collect()
        assert {(r.keep_id, r.group_size) for r in got} == {(29, 91), (203, 4), (None, 1), (None, 2), (301, 2)}
        assert len(got) == len(rows) and sum(r.kept for r in got) == 5


@pytest.mark.parametrize("size", [1 << 26, 1 << 15])
def test_only_texts_that_may_be_shared_are_moved(spark, monkeypatch, size):
    monkeypatch.setattr(exact_dedup, "SHARED_BITS", size)
    rows = [(i, f"text {i % 900}") for i in range(1_000)]
    docs = frame(spark, rows)
    marks = exact_dedup.fingerprints(docs)
    groups = marks.groupBy(*exact_dedup._KEY).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    bits = exact_dedup.shared_bits(marks, groups)
    assert bits.count() <= size // 32_768
    single, may = (x.select("text").collect() for x in exact_dedup.split_shared(docs, bits))
    shared = {f"text {i}" for i in range(100)}
    assert len(single) + len(may) == len(rows) and not shared & {r.text for r in single}
    assert sum(r.text in shared for r in may) == 200 and len(may) <= 210


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    # The moduli come from the driver with the function, so tasks see these, too.
    monkeypatch.setattr(exact_dedup, "PRIMES", (1, 1))
    monkeypatch.setattr(exact_dedup, "fingerprint", lambda data: (0, 0))
    rows = [(1, "ab"), (2, "cd"), (3, "ab"), (4, "efg")]
    marks = spark.createDataFrame(
        [(u, i, len(t), hashlib.sha256(t.encode()).hexdigest(), 0, 0) for u, (i, t) in enumerate(rows)],
        "uid long, doc_id long, n_bytes long, text_sha256 string, fp_a long, fp_b long")
    groups = marks.groupBy("fp_a", "fp_b", "n_bytes").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    pieces = spark.createDataFrame([(0, 0, len(t), u, 0, bytearray(t.encode())) for u, (_, t) in enumerate(rows)],
                                   exact_dedup._KEYED_DDL)
    class Docs:  # stands for the documents, whose chunks are given
        def select(self, *_):
            return self
        filter = select
        def mapInArrow(self, *_):  # noqa: N802
            return pieces
    found = exact_dedup.collisions(Docs(), groups, 4).collect()
    assert [tuple(r) for r in found] == [(0, 0, 2)]


def test_hot_keys_are_bounded(spark):
    groups = spark.createDataFrame([("a", 60_000), ("b", 1_001), ("c", 900)], "k string, n_rows long")
    hot = {r.k: r.n_salts for r in skew.hot_keys(groups, 100_000).collect()}
    assert hot == {"a": 60, "b": 2}


# -- near ------------------------------------------------------------------

def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < k:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def near_by_hand(rows, k, percent=80):
    sets = {}
    for i, t in rows:
        sets[i] = shingle_set(t, k)
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def mutated(rnd, base, share):
    return " ".join(w if rnd.random() > share else f"w{rnd.randint(0, 10**6)}" for w in base)


@pytest.fixture(scope="module")
def near_rows():
    rnd = random.Random(5)
    vocabulary = [f"word{i}" for i in range(400)]
    texts = ["", None, "  ", "one", "ONE", "one two", "Two\tone", "one two three four", "a b c d e", "A B\nC d E"]
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([6, 20, 60, 300, 1500]))]
        texts += [mutated(rnd, base, rnd.choice([0, 0.005, 0.02, 0.05, 0.1])) for _ in range(rnd.randint(2, 14))]
    line = " ".join(rnd.choice(vocabulary) for _ in range(12))  # a passage that many texts share
    texts += [line + " " + " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(2, 30))) for _ in range(60)]
    rnd.shuffle(texts)
    return list(enumerate(texts))


def test_word_hashes_follow_the_definition(near_rows):
    data = [(t or "").encode() for _, t in near_rows] + ["é 　 x\x1c y z\x0b q".encode()]
    for k in (4, 5):
        hashes, owner = words.shingles(data, k)
        counts = np.bincount(owner, minlength=len(data))
        assert counts.tolist() == [len(shingle_set(t.decode(), k)) for t in data]
    long = [b"ab cd " * 50, b"x" * 500, b"", b"ab cd " * 50]
    plain = words.words(long)
    words.SLICE, saved = 64, words.SLICE
    try:
        sliced = words.words(long)
    finally:
        words.SLICE = saved
    assert all((a == b).all() for a, b in zip(plain, sliced, strict=True))


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(spark, near_rows, k):
    want = near_by_hand(near_rows, k)
    got = near_dedup.near_duplicates(frame(spark, near_rows), k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(near_rows)


def test_near_duplicates_in_chunks(spark, near_rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK", 5)
    want = near_by_hand(near_rows, 4)
    got = near_dedup.near_duplicates(frame(spark, near_rows), 4).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c) in want.items()}


def test_near_duplicates_defined_results(spark):
    text = "one two three four five six"
    rows = [(None, text), (3, text), (3, text), (2, text), (9, None), (None, None)]
    got = sorted(map(tuple, near_dedup.near_duplicates(frame(spark, rows), 4).collect()), key=str)
    assert got == sorted([(None, 3, None, True), (3, 3, 2, False), (3, 3, 2, False), (2, 3, 2, True),
                          (9, 0, 9, True), (None, 0, None, True)], key=str)
    kept = near_dedup.drop_near_duplicates(frame(spark, rows), 4)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "9", "None", "None"]
    assert near_dedup.near_duplicates(frame(spark, []), 4).count() == 0
    assert near_dedup.drop_near_duplicates(frame(spark, []), 4).count() == 0


def test_estimates_are_close():
    rnd = np.random.default_rng(6)
    for j in (0.3, 0.8, 0.95):
        n = 3000
        common = int(2 * n * j / (1 + j))
        pool = words.mix(rnd.integers(0, 1 << 63, 2 * n, dtype=np.uint64))
        a, b = pool[:n], np.concatenate([pool[:common], pool[n:2 * n - common]])
        regs = near_dedup.registers(np.concatenate([a, b]), np.repeat([0, 1], n), 2)
        found, either = near_dedup.estimate(regs[0], regs[1:])
        assert either[0] == near_dedup.REGISTERS and abs(found[0] - j) < 0.1


def test_components(spark):
    rnd = random.Random(7)
    links = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    label = {x: x for pair in links for x in pair}
    for _ in range(400):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {r.id: r.component for r in got.collect()} == {x: c for x, c in label.items()
                                                          if any(x in p and p[0] != p[1] for p in links)}


def test_components_stop_when_stars_are_left(spark, monkeypatch):
    written = []
    write = components.scratch.materialise
    monkeypatch.setattr(components.scratch, "materialise", lambda df, name: written.append(name) or write(df, name))
    links = [(i, 1000 + i % 7) for i in range(1007, 1200)] + [(5000, 4000), (4000, 4000), (5000, 4000)]
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {r.id: r.component for r in got.collect()} == {x: b for a, b in links for x in (a, b)}
    assert len(written) == 1  # nothing to do but to see that these are stars
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_roots(spark):
    rnd = random.Random(11)
    parent = {i: rnd.choice([i - 1, rnd.randrange(max(1, i - 40), i)]) + 0 for i in range(2, 400) if i % 50}
    last = {}
    for i in sorted(parent):
        last[i] = last.get(parent[i], parent[i])
    got = components.roots(spark.createDataFrame(list(parent.items()), "a long, b long"))
    assert sorted((r.id, r.component) for r in got.collect()) == sorted(last.items())
    assert components.roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_write_few_tables(spark, monkeypatch):
    """Near copies of one text, and chains of them, need a bounded number of written tables."""
    written = []
    write = near_dedup.scratch.materialise
    monkeypatch.setattr(near_dedup.scratch, "materialise", lambda df, name: written.append(name) or write(df, name))
    base = [f"w{i}" for i in range(200)]
    rows = [(d, " ".join([*base[:-1], f"end{d}"])) for d in range(100, 140)] + [(d, f"other text {d} on its own") for d in range(20)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == {d: min(d, 100) for d, _ in rows}
    assert written.count("links") == 1 and len(written) <= 15  # before: 6 of links, 19 in all


# -- passages --------------------------------------------------------------

def repeats_by_hand(rows):
    least = {}
    key = lambda i: -1 if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - 49):
            w = b[s:s + 50]
            least[w] = min(least.get(w, key(i)), key(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if least[b[s:s + 50]] < key(i):
                gone[s:s + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def passage_rows():
    rnd = random.Random(8)
    make = lambda n: "".join(rnd.choice("abcdé \n") for _ in range(n))
    passages = [make(n) for n in (45, 50, 51, 60, 130, 400)]
    rows = [(None, passages[3] + "x"), (0, None), (1, ""), (2, "a" * 49), (3, "a" * 50), (4, "a" * 51), (5, "a" * 200)]
    for i in range(60):
        text = make(rnd.randint(0, 120))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randint(0, len(p) // 3)
            text += p[a:] + make(rnd.randint(0, 40))
        rows.append((100 + i // 2, text))  # each id twice
    rows += [(900, passages[5] * 3), (901, passages[5] * 3), (901, passages[5] * 3)]
    rnd.shuffle(rows)
    return rows


def with_repeated_anchors(table, buckets, cut=7):
    """What a task of records reads, from documents (id, tie, text); and the rows of repeated anchors."""
    import pyarrow as pa

    halves = [table.slice(0, len(table) // 2), table.slice(len(table) // 2)]  # two tasks
    found = [b for t in halves for b in suffix_dedup._anchor_rows(iter([t]), buckets)]
    rows = pa.Table.from_batches(found).sort_by([("kind", "ascending"), ("key", "ascending")]).combine_chunks()
    pieces = [b for a in range(0, len(rows), cut) for b in rows.slice(a, cut).to_batches()]
    repeated = [r for b in suffix_dedup._repeated(iter(pieces), buckets) for r in b.to_pylist()]
    ids, ties = (table.column(c).to_numpy() for c in ("id", "tie"))
    out = [(r["bucket"], 0, r["blob"], None, None, None) for r in repeated if r["kind"] == 0]
    out += [(b, 1, None, *r.values()) for b, r in
            zip(suffix_dedup._document_bucket(ids, ties, buckets).tolist(), table.to_pylist(), strict=True)]
    out.sort(key=lambda r: r[:2])
    names = ["block", "kind", "blob", "id", "tie", "text"]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
    met = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
    return met, repeated


def test_repeated_anchors_are_those_that_occur_again(passage_rows, monkeypatch):
    import collections

    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "MOST", 40)
    monkeypatch.setattr(suffix_dedup, "BATCH", 50)
    rows = [*passage_rows, *((2000 + i, "z" * 70) for i in range(40))]
    table = pa.record_batch([pa.array([i or 0 for i, _ in rows]), pa.array([0] * len(rows)), pa.array([t for _, t in rows])],
                            names=["id", "tie", "text"])
    all_ = [{"anchor": a, "bucket": b} for _, head, _, _, hashed in suffix_dedup._found(iter([table])) for a, b in
            zip(hashed.view(np.int64).tolist(), suffix_dedup._document_bucket(head["doc"], head["tie"], 64).tolist(), strict=True)]
    n = collections.Counter(r["anchor"] for r in all_)
    for cut, combined in ((1, 1 << 20), (2, 100), (7, 1), (10_000, 1 << 20)):
        monkeypatch.setattr(suffix_dedup, "COMBINED", combined)
        _, repeated = with_repeated_anchors(table, 64, cut)
        got = collections.Counter((r["bucket"], a) for r in repeated if r["kind"] == 0 for a in np.frombuffer(r["blob"], np.int64))
        assert got == collections.Counter((r["bucket"], r["anchor"]) for r in all_ if n[r["anchor"]] > 1)
        sums = collections.Counter()
        for r in repeated:
            if r["kind"] == 1:
                sums[r["bucket"]] += r["n"]
        want = collections.Counter()
        for a, k in n.items():
            if k > 1:
                want[int(suffix_dedup._bucket(np.array([a]).view(np.uint64), 64)[0])] += k
        assert sums == want
        assert {(r["anchor"], r["n"]) for r in repeated if r["kind"] == 2} == {(a, k) for a, k in n.items() if k > 10}


@pytest.mark.parametrize("most,together", [(8, 3), (60, 512)])
def test_no_task_holds_a_hot_passage(spark, passage_rows, monkeypatch, most, together):
    import pyarrow as pa

    rows = [*passage_rows, *((2000 + i, passage_rows[0][1] or "z" * 70) for i in range(40)), (3000, "a" * 3000), (1, "ab" * 500)]
    rnd = random.Random(4)
    twice = ["".join(rnd.choice("abcdefgh ") for _ in range(200)) for _ in range(60)]
    rows += [(4000 + i, t) for i, t in enumerate(twice * 2)]
    table = pa.record_batch([pa.array([i or 0 for i, _ in rows]), pa.array([0] * len(rows)), pa.array([t for _, t in rows])],
                            names=["id", "tie", "text"])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    met, repeated = with_repeated_anchors(table, 64)
    hot = suffix_dedup._hot(spark.createDataFrame([tuple(r.values()) for r in repeated],
                                                  "kind int, bucket long, anchor long, n long, blob binary"))
    assert len(hot.anchors) and (len(hot.buckets) or most > 8)
    held = {}
    for batch in suffix_dedup._records(iter([met]), 64, hot):
        for r in batch.to_pylist():
            held[r["bucket"]] = held.get(r["bucket"], 0) + int.from_bytes(r["blob"][:8], "little")
    assert held and max(held.values()) <= most
    # The rows that a context's places take are bounded, too, and nothing is lost.
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    places = [r for b in suffix_dedup._hot_records(iter([met]), 64, hot) for r in b.to_pylist()]
    assert max(len(r["places"]) for r in places) <= 24 * together
    records = sum(len(head) for _, head, *_ in suffix_dedup._found_again(iter([met])))
    assert sum(len(r["places"]) // 24 for r in places) + sum(held.values()) == records
    got = suffix_dedup.digests(suffix_dedup.remove_repeats(docs)).collect()
    assert sorted(map(tuple, got), key=str) == repeats_by_hand(rows)


def test_anchors_depend_on_the_window_alone(passage_rows):
    text = "".join(t or "" for _, t in passage_rows).encode()
    raw = np.frombuffer(text, np.uint8)
    first, n, anchor, _ = suffix_dedup.anchors(raw)
    assert n.sum() == len(raw) - suffix_dedup.LENGTH + 1 and n.max() <= suffix_dedup.PLACES
    place = np.repeat(anchor, n) - np.arange(n.sum())
    seen = {}
    for s, a in enumerate(place.tolist()):
        assert 0 <= a < suffix_dedup.PLACES
        assert seen.setdefault(text[s:s + suffix_dedup.LENGTH], a) == a


@pytest.mark.parametrize("slice_,batch,held", [(1 << 20, 300_000, 4 << 20), (200, 40, 300)])
def test_repeated_passages(spark, passage_rows, monkeypatch, slice_, batch, held):
    import orderlens.llm.suffix_dedup as module

    for name, value in (("SLICE", slice_), ("BATCH", batch), ("HELD", held)):
        monkeypatch.setattr(module, name, value)
    rows = list(passage_rows)
    if slice_ < 1000:  # the functions themselves, in this process, with small bounds
        import pyarrow as pa

        key = lambda i: -(1 << 63) if i is None else i
        table = pa.record_batch([pa.array([key(i) for i, _ in rows]), pa.array([hash(t) for _, t in rows]),
                                 pa.array([t for _, t in rows])], names=["id", "tie", "text"])
        blobs = {}
        met, _ = with_repeated_anchors(table, 3)
        for b in module._records(iter([met]), 3):
            for k, x in zip(b.column("bucket").to_pylist(), b.column("blob").to_pylist(), strict=True):
                blobs.setdefault(k, []).append(x)
        covers = {}
        for group in blobs.values():
            head, ctx = module._unpack(group)
            record, place = np.nonzero(module._covered(head, ctx))
            for r, p in zip(record, place, strict=True):
                covers.setdefault((head["doc"][r], head["tie"][r]), []).append(head["at"][r] + p)
        for i, t in rows:
            at = np.array(sorted(covers.get((key(i), hash(t)), [])), np.int64)
            spans = module._spans(at, np.ones(len(at), np.int64)) if len(at) else []
            want = next(x for x in repeats_by_hand(rows) if x[0] == i and x[1] == len((t or "").encode())
                        and x[2] == sum(b - a for a, b in spans))
            assert want[3] == len(spans)
        return
    got = module.digests(module.remove_repeats(frame(spark, rows))).collect()
    assert sorted(map(tuple, got), key=str) == repeats_by_hand(rows)


def test_levels_keep_the_smallest_id():
    rnd = np.random.default_rng(9)
    family, least = suffix_dedup.Levels(), {}
    for _ in range(40):
        window = np.sort(rnd.integers(0, 500, 60).astype(np.uint64))
        doc = rnd.integers(0, 1000, 60)
        family.add(suffix_dedup.Level.of(window, doc, doc, doc))
        for w, d in zip(window.tolist(), doc.tolist(), strict=True):
            least[w] = min(least.get(w, d), d)
    sizes = [len(x) for x in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
    keys = np.array(sorted(least), np.uint64)
    assert family.least(keys)[0].tolist() == [least[k] for k in keys.tolist()]


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    # All windows share a hash; the bytes decide.
    monkeypatch.setattr(suffix_dedup, "mix", lambda x: x * np.uint64(0))
    texts = ["x" * 50, "y" * 50, "x" * 50, "z" * 50]
    head = np.zeros(4, suffix_dedup._RECORD)
    head["doc"], head["n"] = [1, 2, 3, 4], 1
    rows = np.zeros((4, suffix_dedup.CONTEXT), np.uint8)
    for r, t in zip(rows, texts, strict=True):
        r[:50] = np.frombuffer(t.encode(), np.uint8)
    assert suffix_dedup._covered(head, rows)[:, 0].tolist() == [False, False, True, False]


def test_kept_text(spark):
    passage = "é" * 40  # 80 bytes
    docs = spark.createDataFrame([(1, "a " + passage + " b", 99), (2, "xé" + passage + "é yy", 99), (3, None, 99)],
                                 "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in suffix_dedup.kept_text(docs).collect()}
    assert got[1].text == "a " + passage + " b" and got[1].n_chars == len(got[1].text)
    assert got[2].text == "xé yy" or len(got[2].text) < 10
    assert got[3].text == "" and suffix_dedup.kept_text(docs.limit(0)).count() == 0
    assert suffix_dedup.kept_text(docs).columns == docs.columns


def test_op3_oracle_over_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op3_exact_dedup(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(duck([tuple(r) for r in rows], queries.ORACLE_SQL["op3_exact_dedup"]))


def _odd(spark, rows, ddl, **extra):
    """Documents with columns whose names the operators use inside, with dots, and with nulls."""
    df = spark.createDataFrame(rows, ddl)
    for c in ("kept", "n_bytes", "spans", "__id", "__sum", "__sha", "__gone", "__tie", "__bucket", "score", "lang_pred",
              "rejected", "component_id", "id", "a.b", "__rest"):
        df = df.withColumn(c, F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")))
    return df.withColumn("nothing", F.lit(None).cast("int")).withColumns(extra)


def test_stages_keep_extra_columns(spark):
    from orderlens.llm import stages

    passage = "a passage that several of the documents share, some fifty bytes and more of it. "
    de, en = "der hund und die katze gehen nach hause ", "the dog and the cat are going home now "
    rows = [(i, (de if i % 2 else en) * 4 + f"number {i} and more words {i * i} to tell it apart", "de" if i % 2 else "en")
            for i in range(40)]
    rows += [(50, rows[0][1], "en"), (51, rows[0][1], "en"), (52, passage + rows[1][1], None), (53, rows[2][1] + " " + passage, None),
             (54, None, None), (55, "", None)]
    docs = _odd(spark, rows, "doc_id long, text string, lang string").withColumn("n_chars", F.lit(5).cast("int"))
    texts = {i: t for i, t, _ in rows}
    for name, stage in stages.STAGES[:-1]:
        got = stage(spark, docs, "")
        assert got.columns == docs.columns and got.schema.fieldNames() == docs.schema.fieldNames(), name
        assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in docs.schema}
        kept = got.collect()
        assert kept
        for r in kept:
            assert all(r[c] == f"{c} of {r.doc_id}" for c in ("kept", "n_bytes", "spans", "__id", "__sum", "score", "lang_pred",
                                                               "rejected", "component_id", "id", "a.b", "__rest")), (name, r)
            assert r["nothing"] is None
            if name != "suffix_dedup":
                assert r.text == texts[r.doc_id] and r.n_chars == 5
            else:
                assert r.n_chars == len(r.text)
    packed = stages.STAGES[-1][1](spark, docs, "")
    assert "sequence_id" in packed.columns and packed.count() > 0


def test_rows_that_share_an_id_are_linked_each(spark):
    rnd = random.Random(12)
    make = lambda: " ".join(rnd.choice(["ka", "lo", "mi", "nu", "re", "so", "ti"]) + str(rnd.randint(0, 99)) for _ in range(60))
    rows, want = [], {}
    for i in range(30):
        one, two = make(), make()
        rows += [(i, one), (i, two), (1000 + i, one + " x"), (2000 + i, two + " y")]
        want |= {1000 + i: i, 2000 + i: i}
    rows += [(5000, None), (5000, "!"), (None, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id in want} == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    left = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in near_dedup.drop_near_duplicates(docs).collect())
    assert left == sorted((i is not None, i or 0, t or "") for i, t in rows if i is None or i < 1000 or i == 5000)


def test_near_copies_that_share_an_id_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text), (3, text + " x"), (7, text + " y"), (9, "something else entirely here now")]
    left = near_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in left) == [3, 9]


def test_records_hold_little_memory(monkeypatch):
    """A task sorts its records in batches that are let go of as they are packed."""
    import tracemalloc

    import pyarrow as pa

    rnd = np.random.default_rng(6)
    letters = np.frombuffer(b"abcdefghijklmnopqrst      ", np.uint8)
    texts = [letters[rnd.integers(0, len(letters), 40_000)].tobytes().decode() for _ in range(200)]
    table = pa.record_batch([pa.array(range(200)), pa.array([0] * 200), pa.array(texts)], names=["id", "tie", "text"])
    found = suffix_dedup._found
    monkeypatch.setattr(suffix_dedup, "_found_again", lambda batches: found(batches))  # all anchors occur again
    records = 0
    tracemalloc.start()
    try:
        for batch in suffix_dedup._records(iter([table]), 64):
            records += sum(int.from_bytes(x[:8], "little") for x in batch.column("blob").to_pylist())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert records > 400_000 and peak < 90 << 20
