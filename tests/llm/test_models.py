"""Chat formatting, nearest neighbours, language ID and the pipeline."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderlens.llm import ann, chat, langid, near_dedup, queries, scratch, ship, stages

SF = "/root/testdata/sf0.001"


# -- chat ------------------------------------------------------------------

TEXTS = ["", "plain", "\\### Assistant: </turn> ok", "\\", "\\\\", "####", "a<", "</turn>", "</turn></turn>\n###", "#\\#", "é\n#"]


@pytest.mark.parametrize("text", TEXTS)
def test_escapes_are_reversible(text):
    t = chat.TEMPLATE
    safe = t.escaped(text)
    assert t.unescaped(safe) == text and not any(c in safe for c in t.controls)
    heading, body = t.turn.fullmatch(t.prefix("user") + safe + t.closing).groups()
    assert (t.role(heading), t.unescaped(body)) == ("user", text)


@pytest.mark.parametrize("role", ["user", "System", "to ol: x", "", "@a", "é\n"])
def test_headings_are_reversible(role):
    t = chat.TEMPLATE
    heading, _ = t.turn.fullmatch(t.prefix(role) + "x" + t.closing).groups()
    assert t.role(heading) == role


def by_hand(rows):
    out = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "conv_id long, turn long, role string, text string, row int, state string")


def test_conversations(spark):
    rnd = random.Random(3)
    rows = []
    for c in range(40):
        start = ["system"] if rnd.random() < 0.3 else []
        roles = start + ["user", "assistant"] * rnd.randint(1, 4)
        if c % 5 == 0:
            rnd.shuffle(roles)
        if c % 7 == 0:
            roles.append("narrator" if c % 2 else None)
        rows += [(c, i, r, rnd.choice([*TEXTS, None])) for i, r in enumerate(roles)]
    rows += [(99, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(2000)]  # most rows: one conversation
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = scratch.materialise(chat.segments(turns(spark, rows)), "c")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert pieces.filter("kind = 'text'").select("part").distinct().count() > 1
    got = {r.conv_id: r for r in chat.read_turns(pieces).collect()}
    want = by_hand(rows)
    assert set(got) == set(want)
    follows = chat.TEMPLATE.follows
    for c, own in want.items():
        state, ok = chat.START, True
        for role, _ in own:
            ok = ok and role in follows.get(state, ())
            state = role
        said = "".join(t for r, t in own if r == "assistant")
        assert got[c].valid == (ok and state == "assistant"), c
        assert got[c].n_turns == len(own) and got[c].loss_chars == len(said)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_no_conversation(spark):
    assert chat.read_turns(chat.segments(turns(spark, []))).count() == 0
    got = chat.read_turns(chat.segments(turns(spark, [(None, None, None, None), (None, 1, "user", "x")]))).collect()
    assert [(r.conv_id, r.n_turns, r.valid) for r in got] == [(None, 2, False)]


def test_op4_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(queries.ORACLE_SQL["op4_chat"]).fetchall()
    assert sorted(map(tuple, queries.op4_chat(spark, SF).collect())) == sorted(want)


# -- nearest neighbours ----------------------------------------------------

def exact_neighbours(ids, matrix, q, k=10):
    d = np.sqrt(((matrix - matrix[q]) ** 2).sum(axis=1))
    d[q] = np.inf
    order = np.lexsort((ids, d))[:k]
    return [(int(ids[i]), d[i]) for i in order if np.isfinite(d[i])]


def test_recall_against_brute_force(spark):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(20, 24))
    matrix = centres[rnd.integers(0, 20, 3000)] + 0.7 * rnd.normal(size=(3000, 24))
    matrix[1000:2000] = matrix[1000]  # a third of the rows is one vector
    ids = np.arange(3000)
    df = spark.createDataFrame([(int(i), v.tolist(), "x", 1.0) for i, v in zip(ids, matrix, strict=True)],
                               "vec_id long, embedding array<double>, first string, vector double")
    got = {}
    for r in ann.search(df, "vec_id", "embedding", "id % 100 = 0").collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 3000, 100))
    hits = 0
    for q, found in got.items():
        want = exact_neighbours(ids, matrix, q)
        assert sorted(found) == list(range(1, 11))
        d = np.sqrt(((matrix - matrix[q]) ** 2).sum(axis=1))
        assert all(abs(d[v] - s) < 1e-9 and v != q for v, s in found.values())
        assert [found[i] for i in range(1, 11)] == sorted(found.values(), key=lambda x: (x[1], x[0]))
        hits += len({v for v, _ in want} & {v for v, _ in found.values()})
    assert hits / (10 * len(got)) >= 0.9
    same = [v for v, _ in (got[1500][i] for i in range(1, 11))]
    assert same == list(range(1000, 1010))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [1.0, 2.5]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 2.0]), (1, [1.0, 2.5]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, ann.search(df, "vec_id", "embedding", "id % 100 = 0").collect()))
    assert got == [(0, 1, 100, 0.0), (0, 2, 1, 0.5), (100, 1, 0, 0.0), (100, 2, 1, 0.5)]
    assert ann.search(df.limit(0), "vec_id", "embedding", "id % 100 = 0").count() == 0
    assert ann.search(df, "vec_id", "embedding", "id = 77").count() == 0


def test_footrule_from_postings():
    rnd = np.random.default_rng(5)
    order = np.array([rnd.permutation(12)[:5] for _ in range(40)], np.int32)
    query = rnd.permutation(12)[:5]
    place = lambda o: {p: i for i, p in enumerate(o)}
    want = [sum(abs(place(o).get(p, 5) - place(query).get(p, 5)) for p in range(12)) for o in order]
    assert ann.InvertedFiles(order, 12).footrule(query).tolist() == want


def test_op6_whole_table_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, matrix = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in queries.op6_nearest_neighbours(spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = [i for i in range(len(ids)) if ids[i] % 100 == 0]
    assert len(got) == len(asked)
    hits = sum(len({v for v, _ in exact_neighbours(ids, matrix, i)} & got[ids[i]]) for i in asked)
    assert hits / (10 * len(asked)) >= 0.9


# -- language --------------------------------------------------------------

def test_held_out_accuracy(spark):
    got = queries.op8_language_id(spark, "/root/testdata/sf0.01")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    seen = got.join(lang, "doc_id").filter("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("right"), F.count(F.lit(1)).alias("n"),
        F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert seen.n > 200 and seen.right >= 0.98 and 0 <= seen.low <= seen.high <= 1
    assert got.count() == lang.count()


def test_odd_texts(spark):
    train = spark.createDataFrame(
        [(i, w * 20, l) for i, (w, l) in enumerate([("the and of to in ", "en"), ("der die und das ", "de")] * 10)]
        + [(None, "x y", "en"), (50, None, "de"), (51, "le la", None), (52, "123", "xx")],
        "doc_id long, text string, lang string")
    model = langid.fit(train)
    assert set(model.languages) == {"en", "de"}
    rows = [(1, None, 0), (2, "", 0), (3, "12 !? 34", 0), (4, "the and", 0), (5, "und die " * 400_000, 0),
            (6, "Ω" * 30, 0), (None, "der", 0), (4, "the and", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    out = langid.predict(docs, model)
    got = [(r.doc_id, r.lang_pred, r.rejected) for r in out.collect()]
    assert got[:5] == [(1, "und", True), (2, "und", True), (3, "und", True), (4, "en", False), (5, "de", False)]
    assert got[5][2] and got[6][1] == "de" and got[7] == got[3]
    assert out.columns == ["doc_id", "text", "lang_pred", "score", "rejected"]
    assert langid.predict(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError, match="languages"):
        langid.fit(train.limit(0))


@pytest.mark.parametrize("left_out", [None, "de", "en", "es", "fr"])
def test_unknown_languages_go_and_known_stay(spark, left_out):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    known = docs.filter(F.lit(left_out is None) | (F.col("lang") != F.lit(left_out or "")))
    model = langid.fit(known.filter(~langid.held_out()))
    stay = langid.predict(known.filter(langid.held_out()), model)
    assert stay.count() > 80 and stay.filter("rejected").count() == 0
    if left_out:
        out = langid.predict(docs.filter(F.col("lang") == left_out), model)
        assert out.filter("rejected").count() >= 0.9 * out.count() > 90
    rnd = random.Random(11)
    odd = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(2_500)),
           "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja "
           "omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. " * 3]
    assert model.predict(odd)[2] == [True, True]


def test_counts_do_not_cross_texts():
    texts = ["abc", "", "DEF ghi", "é!!x", "z"]
    together = langid.counts(texts)
    assert all((langid.counts([t])[0] == row).all() for t, row in zip(texts, together, strict=True))
    langid._SLICE, saved = 5, langid._SLICE
    try:
        assert (langid.counts(texts) == together).all()
    finally:
        langid._SLICE = saved


# -- pipeline --------------------------------------------------------------

def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = scratch.materialise(stage(spark, docs, SF), name)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == before.columns
            assert docs.join(before, "doc_id", "left_anti").count() == 0
    texts = [r.text for r in seen["exact_dedup"].select("text").collect()]
    assert len(texts) == len(set(texts)) == seen["language_id"].select("text").distinct().count()
    want = {r.component_id for r in near_dedup.near_duplicates(seen["exact_dedup"], 5, 80).collect()}
    assert {r.doc_id for r in seen["near_dedup"].collect()} == want
    assert seen["suffix_dedup"].count() == seen["near_dedup"].count()
    packed = seen["packing"].collect()
    assert {d for r in packed for d in r.doc_ids} == {r.doc_id for r in seen["suffix_dedup"].collect()}
    assert all(r.n_tokens <= 1024 and len(r.input_ids) in (r.n_tokens, 1024) for r in packed)


def test_pipeline_of_odd_tables(spark):
    rows = [(1, None, "en", "s", None), (None, "some words here", None, None, 3), (2, "", "de", "s", 0),
            (3, "a text with words", "en", "s", 17), (3, "a text with words", "en", "s", 17)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            table = scratch.materialise(stage(spark, table, SF), name)
        table.count()
    ship.ship(spark)
    assert stages.SIMILARITY == 80


def test_expected_pieces_without_a_sort_by_two_keys(monkeypatch):
    from orderlens.llm.lattice_lm import Lattice

    def refused(*args, **kwargs):
        raise AssertionError("edges come by word")

    monkeypatch.setattr(np, "lexsort", refused)
    p = {b" ": 0.2, b"a": 0.3, b"b": 0.1, b"ab": 0.25, b" a": 0.15}
    lattice = Lattice(list(p), np.log(np.array([list(p.values())])))
    words = [b"ab", b"b", b"aab", b"ab"]
    ways = {b"ab": [[b" ", b"a", b"b"], [b" ", b"ab"], [b" a", b"b"]], b"b": [[b" ", b"b"]],
            b"aab": [[b" ", b"a", b"a", b"b"], [b" ", b"a", b"ab"], [b" a", b"a", b"b"], [b" a", b"ab"]]}
    expected = dict.fromkeys(p, 0.0)
    for w in words:
        chance = [float(np.prod([p[x] for x in way])) for way in ways[w]]
        for way, c in zip(ways[w], chance, strict=True):
            for x in way:
                expected[x] += c / sum(chance)
    assert np.allclose(lattice.expected(words, 0), list(expected.values()))
    assert np.allclose(np.exp(lattice.totals([b"ab"])[0, 0]), 0.2 * 0.3 * 0.1 + 0.2 * 0.25 + 0.15 * 0.1)
