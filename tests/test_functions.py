"""Column functions against plain-Python statements of the same rules.

Each test evaluates a batch of randomised inputs in one Spark job."""

import datetime as dt
import decimal
import random

from pyspark.sql import functions as F

from orderlens.functions import dates, money, text

WS = [" ", "\t", " ", " ", "\n", "\r", "\x0b", "\x0c"]


def _rand_name(rnd):
    parts = ["".join(rnd.choice("abcXYZé") for _ in range(rnd.randint(1, 4)))
             for _ in range(rnd.randint(1, 4))]
    seps = [rnd.choice([" ", "  ", "  ", " "]) for _ in parts]
    lead = rnd.choice(["", " ", "  "])
    return lead + "".join(p + s for p, s in zip(parts, seps))


def test_name_split_matches_python_split(spark):
    rnd = random.Random(5)
    names = [_rand_name(rnd) for _ in range(300)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select("n", text.first_token(F.col("n")).alias("f"),
                    text.rest_tokens(F.col("n")).alias("r")).collect()
    for row in got:
        toks = row.n.split()
        assert (row.f, row.r) == (toks[0], " ".join(toks[1:])), row.n


def test_strip_line_keeps_tabs(spark):
    rnd = random.Random(6)
    lines = []
    for _ in range(300):
        core = "a\tb" if rnd.random() < 0.5 else "\ta\t\t"
        lines.append("".join(rnd.choice(WS[:1] + WS[2:]) for _ in range(rnd.randint(0, 3)))
                     + core + "".join(rnd.choice(WS[:1] + WS[2:]) for _ in range(rnd.randint(0, 3))))
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    got = df.select("x", text.strip_line(F.col("x")).alias("s"),
                    text.is_blank(F.col("x")).alias("b")).collect()
    for row in got:
        # Python's strip(), except that tabs are field separators and stay
        want = row.x.strip("".join(w for w in WS if w != "\t") + "\u0085 　")
        assert row.s == want, repr(row.x)
        assert row.b == (row.x.strip() == "")


def test_list_split_keeps_trailing_empties(spark):
    vals = ["a;b", "a;;b", "a;", ";", "", "x"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.s for r in df.select(text.split_list(F.col("v")).alias("s")).collect()]
    assert got == [v.split(";") for v in vals]


def test_round_half_up_on_exact_halves(spark):
    rows = [("10.50", 1), ("0.25", 2), ("3.35", 3), ("1.005", 1)]
    df = spark.createDataFrame(rows, "p string, q long")
    total = money.line_total(F.col("p").cast("decimal(12,3)"), F.col("q"))
    got = df.select(money.round_to_double(total, 0).alias("r0"),
                    money.round_to_double(total, 2).alias("r2")).collect()
    for (p, q), r in zip(rows, got):
        # price -> decimal(12,2) also rounds half up (1.005 -> 1.01)
        exact = decimal.Decimal(p).quantize(decimal.Decimal("0.01"),
                                            rounding=decimal.ROUND_HALF_UP) * q
        want0 = float(exact.quantize(decimal.Decimal("1"), rounding=decimal.ROUND_HALF_UP))
        want2 = float(exact.quantize(decimal.Decimal("0.01"), rounding=decimal.ROUND_HALF_UP))
        assert (r.r0, r.r2) == (want0, want2)


def test_calendar_labels(spark):
    days = [dt.date(2020, m, 1 + (m % 27)) for m in range(1, 13)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(dates.quarter_label(F.col("d")).alias("q"),
                    dates.month_name(F.col("d")).alias("m"),
                    dates.year_of(F.col("d")).alias("y")).collect()
    assert [r.q for r in got] == ["Q1"] * 3 + ["Q2"] * 3 + ["Q3"] * 3 + ["Q4"] * 3
    assert [r.m for r in got] == [d.strftime("%B") for d in days]
    assert {r.y for r in got} == {2020}


def test_compact_date_parsing(spark):
    df = spark.createDataFrame([("20120814",), ("2012-08-14",), (None,)], "s string")
    got = [r.d for r in df.select(dates.parse_compact_date(F.col("s"), strict=False)
                                  .alias("d")).collect()]
    assert got == [dt.date(2012, 8, 14), None, None]
