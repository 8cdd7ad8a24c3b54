import random

import pytest
from pyspark.sql import functions as F

from sparkmill.llm import suffixes
from sparkmill.llm.texts import py_like


def brute(rows, span):
    out = {}
    right = [t for _, t, s in rows if s & 2 and t]
    for i, t, s in rows:
        if not (s & 1 and t):
            continue
        end = covered = best = 0
        for o in range(len(t) - span + 1):
            n = max((suffixes.common(t[o:], u[k:]) for u in right for k in range(len(u)) if u[k : k + span] == t[o : o + span]), default=0)
            if n >= span:
                covered += max(0, o + n - max(o, end))
                end, best = max(end, o + n), max(best, n)
        if best:
            out[i] = (covered, best)
    return out


@pytest.mark.parametrize("most", [suffixes.MOST, 2])
def test_coverage_against_all_places(spark, most):
    rng = random.Random(6)
    parts = ["".join(rng.choice("가나다라") for _ in range(rng.randrange(3, 14))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))), rng.choice([1, 2, 2, 3])) for i in range(90)]
    rows += [(900, None, 1), (901, "", 2), (902, "가나", 3)]
    df = spark.createDataFrame(rows, "tid long, text string, side int").withColumn("off", F.lit("clash"))
    got = {r["tid"]: (r["covered"], r["longest"]) for r in suffixes.shared_spans(df.repartition(3), span=5, most=most).collect()}
    assert got == brute(rows, 5) and got


def test_long_spans_follow_each_other(spark):
    df = spark.createDataFrame([(1, "나" + "가다" * 400, 1), (2, "가다" * 400 + "라", 2)], "tid long, text string, side int")
    assert suffixes.shared_spans(df).first()["covered"] == 800
    rng = random.Random(1)
    long = "".join(chr(0xAC00 + rng.randrange(3000)) for _ in range(1000))
    df = spark.createDataFrame([(1, "나" + long + "다", 1), (2, "라" + long + "마", 2), (3, long[100:600], 2)], "tid long, text string, side int")
    got = suffixes.shared_spans(df).first()
    assert got["covered"] == got["longest"] == 1000 and got["other"] == 2


def test_nothing_shared(spark):
    df = spark.createDataFrame([(1, "가나다라마바사아자차", 1)], "tid long, text string, side int")
    assert suffixes.shared_spans(df).count() == 0 and suffixes.shared_spans(df.where("false")).count() == 0


@pytest.mark.parametrize("most", [suffixes.PAIRS, 1])
def test_every_shared_run_gives_its_pair(spark, most):
    rng = random.Random(8)
    word = lambda n: "".join(chr(0xAC00 + rng.randrange(400)) for _ in range(n))
    parts = [word(rng.randrange(6, 22)) for _ in range(30)]
    rows = [(i, rng.choice(parts) + word(rng.randrange(6)) + rng.choice(parts), rng.choice([1, 2, 3, 4, 8, 10, 5, 15])) for i in range(120)]
    rows += [(500, "", 1), (501, None, 2), (502, "짧은", 3), (503, "가" * 900, 1), (504, "가" * 700 + "나", 2)]
    want = set()
    for x, a, p in rows:
        for y, b, q in rows:
            if x != y and a and b and p & (q >> 1) & 5:
                if py_like(a, b) >= 0.6 and any(a[i : i + suffixes.RUN] in b for i in range(len(a) - suffixes.RUN + 1)):
                    want.add((x, y))
    df = spark.createDataFrame(rows, "tid long, text string, mask int").withColumn("h", F.lit("clash"))
    got = {tuple(r) for r in suffixes.span_pairs(df.repartition(4), most=most).collect()}
    if most == 1:
        assert len(got) < len(want)  # what is too common is left to the join
    else:
        assert got >= want and want


def test_no_span_pairs(spark):
    df = spark.createDataFrame([(1, "가나다라마바사아자차카타파하", 1)], "tid long, text string, mask int")
    assert suffixes.span_pairs(df).count() == 0 and suffixes.span_pairs(df.where("false")).count() == 0
