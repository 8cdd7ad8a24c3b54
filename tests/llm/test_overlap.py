import random

import pytest
from pyspark.sql import functions as F

from sparkmill.llm import overlap
from sparkmill.llm.texts import py_like


def texts(seed, n):
    rng = random.Random(seed)
    syllables = [chr(0xAC00 + 37 * k) for k in range(60)]
    out = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 40))) for _ in range(n // 2)]
    while len(out) < n:
        t = list(rng.choice(out))
        for _ in range(rng.randrange(6)):
            t[rng.randrange(len(t))] = rng.choice(syllables)
        cut = rng.randrange(len(t))
        out.append("".join(t[cut:] + t[:cut]))
    return out + ["", "가", "가", "가나", "가나", None, "아" * 30_000, "아" * 20_000 + "나"], rng


@pytest.mark.parametrize("tasks", [(overlap.TASK_PAIRS, overlap.TASK_ENTRIES), (40, 10)])
def test_cross_pairs_against_all_pairs(spark, tasks, monkeypatch):
    monkeypatch.setattr(overlap, "TASK_PAIRS", tasks[0])
    monkeypatch.setattr(overlap, "TASK_ENTRIES", tasks[1])
    t, rng = texts(3, 260)
    rows = [(i, rng.random() < 0.4, x, rng.choice(t)) for i, x in enumerate(t)]
    alike = lambda a, b: py_like(a or "", b or "") >= 0.6
    want = {(min(i, j), max(i, j)) for i, li, a, b in rows for j, lj, c, d in rows if li and not lj and (alike(a, c) or alike(b, d))}
    df = spark.createDataFrame(rows + rows[:5] + [(None, True, "가나", "가나")], "no long, is_left boolean, first string, second string").withColumn("tid", F.lit(1)).withColumn("mask", F.lit("clash"))
    got = overlap.cross_pairs(df.repartition(3)).collect()
    assert {r["by"] for r in got} > {overlap.BY_JOIN, overlap.BY_SPAN | overlap.BY_JOIN}
    got = [(r["low_no"], r["high_no"]) for r in got]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_nothing_to_compare(spark):
    empty = spark.createDataFrame([], "no long, is_left boolean, first string, second string")
    assert overlap.cross_pairs(empty).count() == 0
    one_side = spark.createDataFrame([(1, True, "가나다", "라마바"), (2, True, "가나다", "라마바")], empty.schema)
    assert overlap.cross_pairs(one_side).count() == 0
