import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmill.llm import sizeaware
from sparkmill.llm.texts import py_like


def sets(seed, n):
    rng = random.Random(seed)
    alphabet = [chr(0xAC00 + 29 * k) for k in range(90)]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([2, 3, 5, 9, 14, 20, 33, 60]))) for _ in range(n // 2)]
    while len(texts) < n:
        t = list(rng.choice(texts))
        for _ in range(rng.randrange(1 + len(t) // 6)):
            t[rng.randrange(len(t))] = rng.choice(alphabet)
        at = rng.randrange(len(t))
        texts.append("".join(t[at:] + t[:at]) if rng.random() < 0.3 else "".join(t))
    return [(rng.randrange(3), i, t) for i, t in enumerate(texts)] + [(0, 900, ""), (1, 901, "가"), (0, 902, None), (2, 903, "가나" * 9000), (2, 904, "가나" * 8000), (0, 1, texts[1])]


@pytest.mark.parametrize("boundary", [None, *sizeaware.BOUNDARIES, 10**6])
def test_no_like_pair_is_lost_at_any_boundary(spark, boundary):
    rows = sets(3, 160)
    if boundary == 10**6:
        rows = [r for r in rows if len(r[2] or "") < 40]
    want = {(min(x, y), max(x, y)) for k, x, a in rows for m, y, b in rows if k == m and x != y and a and b and py_like(a, b) >= 0.6}
    df = spark.createDataFrame(rows, "k long, eid long, text string").withColumn("size", F.lit("clash")).repartition(3)
    got = [tuple(r) for r in sizeaware.size_aware_pairs(df, boundary=boundary).collect()]
    assert len(got) == len(set(got)) and set(got) >= want and want and all(x < y for x, y in got)
    two = sizeaware.size_aware_pairs(df.where("eid % 2 = 0"), df.where("eid % 2 = 1"), boundary=boundary)
    assert {(min(r), max(r)) for r in map(tuple, two.collect())} >= {(x, y) for x, y in want if x % 2 != y % 2}


def test_the_boundary_follows_the_cost():
    n = np.zeros((2, len(sizeaware.BOUNDARIES), 64), np.int64)
    n[0, 2, 0], n[1, 2, :] = 5_000, 400  # sets of 5 to 8 pieces: all under one piece, but under many subsets
    assert sizeaware.cheapest(n) >= 8
    n[0, 2, :], n[1, 2, :] = 3, 4_000  # few under each piece, and far more subsets than pieces
    assert sizeaware.cheapest(n) < 8


def test_no_sets(spark):
    assert sizeaware.size_aware_pairs(spark.createDataFrame([], "k long, eid long, text string")).count() == 0
