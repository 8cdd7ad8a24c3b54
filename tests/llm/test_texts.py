from hypothesis import given, settings, strategies as st

from sparkmill.functions import textnorm as N
from sparkmill.llm import texts as L


def many(spark, values, column):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r["r"] for r in sorted(df.select("i", column(df["v"]).alias("r")).collect(), key=lambda r: r["i"])]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30), st.text(max_size=30))
def test_like_is_symmetric_and_bounded(a, b):
    x, y = N.py_norm(a), N.py_norm(b)
    assert L.py_like(x, y) == L.py_like(y, x)
    assert 0 <= L.py_like(x, y) <= 1
    assert L.py_like(x, x) == (1.0 if len(x) > 1 else 0.0)


def test_part(spark):
    assert many(spark, [" Train", "VAL", None, " ", "test　", "odd"], L.part) == ["train", "validation", "train", "train", "test", "odd"]
