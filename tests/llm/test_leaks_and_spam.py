import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmill.functions.textnorm import py_norm
from sparkmill.llm import leaks, spam


def words(rng, n):
    return " ".join("".join(chr(0xAC00 + rng.randrange(3000)) for _ in range(3)) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    items = [(i, words(rng, rng.randrange(4, 60))) for i in range(25)] + [(90, "짧다"), (91, None), (92, "")]
    docs = []
    for d in range(160):
        body = words(rng, rng.randrange(1, 80))
        if rng.random() < 0.6:
            t = rng.choice(items[:25])[1]
            n = rng.choice([19, 25, 38, 39, 40, 41, 45, 60, 200])
            a = rng.randrange(max(1, len(t) - n))
            body += rng.choice([" ", "\n", "​"]) + t[a : a + n + n // 3] + " " + words(rng, 5)
        docs.append((d, body))
    return docs + [(500, None), (501, ""), (502, items[0][1]), (502, items[0][1])], items


@pytest.mark.parametrize("bits", [leaks.MOST_BITS, 3])
def test_every_common_run_is_found(spark, bits, monkeypatch):
    monkeypatch.setattr(leaks, "MOST_BITS", max(bits, 6))  # a map this small is full: all n-grams are kept, and the join decides
    docs, items = corpus(4)
    runs = {}
    for i, t in items:
        t = py_norm(t)
        for k in range(len(t) - leaks.RUN + 1):
            runs.setdefault(t[k : k + leaks.RUN], set()).add(i)
    want = set()
    for d, t in docs:
        t = py_norm(t)
        for k in range(len(t) - leaks.RUN + 1):
            want |= {(d, i) for i in runs.get(t[k : k + leaks.RUN], ())}
    df = spark.createDataFrame(docs, "id long, text string").withColumn("grams", F.lit("clash"))
    got = leaks.leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["id"], r["item_id"]) for r in got if r["run"] >= leaks.RUN} == want and want
    assert len(got) == len({(r["id"], r["item_id"]) for r in got})


def test_an_exact_fragment_far_from_an_edited_copy(spark):
    rng = random.Random(6)
    item = words(rng, 40).replace(" ", "")
    edits = range(35, len(item), 36)
    edited = "".join("힣" if k in edits else c for k, c in enumerate(item))  # no run over 35, but the better score
    around = " ".join(item[k - 19 : k + 20] + words(rng, 2) for k in edits)  # makes n-grams over the edits common, so that seeds lie between them
    docs = [(1, edited + words(rng, 400) + item[10 : 10 + leaks.RUN + 2] + words(rng, 5)), (2, edited), (3, around), (4, around), (5, around)]
    got = leaks.leaks(spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    got = {r["id"]: r for r in got.collect()}
    assert got[1]["score"] == got[2]["score"] > leaks.MATCH * (leaks.RUN + 2)
    assert got[1]["run"] == leaks.RUN + 2 and got[2]["run"] == 35


def test_nothing_leaks_from_nothing(spark):
    docs, items = corpus(1)
    d, i = spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert leaks.leaks(d.where("false"), i).count() == 0 and leaks.leaks(d, i.where("false")).count() == 0


def test_alignment_against_the_full_table():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.integers(0, 4, 30), rng.integers(0, 4, 45)
        h, run, best, longest = np.zeros((31, 46), int), np.zeros((31, 46), int), 0, 0
        for i in range(30):
            for j in range(45):
                s = a[i] == b[j]
                h[i + 1, j + 1] = max(0, h[i, j] + (leaks.MATCH if s else leaks.MISMATCH), h[i, j + 1] + leaks.GAP, h[i + 1, j] + leaks.GAP)
                run[i + 1, j + 1] = run[i, j] + 1 if s else 0
        got = leaks.align(a, b)
        assert (got[0], got[3]) == (h.max(), run.max())


SENTENCES = ["The commander asked the archers to hold the bridge until the smoke had cleared.", "Nobody could say why the rear guard turned back at the ford that evening.", "If two orders disagree, the later one is kept and the first is noted in the log."]


def test_spam_windows_share(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(SENTENCES).replace("bridge", words(rng, 1)) for _ in range(n))
    stuffed = lambda n: " | ".join(rng.choice(["miro best", "miro", "miro free", "tula top"]) for _ in range(n))
    links = "\n".join(f"https://{words(rng, 1)}.example/{i}" for i in range(60))
    docs = [(i, prose(rng.randrange(5, 25)), rng.choice(["en", "EN ", None])) for i in range(300)]
    docs += [(1000, stuffed(200), "en"), (1001, links, None), (1002, prose(3) + "\n" + stuffed(200), "en"), (1003, prose(40) + "\n" + stuffed(20), "en"), (1004, " ".join(f"#tag{i}" for i in range(200)), "en")]
    docs += [(2000, None, None), (2001, "", "en"), (2002, " \n ", "en"), (2003, "ok", "und"), (2004, stuffed(30_000), "en")]
    df = spark.createDataFrame(docs, "id long, text string, lang string").withColumn("n", F.lit("clash"))
    got = {r["id"]: r["share"] for r in spam.spam_share(df).collect()}
    assert {k for k, v in got.items() if v > 0.5} == {1000, 1001, 1002, 1004, 2004}
    assert not {2000, 2001, 2002} & set(got) and len(got) == 300 + 5 + 2
    assert spam.spam_share(df.where("false")).count() == 0


def test_windows_hold_all_text():
    t = "가나다 라마\n\n" + "긴 줄 " * 500 + "\n짧은 줄"
    assert "".join("".join(spam.windows(t)).split()) == "".join(t.split())


def test_language_is_of_the_whole_text():
    head, body = "hold the bridge " * 1_500, "다리를 지켜라 " * 20_000
    assert len(head) > 20_000 and spam.language(head + body, None) == spam.language(body + head, "und") == "ko"
    assert spam.language(body[:30_000] + head * 10, " ") == spam.language(head, None) == "en"


def test_the_cut_off_is_the_chi_squared_quantile():
    rng = np.random.default_rng(5)
    d = (rng.standard_normal((400_000, len(spam.NAMES))) ** 2).sum(1)
    assert abs((d > spam.far(0.01)).mean() - 0.01) < 0.001 and 55 < spam.far() < 65


def test_a_rare_language_is_judged_by_all(spark):
    prose = lambda n: " ".join(SENTENCES[i % 3] for i in range(n))
    docs = [(i, prose(5 + i % 20), "en") for i in range(200)] + [(900, prose(12), "xx"), (901, " | ".join(["miro best", "miro free"] * 120), "xx")]
    got = {r["id"]: r["share"] for r in spam.spam_share(spark.createDataFrame(docs, "id long, text string, lang string")).collect()}
    assert got[900] < 0.5 < got[901]
