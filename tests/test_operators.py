import random

import pytest
from pyspark.sql import functions as F

from sparkmill.operators import chat, components, coverage, dedup, planner, pool, rank, rules, runs, sanitize, score


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("most", [3, 60, components.MERGE])
@pytest.mark.parametrize("seed", range(2))
def test_components_against_one_union_find(spark, seed, most):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, k) for k in range(5001, 5100)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    loose = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    want = {(x, root(x)) for x in up if x not in loose}
    got = components.connected_components(spark.createDataFrame(links + [(1, None)], "a long, b long").repartition(7), most=most)
    assert set(rows(got)) == want and got.count() == len(want)


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("per_task", [3, 1000])
def test_ranks_are_a_permutation_of_each_group(spark, per_task):
    df = spark.range(100).select("id", F.when(F.col("id") < 70, "a").when(F.col("id") < 99, "b").alias("g"))
    got = rank.ranked(df, ["g"], F.xxhash64("id"), per_task=per_task).collect()
    for g, n in (("a", 70), ("b", 29), (None, 1)):
        assert sorted(r["rank"] for r in got if r["g"] == g) == list(range(n))


@pytest.mark.parametrize("hot", [2, 1000])
def test_join_by_a_hot_key(spark, hot):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}", "x") for i in range(60)] + [(99, None, "x")], "i int, k string, v string")
    small = spark.createDataFrame([("hot", 40, 1), *[(f"k{i}", 1, i) for i in range(0, 60, 6)]], "k string, n long, v2 int")
    got = rank.spread_join(big, small, "k", "n", hot=hot, most=0)
    assert rows(got, "i") == rows(big.join(small, "k"), "i") and "v2" in got.columns and "n" not in got.columns


def test_rollup_shares_and_spine(spark):
    leaves = spark.createDataFrame([("a", "x", 3), ("a", None, 1), ("b", "x", 4)], "p string, q string, n long")
    got = {(r["p"], r["q"], r["depth"]): (r["n"], r["share"]) for r in coverage.rollup_shares(leaves, ["p", "q"]).collect()}
    assert got[(None, None, 0)] == (8, 1.0) and got[("a", None, 1)] == (4, 0.5)
    assert got[("a", "unknown", 2)] == (1, 0.25) and got[("b", "x", 2)] == (4, 1.0)
    dim = spark.createDataFrame([("a",), ("c",)], "p string")
    assert rows(coverage.spine(dim, coverage.counted(leaves, ["p"]), ["p"])) == [("a", 2), ("c", 0)]


def test_slot_index_ties_by_first_seen(spark):
    df = spark.createDataFrame([("p", "b", 1), ("p", "a", 2), ("p", "b", 3)], "path string, text string, at int")
    assert rows(coverage.slot_index(df, ["path"], "text", "at"), "text", "slot", "n") == [("a", 1, 1), ("b", 2, 2)]


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([("l", "x", 1), ("l", "x", 2), ("l", None, 3), ("l", None, 4), ("l", "", 5), ("m", "x", 6)], "leaf string, k string, at int")
    s = dedup.duplicate_stats(df, ["leaf"], F.col("k"))
    assert rows(s) == [("l", 5, 3, 2, 2, 2), ("m", 1, 1, 0, 0, 1)]
    assert rows(dedup.totals(s, True)) == [(1, 5, 2, 2)]
    assert rows(dedup.keep_first(df, ["leaf", "k"], "at"), "at") == [(1,), (3,), (5,), (6,)]


def test_pool_and_cycle(spark):
    df = spark.createDataFrame([("t", "b", 1), ("t", "a", 2), ("t", "b", 3), ("t", "c", 4), ("v", "a", 5), ("v", None, 6)], "split string, k string, at int")
    assert rows(pool.first_distinct(df, ["split"], "k", "at", 2), "split", "k", "place") == [("t", "a", 2), ("t", "b", 1), ("v", "a", 1)]
    assert rows(pool.reserved_elsewhere(df, "split", "k"), "split", "k") == [("t", "a"), ("v", "a")]
    one = spark.createDataFrame([(5, 2, 1), (0, 2, 1), (3, 0, 0)], "n int, p int, o int")
    assert rows(pool.cycle_plan(one, F.col("n"), F.col("p"), F.col("o")), "output", "source") == [(1, 2), (2, 1), (3, 2), (4, 1), (5, 2)]
    assert rows(pool.policy(one, F.col("n"), F.col("p"), 3), "n_new", "n_cycle") == [(0, 0), (1, 4), (3, 0)]


def test_chunks_intervals_and_limits(spark):
    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", None), ("d", 3)], "k string, n long")
    assert rows(planner.chunks(df, F.col("n"), 3), "k", "chunk_no", "chunk_size") == [("a", 0, 3), ("a", 1, 3), ("a", 2, 1), ("d", 0, 3)]
    items = spark.createDataFrame([("g", 1, 2), ("g", 2, 0), ("g", 3, 1)], "g string, item int, n long")
    out = spark.createDataFrame([("g", i) for i in range(5)], "g string, pos long")
    assert rows(planner.assign_intervals(items, out, ["g"], "n", ["item"], "pos"), "pos", "item") == [(0, 1), (1, 1), (2, 3)]
    assert rows(planner.within_limit(items, F.col("n"), F.lit(2), ["g"], ["item"]), "item") == [(1,), (2,)]


def test_greedy_pairs(spark):
    df = spark.createDataFrame([("s", 1, "a", 4, 1), ("s", 2, "a", 4, 2), ("s", 3, "b", 5, 3), ("s", 4, "b", 2, 4), ("t", 5, "a", 9, 1)], "g string, item long, k string, n long, at int")
    assert rows(planner.greedy_pairs(df, "g", "item", "k", "n", "at", 9)) == [("s", 1, 3), ("s", 2, 4), ("t", 5, None)]


def test_rules(spark):
    df = spark.createDataFrame([(1, ["move", "attack", "attack"], '{"a":1,"b":2}', 5), (2, None, "{}", None)], "i int, k array<string>, j string, v int")
    r = [rules.followed_by("AFTER", F.col("k"), ["move", "attack"], "attack"), rules.keys_are_not("KEYS", F.col("j"), ["b", "a"]), rules.out_of_range("V", F.col("v"), 6), rules.repeated("TWICE", F.coalesce("k", F.array().cast("array<string>")))]
    got = {x["i"]: (x["failure_reasons"], x["passed"]) for x in rules.validate(df, r).collect()}
    assert got == {1: (["AFTER", "AFTER", "TWICE", "V"], False), 2: (["KEYS"], False)}
    assert rows(rules.validate(df, []), "passed") == [(True,), (True,)]


@pytest.mark.parametrize(
    ("near", "far", "c", "codes"),
    [(None, None, [], []), ("a", None, [], ["X_SHOULD_BE_NULL"]), ("a", "a", ["a"], []), ("a", "b", ["a"], ["X_FAR_OUTSIDE", "X_SINGLE_MISMATCH"]),
     ("a", "b", ["a", "b"], []), ("a", "a", ["a", "b"], ["X_SHOULD_DIFFER"]), (None, None, ["a", "b"], ["X_FAR_OUTSIDE", "X_NEAR_OUTSIDE", "X_SHOULD_DIFFER"])],
)
def test_pointers(spark, near, far, c, codes):
    df = spark.createDataFrame([(near, far, c)], "n string, f string, c array<string>")
    assert rules.validate(df, rules.pointer_pair("X", F.col("n"), F.col("f"), F.col("c"))).first()["failure_reasons"] == codes


def test_fold_looks_at_what_is_kept(spark):
    t = "array<struct<type:string>>"
    df = spark.createDataFrame([([("attack",), ("wait",), ("move",), ("wait",), ("attack",)],), (None,)], f"s {t}")
    kept = df.select(sanitize.folded(F.col("s"), "type", {"wait": ["attack"]}, 3, t)["type"].alias("k")).collect()
    assert [r["k"] for r in kept] == [["attack", "move", "wait"], []]


def test_chat(spark):
    df = spark.createDataFrame([("u", "a"), ("u", None)], "u string, a string").select(chat.messages(F.lit("s"), F.col("u"), F.col("a")).alias("m"))
    assert rows(df.select(chat.contract(F.col("m")))) == [(False,), (True,)]
    r = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "x")], "n int, k string")
    s = spark.createDataFrame([(10, "x"), (11, "x")], "m int, k string")
    assert rows(chat.restore(r, s, "k", "n", "m", True), "n", "m") == [(1, 10), (2, 11), (3, None), (4, None)]
    assert rows(chat.restore(r, s, "k", "n", "m", False), "n", "m") == [(1, 10), (2, 10), (3, None), (4, 10)]


def test_scores(spark):
    df = spark.createDataFrame([("a", True, 1.0), ("a", None, 3.0), (None, True, None)], "g string, ok boolean, v double")
    how = ({"ok": F.col("ok")}, {"v": F.col("v")})
    s = score.summary(df, [], *how).first()
    assert (s["n"], round(s["ok_rate"], 6), s["v_mean"], s["v_p50"]) == (3, 0.666667, 2.0, 2.0)
    parts = score.breakdown(df, {"g": F.col("g")}, *how)
    assert rows(parts, "axis", "value", "n") == [("g", "a", 2), ("g", "unknown", 1)]
    assert rows(score.breakdown_check(parts, 3), "n_unknown", "is_whole") == [(1, True)]
    empty = score.summary(df.where("false"), [], *how).first()
    assert empty["n"] == 0 and empty["ok_rate"] is None and empty["v_p95"] is None


@pytest.mark.parametrize("accuracy", [10, 1000])
def test_percentiles_are_exact(spark, accuracy):
    rng = random.Random(accuracy)
    data = [(rng.choice(["a", "a", "b", None]), rng.choice([None, rng.random(), float(rng.randrange(5))])) for _ in range(3000)] + [("one", 4.0), ("none", None)]
    got = rank.percentiles(spark.createDataFrame(data, "g string, v double").repartition(5), ["g"], {"v": F.col("v")}, (0.0, 0.25, 0.5, 0.95, 1.0), accuracy)
    for r in got.collect():
        held = sorted(v for g, v in data if g == r["g"] and v is not None)
        for p in (0, 25, 50, 95, 100):
            at = p / 100 * (len(held) - 1)
            low = int(at)
            want = held[low] + (held[min(low + 1, len(held) - 1)] - held[low]) * (at - low) if held else None
            assert r[f"v_p{p}"] == want or abs(r[f"v_p{p}"] - want) < 1e-9
    assert got.count() == 5


def test_running_sums_over_ranges(spark):
    rng = random.Random(4)
    data = [("hot" if i % 3 else rng.choice(["x", None]), rng.randrange(50), rng.choice([None, 1, 2, 7]), i) for i in range(400)]
    got = rank.running(spark.createDataFrame(data, "g string, o int, v int, i int").repartition(7), F.col("v"), ["g"], ["o", "i"], "before").collect()
    for r in got:
        assert r["before"] == sum(v or 0 for g, o, v, i in data if g == r["g"] and (o, i) < (r["o"], r["i"]))
    assert len(got) == 400


@pytest.mark.parametrize("width", [3, 10_000])
def test_intervals_against_all_places(spark, width):
    rng = random.Random(width)
    items = [(rng.choice("ab"), i, rng.choice([None, 0, 1, 5, 20])) for i in range(40)]
    outs = [(rng.choice("abc"), rng.randrange(150), f"o{i}") for i in range(200)] + [("a", -1, "neg")]
    want = []
    for g, pos, o in outs:
        at = 0
        for h, i, n in items:
            if h == g and n:
                if at <= pos < at + n:
                    want.append((g, i, n, pos, o))
                at += n
    got = planner.assign_intervals(spark.createDataFrame(items, "g string, item int, n int"), spark.createDataFrame(outs, "g string, pos int, o string"), ["g"], "n", ["item"], "pos", width)
    assert rows(got) == sorted(want, key=repr)


def test_greedy_pairs_against_a_plain_search(spark):
    rng = random.Random(2)
    data = [("g", i, rng.choice(["a", "b", "c", None]), rng.randrange(1, 10)) for i in range(60)]
    free, want = list(data), []
    while free:
        first = free.pop(0)
        mate = next((x for x in free if x[2] != first[2] and x[3] + first[3] <= 10), None)
        if mate:
            free.remove(mate)
        want.append(("g", first[1], mate and mate[1]))
    df = spark.createDataFrame([(*d, d[1]) for d in data], "g string, item long, k string, n long, at int")
    assert rows(planner.greedy_pairs(df, "g", "item", "k", "n", "at", 10)) == sorted(want, key=repr)


def test_runs(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "i int, l string"), spark.createDataFrame([(2, "q"), (3, "r")], "i int, r string")
    assert rows(runs.reconcile(a, b, ["i"], {"l": "-", "r": "-"}), "i", "l", "r", "status") == [(1, "x", "-", "no_response"), (2, "y", "q", "ok"), (3, "-", "r", "no_request")]
    names = spark.createDataFrame([("a_0007.jsonl",), ("b",)], "n string")
    assert names.agg(runs.next_number(F.col("n"), r"_(\d{4})\.")).first()[0] == 8
    assert names.where("false").agg(runs.next_number(F.col("n"), r"_(\d{4})\.")).first()[0] == 1
