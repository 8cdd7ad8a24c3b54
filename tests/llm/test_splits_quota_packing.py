import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkmill.llm import packing, quota, splits


def greedy(sizes, shares):
    total = sum(s * n for s, n in sizes)
    gap = {k: total * v / sum(shares.values()) for k, v in shares.items()}
    got = {}
    for s, n in sorted(sizes, reverse=True):
        for _ in range(n):
            k = max(gap, key=lambda x: gap[x])
            gap[k] -= s
            got[(s, k)] = got.get((s, k), 0) + 1
    return got


@pytest.mark.parametrize("seed", range(8))
def test_quotas_are_the_one_by_one_greedy(seed):
    rng = random.Random(seed)
    sizes = [(s, rng.randrange(1, 60)) for s in rng.sample(range(1, 200), rng.randrange(1, 12))]
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    got = {(s, k): hi - lo for s, k, lo, hi in splits.quotas(sizes, shares)}
    want = greedy(sizes, shares)
    assert {s: sum(n for (z, _), n in got.items() if z == s) for s, _ in sizes} == dict(sizes)
    assert sum(abs(got.get(k, 0) - want.get(k, 0)) for k in {*got, *want}) <= 2 * len(sizes)  # ties between equal gaps may fall the other way


def test_groups_stay_together_through_shared_keys(spark):
    rows = [(i, f"s{i % 50}", None if i % 3 else f"a{i % 40}", i) for i in range(600)] + [(1000 + i, None, None, 0) for i in range(5)] + [(2000 + i, "hot", None, 0) for i in range(300)]
    df = spark.createDataFrame(rows, "no long, source string, author string, size long").withColumn("root", F.lit("clash"))
    got = splits.grouped_split(df, ["source", "author"], {"train": 0.6, "test": 0.4}).collect()
    assert len(got) == len(rows)
    by_group = {}
    for r in got:
        by_group.setdefault(r["group_no"], set()).add(r["new_split"])
    assert all(len(v) == 1 for v in by_group.values())
    assert len({r["group_no"] for r in got if r["no"] >= 2000}) == 1 and len({r["group_no"] for r in got if 1000 <= r["no"] < 2000}) == 5
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for no, s, a, _ in rows[:600]:
        if a:
            up[root(("s", s))] = root(("a", a))
    want = {no: root(("s", s)) for no, s, a, _ in rows[:600]}
    have = {r["no"]: r["group_no"] for r in got if r["no"] < 600}
    assert len(set(want.values())) == len(set(have.values())) == len({(want[k], have[k]) for k in want})


def test_torn_and_families(spark):
    df = spark.createDataFrame([(1, "A_01, 쳐라", "train"), (2, "Ａ＿０２ 쳐라!", "test"), (3, None, "train"), (4, " ", "train"), (5, "E_01 쳐라", "test")], "no long, base string, part string")
    df = df.withColumn("family", splits.family(F.coalesce("base", F.lit(""))))
    assert sorted(r["no"] for r in splits.torn(df, ["base", "family"], "part").collect()) == [1, 2]
    assert splits.torn(df.where("false"), ["base", "family"], "part").count() == 0
    with pytest.raises(ValueError, match="no splits"):
        splits.assign(df.select(F.col("no").alias("group_no"), F.lit(1).alias("size")), {})


def quota_input(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["train"] * 9 + ["test"]), rng.choices(["A-x", "b ", "c", None], [60, 30, 5, 5])[0]) for i in range(3000)]
    df = spark.createDataFrame(rows, "no long, split string, v string").withColumn("n_have", F.lit(0))
    cells = quota.cells(df, {"kind": F.col("v")}, {})
    req = spark.createDataFrame([(1, "train", "kind", None, 200, 30), (2, "train", "kind", None, 3000, 5), (3, "none", "kind", None, 10, 1)], "request_no long, split string, axis string, parent string, sample_size long, min_rows long")
    dim = spark.createDataFrame([("kind", None, "a_x", 1, 70.0), ("kind", None, "B", 2, 29.0), ("kind", None, "c", 3, 1.0), ("kind", None, "d", 4, 0.0), ("kind", "p", "a_x", 1, 100.0)], "axis string, parent string, value string, ord int, target_pct double")
    return rows, cells, quota.goals(req, dim)


@pytest.mark.parametrize("seed", range(60))
def test_floors_and_shortages_are_paid_by_the_others(seed):
    rng = random.Random(seed)
    k = rng.randrange(1, 9)
    shares = [rng.choice([0, 0.0, rng.random()]) for _ in range(k)]
    floors, have = [rng.randrange(0, 30) for _ in range(k)], [rng.choice([0, rng.randrange(200)]) for _ in range(k)]
    size = rng.choice([0, rng.randrange(400)])
    x = quota.shared_out(size, shares, floors, have)
    low = [min(f, h) for f, h in zip(floors, have)]
    assert all(a - 1e-9 <= v <= h + 1e-9 for a, v, h in zip(low, x, have))
    most = sum(h if s > 0 else a for s, a, h in zip(shares, low, have))
    assert abs(sum(x) - min(max(size, sum(low)), most)) < 1e-6
    free = {round(v / s, 6) for s, a, v, h in zip(shares, low, x, have) if s > 0 and a + 1e-6 < v < h - 1e-6}
    assert len(free) <= 1  # one level for all that are neither at their floor nor used up
    for s, a, v, h in zip(shares, low, x, have):
        if free and s > 0 and v <= a + 1e-6 and a < h:
            assert max(free) * s <= a + 1e-4
    assert all(abs(v - a) < 1e-9 for s, a, v in zip(shares, low, x) if s == 0)


def test_draw_meets_shares_floors_and_reports_shortage(spark):
    rows, cells, goal = quota_input(spark)
    have = Counter({"A-x": "a_x", "b ": "B", "c": "c"}[v] for _, s, v in rows if s == "train" and v)
    got = quota.draw(cells, goal).collect()
    n = Counter((r["request_no"], r["category"]) for r in got)
    paid = (200 - min(30, have["c"])) / 99  # by the two above their floor, in the ratio of their shares
    assert n[(1, "c")] == min(30, have["c"]) and abs(n[(1, "a_x")] - 70 * paid) < 1 and abs(n[(1, "B")] - 29 * paid) < 1
    assert n[(1, "a_x")] + n[(1, "B")] + n[(1, "c")] == 200
    assert {c: n[(2, c)] for c in have} == dict(have) and (1, "d") not in n and not any(k[0] == 3 for k in n)  # fewer than 3,000 are there
    assert len({(r["request_no"], r["no"]) for r in got}) == len(got)
    out = {(r["request_no"], r["category"]): r for r in quota.outcome(cells, goal).collect()}
    short = {k for k, r in out.items() if r["is_short"]}
    assert (2, "a_x") in short and (1, "d") in short and (3, "B") in short and (1, "a_x") not in short
    assert all(r["n_drawn"] == n[k] for k, r in out.items()) and abs(out[(1, "a_x")]["share_drawn"] - n[(1, "a_x")] / 200) < 1e-9
    assert out[(3, "B")]["share_drawn"] is None
    assert sorted((r["request_no"], r["no"]) for r in quota.draw(cells, goal).collect()) == sorted((r["request_no"], r["no"]) for r in got)


def test_draw_of_nothing(spark):
    _, cells, goal = quota_input(spark)
    assert quota.draw(cells.where("false"), goal).count() == 0 and quota.draw(cells, goal.where("false")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_best_fit_against_a_plain_search(seed):
    rng = random.Random(seed)
    cap = rng.choice([7, 64, 1000])
    sizes = sorted((rng.randrange(cap + 1) for _ in range(300)), reverse=True)
    room, want = [], []
    for s in sizes:
        fit = [(r, i) for i, r in enumerate(room) if r >= s]
        if fit:
            tight = min(fit)[0]
            i = max(i for r, i in fit if r == tight)
        else:
            room.append(cap)
            i = len(room) - 1
        room[i] -= s
        want.append(tuple(sorted(room)))
    got = packing.best_fit(sizes, cap)
    used = Counter()
    for c, s in zip(got, sizes):
        used[c] += s
    assert max(used.values()) <= cap and len(used) == len(room)
    assert sorted(cap - v for v in used.values()) == sorted(room)


def test_packing_keeps_all_and_cuts_only_what_is_too_large(spark):
    items = [(1, 25), (2, 10), (3, 0), (4, None), (5, 9), (5, 9)] + [(10 + i, 1 + i % 9) for i in range(200)]
    df = spark.createDataFrame(items, "id long, size long").withColumn("shard", F.lit(0)).withColumn("piece", F.lit(0))
    limits = spark.createDataFrame([("ten", 10), ("big", 1000)], "limit_name string, capacity long")
    got = packing.pack(df, limits, shard=50).collect()
    for name, cap in (("ten", 10), ("big", 1000)):
        mine = [r for r in got if r["limit_name"] == name]
        assert sum(r["size"] for r in mine) == sum(s or 0 for _, s in items)
        fill = Counter()
        for r in mine:
            fill[r["container"]] += r["size"]
        assert max(fill.values()) <= cap
        assert {r["id"] for r in mine if r["n_pieces"] > 1} == ({1} if cap == 10 else set())
    assert packing.pack(df.where("false"), limits).count() == 0 and packing.pack(df, limits.where("false")).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, spark.createDataFrame([("none", 0)], limits.schema))
