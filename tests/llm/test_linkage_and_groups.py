import random

import pytest
from pyspark.sql import Row, functions as F

from sparkmill.functions.textnorm import py_norm
from sparkmill.llm import battle, linkage, neargroups
from sparkmill.llm.texts import py_like

SIDE = "array<struct<unitId:string,isAlive:boolean,canBeTargeted:boolean,isRanged:boolean,hpRatio:double,attackRatioToAvg:double,engagedByOpponentCount:int,teamFormationRole:string,extra:string>>"
AREA = f"struct<allies:{SIDE},enemies:{SIDE}>"
NAMES = ["unitId", "isAlive", "canBeTargeted", "isRanged", "hpRatio", "attackRatioToAvg", "engagedByOpponentCount", "teamFormationRole", "extra"]
WORDS = "공격 후퇴 A_01 E_02 다리 숲길 성문 먼저 천천히 막아라 지켜라 돌아 북쪽 남쪽 화살 방패".split()


def unit(rng, name):
    return (name, rng.random() < 0.8, rng.random() < 0.9, rng.random() < 0.5, round(rng.random(), 2), round(rng.uniform(0.5, 1.8), 2), rng.randrange(4), rng.choice(["front", "mid", None]), "x")


def field(rng):
    return [unit(rng, s) for s in battle.SLOTS]


def nudged(rng, units, n):
    out = list(units)
    for i in rng.sample(range(12), n):
        u = list(out[i])
        u[rng.choice([1, 2, 3])] ^= True
        out[i] = tuple(u)
    return [u[:4] + (round(u[4] + rng.choice([-0.02, 0, 0.02]), 2), u[5]) + u[6:] for u in out]


def text(rng):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(8))


def edited(rng, t):
    w = t.split()
    for _ in range(rng.randrange(4)):
        w[rng.randrange(len(w))] = rng.choice(WORDS)
    return " ".join(w)


def agree(a, b):
    n = 0
    for s in battle.SLOTS:
        x, y = next((u for u in a if u[0] == s), None), next((u for u in b if u[0] == s), None)
        if x and y and (x[1:4], x[6:8]) == (y[1:4], y[6:8]):
            near = lambda p, q: p is None and q is None if p is None or q is None else abs(p - q) <= 0.025 + 1e-9
            n += near(x[4], y[4]) and near(x[5], y[5])
    return n


def area(units, rng):
    a, e = [u for u in units if u[0].startswith("A")], [u for u in units if u[0].startswith("E")]
    rng.shuffle(a)
    rng.shuffle(e)
    return Row(allies=[Row(**dict(zip(NAMES, u))) for u in a], enemies=[Row(**dict(zip(NAMES, u))) for u in e])


def samples(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if out and rng.random() < 0.6:
            o = rng.choice(out)
            units = nudged(rng, o[1], rng.randrange(5)) if rng.random() < 0.8 else o[1]
            out.append((i, units, edited(rng, o[2]) if rng.random() < 0.8 else o[2], edited(rng, o[3]) if rng.random() < 0.7 else o[3]))
        else:
            out.append((i, field(rng), text(rng), text(rng)))
    u = field(rng)
    out += [(n, u[:8], "다섯 여섯", "일곱 여덟"), (n + 1, u[:8], "다섯 여섯", "일곱 여덟"), (n + 2, u, "", "일곱"), (n + 3, u, "", "일곱"), (n + 4, u, None, None), (n + 5, u, "긴 " * 4000, "말 "), (n + 6, u, "긴 " * 4000, "말 가")]
    holed = [x[:4] + (None,) + x[5:] for x in u]
    out += [(n + 7, holed, "빈칸 있는 명령", "생각은 같다"), (n + 8, holed, "빈칸 있는 명령!", "생각은 같다"), (n + 9, u, "빈칸 있는 명령", "생각은 같다")]
    return out, rng


def frame(spark, rows, rng, batches=None):
    data = [(i, None if batches is None else batches[i], f"id{i % 7}", t, s, area(u, rng), 1, "clash") for i, u, t, s in rows]
    return spark.createDataFrame(data, f"no long, batch long, id string, text string, second string, area {AREA}, eid int, units string")


@pytest.mark.parametrize("heavy", [None, 1])
def test_groups_against_all_pairs(spark, heavy, monkeypatch):
    if heavy:
        monkeypatch.setattr(battle, "boundary", lambda mean: heavy)
    rows, rng = samples(5, 90)
    up = {i: i for i, *_ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, u, t, s in rows:
        for j, v, t2, s2 in rows:
            if j < i and agree(u, v) >= 9 and py_like(py_norm(t), py_norm(t2)) >= 0.6 and py_like(py_norm(s), py_norm(s2)) >= 0.6:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    want = {(i, root(i)) for i in up if root(i) != i}
    df = frame(spark, rows, rng)
    got = neargroups.near_groups(df.unionAll(df.limit(0)), F.col("no"), F.col("area"), F.col("text"), F.col("second")).collect()
    assert {(r["no"], r["group_no"]) for r in got if r["no"] != r["group_no"]} == want
    assert len(got) == len({r["no"] for r in got}) and all(r["n_links"] > 0 for r in got)


def test_no_records(spark):
    rows, rng = samples(1, 3)
    df = frame(spark, rows, rng).where("false")
    assert neargroups.near_groups(df, F.col("no"), F.col("area"), F.col("text"), F.col("second")).count() == 0


def links_of(rows, batches):
    out = set()
    for i, u, t, _ in rows:
        for j, v, t2, _ in rows:
            bi, bj = batches[i], batches[j]
            if bi is not None and (bj is None or bj < bi) and agree(u, v) >= 9 and py_like(py_norm(t), py_norm(t2)) >= 0.6:
                out.add((min(i, j), max(i, j)))
    return out


@pytest.mark.parametrize("heavy", [64, 1])
def test_batches_one_by_one_and_at_once(spark, heavy, monkeypatch):
    monkeypatch.setattr(battle, "boundary", lambda mean: heavy)
    rows, rng = samples(9, 80)
    batches = {i: None if i < 40 else (i - 40) // 20 for i, *_ in rows}
    want = links_of(rows, batches)
    df = frame(spark, rows, rng, batches)
    old, new = df.where("batch is null"), df.where("batch is not null")
    at_once = linkage.LinkageStore(spark)
    at_once.load(old)
    got = at_once.absorb(new).cache()
    assert {(r["known_no"], r["incoming_no"]) for r in got.collect()} == want and got.count() == len(want)
    assert want
    if heavy == 1:
        return
    store = linkage.LinkageStore(spark)
    store.load(old)
    one_by_one = set()
    for b in range(3):
        links = store.absorb(new.where(F.col("batch") == b)).cache()
        one_by_one |= {(r["known_no"], r["incoming_no"]) for r in links.collect()}
        store.merge(links)
    assert one_by_one == want
    at_once.merge(got)
    reps = lambda s: {(r["no"], r["rep"]) for r in s.representatives().collect()}
    assert reps(store) == reps(at_once)


def test_an_empty_history_and_an_empty_batch(spark):
    rows, rng = samples(2, 6)
    df = frame(spark, rows, rng, {i: 1 for i, *_ in rows})
    store = linkage.LinkageStore(spark)
    store.load(df.where("false"))
    assert store.absorb(df.where("false")).count() == 0
    assert store.absorb(df).count() == 0
    assert store.absorb(df.withColumn("batch", F.lit(2)).withColumn("no", F.col("no") + 1000)).count() > 0


def test_weights_rise_with_agreement():
    w = linkage.learn_weights([(0, 0, 0, 900), (4, 3, 0, 60), (3, 3, 0, 20), (1, 0, 0, 50), (4, 3, 1, 5)])
    assert all(x == sorted(x) for x in w.values()) and w["l_text"][4] > w["l_text"][0]
    assert linkage.learn_weights([])["l_id"] == [0.0, 1.0]


def seen(df):
    return {(r["known_no"], r["incoming_no"]) for r in df.collect()}


def test_a_reopened_store_is_the_one_that_stayed_open(spark, tmp_path, monkeypatch):
    rows, rng = samples(9, 80)
    batches = {i: None if i < 40 else (i - 40) // 20 for i, *_ in rows}
    df = frame(spark, rows, rng, batches).cache()
    of = lambda b: df.where(F.col("batch") == b)
    path = str(tmp_path / "store")
    linkage.LinkageStore(spark, path).load(df.where("batch is null"))
    linkage.LinkageStore(spark, path).load(df.where("batch is null"))  # loaded once
    for b in (0, 1):
        store = linkage.LinkageStore(spark, path)
        store.merge(store.absorb(of(b), f"batch {b}"))
    with monkeypatch.context() as m:  # a round that fails before it is told leaves nothing that counts
        m.setattr(linkage.LinkageStore, "_commit", lambda self, name: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            linkage.LinkageStore(spark, path).absorb(of(2), "batch 2")
    store = linkage.LinkageStore(spark, path)
    links = store.absorb(of(2), "batch 2")
    store.merge(links)
    assert seen(links) == {p for p in links_of(rows, batches) if batches[p[1]] == 2 or batches[p[0]] == 2}
    again = linkage.LinkageStore(spark, path)
    assert seen(again.absorb(of(2), "batch 2")) == seen(links) and again.round == store.round == 4
    again.merge(links)
    once = linkage.LinkageStore(spark)
    once.load(df.where("batch is null"))
    once.merge(once.absorb(df.where("batch is not null")))
    reps = lambda s: {(r["no"], r["rep"]) for r in s.representatives().collect()}
    assert seen(again.links()) == links_of(rows, batches) == seen(once.links()) and reps(again) == reps(once)
    assert set(again.weights) == {"l_text", "l_units", "l_id"} and sum(again.patterns.values()) > 0


def test_a_batch_reads_its_own_buckets_only(spark):
    rng = random.Random(3)
    for n in (60, 240):
        rows = [(i, field(rng), text(rng), "") for i in range(n)]
        store = linkage.LinkageStore(spark, per_bucket=2)
        store.load(frame(spark, rows, rng))
        new = [(9000, rows[0][1], rows[0][2], "")]
        assert seen(store.absorb(frame(spark, new, rng, {9000: 1}))) == {(0, 9000)}
        assert store.buckets == n // 2 and store.read["keys"] <= 32 and store.read["contents"] <= 8 and store.read["members"] == 1


@pytest.mark.parametrize(("a", "b", "same"), [(0.1, 0.125, True), (0.1, 0.125004, False), (30_000.0, 50_000.0, False), (30_000.0, 30_000.02, True), (None, None, True), (None, 0.0, False), (0.45, 0.425, True), (-1e18, -1e18, True), (float("nan"), 0.1, False)])
def test_ratios_are_compared_as_they_are(spark, a, b, same):
    rng = random.Random(1)
    one = [u[:4] + (0.5, 0.5) + u[6:] for u in field(rng)]
    two = list(one)
    for i in range(0, 12, 3):  # one unit in each group, four in all
        one[i], two[i] = one[i][:4] + (a,) + one[i][5:], two[i][:4] + (b,) + two[i][5:]
    rows = [(1, one, "다리를 지켜라", "생각한다"), (2, two, "다리를 지켜라", "생각한다")]
    df = frame(spark, rows, rng)
    got = neargroups.near_groups(df, F.col("no"), F.col("area"), F.col("text"), F.col("second")).count()
    assert got == (2 if same else 0)
