"""The queries over the smallest tables: against SQL where there is some, else against brute force in plain Python."""

import math
import re
import unicodedata
from collections import Counter, defaultdict

import pytest

from sparkmill import session
from sparkmill.llm import battle, queries


def rows_of(spark, sf, name):
    return [r.asDict(recursive=True) for r in spark.read.parquet(f"{sf}/{name}.parquet").collect()]


def norm(x):
    return "".join(c for c in unicodedata.normalize("NFKC", x or "").lower() if unicodedata.category(c)[0] in "LN")


def pieces(x):
    t = norm(x)
    return frozenset(zip(t, t[1:]))


def like(a, b):
    n = len(a & b)
    return n / (len(a) + len(b) - n) if a or b else 0


def part(s):
    s = (s or "").strip().lower()
    return {"": "train", "val": "validation"}.get(s, s)


def base(r):
    b = r["command_spec"]["base_command_text"]
    return b if b and b.strip() else r["command_spec"]["command_text"]


def units(r):
    area = r["input"]["input"]["area_situation"]
    return {u["unitId"]: u for side in ("enemies", "allies") for u in reversed(area[side] or [])}


def same_field(a, b):
    n = 0
    for k, x in a.items():
        y = b.get(k)
        if y and all(x[f] == y[f] for f in ("isAlive", "canBeTargeted", "isRanged", "teamFormationRole", "engagedByOpponentCount")):
            near = [x[f] is y[f] is None or None not in (x[f], y[f]) and abs(x[f] - y[f]) <= 0.025 + 1e-9 for f in ("hpRatio", "attackRatioToAvg")]
            n += all(near)
    return n >= 9


@pytest.fixture(scope="module")
def truth(spark, sf):
    accepted, incoming = rows_of(spark, sf, "accepted_samples"), rows_of(spark, sf, "incoming_samples")
    out = defaultdict(set)
    for r in accepted + incoming:
        r["u"], r["c"] = units(r), pieces(r["command_spec"]["command_text"])
    for i in incoming:
        for k in accepted + incoming:
            known = "batch_no" not in k or None not in (k["batch_no"], i["batch_no"]) and k["batch_no"] < i["batch_no"]
            if k is not i and known and like(i["c"], k["c"]) >= 0.6 and same_field(i["u"], k["u"]):
                out["p1_found"].add(tuple(sorted((k["sample_no"], i["sample_no"]))))
    parts = defaultdict(set)
    family = lambda r: re.sub(r"([ae])_[0-9]{2}", r"\1", re.sub(r"\W", "", unicodedata.normalize("NFKC", base(r) or "").lower())).replace("_", "")
    for r in accepted:
        parts[family(r)].add(part(r["split"]))
        r["t"], r["b"] = pieces(r["output"]["thinking"]), pieces(base(r))
    out["p2_found"] = {(r["sample_no"],) for r in accepted if len(parts[family(r)]) > 1}
    up = {r["sample_no"]: r["sample_no"] for r in accepted}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(accepted):
        for b in accepted[:i]:
            alike = like(a["c"], b["c"]) >= 0.6
            if alike and like(a["t"], b["t"]) >= 0.6 and same_field(a["u"], b["u"]):
                x, y = root(a["sample_no"]), root(b["sample_no"])
                up[max(x, y)] = min(x, y)
            if (part(a["split"]) == "train") != (part(b["split"]) == "train") and (alike or like(a["b"], b["b"]) >= 0.6):
                out["p7_found"].add(tuple(sorted((a["sample_no"], b["sample_no"]))))
    out["p4_found"] = {(root(k), k) for k in up if root(k) != k}
    runs = defaultdict(set)
    for r in rows_of(spark, sf, "eval_items"):
        t = norm(r["text"])
        for k in range(len(t) - 39):
            runs[t[k : k + 40]].add(r["item_id"])
    for r in rows_of(spark, sf, "documents"):
        t = norm(r["text"])
        for k in range(len(t) - 39):
            out["p9_found"] |= {(r["doc_id"], i) for i in runs.get(t[k : k + 40], ())}
    return out


@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p4_found", "p7_found", "p9_found"])
def test_found_is_what_brute_force_finds(spark, sf, truth, name):
    got = [tuple(r) for r in queries.QUERIES[name](spark, sf).collect()]
    assert sorted(got) == sorted(truth[name]) and got


@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p4_found", "p7_found", "p9_found", "p5_draw"])
def test_nothing_hangs_on_broadcasts(spark, sf, monkeypatch, name):
    want = sorted(map(tuple, queries.QUERIES[name](spark, sf).collect()))
    monkeypatch.setattr(battle, "BROADCAST_IDS", 0)
    monkeypatch.setattr(battle.small, "__defaults__", (0,))
    monkeypatch.setattr(session.mark_small, "__defaults__", (0, None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, queries.QUERIES[name](spark, sf).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def canon(rows, cols):
    at = sorted(range(len(cols)), key=lambda i: cols[i])
    clean = lambda v: (None if math.isnan(v) else round(v, 5)) if isinstance(v, float) else v
    return sorted((tuple(clean(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_as_sql(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("accepted_samples", "incoming_samples", "documents", "pack_limits", "sample_requests", "taxonomy_dim", "split_targets"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    got = queries.QUERIES[name](spark, sf)
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(got.columns) == sorted(cols)
    assert canon([tuple(r) for r in got.collect()], got.columns) == canon(cur.fetchall(), cols)


def test_reports_say_what_the_pairs_say(spark, sf, truth):
    m = queries.QUERIES["p7_methods"](spark, sf).first()
    assert m["n_pairs"] == len(truth["p7_found"]) == m["n_by_spans"] + m["n_by_join_only"] + m["n_same_text"]
    assert sum(r["n_pairs"] for r in queries.QUERIES["p7_counts"](spark, sf).collect()) == len(truth["p7_found"])
    out = queries.QUERIES["p5_outcome"](spark, sf).collect()
    drawn = Counter((r["request_no"], r["category"]) for r in queries.QUERIES["p5_draw"](spark, sf).collect())
    assert all(r["n_drawn"] == drawn[(r["request_no"], r["category"])] <= r["n_have"] for r in out)
    cover = queries.QUERIES["p7_coverage"](spark, sf).collect()
    assert cover and all(0 <= r[f"{n}_covered"] <= 1 and (r[f"{n}_longest"] >= 8 or r[f"{n}_covered"] == 0) for r in cover for n in ("command", "base"))
    unused = queries.QUERIES["p8_unused"](spark, sf).collect()
    assert len(unused) == 3 and all(0 <= r["unused"] < 0.2 for r in unused)
    aligned = {(r["doc_id"], r["item_id"]): r for r in queries.QUERIES["p9_alignments"](spark, sf).collect()}
    assert truth["p9_found"] <= set(aligned) and all(0 < r["share"] <= 1 for r in aligned.values())
    share = {r["doc_id"]: r["spam_share"] for r in queries.QUERIES["p10_share"](spark, sf).collect()}
    assert {r["doc_id"] for r in queries.QUERIES["p10_found"](spark, sf).collect()} == {k for k, v in share.items() if v > 0.5} and all(0 <= v <= 1 for v in share.values())
