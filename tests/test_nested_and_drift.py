import json
import random

import pytest
from pyspark.sql import functions as F

from sparkmill.operators import dewey, drift
from sparkmill.plans.catalogue import QUERIES

LISTS = ["output.action", "output.action.sequence"]


def item(k):
    return {"type": k}


RAWS = [
    (1, json.dumps({"id": "a", "output": {"action": [{"unitId": "A_01", "sequence": [item("x"), None, item("y")]}]}})),
    (1, json.dumps({"id": "a", "output": {"action": [{"unitId": "A_01", "sequence": [item("x"), None, item("y")]}]}})),  # delivered twice
    (2, json.dumps([{"output": json.dumps({"action": {"unitId": None, "sequence": item("z")}})}, "odd", {"output": {"action": None}}])),
    (3, json.dumps({"samples": [{"output": {"action": json.dumps([{"sequence": json.dumps([item("w")])}])}}]})),
    (4, '{"output": {"action": [{"sequence": [{"type": NaN}]}]}}'),
    (5, '{"output": {}} trailing'),
    (6, ""),
    (7, None),
    (None, '{"output": {"action": {"sequence": {"type": "lost"}}}}'),
    (8, "[]"),
    (9, json.dumps({"output": {"action": [{"unitId": "A_02", "sequence": [{"type": "long", "text": "가" * 200_000}]}]}})),
]


def test_labels_places_and_parents(spark):
    df = spark.createDataFrame(RAWS, "record_no long, raw string").withColumns({"path": F.lit("clash"), "fields": F.lit(1)})
    nodes = dewey.label(df, "record_no", "raw", LISTS)
    items = dewey.flat(nodes, LISTS[1], {"type": "type"}).collect()
    got = {(r["key"], r["label"], r["parent_label"], tuple(r["places"]), r["type"]) for r in items}
    assert got == {
        (1, "0.0.0", "0.0", (0, 0, 0), "x"), (1, "0.0.2", "0.0", (0, 0, 2), "y"), (2, "0.0.0", "0.0", (0, 0, 0), "z"),
        (3, "0.0.0", "0.0", (0, 0, 0), "w"), (9, "0.0.0", "0.0", (0, 0, 0), "long"),
    }
    assert len(items) == len(got)
    actions = {(r["key"], r["label"]) for r in dewey.flat(nodes, LISTS[0], {}).collect()}
    assert {(k, p) for k, _, p, _, _ in got} <= actions
    records = {(r["key"], r["label"]) for r in dewey.flat(nodes, "", {}).collect()}
    assert records == {(1, "0"), (2, "0"), (2, "2"), (3, "0"), (9, "0")}


def test_tables_hold_every_field(spark, tmp_path):
    ally = {"unitId": "A_01", "hpRatio": 0.5, "skillDescription": "s", "IsSkillOnSelf": False, "isSkillAoe": True, "farthestAliveAlly": "A_06", "mood": {"now": "calm"}}
    act = {"unitId": "A_01", "note": "n", "sequence": [{"type": "x", "speed": 2}]}
    record = {
        "id": "a", "command_spec": {"command_text": "c", "slots": {"target": ["E_01"], "actors": ["A_01"], "mentioned_units": ["E_02"], "pace": "fast"}},
        "metadata": {"intent_family": "i", "edge_flags": ["f"], "reviewer": "r"}, "output": {"dialog": [{"unitId": "A_01", "text": "yes"}], "action": [act]},
        "input": {"input": {"command": "c", "area_situation": {"allies": [ally], "enemies": [{"unitId": "E_01", "isRanged": True}]}}},
    }
    rows = [(1, json.dumps(record)), (1, json.dumps(record)), (2, json.dumps({"input": {"command": "d", "area_situation": {"allies": {"unitId": "A_02"}}}}))]
    spark.createDataFrame(rows, "record_no long, raw string").write.parquet(f"{tmp_path}/raw_generations.parquet")

    def got(name):
        out = {}
        for r in QUERIES[name](spark, str(tmp_path)).collect():
            r = r.asDict()
            rest = json.loads(r.pop("rest"))
            place = r.pop("record_no"), r.pop("path").rpartition(".")[2], r.pop("label"), r.pop("parent_label")
            assert place not in out
            out[place] = {k: v for k, v in r.items() if v is not None}, rest
        return out

    assert got("p3_units") == {
        (1, "allies", "0.0", "0"): ({"unitId": "A_01", "hpRatio": "0.5", "skillDescription": "s", "IsSkillOnSelf": "false", "isSkillAoe": "true", "farthestAliveAlly": "A_06"}, {"mood.now": "calm"}),
        (1, "enemies", "0.0", "0"): ({"unitId": "E_01", "isRanged": "true"}, {}), (2, "allies", "0.0", "0"): ({"unitId": "A_02"}, {}),
    }
    assert got("p3_records") == {
        (1, "", "0", None): (
            {
                "id": "a", "command_text": "c", "slots_target": '["E_01"]', "slots_actors": '["A_01"]', "slots_mentioned_units": '["E_02"]', "intent_family": "i", "edge_flags": '["f"]',
                "dialog": '[{"text":"yes","unitId":"A_01"}]', "input_input_command": "c",
            },
            {"command_spec.slots.pace": "fast", "metadata.reviewer": "r"},
        ),
        (2, "", "0", None): ({"input_command": "d"}, {}),
    }
    assert got("p3_actions") == {(1, "action", "0.0", "0"): ({"unit_id": "A_01"}, {"note": "n"})}
    assert got("p3_items") == {(1, "sequence", "0.0.0", "0.0"): ({"type": "x"}, {"speed": "2"})}


def test_no_records(spark):
    assert dewey.label(spark.createDataFrame([], "k long, r string"), "k", "r", LISTS).count() == 0


def lines(spark, files):
    rows = [(feed, no, f"{feed}_{no}", i, r if isinstance(r, str) or r is None else json.dumps(r)) for (feed, no), rs in files.items() for i, r in enumerate(rs)]
    return spark.createDataFrame(rows, "feed string, file_no int, file_name string, line_no int, raw string").withColumn("path", F.lit("clash")).withColumn("types", F.lit(0))


FILES = {
    ("f", 0): [{"a": {"x": 1, "old": "p"}, "n": None}, {"a": {"x": 2, "old": "q"}}, "broken {", "", None],
    ("f", 1): [{"a": {"x": "1", "new": "p"}, "n": 3}, {"a": {"new": "r"}}, {"a": {"new": "r"}}],
    ("f", 2): [{"a": {"new": "zz", "other": ["u", 2]}, "n": None}],
    ("g", 5): [{"k": []}],
    ("g", 9): [{"k": [1]}, {"k": [1]}],
    (None, 1): [{"k": 1}],
}


def test_changes(spark):
    got = {tuple(r) for r in drift.changes(lines(spark, FILES)).select("feed", "file_no", "change", "old_path", "new_path").collect()}
    assert got == {
        ("f", 1, "renamed", "a.old", "a.new"), ("f", 1, "retyped", "a.x", "a.x"),
        ("f", 2, "removed", "a.x", ""), ("f", 2, "added", "", "a.other"),
    }


def test_one_consistent_table(spark):
    df = lines(spark, FILES)
    got = {(r["feed"], r["file_no"], r["line_no"]): r["fields"] for r in drift.unified(df, drift.changes(df)).collect()}
    assert got[("f", 0, 0)] == {"a.x": "1", "a.old": "p"} and got[("f", 1, 0)] == {"a.x": "1", "a.old": "p", "n": "3"}
    assert got[("f", 2, 0)] == {"a.old": "zz", "a.other": '["u",2]'}
    assert len(got) == 10


def test_names_that_return_lose_no_value(spark):
    files = [
        [("p", {"a": "p"}), ("p", {"b": "p"}), ("p", {"b": "p", "a": "z"}), ("p", {"a": "z"}), ("p", {"b": "p", "a": "z"}), ("p", {"c": "p", "a": "z"})],
        [("q", {"a": "p"}), ("q", {"b": "p"}), ("q", {"a": "z"}), ("q", {"a": "z", "b": "p"})],
    ]
    df = lines(spark, {(feed, no): [{"s": r}] for rows in files for no, (feed, r) in enumerate(rows)})
    found = drift.changes(df)
    got = {(r["feed"], r["file_no"]): r["fields"] for r in drift.unified(df, found).collect()}
    assert [got["p", k] for k in range(6)] == [{"s.a": "p"}, {"s.a": "p"}, {"s.a": "p", "s.a@2": "z"}, {"s.a@2": "z"}, {"s.a": "p", "s.a@2": "z"}, {"s.a": "p", "s.a@2": "z"}]
    assert [got["q", k] for k in range(4)] == [{"s.a": "p"}, {"s.a": "p"}, {"s.a": "z"}, {"s.a": "z", "s.b": "p"}]


def test_no_lines(spark):
    assert drift.changes(lines(spark, {("f", 0): [None]}).where("false")).count() == 0


@pytest.mark.parametrize(
    ("pairs", "want"),
    [([("a", "x", 2.0), ("a", "y", 1.9), ("b", "x", 1.9)], {("a", "y"), ("b", "x")}), ([("a", "x", 1.0)], {("a", "x")}), ([("a", "x", 1.0), ("b", "x", 1.5)], {("b", "x")})],
)
def test_matching_is_of_largest_weight(pairs, want):
    assert set(drift.matching(pairs)) == want


@pytest.mark.parametrize("size", [4, drift.SKETCH])
def test_sketches_close_no_pair_that_is_a_rename(spark, size, monkeypatch):
    monkeypatch.setattr(drift, "SKETCH", size)
    rng = random.Random(size)
    files, want = {}, set()
    for f in range(12):
        old = [f"v{rng.randrange(60)}" for _ in range(60)]
        share = rng.choice([0, 0.3, 0.45, 0.5, 0.6, 1])
        new = [rng.choice(old) if rng.random() < share else f"w{rng.randrange(60)}" for _ in range(rng.choice([3, 40]))]
        files[(f"f{f}", 0)] = [{"o": {"a": x}} for x in old]
        files[(f"f{f}", 1)] = [{"o": {"b": x}} for x in new]
        if len(set(new) & set(old)) >= 0.5 * len(set(new)):
            want.add(f"f{f}")
    got = drift.changes(lines(spark, files)).where("change = 'renamed'").collect()
    assert {r["feed"] for r in got} == want and want


def test_a_table_of_typed_columns(spark):
    files = {("f", 0): [{"a": 1, "b": {"c": True}, "b_c": "x", "l": ["p", 2], "m": 1}, {"a": 2.5, "m": "two"}, "no", {}]}
    df = lines(spark, files)
    out = drift.typed(drift.unified(df, drift.changes(df)))
    assert dict(out.dtypes) == {"feed": "string", "file_no": "bigint", "line_no": "bigint", "a": "double", "b_c": "boolean", "b_c_2": "string", "l": "array<string>", "m": "string"}
    got = {r["line_no"]: tuple(r)[3:] for r in out.collect()}
    assert got == {0: (1.0, True, "x", ["p", "2"], "1"), 1: (2.5, None, None, None, "two"), 3: (None,) * 5}
    assert drift.typed(drift.unified(df.where("false"), drift.changes(df.where("false")))).count() == 0


def test_a_line_of_two_texts_keeps_the_least(spark):
    rows = [("f", 0, "f_0", 0, r) for r in ('{"k":"b"}', '{"k":"a"}', "broken", '{"k":"a"}')]
    df = spark.createDataFrame(rows, "feed string, file_no int, file_name string, line_no int, raw string")
    assert [r["fields"] for r in drift.unified(df, drift.changes(df)).collect()] == [{"k": "a"}]
