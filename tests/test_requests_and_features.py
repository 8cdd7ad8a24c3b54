import pytest
from pyspark.sql import functions as F

from sparkmill.operators import dedup, features, nested, requests, rules, sanitize
from sparkmill.sources import records, sinks, texts


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=repr)


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()[0]


@pytest.mark.parametrize(
    ("text", "kind", "want"),
    [('{"a":{"b":"x"}}', "string", "x"), ('{"a":{"b":3}}', "string", "-"), ('{"a":{"b":null}}', "string", "-"), ('{"a":[]}', "string", "-"), ("{", "string", "-"), ("", "string", "-"), (None, "string", "-"),
     ('{"a":{"b":"x"}} tail', "string", "-"), ('{"a":{"b":[1,"z"]}}', "array", '[1,"z"]'), ('{"a":{"b":{"c":1}}}', "object", '{"c":1}'), ('{"a":{"b":1}}', "object", "-")],
)
def test_typed_access(spark, text, kind, want):
    assert one(spark, text, lambda c: nested.json_at(c, "$.a.b", kind, F.lit("-"))) == want


def test_nested_changes(spark):
    assert one(spark, '["a", 1, null, {"x": 1}, "b"]', nested.strings_only) == ["a", "b"] and one(spark, "{}", nested.strings_only) == [] and one(spark, None, nested.strings_only) == []
    df = spark.createDataFrame([(1, ("x", None)), (2, (None, "y")), (3, None)], "i int, s struct<a:string,b:string>")
    assert rows(df.select("i", nested.with_field(F.col("s"), "a", F.lit("z"))["a"].alias("a"), nested.with_field(F.col("s"), "b", F.lit("q"), True)["b"].alias("b"))) == [(1, "x", "q"), (2, "z", "q"), (3, None, None)]
    assert rows(nested.numbered_ids(df, "3", F.lit(7), F.col("i") * 500), "id") == [("37_1000",), ("37_1500",), ("37_500",)]
    assert rows(nested.exploded(df, F.when(F.col("i") == 1, F.array(F.lit("u"), F.lit("v"))), "s", "a", lambda x: x).select("s.a")) == [("u",), ("v",)]


DIM = [("intent_family", None, "skill", 1), ("intent_family", None, "move", 2), ("actor_selection", None, "one", 1), ("target_selection", None, "near", 1), ("action_pattern", None, "go", 1), ("scenario_family", "move", "hold", 1),
       ("scenario_family", "skill", "cast", 1), ("skill_family", None, "heal", 1), ("skill_target_kind", None, "ally", 1), ("conflict_type", None, "null", 1)]


def test_requests_of_both_grammars(spark):
    dim = spark.createDataFrame(DIM, "axis string, parent string, value string, ord int")
    asked = ["move.one.near.go.hold#1.4", " c2-1-1-1-1-3.7 ", "skill.one.near.go.cast#1/heal.ally.null.2", "c1-1-1-1-1-1/1-1-1.2", "move.one.near.go.cast#1.4", "move.one.near.go.hold#0.4", "move.one.near.go.hold#1.0", "c2-9-1-1-1-1.1", "x", "", None,
             "move.one.near.go.hold#1/heal.ally.null.2", "move.one.near.go.hold#99999999999999999999.4"]
    df = spark.createDataFrame(list(enumerate(asked)), "i int, q string").withColumn("intent_family", F.lit("clash"))
    got = {r["i"]: (r["intent_family"], r["scenario_family"], r["skill_family"], r["slot"], r["count"], r["error"]) for r in requests.resolved(df, F.col("q"), dim).collect()}
    assert got[0] == ("move", "hold", None, 1, 4, None) and got[1] == ("move", "hold", None, 3, 7, None)
    assert got[2] == got[3] == ("skill", "cast", "heal", 1, 2, None)
    assert [got[i][5] for i in range(4, 13)] == ["unknown scenario_family", "slot below 1", "count below 1", "unknown actor_selection", "format", "format", "format", "skill parts need a skill intent", "slot below 1"]


def test_contracts_payloads_and_shapes(spark):
    df = spark.createDataFrame([(3, [1, 2], 3), (3, [1], 3), (3, [3], 2), (None, None, 0), (0, [], 0)], "t long, i array<long>, a long")
    assert [r[0] for r in df.select(requests.count_contract(F.col("t"), F.col("i"), F.col("a"))).collect()] == ["ok", "stated total is not the items' sum", "stated total is not what came", "stated total is not the items' sum", "ok"]
    items = spark.createDataFrame([("g", 2, "b", 1), ("g", 1, "a", 2), ("h", 1, "a", 1), ("h", 2, "a", 5)], "g string, at int, p string, n int")
    assert rows(requests.payloads(items, ["g"], "p", "n", "at")) == [("g", '[{"prefix":"a","count":2},{"prefix":"b","count":1}]', 2, 3, True), ("h", '[{"prefix":"a","count":1},{"prefix":"a","count":5}]', 2, 6, False)]
    dim = spark.createDataFrame([("a", None, "x", 1, 100.0), ("b", None, "x", 1, 50.0), ("b", None, "x", 2, 50.0), ("c", None, "x", 2, 100.0), ("d", None, "x", 1, None)], "axis string, parent string, value string, ord int, target_pct double")
    assert rows(requests.dimension_shape(dim), "axis", "error") == [("a", None), ("b", "a value twice"), ("c", "ordinals are not 1 to n"), ("d", "targets are not 100")]


def test_tagged_items_and_blanks(spark):
    t = "array<struct<k:string,a:string,b:string>>"
    df = spark.createDataFrame([([("m", "x", None), ("m", None, None), ("m", "x", "y"), ("z", "x", None), (None, None, None), None, ("w", None, None)],), (None,), ([],)], f"i {t}")
    assert [r[0] for r in df.select(rules.tagged("T", F.col("i"), "k", {"m": (["a"], ["b"]), "w": ([], ["a"])}).bad).collect()] == [5, 0, 0]
    b = spark.createDataFrame([("x", " "), (None, "y")], "p string, q string")
    assert [r["failure_reasons"] for r in rules.validate(b, rules.blank("B", F.col("p"), F.col("q"))).collect()] == [["B_1"], ["B_0"]]


def test_repair(spark):
    t = "array<struct<k:string,n:double,m:string>>"
    df = spark.createDataFrame([([("wait", None, "odd"), ("go", 99.0, None), ("bad", 1.0, "x"), None, ("go", None, "direct")],), (None,)], f"i {t}")
    got = [r[0] for r in df.select(sanitize.coerced(F.col("i"), "k", ["wait", "go"], {"wait": 2.0}, "n", 1.0, 10.0, "m", ["direct"], "direct")).collect()]
    assert [tuple(x) for x in got[0]] == [("wait", 2.0, "direct"), ("go", 10.0, None), ("go", None, "direct")] and got[1] is None
    assert [r[0] for r in df.select(sanitize.first_per_key(F.col("i"), "k")["n"]).collect()] == [[None, 99.0, 1.0], None]


def test_json_equality_and_features(spark):
    eq = features.json_equal
    assert eq('{"a":1,"b":[2]}', '{"b":[2.0],"a":1.0}') and eq("null", "null") and eq("1", "1.0")
    assert not eq("1", "true") and not eq("[1,2]", "[2,1]") and not eq('{"a":1}', "{}") and not eq("0", "null") and eq("x", "1") is None and eq(None, "1") is None
    t = "array<struct<unitId:string,sequence:array<struct<type:string,target:string>>>>"
    a = [("A_02", [("move", None), ("attack", "E_01")]), ("A_01", [("attack", "E_01")])]
    df = spark.createDataFrame([(1, a, a[::-1]), (2, a, None), (3, [], []), (4, None, [(None, None)])], f"i int, a {t}, g {t}")
    got = {r["i"]: tuple(r["c"]) for r in df.select("i", features.against_gold(F.col("a"), F.col("g"), F.lit(True)).alias("c")).collect()}
    assert got[1] == (False, True, True, True, True, True) and got[2][-1] is False and got[3] == (True,) * 6 and got[4][-1] is False
    keys = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string").select(features.duplicate_key(F.col("x"), F.col("y")).alias("k"))
    assert keys.distinct().count() == 2


def test_texts_of_reports(spark):
    assert one(spark, " My Model: v1.0 ", features.slug) == "my-model-v1-0" and one(spark, "<a href=\"x\">'&</a>", features.escaped) == "&lt;a href=&quot;x&quot;&gt;&#x27;&amp;&lt;/a&gt;"
    assert one(spark, 0.0125, features.points, "double") == "+1.25 pp" and one(spark, None, features.points, "double") == "-"
    assert one(spark, "a", lambda c: features.label(c, {"a": "A"})) == "A" and one(spark, "b", lambda c: features.label(c, {})) == "b"
    u = spark.range(4000).select(features.uniform(3, F.col("id")).alias("u"), features.normal(3, F.col("id")).alias("z")).agg(F.min("u"), F.max("u"), F.avg("u"), F.avg("z"), F.stddev("z")).first()
    assert 0 <= u[0] < 0.01 and 0.99 < u[1] < 1 and abs(u[2] - 0.5) < 0.02 and abs(u[3]) < 0.06 and abs(u[4] - 1) < 0.05


def test_strict_join(spark):
    refs, look = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    assert rows(dedup.strict_join(refs, look, "k")) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="no row for 9"):
        dedup.strict_join(refs.union(spark.createDataFrame([(9,)], "k int")), look, "k").collect()
    twice = look.union(spark.createDataFrame([(2, "z")], look.schema))
    with pytest.raises(Exception, match="more than one row for 2"):
        dedup.strict_join(refs, twice, "k").collect()
    assert rows(dedup.strict_join(refs, twice, "k", "report"), "k", "n_repeated", "n_missing") == [(1, 1, 0), (2, 1, 0), (2, 1, 0)]


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":"1"}, {"id":"2"}]')
    (tmp_path / "b.jsonl").write_text('{"id":"3"}\n\n{"id":"4"} x\n[5]\n')
    got = rows(records.file_texts(records.read_records(spark, str(tmp_path), "drop")))
    assert got == [("a.json", '[\n{"id":"1"},\n{"id":"2"}\n]'), ("b.jsonl", '{"id":"3"}')]
    lines = records.read_jsonl(spark, str(tmp_path), glob="*.jsonl")
    assert rows(lines.select("record", "error")) == [('{"id":"3"}', None), (None, "not JSON"), (None, "not an object")]
    with pytest.raises(Exception, match="b.jsonl not"):
        records.read_jsonl(spark, str(tmp_path), "fail", glob="*.jsonl").collect()
    with pytest.raises(Exception, match="root is no object: a.json"):
        records.load_object(spark, str(tmp_path / "a.json")).collect()
    names = spark.createDataFrame([("plan_0001.txt",), ("plan_0002.txt",), ("other.txt",), ("plan_0001.txt",)], "file_name string")
    assert rows(records.plan_files(names, "plan_*.txt")) == [("plan_0001.txt", 1), ("plan_0002.txt", 2)] and rows(records.plan_files(names, number=2), "file_name") == [("plan_0002.txt",)]
    assert one(spark, "X = 1\nP = '''a\nb'''\n", lambda c: texts.literal_of(c, "P")) == "a\nb" and one(spark, "X = 1", lambda c: texts.literal_of(c, "P")) is None
    t = sinks.html_table(spark.createDataFrame([(2, None), (1, "<b>")], "k int, v string"), ["v"], ["k"]).first()[0]
    assert t == "<table><tr><th>v</th></tr><tr><td>&lt;b&gt;</td></tr><tr><td></td></tr></table>"
