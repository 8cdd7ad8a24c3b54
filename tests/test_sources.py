import json

import pytest
from pyspark.sql import functions as F

from sparkmill.session import cut
from sparkmill.sources import records, sinks, texts

FILES = {
    "a.jsonl": '{"id":"1"}\n\n{"id":"2"}\nbroken\n"text"\n',
    "b.json": '[{"id":"3"}, 4]',
    "c.json": '{"samples": [{"id":"5"}]}',
    "d.json": '{\n "id": "6"\n}',
    "e.json": "",
    "f.jsonl": '{"id":"7"} tail\n{"id":"1"}',
    "g.jsonl": "  \n",
}


@pytest.fixture()
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "h.jsonl").write_text('{"id":"8"}')
    return str(tmp_path)


def test_records_and_rejects(spark, folder):
    got = records.read_records(spark, folder).collect()
    ids = {(r["file_name"], r["line_no"], json.loads(r["record"])["id"], r["format"]) for r in got if r["record"]}
    assert ids == {("a.jsonl", 0, "1", "lines"), ("a.jsonl", 2, "2", "lines"), ("b.json", 0, "3", "list"), ("c.json", 0, "5", "wrapped"), ("d.json", 0, "6", "object"), ("f.jsonl", 1, "1", "lines")}
    bad = {(r["file_name"], r["line_no"], r["raw"], r["error"]) for r in got if r["error"]}
    assert bad == {("a.jsonl", 3, "broken", "not JSON"), ("a.jsonl", 4, '"text"', "not an object"), ("b.json", 1, "4", "not an object"), ("f.jsonl", 0, '{"id":"7"} tail', "not JSON")}
    assert records.read_records(spark, folder, "drop", recursive=True).count() == 7
    with pytest.raises(Exception, match="a.jsonl:4 not JSON|b.json:2|f.jsonl:1|a.jsonl:5"):
        records.read_records(spark, folder, "fail").collect()


def test_find_and_resolve(spark, folder):
    r = records.read_records(spark, folder, "drop")
    assert records.find_record(r, "1").first()["file_name"] == "a.jsonl"
    names = r.select("file_name").distinct()
    assert [x[0] for x in records.resolve(names, "b.json").collect()] == ["b.json"]
    assert [x[0] for x in records.resolve(names, "d").collect()] == ["d.json"]
    assert sorted(x[0] for x in records.resolve(names, ".jsonl").collect()) == ["a.jsonl", "f.jsonl"]
    assert records.resolve(names, "zz").count() == 0
    assert r.select(records.reference(F.lit("f"), F.lit(None), F.lit(3))).first()[0] == "f_missing_000003"


def test_report_and_plan_lines(spark, tmp_path):
    (tmp_path / "r.md").write_text('# head\n  1-1-1-1-1-1 @ "A_01, \\"x\\"" @ 2 @ [] @ f_1, f_2\nc1-2/1-1-5 @ \'y\' @ x @ [a, b] @ \nrest @ x\n')
    got = texts.coverage_lines(texts.numbered(spark, str(tmp_path / "r.md"))).collect()
    assert [(r["line_no"], r["path"], r["command"], r["n"], r["flags"], r["refs"]) for r in got] == [(2, "1-1-1-1-1-1", 'A_01, "x"', 2, [], ["f_1", "f_2"]), (3, "1-2/1-1-5", "'y'", None, ["a", "b"], [])]
    (tmp_path / "p.txt").write_text("# plan\n\ntrain a.b#1.3 # note\ntest a.b\nx\ntest a.0\n")
    got = texts.plan_lines(texts.numbered(spark, str(tmp_path / "p.txt"))).collect()
    assert [(r["line_no"], r["split"], r["request"], r["n"], r["error"]) for r in got] == [
        (3, "train", "a.b#1", 3, None), (4, "test", None, None, "no count"), (5, "", None, None, "not <split> <request>"), (6, "test", "a", 0, "count below 1"),
    ]


def test_hashes_and_blocks(spark, folder):
    h = texts.file_hashes(spark, folder)
    assert h.count() == len(FILES) - 1 and texts.tree_hash(h).first()["n_bytes"] == sum(len(t.encode()) for t in FILES.values())
    df = spark.createDataFrame([("x BEGIN\n a b \nEND y",), ("none",)], "t string")
    assert [r[0] for r in df.select(texts.block_between(F.col("t"), "BEGIN", "END")).collect()] == ["a b", None]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "가", None), (2, "b", "z")], "k int, v string, w string")
    sinks.write_jsonl(df, str(tmp_path / "j"))
    sinks.write_jsonl(df.limit(0), str(tmp_path / "j"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "j")).collect()) == ['{"k":1,"v":"가","w":null}', '{"k":2,"v":"b","w":"z"}']
    sinks.write_csv(df, str(tmp_path / "c"), ["v", "extra", "k"])
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["v", "extra", "k"]
    assert sinks.union_by_name(df.select("k"), df.select("v")).columns == ["k", "v"]
    df.write.partitionBy("k").parquet(str(tmp_path / "t"))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    sinks.drop_rows(cut(spark.read.parquet(str(tmp_path / "t"))), spark.createDataFrame([("b",)], "v string"), ["v"], "k", str(tmp_path / "t"))
    assert any(p in before and p.stat().st_mtime_ns == before[p] for p in (tmp_path / "t").rglob("k=1/*.parquet"))
    assert read_lines(spark, tmp_path) == 1


def read_lines(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"a": 1}\nbad\n')
    return records.read_lines(spark, str(tmp_path / "l.jsonl"), "a int").cache().where("_corrupt_record is null").count()
