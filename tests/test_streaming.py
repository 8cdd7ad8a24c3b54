from pyspark.sql import functions as F

from sparkmill.operators import rules
from sparkmill.streaming import ingest


def test_each_content_once_over_two_runs(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    a.coalesce(1).write.parquet(f"{src}/a")
    intake = ingest.Intake(spark, out, ["k", "v"])
    assert intake.run(src, a.schema).count() == 2
    assert intake.run(src, a.schema).count() == 2
    spark.createDataFrame([(2, "y"), (3, None)], "k int, v string").coalesce(1).write.parquet(f"{src}/b")
    got = intake.run(src, a.schema)
    assert sorted(r["k"] for r in got.collect()) == [1, 2, 3]


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    intake = ingest.Intake(spark, str(tmp_path), ["k"])
    df = spark.createDataFrame([(1,), (2,)], "k int")
    intake.take(df, 0)
    intake.take(df.where("k = 2").union(spark.createDataFrame([(3,)], "k int")), 1)
    intake.take(df.where("k = 2").union(spark.createDataFrame([(3,)], "k int")), 1)
    assert sorted(r["k"] for r in spark.read.parquet(f"{tmp_path}/rows").collect()) == [1, 2, 3]


def test_cursor_state_equals_batch(spark, tmp_path):
    t = spark.createDataFrame([("t", "p", "r1", 3), ("t", "p", "r1", 3), ("t", "p", "r2", 4), (None, "q", "r3", 1), ("t", "p", "r4", None)], "split string, path string, request_key string, requested_count int")
    t.write.parquet(str(tmp_path / "t"))
    got = {tuple(r) for r in ingest.cursors(spark, str(tmp_path / "t")).select("split", "path", "cursor_at").collect()}
    assert got == {("t", "p", 7), ("", "q", 1)}


def test_two_deliveries_of_one_content(spark, tmp_path):
    t = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "k int, v string")
    t.write.parquet(str(tmp_path / "a"))
    t.write.parquet(str(tmp_path / "b"))
    assert sorted(r["v"] for r in ingest.ingest_once(spark, [str(tmp_path / "a"), str(tmp_path / "b")], ["v"]).collect()) == ["x", "y"]


def test_a_loop_sees_what_was_accepted(spark, tmp_path):
    loop = ingest.Loop(spark, str(tmp_path), "k", "i", [rules.out_of_range("V", F.col("v"), 0)])
    one = spark.createDataFrame([(1, "a", -1), (2, "a", 1), (3, "a", 2), (4, None, 1), (5, None, 1)], "i int, k string, v int")
    two = spark.createDataFrame([(6, "a", 1), (7, "b", 1)], "i int, k string, v int")
    for task, df in ((0, one), (1, two), (1, two), (2, two.where("false"))):
        loop.take(df, task)
    assert sorted(r["i"] for r in loop.accepted().collect()) == [2, 4, 5, 7]
    got = {r["task"]: (r["n_rows"], r["n_accepted"], r["n_rejected"], r["n_skipped"], r["status"]) for r in loop.progress().collect()}
    assert got == {0: (5, 3, 1, 1, "completed_with_skips_or_errors"), 1: (2, 1, 0, 1, "completed_with_skips_or_errors"), 2: (0, 0, 0, 0, "completed")}
