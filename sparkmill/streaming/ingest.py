"""Incremental intake: each content once over any number of runs, cursors, and a loop of tasks with progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.rules import validate
from ..session import exists, new_path

BUCKETS = 16


class Intake:
    """A target table with a ledger of content hashes beside it. `take` is a foreachBatch sink: rows whose hash the ledger holds are left out.

    Rows and their hashes are written under the batch's number and overwrite it, so a batch that is run again after a failure
    leaves the table as one run does. Files of the source are only seen once thanks to the stream's checkpoint. The ledger lies in `buckets` folders by
    hash, and a batch reads those of its own hashes only; `run_no` numbers the streams that share one table.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda df: df, run_no: int = 0, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.prepare, self.run_no, self.buckets = spark, path, key, prepare, run_no, buckets

    def _ledger(self, before: int) -> DataFrame | None:
        path = f"{self.path}/ledger"
        return self.spark.read.parquet(path).where(F.col("batch") < before) if exists(self.spark, path) else None

    def take(self, df: DataFrame, batch: int) -> None:
        batch += self.run_no * 1_000_000_000
        rows = self.prepare(df).withColumn("_hash", F.sha2(F.to_json(F.struct(*self.key)), 256)).dropDuplicates(["_hash"])
        rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_hash"), F.lit(self.buckets)).cast("int")).persist()
        try:
            ledger, fresh = self._ledger(batch), rows
            if ledger is not None:
                touched = [r[0] for r in rows.select("_bucket").distinct().collect()]  # at most as many numbers as there are buckets
                fresh = rows.join(ledger.where(F.col("_bucket").isin(touched)).select("_hash"), "_hash", "left_anti").persist()
            fresh.drop("_hash", "_bucket").write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch}")
            fresh.select("_hash", "_bucket").repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/ledger/batch={batch}")
            fresh.unpersist()
        finally:
            rows.unpersist()

    def run(self, source: str, schema) -> DataFrame:
        stream = self.spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        q = stream.writeStream.foreachBatch(self.take).option("checkpointLocation", f"{self.path}/checkpoint-{self.run_no}").trigger(availableNow=True).start()
        q.awaitTermination()
        return self.spark.read.parquet(f"{self.path}/rows").drop("batch")


def _glob(spark: SparkSession, path: str) -> str:
    """A stream's source for a table that may be a file or a folder of files."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return f"{path}/*" if fs.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(path)).isDirectory() else path


def ingest_once(spark: SparkSession, sources: list[str], key: list[str]) -> DataFrame:
    """All rows of the sources, taken in one after the other by one intake with a checkpoint each: every content once, however often it is delivered."""
    path = new_path(spark, "intake")
    out = None
    for i, source in enumerate(sources):
        intake = Intake(spark, path, key, run_no=i)
        out = intake.run(_glob(spark, source), spark.read.parquet(source).schema)
    return out


def cursors(spark: SparkSession, source: str) -> DataFrame:
    """(split, path, cursor_at): the cursor of each key after all requests; repeated requests count once, null counts move nothing.

    Each micro-batch takes in the requests not seen before and adds how far they move each cursor under its own number, so that a batch run
    again replaces its addition. What is kept from batch to batch is a ledger of hashes on disk, not state in the executors' memory.
    """
    key = ["split", "path", "request_key", "requested_count"]
    plain = lambda df: df.select(F.coalesce("split", F.lit("")).alias("split"), F.coalesce("path", F.lit("")).alias("path"), "request_key", F.coalesce("requested_count", F.lit(0)).alias("requested_count"))
    rows = Intake(spark, new_path(spark, "cursors"), key, plain).run(_glob(spark, source), spark.read.parquet(source).schema)
    return rows.groupBy("split", "path").agg(F.sum("requested_count").cast("long").alias("cursor_at"))


class Loop:
    """Tasks in order, each seeing what earlier ones accepted: a task's rows are checked, those whose key was accepted before are skipped, the rest
    are appended, and a row of progress is written.

    A task run again under its number replaces its own rows and progress, so a loop may be taken up at any task. Of a task's rows with one
    key the one with the least `order` is taken; null keys are never repeats of each other.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, order: str, rules: list):
        self.spark, self.path, self.key, self.order, self.rules = spark, path, key, order, rules

    def accepted(self, before: int | None = None) -> DataFrame | None:
        path = f"{self.path}/accepted"
        if not exists(self.spark, path):
            return None
        rows = self.spark.read.parquet(path)
        return rows if before is None else rows.where(F.col("task") < before)

    def progress(self) -> DataFrame:
        """(task, n_rows, n_accepted, n_rejected, n_skipped, status)."""
        return self.spark.read.parquet(f"{self.path}/progress")

    def take(self, df: DataFrame, task: int) -> None:
        checked = validate(df, self.rules).persist()
        try:
            good = checked.where("passed").drop("passed", "failure_reasons")
            first = good.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.min(self.order).alias(self.order))
            fresh = good.join(first, [self.key, self.order], "left_semi").unionByName(good.where(F.col(self.key).isNull()))
            old = self.accepted(task)
            if old is not None:
                fresh = fresh.join(old.select(self.key), self.key, "left_anti")
            fresh.write.mode("overwrite").parquet(f"{self.path}/accepted/task={task}")
            n = self.spark.read.schema(fresh.schema).parquet(f"{self.path}/accepted/task={task}").agg(F.count("*").alias("n")).scalar()
            done = checked.agg(F.count("*").alias("n_rows"), F.count_if(~F.col("passed")).alias("n_rejected"), n.alias("n_accepted"))
            done = done.withColumn("n_skipped", F.col("n_rows") - F.col("n_rejected") - F.col("n_accepted"))
            status = F.when(F.col("n_rejected") + F.col("n_skipped") > 0, "completed_with_skips_or_errors").otherwise("completed")
            done.withColumn("status", status).write.mode("overwrite").parquet(f"{self.path}/progress/task={task}")
        finally:
            checked.unpersist()
