"""Record files: JSON, JSONL and wrapped lists, with file names, places and a reject channel."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import strict_variant
from ..operators.dewey import parse

_RECORDS = pa.schema([("file_name", pa.string()), ("line_no", pa.int64()), ("format", pa.string()), ("record", pa.string()), ("raw", pa.string()), ("error", pa.string())])
SCHEMA = "file_name string, line_no long, format string, record string, raw string, error string"


def _compact(v) -> str:
    return json.dumps(v, ensure_ascii=False, separators=(",", ":"))


def split_records(text: str, unwrap: str | None) -> Iterator[tuple[int, str, str | None, str | None, str | None]]:
    """(place, format, record, raw, error) of a file's text: one JSON value (a list, a wrapped list, an object), else one value a line.

    A value that is no object, and a line that is not JSON, is an error with the text as it stands. Records keep the text of their line, or
    are written compactly where they stood inside a larger value. An empty text has no records.
    """
    if not text.strip():
        return
    whole = parse(text)
    if whole is not None and not (isinstance(whole, (int, float, str, bool)) and "\n" in text.strip()):
        kind, values = "object", [whole]
        if isinstance(whole, list):
            kind, values = "list", whole
        elif isinstance(whole, dict) and unwrap and isinstance(whole.get(unwrap), list):
            kind, values = "wrapped", whole[unwrap]
        for i, v in enumerate(values):
            yield (i, kind, _compact(v), None, None) if isinstance(v, dict) else (i, kind, None, _compact(v), "not an object")
        return
    for i, line in enumerate(text.split("\n")):
        if line.strip():
            v = parse(line)
            yield (i, "lines", line, None, None) if isinstance(v, dict) else (i, "lines", None, line, "not JSON" if v is None else "not an object")


def _read(unwrap: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = [(name, *r) for r in split_records(text, unwrap)]
                for i in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 10_000]), _RECORDS)], schema=_RECORDS)

    return run


def read_records(spark: SparkSession, path: str, on_error: str = "reject", unwrap: str | None = "samples", recursive: bool = False, glob: str = "*.json*") -> DataFrame:
    """(file_name, line_no, format, record, raw, error): the records of a file or folder.

    `on_error`: "reject" keeps what is no record as rows with an error, "drop" leaves them out, "fail" raises with file and line. A file is read
    by one task, as a list spans lines; tables of any size belong in Parquet or in `read_lines`.
    """
    if on_error not in ("reject", "drop", "fail"):
        raise ValueError(on_error)
    texts = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", glob).text(path, wholetext=True)
    got = texts.select(F.col("_metadata.file_name").alias("file_name"), "value").mapInArrow(_read(unwrap), SCHEMA)
    if on_error == "drop":
        return got.where("error is null")
    if on_error == "fail":
        bad = F.raise_error(F.concat(F.col("file_name"), F.lit(":"), (F.col("line_no") + 1).cast("string"), F.lit(" "), F.col("error")))
        return got.withColumn("record", F.when(F.col("error").isNotNull(), bad.cast("string")).otherwise(F.col("record")))
    return got


def read_jsonl(spark: SparkSession, path: str, on_error: str = "reject", glob: str = "*", recursive: bool = False) -> DataFrame:
    """(file_name, record, raw, error): JSONL only, of any size: lines are split by Spark and tried on the JVM's side. Blank lines are none.

    `on_error` as in `read_records`. A line is a record if it is one JSON object with nothing after it.
    """
    if on_error not in ("reject", "drop", "fail"):
        raise ValueError(on_error)
    lines = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", glob).text(path).select(F.col("_metadata.file_name").alias("file_name"), "value").where("trim(value) <> ''")
    parsed = strict_variant(F.col("value"))
    error = F.when(parsed.isNull(), "not JSON").when(~F.col("value").rlike(r"^\s*\{"), "not an object")
    got = lines.withColumn("error", error)
    if on_error == "drop":
        got = got.where("error is null")
    record = F.when(F.col("error").isNull(), F.col("value"))
    if on_error == "fail":
        record = F.when(F.col("error").isNotNull(), F.raise_error(F.concat("file_name", F.lit(" "), "error")).cast("string")).otherwise(F.col("value"))
    return got.select("file_name", record.alias("record"), F.when(F.col("error").isNotNull(), F.col("value")).alias("raw"), "error")


def load_object(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, document): JSON documents whose root must be an object; any other root raises with the file's name."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), "value")
    ok = F.coalesce(strict_variant(F.col("value")).isNotNull() & F.col("value").rlike(r"^\s*\{"), F.lit(False))
    bad = F.raise_error(F.concat(F.lit("root is no object: "), F.col("file_name"))).cast("string")
    return texts.select("file_name", F.when(ok, F.col("value")).otherwise(bad).alias("document"))


def file_texts(records: DataFrame) -> DataFrame:
    """(file_name, text): records of `read_records` back in the form their file had: lines, a list, a wrapped list, or one object. A file is one value."""
    g = records.where("record is not null").groupBy("file_name").agg(F.first("format").alias("format"), F.array_sort(F.collect_list(F.struct("line_no", "record"))).alias("r"))
    listed = F.concat(F.lit("[\n"), F.array_join(F.col("r.record"), ",\n"), F.lit("\n]"))
    text = F.when(F.col("format") == "list", listed).when(F.col("format") == "wrapped", F.concat(F.lit('{"samples":'), listed, F.lit("}"))).otherwise(F.array_join(F.col("r.record"), "\n"))
    return g.select("file_name", text.alias("text"))


def plan_files(names: DataFrame, glob: str | None = None, number: int | None = None) -> DataFrame:
    """(file_name, number): distinct files that match a glob (* and ?) and, if asked, have this number as the last one of their stem, in name order."""
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    n = F.nullif(F.regexp_extract(stem, r"([0-9]+)[^0-9]*$", 1), F.lit("")).try_cast("long")
    out = names.select("file_name").distinct().withColumn("number", n)
    if glob is not None:
        pattern = "".join({"*": ".*", "?": "."}.get(c, "\\" + c if not c.isalnum() else c) for c in glob)
        out = out.where(F.col("file_name").rlike(f"(?s)^{pattern}$"))
    return (out if number is None else out.where(F.col("number") == number)).orderBy("file_name")


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSONL of any size by its schema, splittable; what does not fit the schema is kept in _corrupt_record."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def reference(file_name, record_id, place):
    """ "file_id"; a missing id is counted by its place."""
    return F.concat_ws("_", file_name, F.coalesce(record_id, F.format_string("missing_%06d", place)))


def find_record(records: DataFrame, record_id: str) -> DataFrame:
    """The first record with an id, by file and line: one aggregate, nothing is sorted. No such record gives no row."""
    found = records.where(F.get_json_object("record", "$.id") == record_id)
    first = found.agg(F.min_by(F.struct("*"), F.struct("file_name", "line_no")).alias("r")).where("r is not null")
    return first.select("r.*")


def resolve(names: DataFrame, asked: str) -> DataFrame:
    """Files that match a query best: by whole name, else by stem or its beginning, else by any part; (file_name) of the first tier that has any."""
    n = F.col("file_name")
    stem = F.regexp_replace(n, r"\.[^.]*$", "")
    tier = F.when(n == asked, 0).when((stem == asked) | stem.startswith(asked), 1).when(F.contains(n, F.lit(asked)), 2)
    ranked = names.select("file_name", tier.alias("tier")).where("tier is not null")
    best = ranked.agg(F.min("tier").alias("tier"))
    return ranked.join(F.broadcast(best), "tier").select("file_name")  # one row
