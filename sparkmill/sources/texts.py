"""Text sources: coverage report lines, plan lines, blocks between markers, content fingerprints of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as X


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, line_no, line) of small text files; the place in the file is kept, which a line reader would lose."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))
    return files.withColumn("line_no", F.col("line_no") + 1)


def coverage_lines(lines: DataFrame) -> DataFrame:
    """Leaf lines `path @ "text" @ n @ flags @ ref, ref` as path, command, n, flags, refs; other lines drop out."""
    part = F.split(F.ltrim("line"), " @ ", 5)
    keep = F.col("line").rlike(r"^\s*c?[0-9]+(-[0-9]+)+(/[0-9]+(-[0-9]+)*)? @ ")
    return lines.where(keep).select(
        "file_name", "line_no", F.regexp_replace(part[0], "^c", "").alias("path"), X.unquoted(part[1]).alias("command"), part[2].try_cast("long").alias("n"),
        X.listed(F.regexp_replace(part[3], r"^\[|\]$", "")).alias("flags"), X.listed(F.coalesce(F.get(part, F.lit(4)), F.lit(""))).alias("refs"),
    )


def plan_lines(lines: DataFrame) -> DataFrame:
    """Plan lines `<split> <request>.<count>` as split, request, n and error; blank and comment lines drop out, wrong ones keep an error."""
    bare = X.without_comment(F.col("line"))
    at = F.regexp_extract(bare, r"(?U)^(\S+)\s+(\S+)$", 2)
    cut = X.split_count(at)
    error = F.when(at == "", "not <split> <request>").when(cut["prefix"].isNull(), "no count").when(cut["count"].isNull() | (cut["count"] < 1), "count below 1")
    return lines.where(bare != "").select("file_name", "line_no", F.regexp_extract(bare, r"(?U)^(\S+)\s+(\S+)$", 1).alias("split"), cut["prefix"].alias("request"), cut["count"].alias("n"), error.alias("error"))


def block_between(text, begin: str, end: str):
    """What stands between two markers; null where they don't."""
    return F.nullif(F.regexp_extract(text, rf"(?s)\Q{begin}\E\s*(.*?)\s*\Q{end}\E", 1), F.lit(""))


def file_hashes(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, n_bytes, sha256) of every file that is not empty."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    return files.select("path", F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def tree_hash(hashes: DataFrame):
    """(sha256, n_bytes) of all files of a folder, whatever their order: each name and content is hashed, the hashes are added up in four lanes of 60 bits,
    and the sums are hashed. No files give the hash of no sums."""
    each = hashes.select("n_bytes", F.sha2(F.concat(F.element_at(F.split("path", "/"), -1), F.lit(":"), F.col("sha256")), 256).alias("h"))
    lane = lambda i: F.coalesce(F.sum(F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return each.agg(F.sha2(F.concat_ws("|", *[lane(i) for i in range(4)]), 256).alias("sha256"), F.sum("n_bytes").alias("n_bytes"))


def literal_of(source, name: str):
    """The text of a triple-quoted constant in a Python source, between its quotes; null where there is none. Escapes stay as they are written."""
    for quote in ('"""', "'''"):
        found = F.regexp_extract(source, rf"(?sm)^{name}\s*(?::[^=\n]*)?=\s*[rR]?{quote}(.*?){quote}", 1)
        text = found if quote == '"""' else F.coalesce(F.nullif(text, F.lit("")), F.nullif(found, F.lit("")))
    return text
