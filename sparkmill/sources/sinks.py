"""Sinks: compact JSONL, CSV of fixed columns, chat rows, and rewriting of only the partitions a change touches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.features import escaped


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """One compact JSON object a line, nulls kept, characters as they are."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The columns in the given order; those the table lacks are empty."""
    df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]).write.mode("overwrite").option("header", True).csv(path)


def write_pretty(df: DataFrame, path: str) -> None:
    """Indented JSON objects, nulls kept, one document a row. For documents that people read."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", "pretty": "true"}).alias("value")).write.mode("overwrite").text(path)


def write_texts(texts: DataFrame, path: str) -> None:
    """(file_name, text) as text files, each in the folder file_name=<name>: pages, prompts and reports that a plan rendered."""
    texts.select("file_name", F.col("text").alias("value")).repartition("file_name").write.mode("overwrite").partitionBy("file_name").text(path)


def html_table(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """One row, `text`: the columns of a report of few rows as an HTML table in the given order; nulls as empty cells."""
    cell = lambda c: F.concat(F.lit("<td>"), escaped(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), *[cell(c) for c in columns], F.lit("</tr>"))
    head = "<tr>" + "".join(f"<th>{c}</th>" for c in columns) + "</tr>"
    rows = df.agg(F.array_sort(F.collect_list(F.struct(*order, row.alias("_row")))).alias("r"))
    return rows.select(F.concat(F.lit(f"<table>{head}"), F.array_join("r._row", ""), F.lit("</table>")).alias("text"))


def union_by_name(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def drop_rows(table: DataFrame, refs: DataFrame, on: list[str], partition: str, path: str) -> None:
    """Write a partitioned Parquet table without the rows named in `refs`, overwriting the partitions that hold any, no others.

    `table` must be read from another place than `path`, or be cut before, as partitions are replaced. New files are staged beside the table and moved in
    when all tasks have ended, so a failed job leaves the old partitions as they were.
    """
    touched = table.join(refs.select(*on).distinct(), on, "left_semi").select(partition).distinct()
    kept = table.join(touched, partition, "left_semi").join(refs.select(*on).distinct(), on, "left_anti")
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
