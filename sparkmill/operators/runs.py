"""Run summaries, reconciliation by position, first-seen order, and the ledger of contents already taken in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def per_minute(n: Column, seconds: Column) -> Column:
    return F.try_divide(n * 60.0, seconds)


def first_seen_sums(df: DataFrame, keys: list[str], value: Column, pos: str) -> DataFrame:
    """Sums per key with the place where the key is first seen: the order in which a reader meets the groups."""
    return df.groupBy(*keys).agg(F.sum(value).alias("total"), F.min(pos).alias("first_seen"))


def reconcile(left: DataFrame, right: DataFrame, on: list[str], placeholder: dict[str, object]) -> DataFrame:
    """Full outer join by position; `status` says which side is missing, and `placeholder` fills columns."""
    both = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), on, "full")
    status = F.when(F.col("_l").isNull(), "no_request").when(F.col("_r").isNull(), "no_response").otherwise("ok")
    return both.withColumn("status", status).drop("_l", "_r").fillna(placeholder)


def fingerprints(df: DataFrame, content: Column) -> DataFrame:
    return df.withColumn("sha256", F.sha2(F.coalesce(content, F.lit("")), 256))


def not_yet_seen(df: DataFrame, ledger: DataFrame) -> DataFrame:
    return df.join(ledger.select("sha256").distinct(), "sha256", "left_anti")


def next_number(names: Column, pattern: str) -> Column:
    """Aggregate: the largest number in names that match `pattern` (its first group), plus one; 1 where none does."""
    return (F.coalesce(F.max(F.nullif(F.regexp_extract(names, pattern, 1), F.lit("")).try_cast("long")), F.lit(0)) + 1).alias("next_number")


def from_index(df: DataFrame, index: str, start: int) -> DataFrame:
    """Rows from a 0-based index on, by which a run is taken up again; rows without an index drop out."""
    return df.where(F.col(index) >= start)
