"""Expression pools: the first distinct texts of each group, what other groups reserve, and how a pool is reused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def first_distinct(df: DataFrame, group: list[str], key: str, order: str, limit: int) -> DataFrame:
    """The first `limit` distinct keys of each group by where they are first seen, with their place from 1."""
    seen = df.where(F.col(key).isNotNull()).groupBy(*group, key).agg(F.min(order).alias("first_seen"))
    at = F.row_number().over(W.partitionBy(*group).orderBy("first_seen", key))
    return seen.withColumn("place", at).where(F.col("place") <= limit).withColumn("place", F.col("place").cast("long"))


def reserved_elsewhere(df: DataFrame, split: str, key: str) -> DataFrame:
    """(split, key): keys of a split that other splits hold too."""
    per = df.where(F.col(key).isNotNull()).select(split, key).distinct()
    shared = per.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)
    return per.join(shared, key)


def policy(df: DataFrame, wanted: Column, existing: Column, limit: int) -> DataFrame:
    """n_new and n_cycle of `wanted` texts: new ones until the pool holds `limit`, the rest reuses it."""
    new = F.greatest(F.lit(0), F.least(wanted, F.lit(limit) - existing)).cast("long")
    return df.withColumn("n_new", new).withColumn("n_cycle", (wanted - new).cast("long"))


def cycle_plan(df: DataFrame, n: Column, pool: Column, offset: Column) -> DataFrame:
    """One row for each output: `output` from 1 and the 1-based `source` it reuses, round robin from `offset`. An empty pool gives none."""
    at = df.withColumn("_n", n.cast("int")).withColumn("_p", pool.cast("int")).withColumn("_o", offset.cast("int")).where("_n > 0 and _p > 0")
    at = at.withColumn("output", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n").cast("long"))))
    return at.withColumn("source", (F.pmod(F.col("_o") + F.col("output") - 1, F.col("_p")) + 1).cast("long")).drop("_n", "_p", "_o")


def buckets(df: DataFrame, family: str, text: str, style: str, ref: str, most: int) -> DataFrame:
    """One row for each family: its first text and that text's style ("" for null), rows, distinct texts, first reference, and the references at which its first
    `most` texts are first seen, in order. Rows are counted by text before families meet, so a family of any size is one row for each of its texts."""
    t = df.groupBy(family, text).agg(F.min(ref).alias("first_no"), F.count("*").alias("n"), F.min_by(F.struct(F.col(style).alias("s")), ref).alias("s"))
    at = F.row_number().over(W.partitionBy(family).orderBy("first_no"))
    first = t.withColumn("_at", at).where(F.col("_at") <= most).groupBy(family).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("first_no")), lambda x: x.cast("string")), ",").alias("first_refs")
    )
    g = t.groupBy(family).agg(
        F.coalesce(F.min_by(F.struct(F.col(text).alias("t")), "first_no")["t"], F.lit("")).alias("first_text"), F.coalesce(F.min_by("s", "first_no")["s"], F.lit("")).alias("first_style"),
        F.sum("n").alias("n"), F.count(text).alias("n_texts"), F.min("first_no").alias("first_no"),
    )
    return g.join(first, family)
