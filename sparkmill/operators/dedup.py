"""Exact duplicates by any key: statistics, survivors, references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def groups(df: DataFrame, leaf: list[str], key: Column) -> DataFrame:
    """(leaf..., key hash, n): sizes of the groups of equal keys, counted before they are shuffled. Null keys are equal."""
    return df.select(*leaf, F.xxhash64(key, key.isNull()).alias("_k"), F.sha2(F.coalesce(key, F.lit("")), 256).alias("_s")).groupBy(*leaf, "_k", "_s").agg(F.count("*").alias("n"))


def duplicate_stats(df: DataFrame, leaf: list[str], key: Column) -> DataFrame:
    """Per leaf: rows, groups, rows beyond the first of their group, groups with any, and the largest group."""
    g = groups(df, leaf, key)
    return g.groupBy(*leaf).agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_groups"), F.sum(F.col("n") - 1).alias("n_duplicates"),
        F.count_if(F.col("n") > 1).alias("n_duplicate_groups"), F.max("n").alias("largest"),
    )


def totals(stats: DataFrame, only_duplicates: bool = False) -> DataFrame:
    s = stats.where("n_duplicates > 0") if only_duplicates else stats
    return s.agg(
        F.count("*").alias("n_leaves"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("n_duplicates"), F.lit(0)).alias("n_duplicates"),
        F.coalesce(F.max("largest"), F.lit(0)).alias("largest"),
    )


def keep_first(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The rows of each key with the least `order`, by an aggregate over narrow columns and a semi join: no group is sorted or gathered."""
    first = df.groupBy(*key).agg(F.min(order).alias(order))
    cond = [df[c].eqNullSafe(first[c]) for c in [*key, order]]
    return df.join(first, cond, "left_semi")


def reference_stats(refs: DataFrame, lookup: DataFrame, leaf: list[str], ref: str) -> DataFrame:
    """References of each leaf that are found and missing in `lookup`; what the lookup holds twice counts once."""
    known = lookup.select(ref).distinct().withColumn("_hit", F.lit(1))
    return refs.join(known, ref, "left").groupBy(*leaf).agg(F.count("_hit").alias("n_loaded"), F.count_if(F.col("_hit").isNull()).alias("n_missing"))


def strict_join(refs: DataFrame, lookup: DataFrame, key: str, on_error: str = "raise") -> DataFrame:
    """References joined with a lookup whose keys must be unique and complete, in one plan.

    "raise" fails on a reference without a row and on a key the lookup holds twice; "report" gives the matched rows with n_repeated (rows of
    the lookup beyond the first of their key) and n_missing (references without a row). Null keys match nothing and count as missing.
    """
    if on_error not in ("raise", "report"):
        raise ValueError(on_error)
    if on_error == "report":
        repeated = lookup.agg(F.count(key) - F.countDistinct(key)).scalar()
        missing = refs.join(lookup.select(key), key, "left_anti").agg(F.count("*")).scalar()
        return refs.join(lookup, key).withColumns({"n_repeated": repeated, "n_missing": missing})
    columns = [c for c in lookup.columns if c != key]
    once = lookup.groupBy(key).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in columns])
    joined = refs.join(once, key, "left")
    problem = F.when(F.col("_n").isNull(), F.concat(F.lit("no row for "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).when(F.col("_n") > 1, F.concat(F.lit("more than one row for "), F.col(key).cast("string")))
    return joined.where(F.when(problem.isNull(), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))).drop("_n")
