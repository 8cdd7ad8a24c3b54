"""Coverage: counts at the leaves, rolled up level by level, next to what a dimension expects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .rank import running


def rollup_shares(leaves: DataFrame, levels: list[str], n: str = "n") -> DataFrame:
    """Every level's counts from counted leaves, with depth and the share of the parent's count; absent levels are null.

    One pass over the leaves: the roll-up is of counts, never of records, and the parent's count is a window over the rolled-up
    rows. Null values of a level count as the text "unknown".
    """
    named = leaves.select(*[F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in levels], n)
    up = named.rollup(*levels).agg(F.sum(n).cast("long").alias("n"), F.grouping_id(*levels).alias("g"))
    depth = F.lit(len(levels)) - F.log2(F.col("g") + 1).cast("int")
    up = up.withColumn("depth", depth)
    parent = F.array(*[F.when(F.col("depth") > i + 1, F.col(c)) for i, c in enumerate(levels)])
    whole = F.sum(F.when(F.col("depth") > 0, F.col("n"))).over(W.partitionBy("depth", parent))
    return up.select(*levels, F.col("depth").cast("long").alias("depth"), "n", F.when(F.col("depth") > 0, F.col("n") / whole).otherwise(1.0).alias("share"))


def counted(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def spine(dim: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Every row of the dimension with its count, 0 where there is none; values outside the dimension drop out."""
    return dim.join(counts, keys, "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


def axis_counts(df: DataFrame, axes: dict[str, Column]) -> DataFrame:
    """(axis, value, n, share) of several axes in one pass; nulls are left out, shares are of the axis."""
    each = F.array(*[F.struct(F.lit(a).alias("axis"), c.cast("string").alias("value")) for a, c in axes.items()])
    n = df.select(F.explode(each).alias("x")).where("x.value is not null").groupBy("x.axis", "x.value").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("axis")))


def slot_index(df: DataFrame, path: list[str], text: str, first: str) -> DataFrame:
    """1-based place of each (path, text) among its path's texts in text order, by sums over ranges: a path may hold any share of the texts."""
    leaf = df.groupBy(*path, text).agg(F.min(first).alias("first_seen"), F.count("*").alias("n"))
    return running(leaf, F.lit(1).cast("long"), path, [text], "slot").withColumn("slot", F.col("slot") + 1)


def ordinals(dim: DataFrame, parent: list[str], order: list) -> DataFrame:
    return dim.withColumn("ordinal", F.row_number().over(W.partitionBy(*parent).orderBy(*order)).cast("long"))


def outside_dimension(df: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(dim.select(*keys).distinct(), keys, "left_anti")


def with_targets(shares: DataFrame, levels: list[str], dim: DataFrame, under: dict[str, str]) -> DataFrame:
    """Rolled-up shares with target_pct of each row's deepest level: the dimension's row of that axis and value, and, for levels named in `under`, of the
    parent that stands in that other level. Null where the dimension has none."""
    axis, value = F.get(F.array(*map(F.lit, levels)), (F.col("depth") - 1).cast("int")), F.coalesce(*levels[::-1])
    parent = F.lit(None).cast("string")
    for level, above in under.items():
        parent = F.when(axis == level, F.col(above)).otherwise(parent)
    d = dim.select(F.col("axis").alias("_a"), F.col("parent").alias("_p"), F.col("value").alias("_v"), "target_pct")
    s = shares.withColumns({"_axis": axis, "_value": value, "_parent": F.coalesce(parent, F.lit(""))})
    return s.join(d, (F.col("_axis") == F.col("_a")) & (F.col("_value") == F.col("_v")) & (F.col("_parent") == F.coalesce("_p", F.lit(""))), "left").drop("_a", "_p", "_v", "_axis", "_value", "_parent")
