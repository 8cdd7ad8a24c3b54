"""Scoring: boolean rates, means and percentiles, breakdowns that are checked against the whole, differences to a baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .rank import percentiles


def rate(flag: Column) -> Column:
    """Share of rows where the flag is true; null counts as false; no rows give null."""
    return F.avg(F.coalesce(flag, F.lit(False)).cast("int"))


def summary(df: DataFrame, group: list[str], flags: dict[str, Column], measures: dict[str, Column], percents: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """A score table: n, a rate for each flag, and for each measure its mean and exact interpolated percentiles over non-null values; one row a group."""
    plain = [F.count("*").alias("n"), *[rate(c).alias(f"{k}_rate") for k, c in flags.items()], *[F.avg(c).alias(f"{k}_mean") for k, c in measures.items()]]
    keys = group or ["_all"]
    a = df.groupBy(*group).agg(*plain) if group else df.agg(*plain).withColumn("_all", F.lit(0))
    p = percentiles(df if group else df.withColumn("_all", F.lit(0)), keys, measures, percents)
    joined = a.alias("a").join(p.alias("p"), [F.col(f"a.{c}").eqNullSafe(F.col(f"p.{c}")) for c in keys], "left")
    return joined.select("a.*", *[f"p.{c}" for c in p.columns if c not in keys]).drop("_all")


def breakdown(df: DataFrame, axes: dict[str, Column], flags: dict[str, Column], measures: dict[str, Column], percents: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """The summary for each value of each axis: axis, value (null as "unknown"), and the summary's columns."""
    return summary(by_axes(df, axes), ["axis", "value"], flags, measures, percents)


def by_axes(df: DataFrame, axes: dict[str, Column]) -> DataFrame:
    """Every row once for each axis, with `axis` and `value` (null as "unknown")."""
    each = F.array(*[F.struct(F.lit(a).alias("axis"), F.coalesce(c.cast("string"), F.lit("unknown")).alias("value")) for a, c in axes.items()])
    return df.withColumn("_x", F.explode(each)).select("*", "_x.axis", "_x.value").drop("_x")


def breakdown_check(parts: DataFrame, total: int | Column) -> DataFrame:
    """Per axis: the sum over its groups, whether it is the whole, and how many groups are unknown."""
    whole = F.lit(total) if isinstance(total, int) else total
    return parts.groupBy("axis").agg(F.sum("n").alias("n"), F.count_if(F.col("value").startswith("unknown")).alias("n_unknown")).withColumn("is_whole", F.col("n") == whole)


def minus_first(df: DataFrame, order: str, measures: list[str]) -> DataFrame:
    """Each measure minus that of the first row by `order`. For reports of few rows: one window over all of them."""
    w = W.orderBy(order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return df.withColumns({f"{m}_delta": F.col(m) - F.first(m).over(w) for m in measures})


def arg_min(value: str, tie: str, wanted: str) -> Column:
    """`wanted` of the row with the least value, of equal ones with the least tie."""
    return F.min_by(wanted, F.struct(value, tie))
