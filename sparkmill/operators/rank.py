"""Ranks, running sums, percentiles and joins over groups of any size, without sorting or gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import cut, mark_small

PER_TASK = 200_000


def ranked(df: DataFrame, group: list[str], order: Column, name: str = "rank", per_task: int = PER_TASK) -> DataFrame:
    """`df` with the 0-based rank of each row in its group by a random-looking long `order` (ties fall in one place).

    A group is cut by the range of `order` into slots of about `per_task` rows; a row's rank is its place in the slot plus the
    sum of the slots before. `order` must be spread evenly over the longs, as a hash is. Null groups are groups of their own.
    """
    most = df.groupBy(*group).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    slots = max(1, -(-most // per_task))
    df = df.withColumn("_o", order)
    if slots == 1:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy("_o")) - 1).drop("_o")
    df = df.withColumn("_s", F.floor((F.col("_o").cast("double") / 2.0**64 + 0.5) * slots).cast("int"))
    n = df.groupBy(*group, "_s").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*group).orderBy("_s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    n = cut(n.select(*group, "_s", before.alias("_b")), "slots")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"n.{c}")) for c in [*group, "_s"]]
    joined = df.alias("d").join(mark_small(n).alias("n"), same).select("d.*", "n._b")
    at = F.row_number().over(W.partitionBy(*group, "_s").orderBy("_o")) - 1
    return joined.withColumn(name, at + F.col("_b")).drop("_o", "_s", "_b")


def running(df: DataFrame, value: Column, group: list[str], order: list[str], name: str) -> DataFrame:
    """`df` with the sum of `value` over the rows before each in its group, by `order` (ties by the other columns' hash); null values add nothing.

    Rows are spread by ranges of group and order, so a group of any size is many tasks' work; each range's sum comes from one aggregate and is added
    to the ranges after it. A group's table of ranges has at most as many rows as there are partitions. Column names that begin with _r are taken.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    keys = [*group, *order, "_rt"]
    d = df.withColumn("_rv", F.coalesce(value, F.lit(0))).withColumn("_rt", F.xxhash64(*df.columns))
    d = cut(d.repartitionByRange(parts, *keys).withColumn("_rp", F.spark_partition_id()), "ranges")
    sums = d.groupBy(*group, "_rp").agg(F.sum("_rv").alias("_rs"))
    before = F.coalesce(F.sum("_rs").over(W.partitionBy(*group).orderBy("_rp").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = cut(sums.select(*group, "_rp", before.alias("_rb")), "sums")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*group, "_rp"]]
    inside = F.coalesce(F.sum("_rv").over(W.partitionBy(*group, "_rp").orderBy(*order, "_rt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    joined = d.alias("d").join(mark_small(sums).alias("s"), same).select("d.*", "s._rb")
    return joined.withColumn(name, inside + F.col("_rb")).drop("_rv", "_rt", "_rp", "_rb")


def percentiles(df: DataFrame, group: list[str], values: dict[str, Column], shares: tuple[float, ...], accuracy: int = 1_000) -> DataFrame:
    """One row for each group (null is one) with the exact interpolated percentiles of non-null numbers, columns <name>_p<percent>; null where there are none.

    A first pass sketches, for each percentile, two values it lies between; a second counts the values below and keeps those between, at most
    about 6/`accuracy` of a group, from which the two order statistics are read. No group is sorted or gathered whole.
    """
    names = [(n, s, f"_{n}_{i}") for n in values for i, s in enumerate(shares)]
    d = df.select(*group, *[c.cast("double").alias(f"_v_{n}") for n, c in values.items()])
    step = 2.0 / accuracy
    ends = lambda s: F.array(F.lit(max(0.0, s - step)), F.lit(min(1.0, s + step)))
    sketch = [F.percentile_approx(f"_v_{n}", ends(s), accuracy).alias(k) for n, s, k in names]
    whole = [f(F.col(f"_v_{n}")).alias(f"_{w}_{n}") for n in values for w, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    b = cut(d.groupBy(*group).agg(*sketch, *whole), "brackets")
    few = lambda n: F.col(f"_n_{n}") * step <= 4  # noqa: E731  (the sketch's ranks may be off by what one or two values are: such a group is kept whole)
    low = lambda n, s, k: F.when(F.lit(s <= step) | few(n), F.col(f"_lo_{n}")).otherwise(F.col(k)[0])
    high = lambda n, s, k: F.when(F.lit(s >= 1 - step) | few(n), F.col(f"_hi_{n}")).otherwise(F.col(k)[1])
    both = d.alias("d").join(mark_small(b).alias("b"), [F.col(f"d.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group])
    aggs = []
    for n, s, k in names:
        v = F.col(f"_v_{n}")
        aggs += [F.count_if(v < low(n, s, k)).alias(f"{k}_b"), F.collect_list(F.when((v >= low(n, s, k)) & (v <= high(n, s, k)), v)).alias(f"{k}_l")]
        aggs += [F.first(f"_n_{n}").alias(f"{k}_n")]
    got = both.groupBy(*[F.col(f"d.{c}").alias(c) for c in group]).agg(*aggs)
    out = []
    for n, s, k in names:
        at = F.lit(s) * (F.col(f"{k}_n") - 1)
        held = F.array_sort(f"{k}_l")
        pick = lambda i: F.get(held, (i - F.col(f"{k}_b")).cast("int"))  # noqa: B023, E731
        a, z = pick(F.floor(at)), pick(F.ceil(at))
        out.append((a + (z - a) * (at - F.floor(at))).alias(f"{n}_p{round(s * 100)}"))
    return got.select(*group, *out)


def spread_join(rows: DataFrame, by_key: DataFrame, key: str, n: str, hot: int = 1_000_000, most: int = 500_000) -> DataFrame:
    """`rows` joined with a written table of unique keys that holds `n`, the number of rows of each key. Null keys match nothing; `n` is left out.

    A table of few keys is broadcast and no row moves. Else only the keys of more than `hot` rows are (there are at most rows/`hot` of them), and just
    the rows of other keys are shuffled, so that no task gets a key of more rows than that.
    """
    narrow = by_key.drop(n)
    if by_key.count() <= most:
        return rows.join(F.broadcast(narrow), key)
    mark = F.broadcast(by_key.where(F.col(n) > hot).drop(n))
    return rows.join(mark, key).unionByName(rows.join(mark.select(key), key, "left_anti").join(by_key.where(F.col(n) <= hot).drop(n), key))
