"""Batch planning: chunks, pairs, cursors, limits by prefix sums, and intervals as equal joins."""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .rank import running


def chunks(df: DataFrame, n: Column, size: int) -> DataFrame:
    """Each count cut into pieces of at most `size`: chunk_no from 0 and chunk_size. Counts below 1 and nulls give no chunk."""
    k = F.ceil(n / size).cast("long")
    return (
        df.where(n > 0).withColumn("chunk_no", F.explode(F.sequence(F.lit(0).cast("long"), k - 1)))
        .withColumn("chunk_size", F.least(F.lit(size), n - F.col("chunk_no") * size).cast("long"))
    )


def within_limit(df: DataFrame, value: Column, limit: Column, group: list[str], order: list[str]) -> DataFrame:
    """Rows of each group from the first on while the sum of positive values, their own included, stays within the limit; `running` is that sum."""
    before = running(df, value, group, order, "running")
    return before.withColumn("running", F.col("running") + F.coalesce(value, F.lit(0))).where(F.col("running") <= limit)


def assign_intervals(items: DataFrame, outputs: DataFrame, group: list[str], count: str, order: list[str], pos: str, width: int = 10_000) -> DataFrame:
    """Outputs at 0-based place `pos` of their group, each with the item in whose cumulative [start, end) it falls; outputs beyond all items drop out.

    Starts and outputs are laid on one line, and an output takes the last start before it. The line is cut into stretches of `width` places, each a
    window of its own; an item stands once in every stretch it reaches into, so a long item costs a row for each `width` places. Null and
    negative counts cover nothing. Columns of the items come first, and those of the outputs of other names after them.
    """
    at = running(items.where(F.col(count) > 0), F.col(count), group, order, "_from").withColumn("_to", F.col("_from") + F.col(count))
    mine, theirs = [c for c in items.columns if c not in group], [c for c in outputs.columns if c not in (*group, pos, *items.columns)]
    starts = at.withColumn("_s", F.explode(F.sequence(F.floor(F.col("_from") / width), F.floor((F.col("_to") - 1) / width))))
    kinds = {f.name: f.dataType for f in items.schema} | {f.name: f.dataType for f in outputs.schema}
    item = F.struct(*[F.col(c) for c in mine], F.col("_to"))
    line = starts.select(*group, "_s", F.greatest(F.col("_from"), F.col("_s") * width).cast("long").alias("_at"), F.lit(0).alias("_k"), item.alias("_i"), *[F.lit(None).cast(kinds[c]).alias(c) for c in theirs])
    asked = outputs.where(F.col(pos) >= 0).select(*group, F.floor(F.col(pos) / width).alias("_s"), F.col(pos).cast("long").alias("_at"), F.lit(1).alias("_k"), F.lit(None).cast(line.schema["_i"].dataType).alias("_i"), *theirs)
    last = F.last("_i", ignorenulls=True).over(W.partitionBy(*group, "_s").orderBy("_at", "_k").rowsBetween(W.unboundedPreceding, 0))
    got = line.unionByName(asked).withColumn("_i", last).where("_k = 1 and _at < _i._to")
    return got.select(*group, *[F.col("_i")[c].alias(c) for c in mine], F.col("_at").alias(pos), *theirs)


def _paired(rows: list[tuple], most: int) -> list[tuple]:
    """(item, partner) of (item, key, size) rows in order. Free rows stand in one queue for each key and size, so a partner is the least head
    among the queues of other keys that are small enough."""
    queues: dict[tuple, deque] = {}
    for i, (_, key, size) in enumerate(rows):
        queues.setdefault((key, size), deque()).append(i)
    taken, out = [False] * len(rows), []
    for i, (item, key, size) in enumerate(rows):
        if taken[i]:
            continue
        queues[(key, size)].popleft()
        fit = [q[0] for (k, s), q in queues.items() if q and k != key and s + size <= most]
        partner = min(fit, default=None)
        if partner is not None:
            taken[partner] = True
            queues[rows[partner][1:]].popleft()
        out.append((item, None if partner is None else rows[partner][0]))
    return out


def greedy_pairs(df: DataFrame, group: str, item: str, key: str, size: str, order: str, most: int) -> DataFrame:
    """(group, item, partner): each chunk in order with the first later free one of its group that has another key and fits within `most`.

    Whom a chunk meets follows from all choices before it, so a group is one task's work; groups are plans (one run's requests), not tables.
    """

    def pair(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values([order, item])
        clean = [None if pd.isna(k) else k for k in g[key]]
        out = pd.DataFrame(_paired(list(zip(g[item], clean, g[size])), most), columns=["item", "partner"])
        return out.assign(**{group: g[group].iloc[0]})[[group, "item", "partner"]]

    kinds = dict(df.dtypes)
    narrow = df.select(group, item, key, size, order)
    return narrow.groupBy(group).applyInPandas(pair, f"{group} {kinds[group]}, item {kinds[item]}, partner {kinds[item]}")
