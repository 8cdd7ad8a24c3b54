"""Splits that keep related records together: union-find over shared keys with local forests merged over levels, then groups largest first to the split
furthest below target."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.textnorm import nfkc
from ..operators.components import connected_components
from ..operators.rank import ranked, spread_join
from ..session import cut


def family(text: Column) -> Column:
    """A text's family: NFKC, lower case, unit numbers dropped (a_01 as a), letters and digits only. Null and blank are one family."""
    t = F.regexp_replace(F.lower(nfkc(text)), r"[^\p{L}\p{N}_]+", "")
    return F.regexp_replace(F.regexp_replace(t, "([ae])_[0-9]{2}", "$1"), "_", "")


def keyed(rows: DataFrame, keys: list[str], no: str | None = None) -> DataFrame:
    """`rows` with _keys, the hashes of the keys that are not null, and _first, the first of them. A record without any key has a number of its own from its
    column `no`, or, if none is named, from all its columns, so that repeats of it stay together."""
    h = [F.when(F.col(k).isNotNull(), F.xxhash64(F.lit(i if len(keys) > 1 else 0), F.col(k).cast("string"))) for i, k in enumerate(keys)]
    rows = rows.withColumn("_keys", F.array_compact(F.array(*h)))
    own = F.xxhash64(F.lit("alone"), *([no] if no else [c for c in rows.columns if c != "_keys"]))
    return rows.withColumn("_first", F.coalesce(F.get("_keys", F.lit(0)), own))


def groups_of(rows: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """(_first, group_no, _n, aggregates...) of `keyed` rows, written: each first key with its group and what its records come to.

    Records that share a value of any key, also through others, are of one group. Null keys relate nothing. The graph has key values as its nodes, not
    records: a value shared by any number of records is one node, and a record only ties its own values together; with one key nothing has
    to be tied. Records are counted by key before anything is shuffled.
    """
    by_first = rows.groupBy("_first").agg(F.count("*").alias("_n"), *aggregates)
    if len(keys) == 1:
        return cut(by_first.withColumn("group_no", F.col("_first")), "keys")
    ties = rows.select(F.explode(F.transform(F.slice("_keys", 2, len(keys)), lambda k: F.struct(F.get("_keys", F.lit(0)).alias("a"), k.alias("b")))).alias("t"))
    roots = connected_components(ties.select("t.a", "t.b")).select(F.col("node").alias("_first"), F.col("root").alias("group_no"))
    return cut(by_first.join(roots, "_first", "left").withColumn("group_no", F.coalesce("group_no", "_first")), "keys")


def quotas(sizes: list[tuple[int, int]], shares: dict[str, float]) -> list[tuple[int, str, int, int]]:
    """(size, split, first rank, end rank): what giving groups out largest first, each to the split furthest below its target, comes to.

    `sizes`: (size, number of groups). Equal groups are dealt with at once: of c groups of one size a split gets as many as it has
    values among the c largest of its gap, gap - size, gap - 2 size ... Ties go to the split named first. Groups larger than what any split
    lacks still go to the one furthest below.
    """
    total = sum(s * n for s, n in sizes)
    names = list(shares)
    whole = sum(shares.values()) or 1.0
    gap = {k: total * shares[k] / whole for k in names}
    out = []
    for size, count in sorted(sizes, reverse=True):
        # level far enough down that nearly all are given out at once, the rest one by one
        low, high = min(gap.values()) - size * (count + 1.0), max(gap.values())
        for _ in range(200):
            mid = (low + high) / 2
            if sum(max(0, int((gap[k] - mid) // size) + 1) if gap[k] > mid else 0 for k in names) <= count:
                high = mid
            else:
                low = mid
            if high - low < size / 4:
                break
        given = {k: max(0, int((gap[k] - high) // size)) if gap[k] > high else 0 for k in names}
        left = count - sum(given.values())
        heap = [(-(gap[k] - given[k] * size), i, k) for i, k in enumerate(names)]
        heapq.heapify(heap)
        for _ in range(left):
            g, i, k = heap[0]
            given[k] += 1
            heapq.heapreplace(heap, (g + size, i, k))
        at = 0
        for k in names:
            if given[k]:
                out.append((size, k, at, at + given[k]))
                at += given[k]
            gap[k] -= given[k] * size
    return out


def assign(groups: DataFrame, shares: dict[str, float]) -> DataFrame:
    """(group_no, size, new_split) of groups (group_no, size).

    The driver sees the histogram of group sizes only: N records have at most sqrt(2 N) different sizes. Which of the groups of one size go
    where follows the hash of their number. No groups give no rows; an empty `shares` is an error.
    """
    if not shares:
        raise ValueError("no splits")
    hist = [tuple(r) for r in groups.groupBy("size").count().collect()]
    plan = groups.sparkSession.createDataFrame(quotas(hist, shares), "size long, new_split string, lo long, hi long")
    at = ranked(groups.select("group_no", F.col("size").cast("long").alias("size")), ["size"], F.xxhash64("group_no"), "at")
    return at.join(plan, "size").where("at >= lo and at < hi").select("group_no", "size", "new_split")


def grouped_split(rows: DataFrame, keys: list[str], shares: dict[str, float], no: str | None = None) -> DataFrame:
    """`rows` with group_no, size and new_split: all records of a group in one split, the splits near their shares.

    Columns of these names that `rows` brings are replaced. Repeated records count as often as they stand there; no rows give none. Groups are put
    together and assigned in narrow tables of keys; the records themselves stay where they are or move by their key (see `spread_join`).
    """
    r = keyed(rows.drop(*({"group_no", "size", "new_split"} - set(keys))), keys, no)
    by_first = groups_of(r, keys)
    sizes = cut(by_first.groupBy("group_no").agg(F.sum("_n").alias("size")), "groups")
    found = cut(by_first.join(assign(sizes, shares), "group_no"), "assigned")
    return spread_join(r.drop("_keys"), found, "_first", "_n").drop("_first")


def torn(rows: DataFrame, keys: list[str], split: str) -> DataFrame:
    """Records whose group holds more than one value of `split`, with group_no. Nulls of `split` are no value. What a group holds comes from narrow counts
    by key, so that a group of any share of all rows stays where it is."""
    r = keyed(rows.drop(*({"group_no"} - set(keys))), keys)
    by_first = groups_of(r, keys, F.min(split).alias("_lo"), F.max(split).alias("_hi"))
    bad = by_first.groupBy("group_no").agg(F.min("_lo").alias("lo"), F.max("_hi").alias("hi")).where("lo <> hi").select("group_no")
    return spread_join(r.drop("_keys"), cut(by_first.join(bad, "group_no", "left_semi").select("_first", "group_no", "_n"), "torn"), "_first", "_n").drop("_first")
