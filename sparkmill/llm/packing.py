"""Filling containers of fixed capacity: best-fit decreasing with a segment tree over remaining capacities."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F

SHARD = 20_000
BLOCK = 1000  # limits in one plan
PACKED = "limit_name string, id long, piece int, n_pieces int, size long, container long"


class Room:
    """Open containers by what they still hold, in a segment tree with the number of containers below each node."""

    def __init__(self, capacity: int):
        self.n = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.n)  # 1 where a container is open below
        self.open: dict[int, list[int]] = {}

    def put(self, room: int, container: int) -> None:
        at = self.open.setdefault(room, [])
        at.append(container)
        i, tree = room + self.n, self.tree
        while i and not tree[i]:
            tree[i] = 1
            i >>= 1

    def tightest(self, size: int) -> int | None:
        """Take out the container with the least room that holds `size`; its room, or None."""
        tree, n = self.tree, self.n
        i = size + n
        if not tree[i]:
            while i > 1 and (i & 1 or not tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < n:
                i <<= 1
                if not tree[i]:
                    i += 1
        return i - n

    def take(self, room: int) -> int:
        at = self.open[room]
        container = at.pop()
        if not at:
            i, tree = room + self.n, self.tree
            tree[i] = 0
            i >>= 1
            while i and not (tree[2 * i] or tree[2 * i + 1]):
                tree[i] = 0
                i >>= 1
        return container


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The container of each size, given in falling order; sizes are from 0 to capacity."""
    room, out, n = Room(capacity), [], 0
    for size in sizes:
        r = room.tightest(size)
        if r is None:
            c, r = n, capacity
            n += 1
        else:
            c = room.take(r)
        room.put(r - size, c)
        out.append(c)
    return out


def _shard(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values(["size", "id", "piece"], ascending=[False, True, True])
    g["container"] = [(int(g["shard"].iloc[0]) << 32) | c for c in best_fit(g["size"].tolist(), int(g["capacity"].iloc[0]))]
    return g[["limit_name", "id", "piece", "n_pieces", "size", "container"]]


def pack(items: DataFrame, limits: DataFrame, shard: int = SHARD) -> DataFrame:
    """(limit_name, id, piece, n_pieces, size, container) of items (id long, size long) for limits (limit_name, capacity).

    An item larger than the capacity is cut into whole containers and a rest; no other is cut. Pieces are spread by hash over shards of about
    `shard` pieces which are packed on their own; only the last containers of a shard may stay emptier than one packing of all
    would leave them. Null sizes count as 0; items repeated under one id are packed each; capacities below 1 are an error. Limits are parameters, and every
    item has rows for each of them.
    """
    given = [tuple(r) for r in limits.select("limit_name", F.col("capacity").cast("long")).distinct().collect()]
    if any(c is None or c < 1 for _, c in given):
        raise ValueError("a capacity below 1")
    i = items.select(F.col("id").cast("long").alias("id"), F.coalesce(F.col("size").cast("long"), F.lit(0)).alias("s"))
    out = [_packed(i, given[k : k + BLOCK], shard) for k in range(0, len(given), BLOCK)]
    return reduce(DataFrame.unionAll, out) if out else items.sparkSession.createDataFrame([], PACKED)


def _packed(i: DataFrame, given: list[tuple], shard: int) -> DataFrame:
    count = lambda c: F.greatest(F.ceil(F.col("s") / c), F.lit(1)).cast("long")
    n_pieces = i.agg(*[F.coalesce(F.sum(count(F.lit(c))), F.lit(0)) for _, c in given]).first()
    shards = [max(1, -(-n // shard)) for n in n_pieces]
    each = [F.struct(F.lit(a).alias("limit_name"), F.lit(c).cast("long").alias("capacity"), F.lit(n).cast("long").alias("shards")) for (a, c), n in zip(given, shards)]
    pieces = (
        i.select("*", F.inline(F.array(*each)))
        .withColumn("n_pieces", count(F.col("capacity")).cast("int"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)))
        .withColumn("size", F.least("capacity", F.col("s") - F.col("piece") * F.col("capacity")))
        .withColumn("shard", F.pmod(F.xxhash64("id", "piece"), F.col("shards")))
    )
    # as many tasks as shards: each is about as much work as another
    spread = pieces.select("limit_name", "capacity", "shard", "id", "piece", "n_pieces", "size").repartition(max(8, 2 * sum(shards)), "limit_name", "shard")
    return spread.groupBy("limit_name", "shard").applyInPandas(_shard, PACKED)
