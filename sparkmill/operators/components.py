"""Connected components by union-find: local forests in every partition, merged level by level, and star steps where a level outgrows its tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import cut, drop_cut

MERGE = 500_000  # links that one merging task takes in; it holds at most twice as many nodes


def _forest(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Union-find over the links of one partition; gives, with the partition's number, one link to the least member for each node that is not it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}
        part = TaskContext.get().partitionId()

        def root(x: int) -> int:
            while (p := up.get(x, x)) != x:
                up[x] = up.get(p, p)
                x = up[x]
            return x

        def stars() -> pa.RecordBatch:
            ids = [x for x in up if root(x) != x]
            return pa.RecordBatch.from_pydict({"part": pa.array([part] * len(ids), pa.int32()), "a": pa.array(ids, pa.int64()), "b": pa.array([root(x) for x in ids], pa.int64())})

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = root(x), root(y)
                if x != y:
                    up[max(x, y)] = min(x, y)
                    up.setdefault(min(x, y), min(x, y))
                if len(up) > 2 * most:  # bounds a task's memory: hand on what is merged so far
                    yield stars()
                    up.clear()
        if up:
            yield stars()

    return run


def _merged(e: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """Forests merged over levels: neighbouring partitions' forests meet in one task as long as that task holds at most `most` links. The second value says
    whether one forest is left; if not, the links of all forests together are more than a task may hold and do not shrink any more."""
    n, parts = e.agg(F.count("*"), F.max("part") + 1).first()
    while n:
        groups = -(-n // most)
        fan = -(-parts // groups)
        if parts > 1 and fan < 2:
            return e, False
        after = cut(e.repartitionById(-(-parts // fan), F.floor(F.col("part") / fan).cast("int")).select("a", "b").mapInArrow(_forest(most), "part int, a long, b long"), "forest")
        drop_cut(e)
        e = after
        if groups == 1:
            return e, True
        n, parts = e.agg(F.count("*"), F.max("part") + 1).first()
    return e, True


def _stars(e: DataFrame, max_rounds: int) -> DataFrame:
    """Alternating large-star and small-star steps until the links are stars, each step cut into the shared folder."""
    e, seen = e.select("a", "b"), None
    for _ in range(max_rounds):
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        after = cut(small, "links")
        now = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_cut(e)
        e = after
        if now == seen:
            return e
        seen = now
    raise RuntimeError("components did not settle")


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60, most: int = MERGE) -> DataFrame:
    """(node, root): each node of `links` with the least node it hangs together with.

    Nodes are longs. Links may repeat, loop and run either way; nulls are dropped; no links give no rows. Each partition first merges its own links
    into a forest, so what goes on is at most one link per node and partition. The forests are merged hierarchically, a level's tasks taking in as many
    neighbouring forests as fit (`most` links). Where all forests together outgrow a task and a level no longer shrinks them, star steps, which
    spread one component over many tasks, do the rest; both ways give the same rows.
    """
    e = (
        links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
        .where("a is not null and b is not null and a <> b")
        .mapInArrow(_forest(most), "part int, a long, b long")
    )
    e, whole = _merged(cut(e, "links"), most)
    e = e.select("a", "b") if whole else _stars(e, max_rounds)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
