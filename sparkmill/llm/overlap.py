"""Same or nearly same texts across two sides of a table: an exact join of texts by the likeness of their two-character pieces.

Pieces are ordered by how rare they are. Of two like texts the rarest shared piece stands early in both (prefix filter), so each
text is listed under its first pieces only, and only the two sides of one list meet. Before anything is compared exactly, a pair
must pass two bounds read from the list entries: the pieces left after the shared one (position filter), and the least number of
pieces the texts cannot share, from 128-bit piece maps. Both bounds only drop pairs below the likeness, so no pair is lost.

Everything the driver holds is of fixed size: counts of BUCKETS hashed pieces. Lists whose pairs would outweigh one task are cut
into a grid of blocks of either side.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .pieces import MIX, distinct_pairs, maps, may_be_like, pieces
from .suffixes import span_pairs
from .texts import like

BUCKETS = 1 << 18
LIKE = 0.6  # the integer bounds below are those of 6/10
TASK_PAIRS, TASK_ENTRIES = 15_000_000, 100_000  # of one key; a task gets about KEYS of them, one after the other
KEYS = 4
BLOCK = 2_000_000
NO_SIZE = np.int64(1 << 30)  # no text has as many pieces
BY_SPAN, BY_JOIN = 1, 2
ENTRY = np.dtype([("tid", "<i8"), ("b0", "<u8"), ("b1", "<u8"), ("bm", "<u4"), ("size", "<u4"), ("pos", "<u2")])


def _bucket(code: np.ndarray) -> np.ndarray:
    return ((code * MIX) >> np.uint64(46)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(BUCKETS, np.int64)
    for b in batches:
        n += np.bincount(_bucket(pieces(b.column("text").to_pylist())[1]), minlength=BUCKETS)
    at = np.nonzero(n)[0]
    yield pa.RecordBatch.from_pydict({"bucket": at, "n": n[at]})


def _listed(texts: list[str], rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every text's prefix pieces: row, bucket, position, size; and the first place of each row with pieces and the codes in row order."""
    row, code = pieces(texts)
    bucket = _bucket(code)
    order = np.argsort((row.astype(np.uint64) << np.uint64(42)) | (rank[bucket].astype(np.uint64) << np.uint64(24)) | ((code * MIX) >> np.uint64(16)) & np.uint64(0xFFFFFF))
    row, code, bucket = row[order], code[order], bucket[order]
    start = np.nonzero(np.r_[True, row[1:] != row[:-1]])[0] if len(row) else np.zeros(0, np.int64)
    size = np.diff(np.r_[start, len(row)])
    pos = np.arange(len(row)) - np.repeat(start, size)
    n = np.repeat(size, size)
    return row, code, bucket, pos, n, start


def _prefix_counts(rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, least = np.zeros((2, BUCKETS), np.int64), np.full((2, BUCKETS), NO_SIZE)
        for b in batches:
            row, _, bucket, pos, n, _ = _listed(b.column("text").to_pylist(), rank)
            mask = b.column("mask").to_numpy(zero_copy_only=False)[row]
            first = pos <= n - (6 * n + 9) // 10
            for side, bits in ((0, 5), (1, 10)):
                mine = first & (mask & bits > 0)
                count[side] += np.bincount(bucket[mine], minlength=BUCKETS)
                np.minimum.at(least[side], bucket[mine], n[mine])
        at = np.nonzero(count.any(0))[0]
        yield pa.RecordBatch.from_pydict({"bucket": at, "l": count[0][at], "r": count[1][at], "l_least": least[0][at], "r_least": least[1][at]})

    return run


def _blob(e: np.ndarray) -> bytes:
    """Entries field by field, which the shuffle's compression makes smaller than entry by entry."""
    return b"".join(np.ascontiguousarray(e[f]).tobytes() for f in ENTRY.names)


def _entry(blob: pa.Buffer) -> np.ndarray:
    e, at = np.zeros(blob.size // ENTRY.itemsize, ENTRY), 0
    for f in ENTRY.names:
        e[f] = np.frombuffer(blob, ENTRY[f], len(e), at)
        at += len(e) * ENTRY[f].itemsize
    return e


def _entries(rank: np.ndarray, dest: np.ndarray, grid: np.ndarray, least: np.ndarray, part: np.ndarray):
    """Packed list entries by task key. dest: a bucket's first key, -1 for none; grid: into how many blocks either side is cut; least:
    the smallest size either side has in a bucket; part: a key's partition. An entry so far back that even that partner could not reach the likeness is left out.
    """

    def pack(kept: list[np.ndarray], sides: list[np.ndarray], keys: list[np.ndarray]) -> pa.RecordBatch:
        e, side, key = np.concatenate(kept), np.concatenate(sides), np.concatenate(keys)
        order = np.lexsort((e["bm"], side, key))
        e, side, key = e[order], side[order], key[order]
        at = np.nonzero(np.r_[True, (key[1:] != key[:-1]) | (side[1:] != side[:-1])])[0] if len(e) else []
        blobs = [_blob(x) for x in np.split(e, at[1:])] if len(e) else []
        return pa.RecordBatch.from_pydict({"key": pa.array(key[at], pa.int64()), "side": pa.array(side[at], pa.int32()), "part": pa.array(part[key[at]], pa.int32()), "blob": pa.array(blobs, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, sides, keys, held = [], [], [], 0
        for b in batches:
            row, code, bucket, pos, n, start = _listed(b.column("text").to_pylist(), rank)
            if not len(row):
                continue
            b0, b1 = maps(code, start)
            nth = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(row)]))
            tid, mask = b.column("tid").to_numpy(), b.column("mask").to_numpy(zero_copy_only=False).astype(np.int64)
            first = (pos <= n - (6 * n + 9) // 10) & (dest[bucket] >= 0)
            row, bucket, pos, n, nth = row[first], bucket[first], pos[first], n[first], nth[first]
            useful = [8 * (n - pos) >= 3 * (n + least[1 - side][bucket]) for side in (0, 1)]
            e = np.zeros(len(row), ENTRY)
            e["tid"], e["b0"], e["b1"] = tid[row], b0[nth], b1[nth]
            e["bm"], e["size"], e["pos"] = (bucket << 4) | mask[row], n, np.minimum(pos, 65535)
            g = grid[bucket]
            block = (tid[row].astype(np.uint64) * MIX >> np.uint64(32)).astype(np.int64) % g
            for side, bits in ((0, 5), (1, 10)):
                mine = (mask[row] & bits > 0) & useful[side]
                for k in range(int(g.max(initial=1))):  # blocks of the other side
                    use = mine & (g > k)
                    if use.any():
                        kept.append(e[use])
                        sides.append(np.full(use.sum(), side, np.int32))
                        keys.append(dest[bucket[use]] + (block[use] * g[use] + k if side == 0 else k * g[use] + block[use]))
                        held += int(use.sum())
            if held > 1_500_000:
                yield pack(kept, sides, keys)
                kept, sides, keys, held = [], [], [], 0
        if held:
            yield pack(kept, sides, keys)

    return run


def _compare(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of one key's left and right entries that pass both bounds."""
    a, b = a[np.argsort(a["bm"] >> 4, kind="stable")], b[np.argsort(b["bm"] >> 4, kind="stable")]
    ka, kb = a["bm"] >> 4, b["bm"] >> 4
    lists = np.intersect1d(ka, kb)
    a0, a1, b0, b1 = (np.searchsorted(k, lists, s) for k, s in ((ka, "left"), (ka, "right"), (kb, "left"), (kb, "right")))
    sa, sb = a["size"].astype(np.int32), b["size"].astype(np.int32)
    ra, rb = (sa - a["pos"]) * 8, (sb - b["pos"]) * 8
    xs, ys = [], []
    for i0, i1, j0, j1 in zip(a0, a1, b0, b1):
        step = max(1, BLOCK // (j1 - j0))
        for i in range(i0, i1, step):
            p, q = slice(i, min(i + step, i1)), slice(j0, j1)
            both = 3 * (sa[p, None] + sb[None, q])
            x, y = np.nonzero((ra[p, None] >= both) & (rb[None, q] >= both))
            if not len(x):
                continue
            x, y = x + i, y + j0
            near = may_be_like(sa[x] + sb[y], (a["b0"][x], a["b1"][x]), (b["b0"][y], b["b1"][y]))
            ok = near & ((a["bm"][x] & (b["bm"][y] >> 1) & 5) > 0) & (a["tid"][x] != b["tid"][y])
            xs.append(a["tid"][x[ok]])
            ys.append(b["tid"][y[ok]])
    if xs:
        x, y = distinct_pairs(np.concatenate(xs), np.concatenate(ys))
        for i in range(0, len(x), 100_000):
            yield pa.RecordBatch.from_pydict({"x": x[i : i + 100_000], "y": y[i : i + 100_000]})


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each key of a partition sorted by key, one key's entries at a time."""
    held, at = [[], []], None

    def done() -> Iterator[pa.RecordBatch]:
        if held[0] and held[1]:
            yield from _compare(*(np.concatenate(x) for x in held))

    for t in batches:
        for key, side, blob in zip(t.column("key").to_pylist(), t.column("side").to_pylist(), t.column("blob")):
            if key != at:
                yield from done()
                held, at = [[], []], key
            held[side].append(_entry(blob.as_buffer()))
    yield from done()


def _balanced(load: np.ndarray, parts: int) -> np.ndarray:
    """A partition for each key, so that the partitions' loads are near each other: the heaviest first, each to the lightest partition."""
    heap = [(0.0, p) for p in range(parts)]
    out = np.zeros(len(load), np.int32)
    for k in np.argsort(-load, kind="stable"):
        n, p = heap[0]
        out[k] = p
        heapq.heapreplace(heap, (n + load[k] + 1, p))
    return out


def _plan(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rank, first task key, grid and least sizes of each bucket, and the partition of each task key; from two fixed-size histograms."""
    n = np.zeros(BUCKETS, np.int64)
    for r in texts.select("text").mapInArrow(_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow().to_batches():
        n[r.column(0).to_numpy()] = r.column(1).to_numpy()
    rank = np.empty(BUCKETS, np.int32)
    rank[np.lexsort((np.arange(BUCKETS), n))] = np.arange(BUCKETS)
    left, right = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    least = np.full((2, BUCKETS), NO_SIZE)
    held = texts.select("text", "mask").mapInArrow(_prefix_counts(rank), "bucket long, l long, r long, l_least long, r_least long")
    for r in held.groupBy("bucket").agg(F.sum("l"), F.sum("r"), F.min("l_least"), F.min("r_least")).toArrow().to_batches():
        at, left_n, right_n, *sizes = (c.to_numpy() for c in r.columns)
        left[at], right[at], least[:, at] = left_n, right_n, np.stack(sizes)
    pairs, entries = left.astype(float) * right, left + right
    used = pairs > 0
    grid = np.where(used, np.maximum(1, np.ceil(np.sqrt(np.maximum(pairs / TASK_PAIRS, entries / (4 * TASK_ENTRIES))))), 1).astype(np.int64)
    light = used & (grid == 1)
    tasks = int(max(8, pairs[light].sum() // TASK_PAIRS, entries[light].sum() // TASK_ENTRIES))
    dest = np.full(BUCKETS, -1, np.int64)
    dest[light] = (np.arange(BUCKETS)[light] * 2654435761 % (1 << 32)) % tasks
    heavy = np.nonzero(used & (grid > 1))[0]
    dest[heavy] = tasks + np.r_[0, np.cumsum(grid[heavy] ** 2)[:-1]] if len(heavy) else dest[heavy]
    load = np.zeros(tasks + int((grid[heavy] ** 2).sum()))
    np.add.at(load, dest[light], entries[light])
    load[tasks:] = np.repeat(entries[heavy] / grid[heavy], grid[heavy] ** 2)
    dest, grid, least = dest.astype(np.int32), grid.astype(np.int32), least.astype(np.int32)  # they are sent to every task
    return rank, dest, grid, least, _balanced(load, max(8, len(load) // KEYS))


def text_id(text: Column) -> dict[str, Column]:
    """tid and tid2 of a text, 64 bits each: the first runs through the joins, the second is checked wherever ids are turned into records again."""
    return {"tid": F.xxhash64(text), "tid2": F.xxhash64(F.lit(1), text)}


def joined(texts: DataFrame) -> DataFrame:
    """(x, y), with repeats: pairs of tids that may be alike, by the prefix-filter join; every pair that is alike is among them."""
    rank, dest, grid, least, part = _plan(texts)
    lists = texts.mapInArrow(_entries(rank, dest, grid, least, part), "key long, side int, part int, blob binary")
    return lists.repartitionById(int(part.max(initial=0)) + 1, "part").sortWithinPartitions("key").select("key", "side", "blob").mapInArrow(_compared, "x long, y long")


def like_pairs(texts: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """(x, x2, y, y2, by): the ids (see `text_id`) of a left and a right text with like >= 0.6.

    `spans`: further pairs (x, y) that may be alike, such as those of `suffixes.span_pairs`. `by` says where a pair came from: BY_SPAN, BY_JOIN or their sum;
    0 for a text with itself.

    `texts`: tid long, text (normal form, each once), mask int. Texts whose tids collide are told apart by the second number. Mask bits 1 and 4 put a text on the left, 2 and 8 on the right; only 1 with 2
    and 4 with 8 are compared. A text that stands on both sides is paired with itself. Texts without pieces are like nothing;
    no texts give no pairs.
    """
    texts = texts.where(F.length("text") >= 2)
    found = cut(joined(texts).distinct(), "pairs") if spans is None else cut(
        joined(texts).withColumn("by", F.lit(BY_JOIN)).unionAll(spans.withColumn("by", F.lit(BY_SPAN))).groupBy("x", "y").agg(F.bit_or("by").alias("by")), "pairs"
    )
    side = lambda s: texts.select(F.col("tid").alias(s), F.col("text").alias(f"t_{s}"))
    second = lambda t: text_id(F.col(t))["tid2"]
    close = found.join(side("x"), "x").join(side("y"), "y").where(like("t_x", "t_y") >= LIKE).select("x", second("t_x").alias("x2"), "y", second("t_y").alias("y2"), *(["by"] if spans is not None else [F.lit(BY_JOIN).alias("by")]))
    same = texts.where(F.col("mask").bitwiseAND(F.shiftright("mask", 1)).bitwiseAND(5) > 0).select("tid", second("text").alias("tid2"))
    return close.unionAll(same.select("tid", "tid2", "tid", "tid2", F.lit(0)))


def cross_pairs(rows: DataFrame) -> DataFrame:
    """(low_no, high_no, by): records of which one is on the left and one on the right and which have like first or like second texts.

    `rows`: no long, is_left boolean, first, second (normal texts). Candidates are the texts that share a span found by the suffix array, and, for
    pairs without one and for spans too common to be paired off, those of the prefix-filter join; both are compared exactly. `by` says which
    found a pair (see `like_pairs`). Distinct texts are compared once; their records are only joined to the like pairs at the end. Null numbers
    are dropped, null texts are like nothing, repeated rows count once.
    """
    each = rows.where("no is not null").select(
        "no", "is_left",
        F.explode(F.array(
            F.struct(F.lit(1).alias("role"), F.col("first").alias("text")),
            F.struct(F.lit(4).alias("role"), F.col("second").alias("text")),
        )).alias("r"),
    ).select("no", "is_left", "r.role", F.coalesce("r.text", F.lit("")).alias("text")).where(F.length("text") >= 2)
    texts = cut(
        each.select("text", F.when(F.col("is_left"), F.col("role")).otherwise(F.col("role") * 2).alias("m"))
        .groupBy("text").agg(F.bit_or("m").cast("int").alias("mask"))
        .select(text_id(F.col("text"))["tid"].alias("tid"), "text", "mask"),
        "texts",
    )
    links = cut(like_pairs(texts, span_pairs(texts)), "links")
    at = each.select("no", "is_left", "role", *[i.alias(c) for c, i in text_id(F.col("text")).items()])
    left = at.where("is_left").select(F.col("no").alias("a"), "role", F.col("tid").alias("x"), F.col("tid2").alias("x2"))
    right = at.where("not is_left").select(F.col("no").alias("b"), "role", F.col("tid").alias("y"), F.col("tid2").alias("y2"))
    pairs = links.join(left, ["x", "x2"]).join(right, ["y", "y2", "role"]).select(F.least("a", "b").alias("low_no"), F.greatest("a", "b").alias("high_no"), "by")
    return pairs.groupBy("low_no", "high_no").agg(F.bit_or("by").alias("by"))
