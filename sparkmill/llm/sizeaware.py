"""Size-aware join of sets of text pieces inside groups: fixed-size subsets of small sets, inverted lists for large ones, the boundary by cost.

Two sets of n and m pieces with a likeness of 0.6 share at least 0.6 of the larger one, so the first c pieces they share, rarest first, stand among the
first n - ceil(0.6 n) + c of either. A small set is listed under every subset of two of those (c = 2), which few others have; small sets meet under
subsets only. Subsets of a large set would be too many: it is listed under its single pieces (c = 1), and so are the small sets that are near enough
in size to be like a large one; under a piece only pairs with a large set meet. No pair of likeness 0.6 is lost wherever the boundary lies, and
it is put where listing and comparing together cost least, counted over all sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .pieces import firsts

BUCKETS = 1 << 16
BOUNDARIES = (0, 4, 8, 12, 16, 20, 24, 32)  # numbers of pieces up to which a set may be small
ROW_COST = 4.0  # of listing a set under one key, in comparisons of a pair: measured, see README
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _codes(text: str) -> np.ndarray:
    """Hashes of the distinct pieces of a normal text."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    h = np.sort((c[:-1] << np.uint64(21)) | c[1:])
    h = h[firsts(h)] * _MIX
    return h ^ (h >> np.uint64(32))


def _bucket(h) -> np.ndarray:
    return (np.asarray(h, np.uint64) >> np.uint64(48)).astype(np.int64)


def prefix(n: int, c: int) -> int:
    """How many of the n pieces, rarest first, hold c of those shared with any set of likeness 0.6."""
    return min(n, n - (6 * n + 9) // 10 + c)


def _in_order(text: str, rank: np.ndarray) -> np.ndarray:
    h = _codes(text)
    return h[np.lexsort((h, rank[_bucket(h)]))]


def _subsets(h: np.ndarray) -> np.ndarray:
    """Keys of the subsets of two of a set's first pieces; a set of one piece has that piece twice."""
    p = h[: prefix(len(h), 2)]
    pairs = np.array(list(combinations(range(len(p)), 2)) or [(0, 0)])
    return (p[pairs[:, 0]] * _MIX) ^ p[pairs[:, 1]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(BUCKETS, np.int64)
    for b in batches:
        for t in b.column("text").to_pylist():
            n += np.bincount(_bucket(_codes(t)), minlength=BUCKETS)
    at = np.nonzero(n)[0]
    yield pa.RecordBatch.from_pydict({"bucket": at, "n": n[at]})


def _costed(rank: np.ndarray):
    """For each class of sizes, how many sets each bucket of keys lists: of pieces, and of subsets where the class may be small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, len(BOUNDARIES), BUCKETS), np.int64)
        for b in batches:
            for k, t in zip(b.column("k").to_pylist(), b.column("text").to_pylist()):
                h = _in_order(t, rank)
                salt = np.uint64(k & 0xFFFFFFFFFFFFFFFF)
                at = int(np.searchsorted(BOUNDARIES, len(h)))  # the first boundary that makes it small
                pieces = np.bincount(_bucket((h[: prefix(len(h), 1)] ^ salt) * _MIX), minlength=BUCKETS)
                if at < len(BOUNDARIES):
                    n[0, at] += pieces
                    n[1, at] += np.bincount(_bucket((_subsets(h) ^ salt) * _MIX), minlength=BUCKETS)
                else:
                    n[0, 0] += pieces  # the class of boundary 0 is free for sets that are always large
        kind, size, bucket = np.nonzero(n)
        yield pa.RecordBatch.from_pydict({"kind": kind, "size": size, "bucket": bucket, "n": n[kind, size, bucket]})

    return run


def cheapest(n: np.ndarray) -> int:
    """The boundary of least cost from the counts of `_costed` over all sets: rows listed times ROW_COST, and pairs compared under each key.

    n[0, s] counts listings under pieces, n[1, s] under subsets, of sets whose least boundary is BOUNDARIES[s]; n[0, 0] those that are always large.
    """
    best = []
    for s, b in enumerate(BOUNDARIES):
        small = range(1, s + 1)
        subsets = n[1, list(small)].sum(0) if s else np.zeros(n.shape[2])
        listed_small = [i for i in small if BOUNDARIES[i] > 0.6 * b]  # those that may be like a large set
        large = n[0, [0, *range(s + 1, len(BOUNDARIES))]].sum(0)
        near = n[0, listed_small].sum(0) if listed_small else np.zeros(n.shape[2])
        rows = subsets.sum() + large.sum() + near.sum()
        pairs = (subsets.astype(float) ** 2).sum() / 2 + (large.astype(float) * (large / 2 + near)).sum()
        best.append((ROW_COST * rows + pairs, b))
    return min(best)[1]


def _listed(rank: np.ndarray, boundary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, keys, sizes, kinds = [], [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                h = _in_order(t, rank)
                n = len(h)
                if n <= boundary:
                    s = _subsets(h)
                    at.append(np.full(len(s), i)), keys.append(s), sizes.append(np.full(len(s), n)), kinds.append(np.full(len(s), 0))
                if n > boundary or n > 0.6 * boundary:
                    p = h[: prefix(n, 1)]
                    at.append(np.full(len(p), i)), keys.append(p), sizes.append(np.full(len(p), n)), kinds.append(np.full(len(p), 2 if n > boundary else 1))
            if at:
                rows = np.concatenate(at)
                yield pa.RecordBatch.from_arrays(
                    [b.column("k").take(pa.array(rows)), b.column("eid").take(pa.array(rows)), pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sizes).astype(np.int32)), pa.array(np.concatenate(kinds).astype(np.int32))],
                    names=["k", "eid", "key", "size", "kind"],
                )

    return run


def plan(sets: DataFrame) -> tuple[np.ndarray, int]:
    """The pieces' order, rarest first, and the boundary, from two histograms of fixed size over all sets (k, text)."""
    n = np.zeros(BUCKETS, np.int64)
    for r in sets.select("text").mapInArrow(_counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow().to_batches():
        n[r.column(0).to_numpy()] = r.column(1).to_numpy()
    rank = np.empty(BUCKETS, np.int32)
    rank[np.lexsort((np.arange(BUCKETS), n))] = np.arange(BUCKETS)
    cost = np.zeros((2, len(BOUNDARIES), BUCKETS), np.int64)
    for r in sets.select("k", "text").mapInArrow(_costed(rank), "kind long, size long, bucket long, n long").groupBy("kind", "size", "bucket").agg(F.sum("n").alias("n")).toArrow().to_batches():
        cost[tuple(r.column(i).to_numpy() for i in range(3))] = r.column(3).to_numpy()
    return rank, cheapest(cost)


def size_aware_pairs(a: DataFrame, b: DataFrame | None = None, boundary: int | None = None) -> DataFrame:
    """Distinct (x, y): eids of one group k whose texts may have a likeness of 0.6; all that have are among them. `a` and `b`: k long, eid, text (normal form). Without
    `b` the pairs are inside `a`, the lesser eid first. Texts of fewer than two characters are like nothing; no sets give no pairs.
    """
    sides = [s.where(F.length("text") >= 2).select("k", "eid", "text") for s in ([a] if b is None else [a, b])]
    rank, found = plan(sides[0] if b is None else sides[0].unionAll(sides[1]))
    kinds = f"k long, eid {sides[0].schema['eid'].dataType.simpleString()}, key long, size int, kind int"
    lists = [cut(s.mapInArrow(_listed(rank, found if boundary is None else boundary), kinds), "lists") for s in sides]
    left = lists[0].select("k", "key", F.col("eid").alias("x"), F.col("size").alias("n"), F.col("kind").alias("s"))
    right = lists[-1].select("k", "key", F.col("eid").alias("y"), F.col("size").alias("m"), F.col("kind").alias("t"))
    meet = (F.col("s") + F.col("t") == 0) | (F.least("s", "t") >= 1) & (F.greatest("s", "t") == 2)  # two under a subset, or one large under a piece
    near = 10 * F.least("n", "m") >= 6 * F.greatest("n", "m")
    both = left.join(right, ["k", "key"]).where(meet & near & (F.col("x") < F.col("y") if b is None else F.lit(True)))
    return both.select("x", "y").distinct()
