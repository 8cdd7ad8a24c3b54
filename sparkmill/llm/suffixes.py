"""Spans that texts of one side share with texts of the other: a partitioned suffix array, merged into coverage per text.

The suffixes of all texts are partitioned by their first SPAN characters and sorted in each partition. In sorted order the longest
prefix that a left suffix shares with any right suffix is the one with its nearest right neighbour before or after it, so one pass over
adjacent suffixes finds it; no pairs are formed. Suffixes whose first SPAN characters stand on one side only are dropped
before the shuffle by two fixed-size maps of hashed grams. A gram that too many right suffixes begin with is spread over salts, each of
which sees all left suffixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .pieces import distinct_pairs, firsts, maps, may_be_like, pieces

SPAN = 8  # the least length of a shared span
WIDTH = 256  # characters of a suffix that are compared at once; a longer span shows as spans that follow each other
MAP = 1 << 20
MOST = 50_000  # right suffixes in one group
_MIX = 0x9E3779B97F4A7C15


def _grams(texts: list[str], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, offset and hash of the first `span` characters of each suffix that has as many."""
    size = np.array([len(t) for t in texts], np.int64)
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    begin = np.cumsum(np.r_[0, size])[:-1]
    if len(c) < span:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    h = np.zeros(len(c) - span + 1, np.uint64)
    for k in range(span):
        h = h * np.uint64(_MIX) + c[k : k + len(h)]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    row = np.repeat(np.arange(len(texts)), size)[: len(h)]
    off = np.arange(len(h)) - begin[row]
    ok = off + span <= size[row]
    return row[ok], off[ok], h[ok]


def _present(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, MAP), np.int64)
        for b in batches:
            row, _, h = _grams(b.column("text").to_pylist(), span)
            side = b.column("side").to_numpy(zero_copy_only=False)[row]
            at = (h >> np.uint64(44)).astype(np.int64)
            n[0] += np.bincount(at[side & 1 > 0], minlength=MAP)
            n[1] += np.bincount(at[side & 2 > 0], minlength=MAP)
        at = np.nonzero(n.any(0))[0]
        yield pa.RecordBatch.from_pydict({"bucket": at, "l": n[0][at], "r": n[1][at]})

    return run


def _emit(both: np.ndarray, salts: np.ndarray, span: int):
    schema = pa.schema([("gram", pa.int64()), ("salt", pa.int32()), ("tid", pa.int64()), ("off", pa.int32()), ("side", pa.int32()), ("suffix", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, tid, side = b.column("text").to_pylist(), b.column("tid").to_numpy(), b.column("side").to_numpy(zero_copy_only=False).astype(np.int64)
            row, off, h = _grams(texts, span)
            at = (h >> np.uint64(44)).astype(np.int64)
            keep = both[at]
            row, off, h, n = row[keep], off[keep], h[keep].astype(np.int64), salts[at[keep]]
            for s, bit in ((0, 1), (1, 2)):
                for k in range(int(n.max(initial=0))):
                    use = (side[row] & bit > 0) & (n > k) & ((s == 0) | ((tid[row] + off) % n == k))
                    if use.any():
                        r, o = row[use], off[use]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(h[use]), pa.array(np.full(len(r), k, np.int32)), pa.array(tid[r]), pa.array(o.astype(np.int32)), pa.array(np.full(len(r), s, np.int32)), pa.array([texts[i][x : x + WIDTH] for i, x in zip(r, o)], pa.string())],
                            schema=schema,
                        )

    return run


def common(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def longest(suffixes: list[str], sides: list[int], span: int) -> list[tuple[int, int, int]]:
    """(place of a left suffix, length, place of a right suffix) by one pass down and one pass up the sorted suffixes."""
    order = sorted(range(len(suffixes)), key=lambda i: suffixes[i])
    best: dict[int, tuple[int, int]] = {}
    for way in (order, order[::-1]):
        right, lcp, before = None, 0, None
        for i in way:
            if before is not None:
                lcp = min(lcp, common(suffixes[before], suffixes[i]))
            if sides[i]:
                right, lcp = i, len(suffixes[i])
            elif right is not None and lcp >= span and lcp > best.get(i, (0, 0))[0]:
                best[i] = (lcp, right)
            before = i
    return [(i, n, r) for i, (n, r) in best.items()]


def _match(span: int):
    schema = pa.schema([("tid", pa.int64()), ("off", pa.int32()), ("n", pa.int32()), ("other", pa.int64()), ("at", pa.int32())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def flush(f: pd.DataFrame) -> list[tuple]:
            out = []
            tid, off, side, suffix = f["tid"].to_numpy(), f["off"].to_numpy(), f["side"].to_numpy(), f["suffix"].tolist()
            key = f["gram"].to_numpy(), f["salt"].to_numpy()
            cut = np.nonzero(np.r_[True, (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])])[0]
            for s, e in zip(cut, [*cut[1:], len(f)]):
                if 0 < side[s:e].sum() < e - s:
                    out += [(tid[s + i], off[s + i], n, tid[s + r], off[s + r]) for i, n, r in longest(suffix[s:e], side[s:e].tolist(), span)]
            return out

        for f in frames:  # sorted by gram and salt; the last group of a frame may go on in the next
            f = pd.concat([*held, f], ignore_index=True) if held else f
            if not len(f):
                continue
            last = (f["gram"] == f["gram"].iloc[-1]) & (f["salt"] == f["salt"].iloc[-1])
            held = [f[last]]
            yield pd.DataFrame(flush(f[~last]), columns=schema.names) if (~last).any() else pd.DataFrame(columns=schema.names)
        if held:
            yield pd.DataFrame(flush(held[0]), columns=schema.names)

    return run


def _merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans sorted by text and offset into characters covered, the longest span and the other text it stands in. Spans that follow each other in both
    texts are one."""
    tid = end = chain = begin = before = None
    covered = best = other = 0
    for f in frames:
        out = []
        for t, o, n, x, at in zip(f["tid"], f["off"], f["n"], f["other"], f["at"]):
            if t != tid:
                if tid is not None:
                    out.append((tid, covered, best, other))
                tid, end, covered, best, chain = t, 0, 0, 0, None
            if (x, at - o) != chain or o != before + 1:
                chain, begin = (x, at - o), o
            before = o
            covered += max(0, o + n - max(o, end))
            end = max(end, o + n)
            if o + n - begin > best:
                best, other = o + n - begin, x
        yield pd.DataFrame(out, columns=["tid", "covered", "longest", "other"])
    if tid is not None:
        yield pd.DataFrame([(tid, covered, best, other)], columns=["tid", "covered", "longest", "other"])


def shared_spans(texts: DataFrame, span: int = SPAN, most: int = MOST) -> DataFrame:
    """(tid, covered, longest, other): for each left text with any, the characters in spans of `span` or more that stand in right texts.

    `texts`: tid long (unique), text, side int (1 left, 2 right, 3 both; a text on both sides covers itself). Null and shorter texts share
    nothing; no texts give no rows. `other` is a right text with the longest span. `covered` is exact at any length; suffixes are compared by their first
    WIDTH characters, and a longer span is put together from spans that follow each other in one right text, so where several right texts agree for WIDTH
    characters, `longest` may be that of another than the one that goes on longest.
    """
    texts = texts.select("tid", "text", "side").where(F.length("text") >= span)
    n = np.zeros((2, MAP), np.int64)
    for r in texts.mapInArrow(_present(span), "bucket long, l long, r long").groupBy("bucket").agg(F.sum("l").alias("l"), F.sum("r").alias("r")).toArrow().to_batches():
        n[:, r.column(0).to_numpy()] = np.stack([r.column(1).to_numpy(), r.column(2).to_numpy()])
    both, salts = n.all(0), np.maximum(1, -(-n[1] // most))
    kinds = "gram long, salt int, tid long, off int, side int, suffix string"
    sorted_ = texts.mapInArrow(_emit(both, salts, span), kinds).repartition("gram", "salt").sortWithinPartitions("gram", "salt")
    found = sorted_.mapInPandas(_match(span), "tid long, off int, n int, other long, at int").groupBy("tid", "off").agg(F.max(F.struct("n", "other", "at")).alias("m"))
    spans = found.select("tid", "off", "m.n", "m.other", "m.at").repartition("tid").sortWithinPartitions("tid", "off")
    return spans.mapInPandas(_merge, "tid long, covered long, longest long, other long")


# Pairs of texts that share a span ----------------------------------------------------------------------------------------------

RUN = 16  # the span that two texts share, by which they are found
PAIRS = 50_000  # of one interval that are paired off
BITS = 1 << 24


def _picked(texts: list[str], n: np.ndarray, run: int, span: int) -> tuple[np.ndarray, ...]:
    """Row, offset and hash of all suffixes, and the places among them of those that stand for a text: of every `run` characters the one that begins with the rarest gram.

    Which that is follows from these characters alone, so two texts that share them have the same gram among theirs.
    """
    row, off, h = _grams(texts, span)
    none = np.zeros(0, np.int64)
    if not len(h):
        return row, off, h, none
    order = (n[(h >> np.uint64(44)).astype(np.int64)].astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20))
    w = run - span + 1
    best, have = np.arange(len(h)), 1  # place of the least order in the `have` places from each on, by doubling
    while have < w:
        step = min(have, w - have)
        if len(best) <= step:
            return row, off, h, none
        a, b = best[:-step], best[step:]
        best = np.where(order[a] <= order[b], a, b)
        have += step
    last = np.arange(len(best)) + w - 1
    best = best[row[: len(best)] == row[last]]  # these places never go back
    return row, off, h, best[firsts(best)]


def _side_bits(n: np.ndarray, run: int, span: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros((2, BITS), bool)
        for b in batches:
            row, _, h, pick = _picked(b.column("text").to_pylist(), n, run, span)
            mask, at = b.column("mask").to_numpy(zero_copy_only=False)[row[pick]], (h[pick] >> np.uint64(40)).astype(np.int64)
            bits[0][at[mask & 5 > 0]] = True
            bits[1][at[mask & 10 > 0]] = True
        words = np.packbits(bits, axis=1).view(np.int64)
        at = np.nonzero(words.any(0))[0]
        yield pa.RecordBatch.from_pydict({"word": at, "l": words[0][at], "r": words[1][at]})

    return go


def _suffixes(n: np.ndarray, words: np.ndarray, run: int, span: int):
    """Two hashes of each picked suffix, of its first and its next `span` characters, with its text's sides, number of pieces and piece maps."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.unpackbits(words.view(np.uint8)).astype(bool)
        for b in batches:
            texts, tid, mask = b.column("text").to_pylist(), b.column("tid").to_numpy(), b.column("mask").to_numpy(zero_copy_only=False).astype(np.int32)
            row_of, off, h_of, pick = _picked(texts, n, run, span)
            pick = pick[both[(h_of[pick] >> np.uint64(40)).astype(np.int64)]]
            if not len(pick):
                continue
            row, h = row_of[pick], h_of[pick]
            size = np.array([len(t) for t in texts])
            after = np.minimum(pick + span, len(h_of) - 1)  # grams stand in the order of rows and offsets
            whole = off[pick] + 2 * span <= size[row]
            deep = np.where(whole, h_of[after], np.uint64(0))
            begin = firsts(row)
            used, nth = row[begin], np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(row)]))
            at, code = pieces([texts[r] for r in used])  # all have some: they are longer than a gram
            start = np.nonzero(np.r_[True, at[1:] != at[:-1]])[0]
            b0, b1 = maps(code, start)
            n_pieces = np.diff(np.r_[start, len(at)]).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "h": h.view(np.int64), "deep": deep.view(np.int64), "tid": tid[row], "mask": mask[row], "size": n_pieces[nth], "b0": b0[nth].view(np.int64), "b1": b1[nth].view(np.int64),
            })

    return go


def _interval_pairs(rows: np.ndarray, c: list[np.ndarray], most: int, descend: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Left and right tids of an interval, rows of the columns `c`, of suffixes with a common prefix; one that holds more pairs than `most` is cut into those of
    the longer prefixes, and what is still too large gives none. Pairs whose sizes or piece maps rule out the likeness are left out."""
    _, deep, tid, mask, size, b0, b1 = c
    for left, right in ((1, 2), (4, 8)):
        i, j = rows[mask[rows] & left > 0], rows[mask[rows] & right > 0]
        if not len(i) or not len(j):
            continue
        if len(i) * len(j) > most:
            if descend:
                order = rows[np.argsort(deep[rows], kind="stable")]
                for part in np.split(order, np.nonzero(np.diff(deep[order]))[0] + 1):
                    if deep[part[0]]:
                        yield from _interval_pairs(part, [*c[:3], mask & (left | right), *c[4:]], most, False)
            continue
        near = 10 * np.minimum(size[i][:, None], size[j][None, :]) >= 6 * np.maximum(size[i][:, None], size[j][None, :])
        a, b = np.nonzero(near)
        a, b = i[a], j[b]
        ok = (tid[a] != tid[b]) & may_be_like(size[a] + size[b], (b0[a].view(np.uint64), b1[a].view(np.uint64)), (b0[b].view(np.uint64), b1[b].view(np.uint64)))
        yield tid[a[ok]], tid[b[ok]]


def _intervals(most: int):
    names = ["h", "deep", "tid", "mask", "size", "b0", "b1"]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in _with_end(batches):  # sorted; the last interval of a batch may go on in the next
            now = None if b is None else [b.column(c).to_numpy(zero_copy_only=False) for c in names]
            cols = held if now is None else now if held is None else [np.concatenate(x) for x in zip(held, now)]
            if cols is None or not len(cols[0]):
                continue
            h = cols[0]
            start = np.nonzero(np.r_[True, h[1:] != h[:-1]])[0]
            end = len(h) if b is None else start[-1]
            held = None if b is None else [c[end:] for c in cols]
            xs, ys = [], []
            both = np.bitwise_or.reduceat(cols[3], start)
            for s, e, m in zip(start, [*start[1:], len(h)], both):
                if e <= end and (m & 3 == 3 or m & 12 == 12):
                    for x, y in _interval_pairs(np.arange(s, e), cols, most):
                        xs.append(x)
                        ys.append(y)
            if xs:
                x, y = distinct_pairs(np.concatenate(xs), np.concatenate(ys))
                for i in range(0, len(x), 100_000):
                    yield pa.RecordBatch.from_pydict({"x": x[i : i + 100_000], "y": y[i : i + 100_000]})

    return go


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def span_pairs(texts: DataFrame, run: int = RUN, span: int = SPAN, most: int = PAIRS) -> DataFrame:
    """(x, y), with repeats: tids of a left and a right text that share `run` characters in a row and whose pieces allow a likeness of 0.6; all that have it are among them.

    `texts`: tid long, text, mask int (bits 1 and 4 left, 2 and 8 right; 1 meets 2 and 4 meets 8). Of the array of all suffixes those are kept that begin
    with the rarest gram of `span` characters in some `run` characters of their text, so a shared span keeps the same suffix on both sides. They
    are partitioned by that gram and sorted; adjacent suffixes with a common prefix make an interval, and one that holds both sides gives pairs. An interval of more
    than `most` pairs is cut into those of twice the prefix, and what is still larger gives none: such pairs are left to the caller's own join.
    Suffixes whose gram no text of the other side has kept are dropped before they are shuffled, by two maps of fixed size.
    """
    texts = texts.select("tid", "text", "mask").where(F.length("text") >= run)
    n = np.zeros(MAP, np.int64)
    sides = texts.select("text", F.lit(1).alias("side"))
    for r in sides.mapInArrow(_present(span), "bucket long, l long, r long").groupBy("bucket").agg(F.sum("l").alias("l")).toArrow().to_batches():
        n[r.column(0).to_numpy()] = r.column(1).to_numpy()
    n = np.minimum(n, (1 << 20) - 1).astype(np.int32)
    words = np.zeros((2, BITS // 64), np.int64)
    for r in texts.select("text", "mask").mapInArrow(_side_bits(n, run, span), "word long, l long, r long").groupBy("word").agg(F.bit_or("l"), F.bit_or("r")).toArrow().to_batches():
        words[:, r.column(0).to_numpy()] = np.stack([r.column(1).to_numpy(), r.column(2).to_numpy()])
    rows = texts.mapInArrow(_suffixes(n, words[0] & words[1], run, span), "h long, deep long, tid long, mask int, size int, b0 long, b1 long")
    return rows.repartition("h").sortWithinPartitions("h", "deep").mapInArrow(_intervals(most), "x long, y long")
