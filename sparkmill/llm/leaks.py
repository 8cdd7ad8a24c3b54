"""Evaluation texts inside training text: rare n-gram seeds find the places, Smith-Waterman alignment scores them.

Both sides are compared in their normal form. A common run of RUN characters holds a whole seed of SEED characters wherever it lies in
an item, because an item's seeds start at most RUN - SEED + 1 characters apart; within that distance the n-gram that is rarest in
the corpus is taken. All texts are read once and whole; what is kept of the corpus are the documents that hold any n-gram of an item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.textnorm import norm
from ..operators.rank import spread_join
from ..session import cut, mark_small
from .pieces import firsts

RUN, SEED = 40, 20
MATCH, MISMATCH, GAP = 2, -1, -1
_B = np.uint64(0x9E3779B97F4A7C15)
MOST_BITS = 27  # log2 of the bits in the map of the items' n-grams: 16 MB sent to a task, 128 MB there


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end, and where each begins."""
    begin = np.cumsum([0, *map(len, texts)])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4"), begin


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the SEED characters from each place, by doubling."""
    h, have, parts, want = codes.astype(np.uint64) + np.uint64(1), 1, [], SEED
    total, at = None, 0
    while want:
        if want & 1:
            shifted = h[at:]
            total = shifted.copy() if total is None else total[: len(shifted)] * _pow(have) + shifted[: len(total)]
            at += have
        want >>= 1
        if want:
            if len(h) <= have:
                return np.zeros(0, np.uint64)
            h = h[:-have] * _pow(have) + h[have:]
            have *= 2
    keep = max(0, len(codes) - SEED + 1)
    total = total[:keep]
    return (total ^ (total >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def _pow(n: int) -> np.uint64:
    return np.uint64(pow(int(_B), n, 1 << 64))


def _bits(h: np.ndarray, log: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each n-gram in a map of 2^log bits."""
    return (h >> np.uint64(64 - log)).astype(np.int64), ((h >> np.uint64(8)) & np.uint64((1 << log) - 1)).astype(np.int64)


def seeds(rare: np.ndarray) -> np.ndarray:
    """Which of an item's n-grams, in the order of their places, are its seeds: in every stretch of RUN - SEED + 1 places the last of those that the fewest
    documents hold."""
    keep = np.zeros(len(rare), bool)
    last, step = -1, RUN - SEED + 1  # the seed chosen last; the next lies at most `step` further
    while last + step < len(rare):
        window = rare[last + 1 : last + 1 + step]
        last += len(window) - int(np.argmin(window[::-1]))
        keep[last] = True
    return keep


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment of two code arrays: score, end in a, end in b, and the longest common run. Linear gaps; memory of one row."""
    j = np.arange(len(b) + 1)
    h, run = np.zeros(len(b) + 1, np.int64), np.zeros(len(b), np.int64)
    best = (0, 0, 0)
    longest = 0
    for i, c in enumerate(a):
        same = b == c
        run = np.where(same, np.r_[0, run[:-1]] + 1, 0)
        t = np.zeros(len(b) + 1, np.int64)
        t[1:] = np.maximum(0, np.maximum(h[:-1] + np.where(same, MATCH, MISMATCH), h[1:] + GAP))
        h = np.maximum.accumulate(t - GAP * j) + GAP * j
        k = int(h.argmax())
        if h[k] > best[0]:
            best = (int(h[k]), i + 1, k)
        longest = max(longest, int(run.max(initial=0)))
    return *best, longest


def _item_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            h = _grams(_codes([t])[0])
            yield pa.RecordBatch.from_pydict({"g": h.view(np.int64), "item_id": np.full(len(h), i, np.int64), "place": np.arange(len(h), dtype=np.int32), "n_chars": np.full(len(h), len(t), np.int32)})


def _item_bits(log: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << log, bool)
        for b in batches:
            for at in _bits(b.column(0).to_numpy().view(np.uint64), log):
                table[at] = True
        words = np.packbits(table).view(np.int64)
        at = np.nonzero(words)[0]
        yield pa.RecordBatch.from_pydict({"word": at, "bits": words[at]})

    return run


def _scan(words: np.ndarray, log: int):
    """Documents with the n-grams whose bits are set, and where each begins; the bits of n-grams no item has are set by chance now and then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(words.view(np.uint8)).astype(bool)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            codes, begin = _codes(texts)
            h = _grams(codes)
            one, two = _bits(h, log)
            at = np.nonzero(table[one])[0]
            at = at[table[two[at]]]
            doc = np.searchsorted(begin, at, "right") - 1
            inside = at + SEED <= begin[doc + 1]
            at, doc = at[inside], doc[inside]
            if not len(doc):
                continue
            first = firsts(doc)
            docs = doc[first]
            yield pa.RecordBatch.from_pydict({
                "id": ids.take(pa.array(docs)), "text": pa.array([texts[d] for d in docs], pa.string()),
                "grams": pa.array(np.split(h[at].view(np.int64), first[1:]), pa.list_(pa.int64())),
                "places": pa.array(np.split((at - begin[doc]).astype(np.int32), first[1:]), pa.list_(pa.int32())),
            })

    return run


def _seeds(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("place").drop_duplicates("place")
    return g[seeds(g["n"].to_numpy())]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of a document around the places where an item would begin, as long as the alignment may reach, joined where they overlap."""
    for b in batches:
        out: list[tuple] = []
        for doc_id, text, items in zip(*(b.column(i).to_pylist() for i in range(3))):
            for item in items:
                n, lo, hi = item["n_chars"], None, None
                for x in [*sorted(set(item["begins"])), None]:
                    if lo is not None and (x is None or x - n > hi):
                        out.append((doc_id, item["item_id"], text[max(0, lo) : hi]))
                        lo = None
                    if x is not None:
                        lo, hi = x - n if lo is None else lo, x + 2 * n
        yield pa.RecordBatch.from_pydict({"id": pa.array([o[0] for o in out], pa.int64()), "item_id": pa.array([o[1] for o in out], pa.int64()), "part": pa.array([o[2] for o in out], pa.string())})


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [(align(codes := _codes([item])[0], _codes([part])[0]), len(codes)) for item, part in zip(b.column("item").to_pylist(), b.column("part").to_pylist())]
        yield pa.RecordBatch.from_pydict({
            "id": b.column("id"), "item_id": b.column("item_id"), "score": pa.array([g[0] for g, _ in got], pa.int64()),
            "share": pa.array([g[0] / (MATCH * n) for g, n in got], pa.float64()), "run": pa.array([g[3] for g, _ in got], pa.int64()),
        })


def leaks(docs: DataFrame, items: DataFrame, least_score: int = MATCH * RUN) -> DataFrame:
    """(id, item_id, score, share, run): documents and items that share a passage, one row for each pair.

    `docs`: id, text; `items`: item_id, text. `score` is the best local alignment of the item with the document, `share` that of the item's own
    score, `run` the longest common run, which may lie elsewhere in the document. Every pair with a common run of RUN characters is given; edited copies are if a SEED of
    them is left and the alignment reaches `least_score`. Null and short texts have no passages; repeated rows give one row; no rows give none.

    Both sides go through the same normal form, and each text once. The items' n-grams are a table; a map of their bits, of a size that follows their number up to
    2^MOST_BITS, tells the documents' scan which n-grams to keep, and the table itself decides in the join. Seeds that many documents hold are
    joined without moving those documents' rows to one task. Only the windows around seeds are aligned.
    """
    spark = docs.sparkSession
    item = cut(items.select(F.col("item_id").cast("long").alias("item_id"), norm(F.col("text")).alias("item")).where(F.length("item") >= SEED).distinct(), "items")
    grams = cut(item.mapInArrow(_item_grams, "g long, item_id long, place int, n_chars int"), "grams")
    n = grams.count()
    if not n:
        return spark.createDataFrame([], "id long, item_id long, score long, share double, run long")
    log = min(MOST_BITS, max(16, (64 * n - 1).bit_length()))
    words = np.zeros((1 << log) // 64, np.int64)
    for r in grams.select("g").mapInArrow(_item_bits(log), "word long, bits long").groupBy("word").agg(F.bit_or("bits")).toArrow().to_batches():
        words[r.column(0).to_numpy()] = r.column(1).to_numpy()
    texts = docs.select(F.col("id").cast("long").alias("id"), norm(F.col("text")).alias("text")).where(F.length("text") >= SEED)
    hits = texts.mapInArrow(_scan(words, log), "id long, text string, grams array<long>, places array<int>")
    hits = cut(hits.withColumn("row", F.monotonically_increasing_id()), "hits")
    n_docs = cut(hits.select(F.explode(F.array_distinct("grams")).alias("g")).groupBy("g").agg(F.count("*").alias("n")), "n_docs")
    told = grams.join(n_docs, "g", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    seed = told.groupBy("item_id").applyInPandas(_seeds, "g long, item_id long, place int, n_chars int, n long").where("n > 0")
    by_gram = cut(seed.groupBy("g").agg(F.collect_list(F.struct("item_id", "place", "n_chars")).alias("of"), F.first("n").alias("n")), "seeds")
    places = hits.select("row", F.explode(F.arrays_zip("grams", "places")).alias("x")).select("row", F.col("x.grams").alias("g"), F.col("x.places").alias("at"))
    met = spread_join(places, by_gram, "g", "n").select("row", "at", F.explode("of").alias("o"))
    begins = met.groupBy("row", F.col("o.item_id").alias("item_id")).agg(F.first("o.n_chars").alias("n_chars"), F.collect_set(F.col("at") - F.col("o.place")).alias("begins"))
    pairs = begins.groupBy("row").agg(F.collect_list(F.struct("item_id", "n_chars", "begins")).alias("items"))
    parts = cut(hits.select("row", "id", "text").join(pairs, "row").select("id", "text", "items").mapInArrow(_windows, "id long, item_id long, part string"), "parts")
    tasks = max(8, spark.sparkContext.defaultParallelism, parts.count() // 2_000)
    both = parts.repartition(tasks).join(mark_small(item, 100_000), "item_id").select("id", "item_id", "part", "item")
    scored = both.mapInArrow(_aligned, "id long, item_id long, score long, share double, run long")
    best = scored.groupBy("id", "item_id").agg(F.max("score").alias("score"), F.max("share").alias("share"), F.max("run").alias("run"))
    return best.where(F.col("score") >= least_score)
