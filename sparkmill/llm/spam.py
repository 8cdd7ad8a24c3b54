'''Keyword-stuffed pages and link lists: robust Mahalanobis distance of text windows, flagged where it lies towards spam.

A text is cut into windows of about WINDOW characters. Each window has six measures: the share of links, tags, prices and stock numbers;
repetition; entropy; the share of the commonest word; the share of function words and endings; the density of list
separators. Per language, the centre and spread of ordinary windows are medians and scaled median deviations first, then means
and covariance of the windows within three of those (one reweighting step). A window is spam if its squared distance
is above what TAIL of normal windows exceed and it lies towards spam: the cosine between its clipped deviations and the signs of spam is above TOWARDS. A
document is, if such windows hold more than half of its characters.
'''

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut

WINDOW, TOWARDS, CLIP = 240, 0.2, 8.0
TAIL = 1e-10  # share of ordinary windows that may lie as far out as spam, were their measures normal
PRIOR = 200  # windows of all languages that each language's centre and spread are mixed with
NAMES = ["links", "repeats", "entropy", "top", "function", "lists"]
SIGNS = np.array([1, 1, -1, 1, -1, 1.0])
LEAST_SPREAD = np.array([0.025, 0.04, 0.025, 0.03, 0.04, 0.01])  # about what one word or two, or two marks, change in a window of some 40 words


def far(tail: float = TAIL) -> float:
    """The squared distance that a share `tail` of normal windows exceeds: the chi-squared quantile of the six measures, by halving. (Its upper tail for
    an even number of measures is a finite sum.)"""
    half = len(NAMES) // 2
    over = lambda x: math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(half))
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if over(mid) > tail else (low, mid)
    return high


# English function words, Korean endings and particles, marks of links and goods.
ENGLISH = frozenset(
    "a an the of in to on at by for from with and or but not no nor so if as that which who when while where than then there this these "
    "those it its he she they we you i his her their our was were is are be been being had has have did do does would could should will can "
    "may might out up down over under after before since until all only into through him them what how because although though even both "
    "each every nobody whose off".split()
)
KOREAN = re.compile(r"(?:다|요|는|은|이|가|을|를|에|서|로|고|의|도|만|과|와|지|며|면|게|기|나|던|자|한|인|된|할|될)$")
LINK = re.compile(
    r"https?://\S+|www\.\S+|</?[a-z][^>]*>|\]\(|[#@]\w+|\b[A-Z]{2,5}-\d{3,}\b|[★☆]+|\b\d[\d,.]*\s?(?:원|won|usd)|[$€£]\s?\d[\d.,]*", re.I
)
WORD = re.compile(r"\w+")
HIDDEN = re.compile("[\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]")
LIST_MARK = re.compile("[^\\w\\s\"'“”‘’.:?!…()\\[\\]–—-]")


def windows(text: str, size: int = WINDOW) -> list[str]:
    """All of a text but blank lines, in windows of about `size` characters; long lines are cut at spaces, short ones joined."""
    out: list[str] = []
    held: list[str] = []
    n = 0
    for line in text.split("\n"):
        if not line.strip():
            continue
        if len(line) <= size:
            held.append(line)
            n += len(line)
            if n >= size:
                out.append("\n".join(held))
                held, n = [], 0
            continue
        if held:
            out.append("\n".join(held))
            held, n = [], 0
        step, i = -(-len(line) // max(1, round(len(line) / size))), 0
        while i < len(line):
            j = min(len(line), i + step)
            if j < len(line) and (e := line.find(" ", j, j + 40)) > 0:
                j = e
            out.append(line[i:j])
            i = j
    if held:
        out.append("\n".join(held))
    return out


def measures(w: str) -> tuple[float, ...]:
    n = len(w)
    links = sum(len(m.group()) for m in LINK.finditer(w)) / n
    plain = LINK.sub(" ", w) if links else w
    words = [t.lower() for t in WORD.findall(plain)]
    m = len(words)
    lists = len(LIST_MARK.findall(w)) / n
    if not m:
        return links, 1.0, 0.0, 1.0, 0.0, lists
    c = Counter(words)
    entropy = -sum(v / m * math.log2(v / m) for v in c.values()) / math.log2(m) if m > 1 else 1.0
    function = sum((t in ENGLISH) if t.isascii() else (len(t) > 1 and KOREAN.search(t) is not None) for t in words) / m
    return links, 1 - len(c) / m, entropy, max(c.values()) / m if m > 3 else 0.0, function, lists


def language(text: str, given: str | None) -> str:
    """The given language in plain spelling; where it is missing, blank or und, ko for texts that are mostly Hangul, else en."""
    g = (given or "").strip().lower()[:2]
    if g and g != "un":
        return g
    letters = sum(map(str.isalpha, text))
    return "ko" if 3 * sum("가" <= c <= "힣" for c in text) > letters else "en"


def plain(text: str) -> str:
    """NFKC without invisible format characters, so that other spellings of the same characters measure alike."""
    t = unicodedata.normalize("NFKC", text)
    return t if t.isascii() else HIDDEN.sub("", t)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for i, t, l in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if t and (ws := windows(plain(t))):
                lang = language(t, l)
                rows += [(i, lang, len(w), *measures(w)) for w in ws]
        yield pa.RecordBatch.from_pandas(
            pd.DataFrame(rows, columns=["id", "lang", "n", *NAMES]), schema=pa.schema([("id", pa.int64()), ("lang", pa.string()), ("n", pa.int32()), *[(c, pa.float32()) for c in NAMES]]), preserve_index=False
        )


def _mixed(own: np.ndarray, n: int, all_: np.ndarray) -> np.ndarray:
    """A language's figures from n windows, mixed with those of PRIOR windows of all languages, so that a rare language is measured nearly as all are."""
    w = n / (n + PRIOR)
    return w * own + (1 - w) * all_


def _spread(w: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Centre, inverse covariance and deviations of each language's ordinary windows; "*" is of all. Languages are few: their names are two letters."""
    both = w.unionAll(w.withColumn("lang", F.lit("*")))
    mid = both.groupBy("lang").agg(F.count("*").alias("n"), *[F.percentile_approx(c, 0.5, 10_000).alias(c) for c in NAMES]).collect()
    spark = w.sparkSession
    if not mid:
        return {}
    n = {r["lang"]: r["n"] for r in mid}
    mid = {r["lang"]: np.array([r[c] for c in NAMES], float) for r in mid}
    mid = {k: v if k == "*" else _mixed(v, n[k], mid["*"]) for k, v in mid.items()}
    table = spark.createDataFrame([(k, *map(float, v)) for k, v in mid.items()], "lang string, " + ", ".join(f"m_{c} double" for c in NAMES))
    off = both.join(F.broadcast(table), "lang")
    dev = {r["lang"]: np.array([r[c] for c in NAMES], float) for r in off.groupBy("lang").agg(*[F.percentile_approx(F.abs(F.col(c) - F.col(f"m_{c}")), 0.5, 10_000).alias(c) for c in NAMES]).collect()}
    dev = {k: v if k == "*" else _mixed(v, n[k], dev["*"]) for k, v in dev.items()}
    spread = {k: np.maximum(1.4826 * dev[k], LEAST_SPREAD) for k in mid}
    table = spark.createDataFrame([(k, *map(float, mid[k]), *map(float, spread[k])) for k in mid], "lang string, " + ", ".join([f"m_{c} double" for c in NAMES] + [f"s_{c} double" for c in NAMES]))
    near = both.join(F.broadcast(table), "lang")
    for c in NAMES:
        near = near.where(F.abs(F.col(c) - F.col(f"m_{c}")) <= 3 * F.col(f"s_{c}"))
    pairs = [(i, j) for i in range(len(NAMES)) for j in range(i, len(NAMES))]
    agg = near.groupBy("lang").agg(F.count("*").alias("n"), *[F.avg(F.col(c).cast("double")).alias(c) for c in NAMES], *[F.avg(F.col(NAMES[i]).cast("double") * F.col(NAMES[j])).alias(f"x_{i}_{j}") for i, j in pairs])
    got = {}
    for r in agg.collect():
        mu = np.array([r[c] for c in NAMES])
        cov = np.diag(LEAST_SPREAD**2)
        for i, j in pairs:
            v = r[f"x_{i}_{j}"] - mu[i] * mu[j]
            cov[i, j] += v
            if i != j:
                cov[j, i] += v
        got[r["lang"]] = (r["n"], mu, cov)
    out = {}
    for lang in mid:
        n_own, mu, cov = got.get(lang, (0, mid[lang], np.diag(spread[lang] ** 2)))
        if lang != "*" and "*" in got:
            mu, cov = _mixed(mu, n_own, got["*"][1]), _mixed(cov, n_own, got["*"][2])
        out[lang] = (mu, np.linalg.inv(cov), np.sqrt(np.diag(cov)))
    return out


def _judge(spread: dict):
    limit = far()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x = f[NAMES].to_numpy(float)
            bad = np.zeros(len(f), bool)
            langs = f["lang"].to_numpy()
            for lang in set(langs):
                mu, inv, sd = spread[lang]
                i = langs == lang
                z = x[i] - mu
                d = np.einsum("ij,jk,ik->i", z, inv, z)
                v = np.clip(z / sd, -CLIP, CLIP)
                bad[i] = (d > limit) & (v @ SIGNS > TOWARDS * np.sqrt(len(SIGNS)) * np.linalg.norm(v, axis=1))
            yield pd.DataFrame({"id": f["id"], "n": f["n"].astype("int64"), "bad": np.where(bad, f["n"], 0).astype("int64")})

    return run


def spam_share(docs: DataFrame) -> DataFrame:
    """(id, n_chars, share): every document with any text and the share of its characters that stand in spam windows.

    `docs`: id long, text, lang. Null, empty and blank texts give no row; rows with one id count as one document; no documents give no rows.
    """
    w = cut(docs.select(F.col("id").cast("long").alias("id"), "text", "lang").where("id is not null").mapInArrow(_measure, "id long, lang string, n int, " + ", ".join(f"{c} float" for c in NAMES)), "windows")
    judged = w.mapInPandas(_judge(_spread(w)), "id long, n long, bad long")
    return judged.groupBy("id").agg(F.sum("n").alias("n_chars"), (F.sum("bad") / F.sum("n")).alias("share"))
