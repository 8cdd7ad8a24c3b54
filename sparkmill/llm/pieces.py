"""The two-character pieces of many texts at once, and maps of them by which pairs that cannot be alike are told apart."""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)


def firsts(sorted_: np.ndarray) -> np.ndarray:
    """Where each run of equal values of a sorted array begins."""
    return np.nonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])[0] if len(sorted_) else np.zeros(0, np.int64)


def distinct_pairs(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    keep = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])] if len(x) else np.zeros(0, bool)
    return x[keep], y[keep]


def pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row and code of every distinct piece of normal texts, sorted by row."""
    c = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    end = c == 10
    row = (np.cumsum(end) - end).astype(np.uint64)
    ok = ~(end[:-1] | end[1:])
    key = (row[:-1][ok] << np.uint64(42)) | (c[:-1][ok] << np.uint64(21)) | c[1:][ok]
    key.sort()
    key = key[firsts(key)]
    return (key >> np.uint64(42)).astype(np.int64), key & np.uint64((1 << 42) - 1)


def maps(code: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two words of 64 bits for each run of codes from a start on: one bit for each hashed piece."""
    bit = (code * MIX) >> np.uint64(57)
    one = np.uint64(1) << (bit & np.uint64(63))
    return np.bitwise_or.reduceat(np.where(bit < 64, one, np.uint64(0)), start), np.bitwise_or.reduceat(np.where(bit >= 64, one, np.uint64(0)), start)


def may_be_like(n: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether two texts with n pieces together may have a likeness of 0.6: each bit that is set in one map only is a piece they do not share."""
    return np.bitwise_count(a[0] ^ b[0]) + np.bitwise_count(a[1] ^ b[1]) <= n - 2 * ((3 * n + 7) // 8)
