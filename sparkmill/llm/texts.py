"""What the queries of training text mean by like texts, parts and base texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def pieces(text: str) -> set:
    """The distinct two-character pieces of a normal text; a text of fewer than two characters has none."""
    return set(zip(text, text[1:]))


def py_like(a: str, b: str) -> float:
    """Shared pieces over all pieces of two normal texts; 0 where neither has any."""
    x, y = pieces(a), pieces(b)
    n = len(x & y)
    return n / (len(x) + len(y) - n) if x or y else 0.0


@F.pandas_udf(T.DoubleType())
def like(a: pd.Series, b: pd.Series) -> pd.Series:
    """like(x, y) of two columns of normal texts, in Arrow batches; 0 for null and for texts without pieces."""
    return pd.Series([py_like(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


def part(split: Column) -> Column:
    """A split's plain name: trimmed, lower-cased; null or blank is train, val is validation."""
    p = F.lower(F.trim(F.regexp_replace(F.coalesce(split, F.lit("")), r"(?U)^\s+|\s+$", "")))
    return F.when(p == "", "train").when(p == "val", "validation").otherwise(p)


def base_text(command: Column, base: Column) -> Column:
    """base(s): the base text, or the command where the base is null or blank."""
    return F.when(F.regexp_replace(F.coalesce(base, F.lit("")), r"(?U)\s+", "") == "", command).otherwise(base)
