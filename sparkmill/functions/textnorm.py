"""Text normal form."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F, types as T

_DROP = re.compile(r"[\W_]+")


def py_norm(text: str | None) -> str:
    """NFKC, lower case, letters and digits only. Null gives the empty text."""
    return _DROP.sub("", unicodedata.normalize("NFKC", text).lower()) if text else ""


def _jvm_has_icu() -> bool:
    try:
        spark = SparkSession.getActiveSession()
        return spark._jvm.com.ibm.icu.text.Normalizer.compose("Ａ", True) == "A"
    except Exception:
        return False


@F.pandas_udf(T.StringType())
def _nfkc_py(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x) if x else "")


def nfkc(text: Column) -> Column:
    """Unicode form NFKC, on the JVM's side where Spark's own ICU is at hand, else in Arrow batches. Null gives the empty text."""
    text = F.coalesce(text, F.lit(""))
    if _jvm_has_icu():
        return F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    return _nfkc_py(text)


def norm(text: Column) -> Column:
    """norm(x): NFKC, lower case, only letters and digits. Null gives the empty text."""
    return F.regexp_replace(F.lower(nfkc(text)), r"[^\p{L}\p{N}]+", "")
