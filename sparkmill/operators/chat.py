"""Chat rows: built from records, checked, cut into prompt and completion, and matched back to the records they came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .rank import running

ROLES = ("system", "user", "assistant")


def messages(system: Column, user: Column, assistant: Column) -> Column:
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in zip(ROLES, (system, user, assistant))])


def contract(m: Column) -> Column:
    """Whether the roles are exactly system, user, assistant and no content is null."""
    roles = F.transform(m, lambda x: x["role"])
    return F.coalesce((roles == F.array(*map(F.lit, ROLES))) & ~F.exists(m, lambda x: x["content"].isNull()), F.lit(False))


def answers_json(m: Column, keys: list[str]) -> Column:
    """Whether the last message is a JSON object with exactly these keys."""
    found = F.json_object_keys(F.try_element_at(m, F.lit(-1))["content"])
    return F.coalesce(F.array_sort(found) == F.array(*[F.lit(k) for k in sorted(keys)]), F.lit(False))


def prompt_completion(m: Column) -> Column:
    return F.struct(F.slice(m, 1, F.greatest(F.size(m) - 1, F.lit(0))).alias("prompt"), F.try_element_at(m, F.lit(-1)).alias("completion"))


def restore(rows: DataFrame, sources: DataFrame, key: str, row_order: str, source_order: str, consume: bool) -> DataFrame:
    """Rows with the source of the same key: always the first one, or, with `consume`, the n-th row of a key the n-th source.

    Keys may be long texts: what is shuffled and sorted by is their SHA-256. Rows without a source keep null. Without `consume` sources are
    aggregated, not sorted; with it, places come from sums over ranges, so that one key may hold any share of the rows.
    """
    r, s = rows.withColumn("_h", F.sha2(F.col(key), 256)), sources.withColumn("_h", F.sha2(F.col(key), 256)).drop(key)
    if consume:
        one = F.lit(1).cast("long")
        r, s = running(r, one, ["_h"], [row_order], "_n"), running(s, one, ["_h"], [source_order], "_n")
        return r.join(s, ["_h", "_n"], "left").drop("_h", "_n")
    first = s.where("_h is not null").groupBy("_h").agg(F.min_by(F.struct(*[c for c in s.columns if c != "_h"]), source_order).alias("_s"))
    return r.join(first, "_h", "left").select(*[c for c in r.columns if c != "_h"], "_s.*")


def shuffled(df: DataFrame, seed: int, ref: Column) -> DataFrame:
    """`df` with `shuffle_key`, by which any reader gets one seeded order: md5 of seed and reference."""
    return df.withColumn("shuffle_key", F.md5(F.concat(F.lit(f"{seed}|"), ref.cast("string"))))
