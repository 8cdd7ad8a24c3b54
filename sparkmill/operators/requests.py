"""Requests of a plan: two grammars resolved against a dimension, count contracts, payloads, and the shape of the dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The parts of a request in order.
AXES = ("intent_family", "actor_selection", "target_selection", "action_pattern", "scenario_family")
SKILL = ("skill_family", "skill_target_kind", "conflict_type")
STABLE = r"^([^.#/\s]+)\.([^.#/\s]+)\.([^.#/\s]+)\.([^.#/\s]+)\.([^.#/\s]+)#([0-9]+)(?:/([^.#/\s]+)\.([^.#/\s]+)\.([^.#/\s]+))?\.([0-9]+)$"
NUMERIC = r"^c([0-9]+)-([0-9]+)-([0-9]+)-([0-9]+)-([0-9]+)-([0-9]+)(?:/([0-9]+)-([0-9]+)-([0-9]+))?\.([0-9]+)$"


def parsed(request: Column) -> Column:
    """struct of the keys of a request's parts (names in the stable grammar, ordinals in the numeric one, which begins with c and a digit), slot and
    count as long, and error ("format" where neither grammar fits). Absent skill parts are null."""
    r = F.trim(request)
    numeric = r.rlike(r"^c[0-9]")
    pick = lambda i: F.nullif(F.when(numeric, F.regexp_extract(r, NUMERIC, i)).otherwise(F.regexp_extract(r, STABLE, i)), F.lit(""))
    keys = [pick(i + 1).alias(a) for i, a in enumerate(AXES)] + [pick(i + 7).alias(a) for i, a in enumerate(SKILL)]
    slot, count = pick(6).try_cast("long"), pick(10).try_cast("long")
    error = F.when(pick(10).isNull(), "format").when(F.coalesce(slot, F.lit(0)) < 1, "slot below 1").when(F.coalesce(count, F.lit(0)) < 1, "count below 1")
    return F.struct(*keys, slot.alias("slot"), count.alias("count"), error.alias("error"))


def resolved(df: DataFrame, request: Column, dim: DataFrame, skill_intent: str = "skill") -> DataFrame:
    """`df` with the values of all axes, slot, count and error: the first of format, slot, count, an axis whose value or ordinal the dimension does not
    have ("unknown <axis>"), and skill parts under another intent than `skill_intent`. Null where the request is right.

    `dim`: axis, parent, value, ord. The scenario is looked up under its intent, other axes by themselves; a name and its ordinal are one key.
    """
    out = df.withColumn("_q", parsed(request))
    keyed = dim.select("axis", "parent", "value", F.explode(F.array("value", F.col("ord").cast("string"))).alias("key"))
    for a in (*AXES, *SKILL):
        mine = keyed.where(F.col("axis") == a)
        if a == "scenario_family":
            mine = mine.select(F.col("key").alias("_k"), F.col("parent").alias("_p"), F.col("value").alias(a))
            on = (F.col(f"_q.{a}") == F.col("_k")) & (F.col("intent_family") == F.col("_p"))
        else:
            mine = mine.where("parent is null").select(F.col("key").alias("_k"), F.col("value").alias(a))
            on = F.col(f"_q.{a}") == F.col("_k")
        out = out.drop(a).join(mine, on, "left").drop("_k", "_p")
    error = F.col("_q.error")
    for a in (*AXES, *SKILL):
        error = F.coalesce(error, F.when(F.col(a).isNull() & (F.lit(a in AXES) | F.col(f"_q.{a}").isNotNull()), F.lit(f"unknown {a}")))
    error = F.coalesce(error, F.when(F.col("_q.skill_family").isNotNull() & (F.col("intent_family") != skill_intent), F.lit("skill parts need a skill intent")))
    return out.withColumns({"slot": F.col("_q.slot"), "count": F.col("_q.count"), "error": error}).drop("_q")


def count_contract(stated: Column, items: Column, actual: Column) -> Column:
    """ "ok", or what breaks: the stated total against the sum of the items' counts, then against what came. Null counts break it."""
    total = F.aggregate(F.coalesce(items, F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    return F.when(~same(stated, total), "stated total is not the items' sum").when(~same(stated, actual), "stated total is not what came").otherwise("ok")


def payloads(items: DataFrame, group: list[str], prefix: str, count: str, order: str) -> DataFrame:
    """One payload for each group: `payload` (JSON of its items in order), n_items, total (sum of their counts) and distinct_prefixes, which is false
    where two items of a payload have one prefix. A group is what one request carries, so it is one value."""
    item = F.struct(F.col(order).alias("at"), F.col(prefix).alias("prefix"), F.col(count).alias("count"))
    g = items.groupBy(*group).agg(F.array_sort(F.collect_list(item)).alias("_i"), F.sum(count).cast("long").alias("total"), (F.count(prefix) == F.countDistinct(prefix)).alias("distinct_prefixes"))
    rows = F.transform("_i", lambda x: F.struct(x["prefix"].alias("prefix"), x["count"].alias("count")))
    return g.select(*group, F.to_json(rows).alias("payload"), F.size("_i").cast("long").alias("n_items"), "total", "distinct_prefixes")


def dimension_shape(dim: DataFrame) -> DataFrame:
    """(axis, parent, n_values, error): for each axis and parent, the first of: a value twice, ordinals that are not 1 to n, targets that do not add up to
    100; null where the shape is right."""
    g = dim.groupBy("axis", "parent").agg(
        F.count("*").alias("n_values"), F.countDistinct("value").alias("_v"), F.countDistinct("ord").alias("_o"), F.min("ord").alias("_lo"), F.max("ord").alias("_hi"), F.sum("target_pct").alias("_t")
    )
    error = (
        F.when(F.col("_v") != F.col("n_values"), "a value twice").when((F.col("_o") != F.col("n_values")) | (F.col("_lo") != 1) | (F.col("_hi") != F.col("n_values")), "ordinals are not 1 to n")
        .when(F.abs(F.coalesce("_t", F.lit(0)) - 100) > 1e-6, "targets are not 100")
    )
    return g.select("axis", "parent", "n_values", error.alias("error"))


def described(df: DataFrame, dim: DataFrame, axes: dict[str, str]) -> DataFrame:
    """`df` with <column>_description for each column that holds values of an axis; "" where the dimension has none."""
    for column, axis in axes.items():
        d = dim.where((F.col("axis") == axis) & F.col("parent").isNull()).select(F.col("value").alias("_k"), F.col("description").alias("_d"))
        df = df.join(d, F.col(column) == F.col("_k"), "left").withColumn(f"{column}_description", F.coalesce("_d", F.lit(""))).drop("_k", "_d")
    return df


def preferred(names: DataFrame, name: str, order: list[str]) -> DataFrame:
    """The distinct names that stand in `order`, with their place there from 1; others drop out."""
    at = F.array_position(F.array(*map(F.lit, order)).cast("array<string>"), F.col("name"))
    return names.select(F.col(name).alias("name")).distinct().withColumn("place", at).where("place > 0")
