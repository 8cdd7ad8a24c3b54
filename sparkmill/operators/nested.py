"""Nested and semi-structured fields: typed access with a default, fields set where absent, items exploded with an override."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strict_variant

# What Spark calls the types of JSON values.
KINDS = {"string": "STRING", "long": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE", "object": "OBJECT", "array": "ARRAY"}


def json_at(text: Column, path: str, kind: str, default: Column | None = None) -> Column:
    """What stands at `path` ("$.a.b") of a JSON text if it is of the kind asked for, else the default. Objects and lists come as JSON texts.

    Unreadable texts, missing keys, nulls and values of another kind all give the default; a whole number is a double too.
    """
    v = F.try_variant_get(strict_variant(text), path, "variant")
    found = F.schema_of_variant(v)
    if kind == "double":
        fits = found.rlike("^(BIGINT|DOUBLE|DECIMAL)")
    else:
        fits = found.startswith(KINDS[kind])
    got = F.to_json(v) if kind in ("object", "array") else F.try_variant_get(v, "$", kind)
    return F.coalesce(F.when(fits, got), default) if default is not None else F.when(fits, got)


def strings_only(json_list: Column) -> Column:
    """The texts of a JSON list in order; other elements drop out. What is no list gives an empty one."""
    items = F.coalesce(F.from_json(json_list, "array<variant>"), F.array().cast("array<variant>"))
    texts = F.filter(items, lambda v: F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False)))
    return F.transform(texts, lambda v: F.try_variant_get(v, "$", "string"))


def with_field(record: Column, name: str, value: Column, always: bool = False) -> Column:
    """A struct with a field set: everywhere, or only where it is null. A null struct stays null."""
    old = record[name.split(".")[0]]
    for part in name.split(".")[1:]:
        old = old[part]
    return record.withField(name, value if always else F.coalesce(old, value))


def numbered_ids(df: DataFrame, prefix: str, batch: Column, at: Column, name: str = "id") -> DataFrame:
    """`df` with ids "<prefix><batch>_<place>"; `at` is the 1-based place in the batch, written with three digits at least."""
    place = at.cast("string")
    return df.withColumn(name, F.concat(F.lit(prefix), batch.cast("string"), F.lit("_"), F.when(F.length(place) < 3, F.lpad(place, 3, "0")).otherwise(place)))


def exploded(df: DataFrame, items: Column, into: str, field: str, value) -> DataFrame:
    """One row for each item, with `field` of the struct column `into` set to what `value` gives of the item; null and empty lists give no row."""
    return df.withColumn("_item", F.explode(items)).withColumn(into, F.col(into).withField(field, value(F.col("_item")))).drop("_item")
