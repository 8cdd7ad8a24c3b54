"""A rule engine: rules are columns that give error codes; all run on one pass, and a record passes if it has none."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .nested import json_at


@dataclass(frozen=True)
class Rule:
    """`bad`: a boolean (one error where true; null is no error) or a long (so many errors)."""

    code: str
    bad: Column
    counts: bool = False

    def errors(self) -> Column:
        n = F.coalesce(self.bad, F.lit(0)) if self.counts else F.when(self.bad, 1).otherwise(0)
        return F.array_repeat(F.lit(self.code), n.cast("int"))


def validate(df: DataFrame, rules: list[Rule], reasons: str = "failure_reasons", passed: str = "passed") -> DataFrame:
    """`df` with its error codes, sorted (the multiset is what counts), and whether there are none. No rule stops another."""
    found = F.concat(*[r.errors() for r in rules]) if rules else F.array().cast("array<string>")
    return df.withColumn(reasons, F.array_sort(found)).withColumn(passed, F.size(reasons) == 0)


def reason_counts(df: DataFrame, reasons: str = "failure_reasons") -> DataFrame:
    return df.select(F.explode(reasons).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


# Constructors. `items` are array columns, and the element rules count the elements that break them.
def not_in(code: str, c: Column, allowed: list) -> Rule:
    return Rule(code, c.isNull() | ~c.isin(allowed))


def out_of_range(code: str, c: Column, low=None, high=None) -> Rule:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return Rule(code, bad)


def each_element(code: str, items: Column, bad) -> Rule:
    return Rule(code, F.size(F.filter(F.coalesce(items, F.array()), bad)), counts=True)


def size_is_not(code: str, items: Column, n: int) -> Rule:
    return Rule(code, F.coalesce(F.size(items), F.lit(-1)) != n)


def set_is_not(code: str, items: Column, wanted: Column) -> Rule:
    return Rule(code, F.array_sort(F.array_distinct(items)) != F.array_sort(F.array_distinct(wanted)))


def repeated(code: str, items: Column) -> Rule:
    """One error for each element beyond the first of its kind."""
    return Rule(code, F.size(F.array_compact(items)) - F.size(F.array_distinct(F.array_compact(items))), counts=True)


def keys_are_not(code: str, json_text: Column, keys: list[str]) -> Rule:
    return Rule(code, F.array_sort(F.json_object_keys(json_text)) != F.array(*[F.lit(k) for k in sorted(keys)]))


def missing_from(code: str, required: Column, actual: Column) -> Rule:
    return Rule(code, F.size(F.array_except(required, actual)) > 0)


def outside(code: str, actual: Column, allowed: Column) -> Rule:
    """Applies wherever `allowed` is given, be it empty."""
    return Rule(code, allowed.isNotNull() & (F.size(F.array_except(actual, allowed)) > 0))


def meets(code: str, actual: Column, forbidden: Column) -> Rule:
    return Rule(code, F.arrays_overlap(actual, forbidden))


def followed_by(code: str, kinds: Column, first: list[str], then: str) -> Rule:
    """Elements equal to `then` right after one of `first`."""
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice(kinds, 1, F.greatest(F.size(kinds) - 1, F.lit(0))))
    hit = F.zip_with(kinds, before, lambda k, b: F.coalesce((k == then) & b.isin(first), F.lit(False)))
    return Rule(code, F.size(F.filter(hit, lambda x: x)), counts=True)


def blank(code: str, *texts: Column) -> list[Rule]:
    """One rule for each text that must say something: an error where it is null or blank."""
    return [Rule(f"{code}_{i}", F.trim(F.coalesce(t, F.lit(""))) == "") for i, t in enumerate(texts)]


def tagged(code: str, items: Column, tag: str, shapes: dict[str, tuple[list[str], list[str]]]) -> Rule:
    """Items of a tagged union: `shapes` gives for each tag the fields an item must have and those it may not have. One error for each item
    that is null, has a tag without a shape, lacks a field or has one too many."""
    bad = lambda x: F.coalesce(
        ~x[tag].isin(list(shapes))
        | _any([(x[tag] == t) & (_any([x[f].isNull() for f in must]) | _any([x[f].isNotNull() for f in never])) for t, (must, never) in shapes.items()]),
        F.lit(True),
    )
    return Rule(code, F.coalesce(F.size(F.filter(items, bad)), F.lit(0)), counts=True)


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def absent(code: str, record: Column, field: str) -> Rule:
    """The key is not there at all in a JSON text: null is there, missing is not."""
    return Rule(code, ~F.array_contains(F.json_object_keys(record), field))


def not_typed(code: str, record: Column, path: str, kind: str) -> Rule:
    """What stands at a path of a JSON text is not of the kind asked for, be it missing, null or of another."""
    return Rule(code, json_at(record, path, kind).isNull())


def pointer_pair(prefix: str, near: Column, far: Column, candidates: Column) -> list[Rule]:
    """A nearest and a farthest pointer into `candidates`: null with none, equal with one, different with more, always inside."""
    n = F.size(candidates)
    some = near.isNotNull() | far.isNotNull()
    return [
        Rule(f"{prefix}_SHOULD_BE_NULL", (n == 0) & some),
        Rule(f"{prefix}_NEAR_OUTSIDE", (n > 0) & (near.isNull() | ~F.array_contains(candidates, near))),
        Rule(f"{prefix}_FAR_OUTSIDE", (n > 0) & (far.isNull() | ~F.array_contains(candidates, far))),
        Rule(f"{prefix}_SINGLE_MISMATCH", (n == 1) & ~near.eqNullSafe(far)),
        Rule(f"{prefix}_SHOULD_DIFFER", (n > 1) & near.eqNullSafe(far)),
    ]


def lookup(items: Column, field: str, value: Column) -> Column:
    """The first element whose `field` is `value`: a join inside the row."""
    return F.get(F.filter(items, lambda u: u[field] == value), F.lit(0))
