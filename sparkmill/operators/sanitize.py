"""Repair of ordered sequences: a fold that looks at what it has kept so far."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def folded(items: Column, kind: str, forbidden_after: dict[str, list[str]], most: int, kept_type: str) -> Column:
    """Items in order, without those whose kind may not follow the kind kept last, and at most `most` of them.

    `forbidden_after`: kind to the kinds it may not follow. `kept_type`: the array's type. Null arrays give empty ones; null items are dropped.
    """

    def step(acc: Column, x: Column) -> Column:
        last = F.when(F.size(acc) > 0, F.element_at(acc, -1)[kind])
        bad = F.lit(False)
        for k, before in forbidden_after.items():
            bad = bad | ((x[kind] == k) & F.coalesce(last.isin(before), F.lit(False)))
        return F.when(x.isNull() | F.coalesce(bad, F.lit(False)) | (F.size(acc) >= most), acc).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.coalesce(items, F.array().cast(kept_type)), F.array().cast(kept_type), step)


def coerced(items: Column, kind: str, allowed: list[str], defaults: dict[str, float], number: str, low: float, high: float, mode: str, modes: list[str], plain_mode: str) -> Column:
    """Items with `number` clamped to [low, high] (null takes its kind's default, if there is one) and a `mode` that is not one of `modes` as `plain_mode` (null stays).

    Items of kinds that are not allowed, and null ones, drop out. A null list gives null.
    """
    given = F.create_map(*[F.lit(v) for kv in defaults.items() for v in kv]) if defaults else None

    def clean(x: Column) -> Column:
        n = F.coalesce(x[number], F.try_element_at(given, x[kind])) if defaults else x[number]
        m = F.when(x[mode].isNull() | x[mode].isin(modes), x[mode]).otherwise(plain_mode)
        return x.withField(number, F.when(n.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), n)))).withField(mode, m)

    return F.transform(F.filter(items, lambda x: F.coalesce(x[kind].isin(allowed), F.lit(False))), clean)


def first_per_key(items: Column, key: str) -> Column:
    """The first item of each key, in order; items without a key drop out."""
    keys = F.transform(items, lambda x: x[key])
    return F.filter(items, lambda x, i: x[key].isNotNull() & (F.array_position(keys, x[key]) == i + 1))


def spoken(dialog: Column, key: str, known: Column, default: Column) -> Column:
    """Lines of a dialog whose speaker is known; the default line where none is left."""
    kept = F.filter(dialog, lambda d: F.array_contains(known, d[key]))
    return F.when(F.coalesce(F.size(kept), F.lit(0)) > 0, kept).otherwise(F.array(default))
