"""Features of an output and its comparison with a gold one; duplicate keys over several fields; draws and texts of reports."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def actors(action: Column) -> Column:
    """The sorted set of unitIds that act."""
    return F.array_sort(F.array_distinct(F.array_compact(action["unitId"])))


def targets(action: Column) -> Column:
    """The sorted set of units that any item of any sequence is aimed at."""
    each = F.flatten(F.transform(action["sequence"], lambda s: F.coalesce(s["target"], F.array().cast("array<string>"))))
    return F.array_sort(F.array_distinct(F.array_compact(each)))


def signature(action: Column) -> Column:
    """The sorted list of actor and item types ("A_01:move,attack"); repeats stay."""
    one = lambda a: F.concat(F.coalesce(a["unitId"], F.lit("")), F.lit(":"), F.array_join(a["sequence"]["type"], ","))
    return F.array_sort(F.transform(action, lambda a: F.coalesce(one(a), F.lit(""))))


def json_equal(a: str | None, b: str | None) -> bool | None:
    """Whether two JSON texts say the same: key order does not count, 2 and 2.0 are equal, true and 1 are not. Null where either is no JSON."""

    def same(x, y) -> bool:
        if isinstance(x, bool) or isinstance(y, bool):
            return x is y
        if isinstance(x, dict) and isinstance(y, dict):
            return x.keys() == y.keys() and all(same(x[k], y[k]) for k in x)
        if isinstance(x, list) and isinstance(y, list):
            return len(x) == len(y) and all(map(same, x, y))
        return x == y and not isinstance(x, (dict, list)) and not isinstance(y, (dict, list))

    try:
        return same(json.loads(a), json.loads(b))
    except (TypeError, ValueError, RecursionError):
        return None


@F.pandas_udf(T.BooleanType())
def json_same(a: pd.Series, b: pd.Series) -> pd.Series:
    """`json_equal` of two columns, in Arrow batches."""
    return pd.Series([json_equal(x, y) for x, y in zip(a, b)], dtype="object")


def against_gold(action: Column, gold: Column, contract_ok: Column) -> Column:
    """struct(action_exact, actors_same, targets_same, signature_same, semantic, empty_right) of an action list and a gold one.

    `semantic`: equal item for item, or the contract holds and actors, targets and signatures are the same. `empty_right`: both are empty or
    neither is. Null lists count as empty.
    """
    none = F.size(F.coalesce(action["unitId"], F.array().cast("array<string>"))), F.size(F.coalesce(gold["unitId"], F.array().cast("array<string>")))
    exact = F.to_json(action).eqNullSafe(F.to_json(gold))
    a, t, s = (f(action).eqNullSafe(f(gold)) for f in (actors, targets, signature))
    return F.struct(
        exact.alias("action_exact"), a.alias("actors_same"), t.alias("targets_same"), s.alias("signature_same"),
        (exact | (F.coalesce(contract_ok, F.lit(False)) & a & t & s)).alias("semantic"), ((none[0] == 0) == (none[1] == 0)).alias("empty_right"),
    )


def duplicate_key(*fields: Column) -> Column:
    """One key of several fields of any type: the SHA-256 of their JSON. Nulls count as values of their own; order of fields counts."""
    return F.sha2(F.to_json(F.struct(*[f.alias(f"f{i}") for i, f in enumerate(fields)]), {"ignoreNullFields": "false"}), 256)


def unit_signature(units: Column) -> Column:
    """Units in the order of their ids: what is equal for two fields of units listed in another order."""
    return F.array_sort(F.transform(units, lambda u: F.struct(u["unitId"].alias("unitId"), u.alias("unit"))))


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that follows from seed and keys alone: any task and any run draws the same."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def normal(seed: int, *keys: Column) -> Column:
    """A standard normal number from two uniform ones."""
    u, v = (1 - uniform(seed, F.lit(k), *keys) for k in ("u", "v"))
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * v)


def slug(text: Column) -> Column:
    """A name for files: lower case, runs of anything but a-z and 0-9 as one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def escaped(text: Column) -> Column:
    """A text for HTML: & < > and both quotes as entities."""
    for c, e in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(c), F.lit(e))
    return text


def points(delta: Column) -> Column:
    """A difference of two rates in percentage points: "+1.25 pp"; - for none."""
    return F.when(delta.isNotNull(), F.format_string("%+.2f pp", delta * 100)).otherwise("-")


def label(name: Column, labels: dict[str, str]) -> Column:
    """The label of a column's name; a name without one as it is."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name) if pairs else name
