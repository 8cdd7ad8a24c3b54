"""Deeply nested records into flat related tables by Dewey labels.

Every object of a record gets the ordinals of the list places on its way from the root as its label ("3.0.2": record 3 of the root, its
action 0, that one's item 2) and its schema path ("output.action.sequence"). A label cut by its last ordinal is the label of the
parent, on the schema path's own parent table. Objects of one schema path are the rows of one table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

NODE = "key long, path string, label string, parent_path string, parent_label string, places array<int>, fields map<string,string>"
_SCHEMA = pa.schema([
    ("key", pa.int64()), ("path", pa.string()), ("label", pa.string()), ("parent_path", pa.string()), ("parent_label", pa.string()),
    ("places", pa.list_(pa.int32())), ("fields", pa.map_(pa.string(), pa.string())),
])


def _no_constant(name: str) -> None:
    raise ValueError(name)


def parse(text: str | None):
    """The value of strict JSON (no NaN, nothing after it), or None for what is not; the last of repeated keys counts."""
    if text is None:
        return None
    try:
        return json.loads(text, parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return None


def opened(value):
    """A part stored as a JSON string as what it says, however often it was stored so; other values as they are."""
    while isinstance(value, str):
        inner = parse(value) if value.lstrip()[:1] in ("{", "[", '"') else None
        if inner is None:
            return value
        value = inner
    return value


def each(value) -> list:
    """The elements of a list part: one object in place of a list is its only element; null and scalars have none."""
    value = opened(value)
    return value if isinstance(value, list) else [value] if isinstance(value, dict) else []


def _text(value) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def roots(value, wrap: str) -> list:
    value = opened(value)
    if isinstance(value, dict) and wrap in value:
        value = value[wrap]
    return each(value)


def nodes(value, lists: frozenset[str], wrap: str, only: frozenset[str] | None = None) -> Iterator[tuple]:
    """(path, label, parent path, parent label, places, fields) of the records of a parsed text and of the objects in the lists of `lists`.

    Objects that are no list elements belong to their nearest labelled ancestor: their scalars are its fields under dotted names. Lists
    not named stay fields as JSON. `only`: the paths whose records are given, all if None.
    """
    on_way = lists if only is None else {p for p in lists if any(q == p or q.startswith(f"{p}.") for q in only)}
    stack = [("", (i,), r, None, None) for i, r in reversed(list(enumerate(roots(value, wrap))))]
    while stack:
        path, places, obj, up, up_places = stack.pop()
        obj = opened(obj)
        if not isinstance(obj, dict):
            continue
        wanted = only is None or path in only
        fields: dict[str, str] = {}
        children: list[tuple] = []
        walk = [("", obj)]
        while walk:
            prefix, part = walk.pop()
            for name, v in part.items():
                at = f"{prefix}{name}"
                full = f"{path}.{at}" if path else at
                if full in lists:
                    if full in on_way:
                        children += [(full, (*places, i), x, path, places) for i, x in enumerate(each(v))]
                    continue
                inner = opened(v) if isinstance(v, str) and v[:1] in "{[" else v
                if isinstance(inner, dict):
                    walk.append((f"{at}.", inner))
                elif v is not None and wanted:
                    fields[at] = _text(v)
        stack += reversed(children)
        dotted = lambda p: None if p is None else ".".join(map(str, p))
        if wanted:
            yield path, dotted(places), up, dotted(up_places), list(places), list(fields.items())


def _label(lists: frozenset[str], wrap: str, only: frozenset[str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for key, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                value = parse(raw)
                if value is not None:
                    rows += [(key, *n) for n in nodes(value, lists, wrap, only)]
                if len(rows) > 20_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def label(df: DataFrame, key: str, raw: str, lists: list[str], wrap: str = "samples", only: list[str] | None = None) -> DataFrame:
    """Nodes (key, path, label, parent_path, parent_label, places, fields) of all records in a column of JSON texts.

    `lists`: the schema paths whose elements become rows of their own; the root is always one (path ""). `only`: the paths to give, if not all. Texts that are null, empty or
    not valid JSON give nothing. A text delivered again under its key gives its nodes again: see `flat`.
    """
    return df.select(F.col(key).cast("long").alias("key"), F.col(raw).alias("raw")).where("key is not null").mapInArrow(_label(frozenset(lists), wrap, None if only is None else frozenset(only)), NODE)


def flat(nodes: DataFrame, path: str | list[str], fields: dict[str, str], rest: str | None = None) -> DataFrame:
    """One table: key, label, parent_label, path, places and `fields` (column to dotted field name) of the nodes on `path`, once per key and label.

    `rest`: a column for the map of all other fields, by dotted name in order; lists that `label` made rows of are not in it.
    """
    paths = [path] if isinstance(path, str) else path
    others = [F.map_from_entries(F.array_sort(F.map_entries(F.map_filter("fields", lambda k, _: ~k.isin(list(fields.values())))))).alias(rest)] if rest else []
    picked = nodes.where(F.col("path").isin(paths)).select("key", "path", "label", "parent_label", "places", *[F.col("fields")[name].alias(c) for c, name in fields.items()], *others)
    return picked.dropDuplicates(["key", "path", "label"])
