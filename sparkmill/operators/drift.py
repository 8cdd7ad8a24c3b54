"""Schemas that drift between files: column profiles, renames by bipartite matching, one consistent table.

A first pass gives, for each file, the paths and their types; what differs from the file before comes out of joins of these small
profiles. Only the files with both vanished and new paths are read a second time, for sketches of the values of those paths alone. Sketches of few values are
exact; of pairs of columns with more, those that may still share half their values are read a third time and compared exactly. Renames
are the matching of vanished with new paths that has the most shared values (names decide ties), solved for one parent and type at a time.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import cut, mark_small
from .dewey import parse

SKETCH = 256  # hashes of distinct values kept of a column

_PROFILE = pa.schema([("feed", pa.string()), ("file_no", pa.int64()), ("path", pa.string()), ("type", pa.string())])


def kind(value) -> list[str]:
    """The types a value speaks for: none for null and empty lists, one per element type for lists."""
    if value is None:
        return []
    if isinstance(value, bool):
        return ["boolean"]
    if isinstance(value, (int, float)):
        return ["number"]
    if isinstance(value, str):
        return ["string"]
    if isinstance(value, dict):
        return ["object"]
    return sorted({f"array of {k}" for v in value for k in (["array"] if isinstance(v, list) else kind(v))})


def paths(record: dict) -> Iterator[tuple[str, object]]:
    """Every key of a record by its dotted path, with its value; objects are walked through, lists are not."""
    stack = [("", record)]
    while stack:
        prefix, obj = stack.pop()
        for k, v in obj.items():
            yield prefix + k, v
            if isinstance(v, dict):
                stack.append((f"{prefix}{k}.", v))


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got: set[tuple] = set()
        for feed, no, raw in zip(*(b.column(i).to_pylist() for i in range(3))):
            got.add((feed, no, None, None))
            record = parse(raw)
            if isinstance(record, dict):
                for p, v in paths(record):
                    got.add((feed, no, p, None))
                    got.update((feed, no, p, k) for k in kind(v))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got), _PROFILE)], schema=_PROFILE) if got else pa.RecordBatch.from_pylist([], _PROFILE)


def profile(lines: DataFrame) -> DataFrame:
    """(feed, file_no, path, types): each path of each file with the sorted set of its types; a file without any has one row of null path."""
    seen = lines.select("feed", F.col("file_no").cast("long"), "raw").mapInArrow(_profile, "feed string, file_no long, path string, type string")
    return seen.groupBy("feed", "file_no", "path").agg(F.array_sort(F.collect_set("type")).alias("types"))


def _said(value) -> list[str]:
    """The distinct texts a value stands for: of a list one for each element, none for null."""
    return [json.dumps(x, ensure_ascii=False, sort_keys=True) for x in (value if isinstance(value, list) else [value]) if x is not None]


def _wanted_values(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[tuple, set[str]]]:
    """Of each batch of (feed, file_no, raw, paths) the values of the asked paths, by feed, file and path."""
    for b in batches:
        got: dict[tuple, set[str]] = {}
        for feed, no, raw, wanted in zip(*(b.column(i).to_pylist() for i in range(4))):
            record, wanted = parse(raw), set(wanted)
            if isinstance(record, dict):
                for p, v in paths(record):
                    if p in wanted and v is not None:
                        got.setdefault((feed, no, p), set()).update(_said(v))
        yield got


_SKETCH = pa.schema([("feed", pa.string()), ("file_no", pa.int64()), ("path", pa.string()), ("sketch", pa.list_(pa.int64()))])
_VALUES = pa.schema([("feed", pa.string()), ("file_no", pa.int64()), ("path", pa.string()), ("value", pa.string())])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for got in _wanted_values(batches):
        rows = [(*k, sorted(int.from_bytes(blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) for x in v)[:SKETCH]) for k, v in got.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SKETCH)], schema=_SKETCH)


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for got in _wanted_values(batches):
        rows = [(*k, x) for k, v in got.items() for x in v]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _VALUES)], schema=_VALUES)


def by_sketch(new: Column, old: Column, least_share: float, size: int) -> tuple[Column, Column]:
    """(share, open) of two sketches, each the `size` least hashes of a column's distinct values, or all if there are fewer.

    `share` is the exact share of the new column's values that the old one has, where both sketches are whole, else null. `open` says whether the share may still
    reach `least_share` where they are not: the hashes of both up to the lesser of their ends are a random sample of the new values whose
    presence is known, and a pair is closed only if the share is lower than that by more than chance allows once in 10^9.
    """
    whole = (F.size(new) < size) & (F.size(old) < size)
    end = F.least(*[F.when(F.size(x) >= size, F.element_at(x, -1)).otherwise(F.lit(2**63 - 1)) for x in (new, old)])
    sample = F.filter(new, lambda h: h <= end)
    hits = F.size(F.array_intersect(sample, old))
    share = F.try_divide(hits.cast("double"), F.size(sample).cast("double"))
    slack = F.sqrt(F.lit(math.log(1e9)) / (2 * F.greatest(F.size(sample), F.lit(1))))
    return F.when(whole, F.coalesce(share, F.lit(0.0))), ~whole & (F.coalesce(share, F.lit(1.0)) + slack >= least_share)


def matching(pairs: list[tuple[str, str, float]]) -> list[tuple[str, str]]:
    """The matching of largest total weight among weighted (old, new) pairs, by augmenting paths over vertex potentials."""
    old, new = sorted({a for a, _, _ in pairs}), sorted({b for _, b, _ in pairs})
    n = max(len(old), len(new))
    cost = [[0.0] * n for _ in range(n)]
    for a, b, w in pairs:
        cost[old.index(a)][new.index(b)] = -w
    u, v, match = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        low, way, used = [float("inf")] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        while True:
            used[j0] = True
            i0, step, j1 = match[j0], float("inf"), 0
            for j in range(1, n + 1):
                if not used[j]:
                    c = cost[i0 - 1][j - 1] - u[i0] - v[j]
                    if c < low[j]:
                        low[j], way[j] = c, j0
                    if low[j] < step:
                        step, j1 = low[j], j
            for j in range(n + 1):
                if used[j]:
                    u[match[j]] += step
                    v[j] -= step
                else:
                    low[j] -= step
            j0 = j1
            if not match[j0]:
                break
        while j0:
            match[j0] = match[way[j0]]
            j0 = way[j0]
    weight = {(a, b): w for a, b, w in pairs}
    got = [(old[match[j] - 1], new[j - 1]) for j in range(1, n + 1) if match[j] <= len(old) and j <= len(new)]
    return [p for p in got if p in weight]


_PAIRS = pa.schema([("feed", pa.string()), ("file_no", pa.int64()), ("old_path", pa.string()), ("new_path", pa.string())])


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The renames among the candidates of one file, parent and type, a row each."""
    for b in batches:
        rows = []
        for feed, no, pairs in zip(*(b.column(i).to_pylist() for i in range(3))):
            weighted = [(p["old_path"], p["new_path"], 1.0 + p["share"] + 1e-3 * SequenceMatcher(None, p["old_path"], p["new_path"]).ratio()) for p in pairs]
            rows += [(feed, no, *m) for m in matching(weighted)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PAIRS)], schema=_PAIRS)


def parent(path):
    return F.regexp_replace(path, r"\.?[^.]*$", "")


def changes(lines: DataFrame, least_share: float = 0.5) -> DataFrame:
    """(feed, file_no, file_name, change, old_path, new_path): each file against the one before it in its feed.

    `lines`: feed, file_no, file_name, raw. Unreadable, empty and null lines have no paths; lines delivered twice and late files
    change nothing, as files are ordered by number. A feed's first file has no changes. Null feeds are one feed; null file numbers are dropped.
    """
    lines = lines.select(F.coalesce("feed", F.lit("")).alias("feed"), "file_no", "file_name", "raw").where("file_no is not null")
    prof = cut(profile(lines), "profile")
    order = W.partitionBy("feed").orderBy("file_no")
    files = prof.select("feed", "file_no").distinct()
    files = cut(files.withColumn("before", F.lag("file_no").over(order)).withColumn("after", F.lead("file_no").over(order)), "files")
    mine = prof.where("path is not null")
    now = mine.join(files, ["feed", "file_no"]).where("before is not null").select("feed", "file_no", "path", F.col("types").alias("now"))
    was = mine.join(files, ["feed", "file_no"]).where("after is not null").select("feed", F.col("after").alias("file_no"), "path", F.col("types").alias("was"))
    diff = cut(now.join(was, ["feed", "file_no", "path"], "full").where("now is null or was is null or now <> was"), "diff")
    typed = diff.where("size(now) > 0 and size(was) > 0")
    gone = diff.where("now is null").select("feed", "file_no", F.col("path").alias("old_path"), F.col("was").alias("types"), parent(F.col("path")).alias("parent"))
    come = diff.where("was is null").select("feed", "file_no", F.col("path").alias("new_path"), F.col("now").alias("types"), parent(F.col("path")).alias("parent"))
    maybe = cut(gone.join(come, ["feed", "file_no", "types", "parent"]).where("size(types) > 0").join(files, ["feed", "file_no"]).select("feed", "file_no", "before", "old_path", "new_path", "types", "parent"), "maybe")
    lines_of = lines.select("feed", F.col("file_no").cast("long").alias("file_no"), "raw")

    def asked(pairs: DataFrame) -> DataFrame:
        """The lines of the files that hold any of the pairs' paths, with these paths."""
        want = pairs.select("feed", "file_no", F.col("new_path").alias("path")).unionAll(pairs.select("feed", F.col("before").alias("file_no"), F.col("old_path").alias("path")))
        want = cut(want.groupBy("feed", "file_no").agg(F.collect_set("path").alias("paths")), "wanted")
        return lines_of.join(mark_small(want, weight=F.size("paths")), ["feed", "file_no"]).select("feed", "file_no", "raw", "paths")

    some = asked(maybe).mapInArrow(_sketches, "feed string, file_no long, path string, sketch array<long>")
    least = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("sketch")))), 1, SKETCH)
    some = cut(some.groupBy("feed", "file_no", "path").agg(least.alias("sketch")), "sketches")
    pair = (
        maybe.join(some.select("feed", "file_no", F.col("path").alias("new_path"), F.col("sketch").alias("new")), ["feed", "file_no", "new_path"])
        .join(some.select("feed", F.col("file_no").alias("before"), F.col("path").alias("old_path"), F.col("sketch").alias("old")), ["feed", "before", "old_path"])
    )
    share, is_open = by_sketch(F.col("new"), F.col("old"), least_share, SKETCH)
    pair = cut(pair.select("feed", "file_no", "before", "old_path", "new_path", "types", "parent", share.alias("share"), is_open.alias("is_open")).where("is_open or share >= " + str(least_share)), "pairs")
    known, rest = pair.where("share is not null").drop("is_open", "before"), pair.where("is_open").drop("share", "is_open")
    values = cut(asked(rest).mapInArrow(_values, "feed string, file_no long, path string, value string").distinct(), "values")
    of_new = rest.join(values.withColumnRenamed("path", "new_path"), ["feed", "file_no", "new_path"])
    of_old = values.select("feed", F.col("file_no").alias("before"), F.col("path").alias("old_path"), "value", F.lit(1).alias("hit"))
    exact = of_new.join(of_old, ["feed", "before", "old_path", "value"], "left").groupBy("feed", "file_no", "old_path", "new_path", "types", "parent").agg((F.count("hit") / F.count("*")).alias("share"))
    near = known.unionByName(exact).where(F.col("share") >= least_share)
    sets = near.groupBy("feed", "file_no", "parent", "types").agg(F.collect_list(F.struct("old_path", "new_path", "share")).alias("pairs"))  # of one object's columns
    tasks = max(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), lines.sparkSession.sparkContext.defaultParallelism)
    matched = sets.where("size(pairs) > 1").select("feed", "file_no", "pairs").repartition(tasks).mapInArrow(_match, "feed string, file_no long, old_path string, new_path string")
    alone = sets.where("size(pairs) = 1").select("feed", "file_no", F.col("pairs")[0]["old_path"].alias("old_path"), F.col("pairs")[0]["new_path"].alias("new_path"))
    renamed = cut(matched.unionByName(alone), "renamed")
    shape = lambda df, change, old, new: df.select("feed", "file_no", F.lit(change).alias("change"), old.alias("old_path"), new.alias("new_path"))
    none = F.lit("")
    out = (
        shape(renamed, "renamed", F.col("old_path"), F.col("new_path"))
        .unionAll(shape(typed, "retyped", F.col("path"), F.col("path")))
        .unionAll(shape(gone.join(renamed, ["feed", "file_no", "old_path"], "left_anti"), "removed", F.col("old_path"), none))
        .unionAll(shape(come.join(renamed, ["feed", "file_no", "new_path"], "left_anti"), "added", none, F.col("new_path")))
    )
    names = lines.groupBy("feed", F.col("file_no").cast("long").alias("file_no")).agg(F.min("file_name").alias("file_name"))
    return out.join(names, ["feed", "file_no"]).select("feed", "file_no", "file_name", "change", "old_path", "new_path")


def _chains(g: pd.DataFrame) -> pd.DataFrame:
    """From each file with a change on, the names that stand for others, no two columns of a file under one name."""
    known = {*g["old_path"], *g["new_path"]}
    first: dict[str, str] = {}  # of the columns there, those that go by another name than their path
    asleep: dict[str, str] = {}  # the same of removed ones, should they return
    back: set[str] = set()  # columns added under their own path that are there
    out = []
    for no, part in g.sort_values("file_no").groupby("file_no"):
        of = lambda change, c: part.loc[part["change"] == change, c].tolist()
        renamed, removed = dict(zip(of("renamed", "new_path"), of("renamed", "old_path"))), of("removed", "old_path")
        moved = {b: first.get(a, a) for b, a in renamed.items()}
        gone = {*renamed.values(), *removed}
        asleep = {k: v for k, v in (asleep | {p: first[p] for p in removed if p in first}).items() if k not in moved}
        first = {k: v for k, v in first.items() if k not in gone} | moved
        back -= gone | set(moved)
        for p in sorted(of("added", "new_path"), key=lambda p: (p not in asleep, p)):
            own = f"{p}@{no}"
            while own in known or own in first.values():
                own += "@"
            name = next((x for x in (asleep.pop(p, p), p) if x not in first.values() and x not in back), own)
            if name == p:
                back.add(p)
            else:
                first[p] = name
        out.append((g["feed"].iloc[0], no, dict(first)))
    return pd.DataFrame(out, columns=["feed", "from_no", "names"])


_UNIFIED = pa.schema([
    ("feed", pa.string()), ("file_no", pa.int64()), ("line_no", pa.int64()), ("raw", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("kinds", pa.map_(pa.string(), pa.string())),
])


def _unify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for feed, no, line, raw, names in zip(*(b.column(i).to_pylist() for i in range(5))):
            record = parse(raw)
            if isinstance(record, dict):
                names = dict(names or ())
                fields, kinds = {}, {}
                for p, v in paths(record):
                    if not isinstance(v, dict) and v is not None:
                        name = names.get(p, p)
                        fields[name] = v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))
                        kinds[name] = "array" if isinstance(v, list) else kind(v)[0]
                rows.append((feed, no, line, raw, list(fields.items()), list(kinds.items())))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _UNIFIED)], schema=_UNIFIED)


def unified(lines: DataFrame, found: DataFrame) -> DataFrame:
    """(feed, file_no, line_no, fields, kinds): every valid line once, its values under the first name each column had in its feed, and their types.

    `found` is what `changes` gives for the same lines. Values stand as text, lists as JSON. A path that is added while a renamed column goes by it
    gets a name of its own, the path with @ and the number of its file; a removed column returns under its old name if that is free. Of a line
    delivered with several valid texts the least text counts.
    """
    lines = lines.select(F.coalesce("feed", F.lit("")).alias("feed"), F.col("file_no").cast("long").alias("file_no"), F.col("line_no").cast("long").alias("line_no"), "raw")
    moves = found.where("change in ('renamed', 'removed', 'added')").groupBy("feed")
    names = cut(moves.applyInPandas(_chains, "feed string, from_no long, names map<string,string>"), "names")
    files = lines.select("feed", "file_no").distinct().withColumn("names", F.lit(None).cast("map<string,string>"))
    both = files.select("feed", "file_no", "names", F.lit(1).alias("k")).unionAll(names.select("feed", F.col("from_no"), "names", F.lit(0)))
    last = F.last("names", ignorenulls=True).over(W.partitionBy("feed").orderBy("file_no", "k").rowsBetween(W.unboundedPreceding, 0))
    of = cut(both.withColumn("names", last).where("k = 1 and names is not null and size(names) > 0").drop("k"), "of")
    held = lines.join(mark_small(of, weight=1 + F.size("names")), ["feed", "file_no"], "left").select("feed", "file_no", "line_no", "raw", "names")
    rows = held.mapInArrow(_unify, "feed string, file_no long, line_no long, raw string, fields map<string,string>, kinds map<string,string>")
    best = rows.groupBy("feed", "file_no", "line_no").agg(F.min_by(F.struct("fields", "kinds"), "raw").alias("r"))
    return best.select("feed", "file_no", "line_no", "r.fields", "r.kinds")


def typed(rows: DataFrame) -> DataFrame:
    """The lines of `unified` as one table with a column for each name and of one type: double, boolean, array<string> or string where a name holds one
    type of value all over, string where it holds several. Names are written with _ for the dots; two that then are one get a number.

    The driver sees the names and types of the columns, which are the schema of what it returns, and nothing of the lines.
    """
    rows = cut(rows, "unified")
    held = rows.select(F.explode("kinds").alias("name", "kind")).groupBy("name").agg(F.array_sort(F.collect_set("kind")).alias("kinds")).orderBy("name").collect()
    cols, taken = [], {"feed", "file_no", "line_no"}
    for r in held:
        v = F.try_element_at("fields", F.lit(r["name"]))
        value = {"number": v.try_cast("double"), "boolean": v.try_cast("boolean"), "array": F.from_json(v, "array<string>")}.get(r["kinds"][0], v) if len(r["kinds"]) == 1 else v
        name = base = re.sub(r"\W", "_", r["name"]) or "_"
        n = 2
        while name.lower() in taken:
            name, n = f"{base}_{n}", n + 1
        taken.add(name.lower())
        cols.append(value.alias(name))
    return rows.select("feed", "file_no", "line_no", *cols)
