"""Samples that match target category proportions: systematic sampling with unequal probabilities, repaired for floors and shortages."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.rank import ranked
from ..session import cut, mark_small


def plain(value: Column) -> Column:
    """A category's plain form: trimmed, lower-cased, with - and space as _."""
    return F.translate(F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+$", "")), "- ", "__")


def goals(requests: DataFrame, dim: DataFrame) -> DataFrame:
    """One row for each request and category: request_no, split, axis, parent, category (as the dimension writes it), value, share, sample_size, n_want, n_floor, n_need, ord."""
    d = dim.select(F.col("axis").alias("a"), F.col("parent").alias("p"), F.col("value").alias("category"), "target_pct", "ord")
    same = (F.col("axis") == F.col("a")) & F.col("parent").eqNullSafe(F.col("p"))
    share = F.col("sample_size") * F.coalesce("target_pct", F.lit(0.0)) / 100
    return requests.join(d, same).select(
        "request_no", "split", "axis", F.coalesce(plain(F.col("parent")), F.lit("")).alias("parent"), "category", plain(F.col("category")).alias("value"),
        (F.coalesce("target_pct", F.lit(0.0)) / 100).alias("share"), F.greatest("sample_size", F.lit(0)).cast("long").alias("sample_size"), F.greatest(share, F.lit(0.0)).alias("n_want"), F.coalesce("min_rows", F.lit(0)).alias("n_floor"),
        F.greatest(F.coalesce("min_rows", F.lit(0)), F.ceil(share)).alias("n_need"), "ord",
    )


def cells(rows: DataFrame, axes: dict[str, Column], parents: dict[str, Column]) -> DataFrame:
    """(no, split, axis, parent, value): each record under each of its axes, once without a parent and once for each of `parents`' axes with it."""
    each = [F.struct(F.lit(a).alias("axis"), F.lit("").alias("parent"), c.alias("value")) for a, c in axes.items()]
    each += [F.struct(F.lit(a).alias("axis"), plain(p).alias("parent"), axes[a].alias("value")) for a, p in parents.items()]
    return rows.select("no", "split", F.explode(F.array(*each)).alias("c")).select("no", "split", "c.axis", "c.parent", plain(F.col("c.value")).alias("value")).where("value is not null and parent is not null")


def report(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """`goal` with n_have, the records at hand, and is_short. Records are counted before they are shuffled; categories without any have 0."""
    have = rows.groupBy("split", "axis", "parent", "value").agg(F.count("*").alias("n_have"))
    return goal.join(have, ["split", "axis", "parent", "value"], "left").withColumn("n_have", F.coalesce("n_have", F.lit(0))).withColumn("is_short", F.col("n_have") < F.col("n_need"))


def shared_out(size: float, shares: list[float], floors: list[int], have: list[int]) -> list[float]:
    """How many records each category gives, as reals: in proportion to `shares`, but never below its floor nor above what it has.

    x = min(have, max(floor, level * share)) with the level at which all add up to `size`. A floor is paid for by the categories above theirs, and what a short
    category lacks goes to the others in proportion to their shares. Floors that add up to more than `size` are all kept; a size that cannot be
    reached takes all of every category with a share. Floors above what there is are lowered to it.
    """
    low = [min(f, h) for f, h in zip(floors, have)]
    want = min(max(size, sum(low)), sum(h if s > 0 else f for h, f, s in zip(have, low, shares)))
    # the sum rises with the level in straight pieces, which bend where a category leaves its floor or runs out
    at = lambda level: sum(min(h, max(f, level * s)) for s, f, h in zip(shares, low, have))
    before = 0.0
    for bend in [*sorted({x / s for s, f, h in zip(shares, low, have) if s > 0 for x in (f, h)}), None]:
        if bend is None or at(bend) >= want:
            fixed = sum(low[i] if shares[i] <= 0 or have[i] <= 0 else 0 for i in range(len(shares)))
            rising = [(s, f, h) for s, f, h in zip(shares, low, have) if s > 0 and h > 0]
            mid = before if bend is None else (before + bend) / 2
            slope = sum(s for s, f, h in rising if f < mid * s < h)
            rest = fixed + sum(h if mid * s >= h else f for s, f, h in rising if not f < mid * s < h)
            level = (want - rest) / slope if slope else (before if bend is None else bend)
            return [float(min(h, max(f, level * s))) for s, f, h in zip(shares, low, have)]
        before = bend
    return [float(x) for x in low]


def _allotted(g: pd.DataFrame) -> pd.DataFrame:
    """The plan of one request: `take`, where it begins in the running sum of its categories, and the request's whole number of records."""
    g = g.sort_values(["ord", "category"], kind="stable")
    have = g["n_have"].tolist()
    take = shared_out(float(g["sample_size"].iloc[0]), g["share"].clip(lower=0).tolist(), g["n_floor"].clip(lower=0).tolist(), have)
    total = round(sum(take))
    # a sum of reals that should be whole is made whole, so that the crossings are exactly as many
    ends = [float(total) if abs(x - total) < 1e-6 else x for x in np.cumsum(take)]
    return g.assign(take=take, begin=[0.0, *ends[:-1]], end=ends)[["request_no", "category", "take", "begin", "end"]]


def planned(rows: DataFrame, goal: DataFrame, seed: int) -> DataFrame:
    """`report` with take, begin, end and start, the request's one random start; written, as it is read several times."""
    have = cut(report(rows, goal), "goals")
    narrow = have.select("request_no", "category", "ord", "n_have", "sample_size", F.coalesce("share", F.lit(0.0)).alias("share"), "n_floor")
    plan = narrow.groupBy("request_no").applyInPandas(_allotted, "request_no long, category string, take double, begin double, end double")  # a request's categories are rows of the dimension
    start = F.pmod(F.xxhash64(F.lit(seed), "request_no"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return cut(have.join(plan, ["request_no", "category"]).withColumn("start", start), "plan")


def draw(rows: DataFrame, goal: DataFrame, seed: int = 7, plan: DataFrame | None = None) -> DataFrame:
    """(request_no, category, no, by_floor): the drawn records of each request.

    Records stand in random order inside sorted categories. Each has the inclusion probability of its category, what the category gives over what it has
    (`shared_out`: floors and shortages are repaired here, before the draw); the probabilities' sums run on from category to category, and a record is
    drawn where the sum passes a whole number counted from the request's one random start. As a category's probabilities are equal, its sum at a
    record is where the category begins plus its rank times the probability, so only ranks are computed over partitions. A request gets exactly its
    size where there are as many, and a category at least its floor or all it has. `by_floor`: the record is among those that the
    category gives beyond its share. No requests or no records give no rows; a record without a split, or of another, is not drawn.
    """
    plan = planned(rows, goal, seed) if plan is None else plan
    step = (F.col("end") - F.col("begin")) / F.greatest("n_have", F.lit(1))
    passed = lambda x: F.floor(x - F.col("start"))
    sum_at = lambda at: F.when(at >= F.col("n_have"), F.col("end")).otherwise(F.col("begin") + at * step)
    hit = lambda at: passed(sum_at(at))
    wanted = mark_small(cut(plan.where("n_have > 0").select("split", "axis", "parent", "value").distinct(), "wanted"))
    order = F.xxhash64(F.lit(seed), "no", "axis")
    at = ranked(rows.join(wanted, ["split", "axis", "parent", "value"], "left_semi"), ["split", "axis", "parent", "value"], order, "at")
    got = at.join(mark_small(plan), ["split", "axis", "parent", "value"]).where(hit(F.col("at") + 1) > hit(F.col("at")))
    nth = hit(F.col("at") + 1) - hit(F.lit(0))
    return got.select("request_no", "category", "no", (nth > F.ceil("n_want")).alias("by_floor"))


def outcome(rows: DataFrame, goal: DataFrame, seed: int = 7) -> DataFrame:
    """The report after the draw: for each request and category what was wanted, needed and at hand, what was drawn (n_drawn) and its share of the request's
    draw (share_drawn, null where nothing was drawn), next to pct, and is_short."""
    plan = planned(rows, goal, seed)
    n = draw(rows, goal, seed, plan).groupBy("request_no", "category").agg(F.count("*").alias("n_drawn"))
    out = plan.join(n, ["request_no", "category"], "left").withColumn("n_drawn", F.coalesce("n_drawn", F.lit(0)))
    return out.withColumn("share_drawn", F.try_divide(F.col("n_drawn"), F.sum("n_drawn").over(W.partitionBy("request_no"))))
