"""Groups of near-duplicate records: block keys of units, then a size-aware heavy-light join over the sets of pieces of a text.

A record has 12 units, of which two linked records agree in 9, so with the slots in four fixed groups of three at least one group agrees whole: records are
listed under the keys of their groups. Short lists are paired off. Lists above a boundary of cost are joined by the records' texts as sets of
pieces (see sizeaware): subsets of two pieces for small sets, inverted lists for large ones. Every candidate is compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.textnorm import norm
from ..operators.components import connected_components
from ..session import cut
from . import battle
from .texts import like

LIKE = 0.6


def encode(df: DataFrame, no: Column, area: Column, first: Column, second: Column) -> DataFrame:
    """(no, eid, units, first, second) of every record that can be linked at all: both normal texts have a piece and 9 units are there."""
    e = df.select(no.cast("long").alias("no"), area.alias("area"), first.alias("first"), second.alias("second"))
    e = battle.with_units(e, F.col("area")).select("no", "units", norm(F.col("first")).alias("first"), norm(F.col("second")).alias("second"))
    told = F.col("no").isNotNull() & (battle.n_units(F.col("units")) >= battle.NEED) & (F.length("first") >= 2) & (F.length("second") >= 2)
    return e.where(told).withColumn("eid", battle.identity(F.col("units"), F.col("first"), F.col("second")))


def _candidates(ids: DataFrame, text: str, heavy: int) -> DataFrame:
    """Distinct (x, y), x < y, of records that may be linked. Keys hold cells of ratios; the records that probe a list from the cells beside it are a side of their own."""
    ik, pk = battle.keys_of(ids, "x", False), battle.keys_of(ids, "y", True)
    return battle.probed(ik, pk, ids, ids, text, heavy).where("x < y")


def links(e: DataFrame) -> DataFrame:
    """(a, b): record numbers, a < b. Every linked pair of records that differ, by the least number of their copies, and every copy with that number."""
    e = cut(e, "records")
    more = e.groupBy("eid").agg(F.min("no").alias("least"), F.count("*").alias("n")).where("n > 1")
    copies = cut(e.select("eid", "no").join(more, "eid").where("no > least").select(F.col("least").alias("a"), F.col("no").alias("b")), "copies")
    rest = copies.select(F.col("b").alias("no"))
    firsts = e.join(F.broadcast(rest) if copies.count() <= battle.BROADCAST_IDS else rest, "no", "left_anti")
    ids = firsts.select(F.col("no").alias("eid"), "units", "first", "second")
    text, heavy = battle.text_to_join(ids, ["second", "first"])
    pairs = cut(_candidates(ids, text, heavy), "pairs")
    used = cut(pairs.select(F.col("x").alias("no")).unionAll(pairs.select("y")).distinct(), "ids")
    need = cut(e.join(battle.small(used), "no", "left_semi").select("no", "units", "first", "second"), "need")
    side = lambda s: need.select(F.col("no").alias(s), F.col("units").alias(f"u_{s}"), F.col("first").alias(f"f_{s}"), F.col("second").alias(f"s_{s}"))
    close = (
        pairs.join(side("x"), "x").join(side("y"), "y")
        .where(battle.agreed(F.col("u_x"), F.col("u_y")) >= battle.NEED)
        .withColumn("f", like(F.col("f_x"), F.col("f_y"))).withColumn("s", like(F.col("s_x"), F.col("s_y")))
        .where((F.col("f") >= LIKE) & (F.col("s") >= LIKE))
    )
    return cut(close.select(F.col("x").alias("a"), F.col("y").alias("b")).unionAll(copies), "links")


def near_groups(df: DataFrame, no: Column, area: Column, first: Column, second: Column) -> DataFrame:
    """(no, group_no, n_links): every record that is linked, the least number of its group, and its links.

    Links run between records of different content; of copies, the least number has their links and each other copy one, to it.
    Records with null or blank texts, without 9 units or without a number are in no group. No records give no rows.
    """
    l = links(encode(df, no, area, first, second))
    roots = connected_components(l)
    n = l.select("a").unionAll(l.select("b")).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n_links"))
    return roots.join(n, "node").select(F.col("node").alias("no"), F.col("root").alias("group_no"), "n_links")
