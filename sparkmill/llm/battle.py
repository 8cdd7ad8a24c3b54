"""Blocking and comparison of records whose fields are a fixed set of named units with classes and measures.

Two records have the same field of units if at least NEED of the SLOTS agree. A unit agrees if its five classes are equal
(null equals null) and each of its two ratios is apart by at most TOL (null only agrees with null). A unit that is missing
on either side does not agree; of units with one id the first counts; ids outside SLOTS are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from . import sizeaware

SLOTS = [f"{side}_{n:02d}" for side in "AE" for n in range(1, 7)]
NEED, GROUP = 9, 3  # 12 units in 4 groups of 3: with at most 3 that differ, one whole group agrees
TOL, CELL = 0.025 + 1e-9, 0.2  # the tolerance, with what decimal fractions lose as binary ones; cells eight tolerances wide
NO_RATIO = -(2**62)  # the cell of a missing ratio
BROADCAST_IDS = 500_000  # ids; 16 bytes each


def with_units(df: DataFrame, area: Column) -> DataFrame:
    """`df` with units, struct of c, array<bigint> of a hash of each slot's classes (null: no such unit), and r, array<double> of its two ratios as they are.

    Only the compared fields are read, as long as nothing that may not be reordered (such as norm) comes before. A slot's unit is found by the place of its id, so all of it is generated code without lambdas.
    """
    names = ["unitId", "isAlive", "canBeTargeted", "isRanged", "teamFormationRole", "engagedByOpponentCount", "hpRatio", "attackRatioToAvg"]
    df = df.withColumns({f"_{side[0]}_{n}": area[side][n] for side in ("allies", "enemies") for n in names})
    df = df.withColumns({f"_at_{s}": F.array_position(f"_{'a' if s[0] == 'A' else 'e'}_unitId", F.lit(s)) for s in SLOTS})
    codes, ratios = [], []
    for s in SLOTS:
        at = F.coalesce(F.col(f"_at_{s}"), F.lit(0)).cast("int") - 1
        of = lambda n: F.get(F.col(f"_{'a' if s[0] == 'A' else 'e'}_{n}"), at)  # noqa: B023, E731
        flags = [F.coalesce(of(n).cast("int"), F.lit(2)) for n in names[1:4]]
        codes.append(F.when(at >= 0, F.xxhash64(*flags, of(names[4]).isNull(), of(names[4]), of(names[5]).isNull(), of(names[5]))))
        ratios += [of(names[6]).cast("double"), of(names[7]).cast("double")]
    units = F.struct(F.array(*codes).alias("c"), F.array(*ratios).alias("r"))
    return df.withColumn("units", units).drop(*[c for c in df.columns if c.startswith(("_a_", "_e_", "_at_"))])


def identity(*contents: Column) -> Column:
    """struct of two 64-bit hashes of the contents: the identity of a record or text among any number of them."""
    return F.struct(F.xxhash64(*contents).alias("p"), F.xxhash64(F.lit(1), *contents).alias("q"))


def block_keys(u: Column, probe: bool) -> Column:
    """Keys of a record, one for each group of GROUP units without a missing one: classes and the cells of the first ratio.

    A probe has the keys of all cells within the tolerance, so two records of which a group agrees always share a key.
    """
    out = []
    for g in range(0, len(SLOTS), GROUP):
        c = [F.get(u["c"], F.lit(i)) for i in range(g, g + GROUP)]
        h = [F.get(u["r"], F.lit(2 * i)) for i in range(g, g + GROUP)]
        head = F.when(sum((x.isNull().cast("int") for x in c), F.lit(0)) == 0, F.xxhash64(F.lit(g), *c))
        cell = lambda x: F.coalesce(F.floor(x / CELL), F.lit(NO_RATIO))
        if probe:
            wide = TOL + 1e-12  # adding rounds up to a value of a partner, never below it
            near = [F.array_distinct(F.array(cell(x - wide), cell(x + wide))) for x in h]
            keys = F.transform(near[0], lambda a: F.xxhash64(head, a))
            for cells in near[1:]:
                keys = _extended(keys, cells)
        else:
            k = head
            for x in h:
                k = F.xxhash64(k, cell(x))
            keys = F.array(k)
        out.append(F.when(head.isNotNull(), keys).otherwise(F.array().cast("array<bigint>")))
    return F.array_distinct(F.concat(*out))


def _extended(keys: Column, cells: Column) -> Column:
    return F.flatten(F.transform(keys, lambda k: F.transform(cells, lambda a: F.xxhash64(k, a))))


def n_units(u: Column) -> Column:
    """The number of slots that hold a unit."""
    return sum((F.get(u["c"], F.lit(i)).isNotNull().cast("int") for i in range(len(SLOTS))), F.lit(0))


def agreed(a: Column, b: Column) -> Column:
    """The number of slots that agree. A ratio that is no number agrees with nothing."""
    n = F.lit(0)
    for i in range(len(SLOTS)):
        x, y = F.get(a["c"], F.lit(i)), F.get(b["c"], F.lit(i))
        near = lambda j: F.coalesce(F.abs(F.get(a["r"], F.lit(j)) - F.get(b["r"], F.lit(j))) <= TOL, F.get(a["r"], F.lit(j)).isNull() & F.get(b["r"], F.lit(j)).isNull())
        n = n + F.when((x == y) & near(2 * i) & near(2 * i + 1), 1).otherwise(0)
    return n


def one_of_each(e: DataFrame) -> DataFrame:
    """Rows of `e` (no, eid, ...) without those that repeat an eid; the least no stays. Narrow rows are counted first, so groups
    of copies of any size cost one row a partition."""
    more = e.groupBy("eid").agg(F.min("no").alias("least"), F.count("*").alias("n")).where("n > 1")
    rest = cut(e.select("eid", "no").join(more, "eid").where("no > least").select("no"), "copies")
    return e.join(small(rest), "no", "left_anti")


def small(ids: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """`ids`, a written table of one or two narrow columns, marked for broadcast if its counted rows are few enough."""
    return F.broadcast(ids) if ids.count() <= most else ids


def boundary(mean_chars: float | None) -> int:
    """Length n of a list of records with one block key above which the n*n/2 comparisons of its pairs cost more than listing each again under the keys of its text,
    0.4 of its pieces and one. The mean is that of the text column joined by."""
    return max(8, round(2 * sizeaware.ROW_COST * (0.4 * (mean_chars or 0) + 1)))


def text_to_join(rows: DataFrame, texts: list[str]) -> tuple[str, int]:
    """Of several texts that all must be like, the one with the most values, and the boundary of its lists."""
    got = rows.agg(*[F.approx_count_distinct(t).alias(f"n_{t}") for t in texts], *[F.avg(F.length(t)).alias(f"l_{t}") for t in texts]).first()
    text = max(texts, key=lambda t: got[f"n_{t}"])
    return text, boundary(got[f"l_{text}"])


def probed(ik: DataFrame, pk: DataFrame, rows_a: DataFrame, rows_b: DataFrame, text: str, heavy: int) -> DataFrame:
    """Distinct (x, y) of known (x, k) and new (y, k) keys that meet.

    Lists of at most `heavy` known records are paired off. In longer ones the records, as sets of the pieces of their texts, go through the
    size-aware join, so that records which share units by the thousand but differ in what they say are never paired.
    """
    hot = cut(ik.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > heavy).select("k"), "hot")
    n_hot = hot.count()
    if not n_hot:
        return ik.join(pk, "k").select("x", "y").distinct()
    mark = F.broadcast(hot) if n_hot <= BROADCAST_IDS else hot
    light = ik.join(mark, "k", "left_anti").join(pk.join(mark, "k", "left_anti"), "k").select("x", "y")

    def sets(keys: DataFrame, eid: str, rows: DataFrame) -> DataFrame:
        held = keys.join(mark, "k", "left_semi").select("k", F.col(eid).alias("eid"))
        return cut(held.join(rows.select("eid", F.col(text).alias("text")).dropDuplicates(["eid"]), "eid"), "sets")

    dense = sizeaware.size_aware_pairs(sets(ik, "x", rows_a), sets(pk, "y", rows_b))
    return light.unionAll(dense).distinct()


def keys_of(rows: DataFrame, name: str, probe: bool) -> DataFrame:
    """(name, k): the block keys of rows (eid, units)."""
    return rows.select(F.col("eid").alias(name), F.explode(block_keys(F.col("units"), probe)).alias("k"))
