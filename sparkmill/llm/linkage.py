"""Deduplicating new batches against all history: incremental record linkage over persisted blocking-key tables."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.textnorm import norm
from ..operators.components import connected_components
from ..session import cut, exists, new_path
from . import battle
from .texts import like

FIRST = -(2**62)  # the batch of what was accepted before any batch
LIKE_CUTS, UNIT_CUTS = (0.3, 0.6, 0.8, 1.0), (6, 9, 12)
LIKE, ENOUGH = 0.6, battle.NEED
PER_BUCKET, MOST_BUCKETS = 20_000, 4096  # records in a bucket at the start, and the number of folders that still lists well
EID, UNITS = "struct<p:long,q:long>", "struct<c:array<long>,r:array<double>>"
CONTENTS = ["eid", "id", "units", "text"]


def _levels(df: DataFrame) -> DataFrame:
    lev = lambda c, cuts: sum(((F.col(c) >= x).cast("int") for x in cuts), F.lit(0))
    return df.withColumns({"l_text": lev("likeness", LIKE_CUTS), "l_units": lev("n_units", UNIT_CUTS), "l_id": F.coalesce((F.col("id_x") == F.col("id_y")).cast("int"), F.lit(0))})


def learn_weights(patterns: list[tuple[int, int, int, int]], rounds: int = 40) -> dict[str, list[float]]:
    """Fellegi-Sunter weights (log2 m/u) of each field's levels by EM over counted patterns (l_text, l_units, l_id, n).

    The patterns are at most 40, whatever the data. Weights are made to rise with the level, so that a pair which agrees more
    never scores less. No patterns: every level weighs its number.
    """
    sizes = {"l_text": len(LIKE_CUTS) + 1, "l_units": len(UNIT_CUTS) + 1, "l_id": 2}
    if not patterns:
        return {f: [float(i) for i in range(n)] for f, n in sizes.items()}
    names, total = list(sizes), sum(p[-1] for p in patterns)
    m = {f: [(i + 1) / sum(range(1, n + 1)) for i in range(n)] for f, n in sizes.items()}
    u = {f: m[f][::-1] for f in names}
    share = 0.5
    for _ in range(rounds):
        got_m = {f: [0.5] * n for f, n in sizes.items()}
        got_u = {f: [0.5] * n for f, n in sizes.items()}
        match = 0.0
        for *at, n in patterns:
            a = share * math.prod(m[f][i] for f, i in zip(names, at))
            b = (1 - share) * math.prod(u[f][i] for f, i in zip(names, at))
            p = a / (a + b)
            match += p * n
            for f, i in zip(names, at):
                got_m[f][i] += p * n
                got_u[f][i] += (1 - p) * n
        m = {f: [x / sum(v) for x in v] for f, v in got_m.items()}
        u = {f: [x / sum(v) for x in v] for f, v in got_u.items()}
        share = min(max(match / total, 1e-6), 1 - 1e-6)
    out = {}
    for f in names:
        w: list[float] = []
        for a, b in zip(m[f], u[f]):
            w.append(max(math.log2(a / b), w[-1] if w else -math.inf))
        out[f] = w
    return out


class LinkageStore:
    """The accepted records as tables in a folder, which outlives the object and the session: open it again by its path.

    `load` takes what was accepted before; `absorb` takes one batch or several (each is compared with all of lower number), gives the links
    of its rows and adds it. Of the history a batch reads only the buckets its own keys and their partners fall into:

    * contents (eid, id, units, text), one row for each distinct content, and members (eid, no, batch), one for each record, in buckets by eid;
    * keys (k, eid), the blocking keys of contents, in buckets by key;
    * links, by round;
    * reps (no, rep) in buckets by number and clusters (rep, no) in buckets by representative;
    * rounds, written last in every round: number of buckets, the counts of agreement patterns so far and the weights learned from them.

    A round counts once its row in `rounds` is there. What a failed round left behind is overwritten by the next, and a delivery that is absorbed again
    under its `name` gives the links of the first time and changes nothing.

    Columns of a batch: no (long key), batch (long), id, text, area; extra columns are ignored. Null texts count as empty and are like
    nothing; a null batch number is compared with the accepted history only. Rows that repeat a no are taken once.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, per_bucket: int = PER_BUCKET):
        self.spark, self.path, self.per_bucket = spark, path or new_path(spark, "linkage"), per_bucket
        self.round, self.buckets, self.names = 0, 1, {}
        self.patterns: dict[tuple, int] = {}
        self.weights: dict[str, list[float]] | None = None
        self.read: dict[str, int] = {}
        if exists(spark, f"{self.path}/rounds"):
            done = [json.loads(r["value"]) | {"round": r["round"]} for r in spark.read.text(f"{self.path}/rounds").where("value <> ''").collect()]  # one short row a round
            for d in sorted(done, key=lambda d: d["round"]):
                self.round, self.buckets, self.weights = d["round"] + 1, d["buckets"], d["weights"]
                self.patterns = {tuple(p[:-1]): p[-1] for p in d["patterns"]}
                self.names |= {d["name"]: d["round"]} if d["name"] is not None else {}

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(7), key), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, name: str, key: str | None = None, salt: str | None = None) -> None:
        path = f"{self.path}/{name}/round={self.round}"
        if key is None:
            df.write.mode("overwrite").parquet(path)
        else:  # a bucket may be many tasks' work where one key holds many rows
            spread = F.pmod(F.xxhash64(salt or key), F.lit(4))
            df.withColumn("bucket", self._bucket(key)).repartition("bucket", spread).write.mode("overwrite").partitionBy("bucket").parquet(path)

    def _table(self, name: str, kinds: str, keys: DataFrame | None = None, key: str = "k", before: int | None = None) -> DataFrame:
        """A table of the rounds that count (or those `before` one); only the buckets that `keys`, a written table with a column `key`, fall into."""
        base, kinds = f"{self.path}/{name}", f"{kinds}, round int, bucket int"
        if not self.round or not exists(self.spark, base):
            return self.spark.createDataFrame([], kinds)
        df = self.spark.read.option("basePath", base).schema(kinds).parquet(base).where(F.col("round") < (self.round if before is None else before))
        if keys is not None and self.buckets > 1:
            touched = [r[0] for r in keys.select(self._bucket(key)).distinct().collect()]  # at most as many numbers as there are buckets
            self.read[name] = max(self.read.get(name, 0), len(touched))
            df = df.where(F.col("bucket").isin(touched))
        return df

    def _commit(self, name: str | None) -> None:
        row = {"buckets": self.buckets, "patterns": [[*k, n] for k, n in self.patterns.items()], "weights": self.weights, "name": name}
        self.spark.range(1, numPartitions=1).select(F.lit(json.dumps(row)).alias("value")).write.mode("overwrite").text(f"{self.path}/rounds/round={self.round}")
        if name is not None:
            self.names[name] = self.round
        self.round += 1

    def _encode(self, df: DataFrame) -> DataFrame:
        e = df.select(F.col("no").cast("long").alias("no"), F.col("batch").cast("long").alias("batch"), F.col("id").cast("string").alias("id"), "area", "text")
        e = battle.with_units(e, F.col("area")).select("no", "batch", "id", "units", norm(F.col("text")).alias("text"))
        return cut(e.where("no is not null").withColumn("eid", battle.identity(F.col("units"), F.col("text"))), "batch")

    def _add(self, e: DataFrame, firsts: DataFrame, keys: DataFrame) -> None:
        self._write(e.select("eid", "no", "batch").dropDuplicates(["no"]), "members", "eid", "no")
        self._write(firsts.select(*CONTENTS), "contents", "eid")
        self._write(keys, "keys", "k", "eid")

    def load(self, df: DataFrame) -> None:
        """Take the records accepted before any batch. A store that holds a round already is left as it is."""
        if self.round:
            return
        e = self._encode(df.withColumn("batch", F.lit(FIRST)))
        self.buckets = max(1, min(MOST_BUCKETS, e.count() // self.per_bucket))
        firsts = battle.one_of_each(e)
        self._add(e, firsts, firsts.select("eid", F.explode(battle.block_keys(F.col("units"), False)).alias("k")))
        self._commit(None)

    def absorb(self, df: DataFrame, name: str | None = None) -> DataFrame:
        """(known_no, incoming_no, likeness, n_units, score): the links of new rows with rows of lower batches. `self.read` then says how many
        of `self.buckets` buckets of each table were read."""
        if name is not None and name in self.names:
            return self.links().where(F.col("round") == self.names[name]).drop("round")
        self.read = {}
        e = self._encode(df)
        new = cut(battle.one_of_each(e), "new")
        pk = cut(battle.keys_of(new, "y", True), "probes")
        asked = cut(pk.select("k").distinct(), "asked")
        touched = cut(self._table("keys", f"k long, eid {EID}", asked).select("k", F.col("eid").alias("x")).distinct().join(battle.small(asked), "k", "left_semi"), "touched")
        known = touched.select(F.col("x").alias("eid")).distinct()
        firsts = cut(new.join(known, "eid", "left_anti"), "firsts")
        keys = firsts.select("eid", F.explode(battle.block_keys(F.col("units"), False)).alias("k"))
        lists = cut(touched.unionByName(keys.select("k", F.col("eid").alias("x"))), "lists")
        partners = cut(touched.select("x").distinct(), "partners")
        held = self._table("contents", f"eid {EID}, id string, units {UNITS}, text string", partners, "x").select(*CONTENTS).unionByName(firsts.select(*CONTENTS))
        text, heavy = battle.text_to_join(new, ["text"])
        pairs = cut(battle.probed(lists, pk, held, new, text, heavy), "pairs")
        ids = cut(pairs.select(F.col("x").alias("eid")).unionAll(pairs.select("y")).distinct(), "ids")
        body = cut(held.join(battle.small(ids), "eid", "left_semi").dropDuplicates(["eid"]), "need")
        side = lambda s: body.select(F.col("eid").alias(s), F.col("id").alias(f"id_{s}"), F.col("units").alias(f"u_{s}"), F.col("text").alias(f"t_{s}"))
        scored = (
            pairs.join(side("x"), "x").join(side("y"), "y")
            .withColumn("n_units", battle.agreed(F.col("u_x"), F.col("u_y")))
            .withColumn("likeness", like(F.col("t_x"), F.col("t_y")))
        )
        scored = cut(_levels(scored).select("x", "y", "likeness", "n_units", "l_text", "l_units", "l_id"), "scored")
        for *at, n in scored.groupBy("l_text", "l_units", "l_id").count().collect():  # at most 40 patterns
            self.patterns[tuple(at)] = self.patterns.get(tuple(at), 0) + n
        self.weights = learn_weights([(*k, n) for k, n in sorted(self.patterns.items())])
        least = self.weights["l_text"][2] + self.weights["l_units"][2] + self.weights["l_id"][0]  # of a pair that meets the rule only just
        kept = scored.withColumn("score", self._score()).where(F.col("score") >= F.lit(least) - 1e-9).where((F.col("likeness") >= LIKE) & (F.col("n_units") >= ENOUGH))
        kept = cut(kept, "kept")
        linked = cut(kept.select(F.col("x").alias("eid")).unionAll(kept.select("y")).distinct(), "linked")
        mine = e.select("eid", "no", "batch").dropDuplicates(["no"])
        old = self._table("members", f"eid {EID}, no long, batch long", linked, "eid").select("eid", "no", "batch")
        rows = old.unionByName(mine).join(battle.small(linked), "eid", "left_semi")
        k = rows.select(F.col("eid").alias("x"), F.col("no").alias("kn"), F.coalesce("batch", F.lit(2**62)).alias("kb"))
        fresh = mine.select(F.col("eid").alias("y"), F.col("no").alias("yn"), F.coalesce("batch", F.lit(FIRST + 1)).alias("yb"))
        links = (
            kept.join(k, "x").join(fresh, "y").where("kb < yb")
            .select(F.least("kn", "yn").alias("known_no"), F.greatest("kn", "yn").alias("incoming_no"), "likeness", "n_units", "score")
        )
        self._write(links, "links")
        self._add(e, firsts, keys)
        done = self.round
        self._commit(name)
        return self.links().where(F.col("round") == done).drop("round")

    def links(self) -> DataFrame:
        """The links of all rounds, with their round."""
        return self._table("links", "known_no long, incoming_no long, likeness double, n_units int, score double").drop("bucket")

    def _score(self) -> Column:
        pick = lambda f: F.element_at(F.array(*[F.lit(w) for w in self.weights[f]]), F.col(f) + 1)
        return pick("l_text") + pick("l_units") + pick("l_id")

    def representatives(self, numbers: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """(no, rep): every record that is linked, with the least record of its cluster; of `numbers` (no), a written table, only theirs are read."""
        reps = self._table("reps", "no long, rep long", numbers, "no", before)
        if numbers is not None:
            reps = reps.join(battle.small(numbers), "no", "left_semi")
        return reps.groupBy("no").agg(F.max_by("rep", "round").alias("rep"))

    def merge(self, links: DataFrame) -> DataFrame:
        """Take the links of the round absorbed last into the representative mapping; gives the rows of clusters that changed.

        Links are first lifted to the representatives at hand, so union-find runs over the affected clusters' representatives only. Members of affected
        clusters are found by their representative; other clusters are neither read into it nor written again. Run again for the same round it gives and leaves the same.
        """
        ends = cut(links.select(F.col("known_no").alias("a"), F.col("incoming_no").alias("b")), "ends")
        numbers = cut(ends.select(F.col("a").alias("no")).unionAll(ends.select("b")).distinct(), "numbers")
        reps = cut(self.representatives(numbers, self.round - 1), "reps")
        for c in "ab":
            ends = ends.join(reps.select(F.col("no").alias(c), F.col("rep").alias(f"r_{c}")), c, "left")
        at = lambda c: F.coalesce(F.col(f"r_{c}"), F.col(c))
        roots = cut(connected_components(ends.select(at("a").alias("a"), at("b").alias("b"))), "roots")
        nodes = roots.select(F.col("node").alias("rep"), "root")
        clusters = self._table("clusters", "rep long, no long", roots.select(F.col("node").alias("rep")), "rep", self.round - 1).select("rep", "no")
        moved = clusters.join(nodes, "rep").select("no", F.col("root").alias("rep"))
        fresh = roots.join(reps, roots.node == reps.no, "left_anti").select(F.col("node").alias("no"), F.col("root").alias("rep"))
        out = cut(moved.unionAll(fresh).distinct(), "moved")
        for name, key, salt in (("reps", "no", None), ("clusters", "rep", "no")):
            path = f"{self.path}/{name}/round={self.round - 1}"
            out.withColumn("bucket", self._bucket(key)).repartition("bucket", F.pmod(F.xxhash64(salt or key), F.lit(4))).write.mode("overwrite").partitionBy("bucket").parquet(path)
        return out
