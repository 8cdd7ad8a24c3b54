"""The queries of the operators for training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.textnorm import norm
from ..session import cut, new_path, table
from . import leaks, neargroups, overlap, packing, quota, spam, splits, suffixes
from .linkage import LinkageStore
from .texts import base_text, part

COMMAND, BASE, AREA = "command_spec.command_text", "command_spec.base_command_text", "input.input.area_situation"


def _batch(df: DataFrame, batch) -> DataFrame:
    return df.select(F.col("sample_no").alias("no"), "id", batch.alias("batch"), F.col(COMMAND).alias("text"), F.col(AREA).alias("area"))


DELIVERIES = 3


def _linked(spark: SparkSession, sf: str, merged: bool = False) -> tuple[LinkageStore, list[DataFrame]]:
    """The incoming batches in DELIVERIES deliveries of successive batches, each absorbed by a store that is opened anew by its path."""
    path = new_path(spark, "linkage")
    LinkageStore(spark, path).load(_batch(table(spark, sf, "accepted_samples"), F.lit(None)))
    new = _batch(table(spark, sf, "incoming_samples"), F.col("batch_no"))
    marks = new.agg(F.percentile_approx("batch", [i / DELIVERIES for i in range(1, DELIVERIES)], 10_000)).first()[0] or []
    store, moved = LinkageStore(spark, path), []
    for low, high in zip([None, *sorted(set(marks))], [*sorted(set(marks)), None]):
        due = F.lit(True) if low is None else F.col("batch") > low  # a row without a batch comes with the first
        due = due & (F.lit(True) if high is None else F.col("batch") <= high)
        links = store.absorb(new.where(due | F.col("batch").isNull() if low is None else due), f"up to batch {high}")
        if merged:
            moved.append(store.merge(links))
        store = LinkageStore(spark, path)
    return store, moved


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _linked(spark, sf)[0].links().select("known_no", "incoming_no")


def p1_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Every sample, accepted or incoming, with its cluster (its own number where it is alone) and its number of links."""
    store, _ = _linked(spark, sf, merged=True)
    every = table(spark, sf, "accepted_samples").select("sample_no").unionAll(table(spark, sf, "incoming_samples").select("sample_no")).distinct()
    n = store.links().select(F.explode(F.array("known_no", "incoming_no")).alias("sample_no")).groupBy("sample_no").agg(F.count("*").alias("n_links"))
    at = every.join(store.representatives().withColumnRenamed("no", "sample_no"), "sample_no", "left").join(n, "sample_no", "left")
    return at.select("sample_no", F.coalesce("rep", "sample_no").alias("cluster_no"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _near(spark: SparkSession, sf: str) -> DataFrame:
    return neargroups.near_groups(table(spark, sf, "accepted_samples"), F.col("sample_no"), F.col(AREA), F.col(COMMAND), F.col("output.thinking"))


def p1_members(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of p1_clusters, their samples, and those whose cluster's number is no member's of it or not the least."""
    c = cut(p1_clusters(spark, sf), "clusters")
    least = c.groupBy("cluster_no").agg(F.min("sample_no").alias("least"))
    wrong = least.where("cluster_no <> least").agg(F.count("*")).scalar()
    return c.agg(F.count("*").alias("n_rows"), F.countDistinct("sample_no").alias("n_samples"), wrong.alias("n_wrong"), F.count_if((F.col("n_links") == 0) & (F.col("cluster_no") != F.col("sample_no"))).alias("n_without_link"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _near(spark, sf).where("no <> group_no").select(F.col("group_no").alias("first_no"), F.col("no").alias("sample_no"))


def p4_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Every sample with its group (its own number where it is alone) and its number of links."""
    near = _near(spark, sf)
    return table(spark, sf, "accepted_samples").select("sample_no").distinct().join(near.withColumnRenamed("no", "sample_no"), "sample_no", "left").select(
        "sample_no", F.coalesce("group_no", "sample_no").alias("group_no"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def _shared(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "accepted_samples")
    rows = a.select(
        F.col("sample_no").alias("no"), (part(F.col("split")) != "train").alias("is_left"),
        norm(F.col(COMMAND)).alias("first"), norm(base_text(F.col(COMMAND), F.col(BASE))).alias("second"),
    )
    return overlap.cross_pairs(rows)


def p4_members(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of p4_groups, their samples, and groups whose number is not their least member's."""
    g = cut(p4_groups(spark, sf), "groups")
    wrong = g.groupBy("group_no").agg(F.min("sample_no").alias("least")).where("group_no <> least").agg(F.count("*")).scalar()
    return g.agg(F.count("*").alias("n_rows"), F.countDistinct("sample_no").alias("n_samples"), wrong.alias("n_wrong"), F.count_if((F.col("n_links") == 0) & (F.col("group_no") != F.col("sample_no"))).alias("n_without_link"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return _shared(spark, sf).select("low_no", "high_no")


def p7_methods(spark: SparkSession, sf: str) -> DataFrame:
    """How many pairs the suffix array found, and how many only the join did, for which no span is shared or one too common to be paired off."""
    by = F.col("by")
    return _shared(spark, sf).agg(
        F.count("*").alias("n_pairs"), F.count_if(by.bitwiseAND(overlap.BY_SPAN) > 0).alias("n_by_spans"), F.count_if(by == overlap.BY_JOIN).alias("n_by_join_only"), F.count_if(by == 0).alias("n_same_text")
    )


def p7_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The pairs counted by the split and source of the record that is not in train."""
    of = table(spark, sf, "accepted_samples").select(F.col("sample_no").alias("no"), part(F.col("split")).alias("split"), F.coalesce("gen_source", F.lit("")).alias("gen_source")).where("split <> 'train'")
    found = p7_found(spark, sf)
    held = found.select(F.explode(F.array("low_no", "high_no")).alias("no"))
    return held.join(of, "no").groupBy("split", "gen_source").agg(F.count("*").alias("n_pairs"), F.countDistinct("no").alias("n_records"))


def p7_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Of each record outside train: how much of its command and of its base text stands in commands and base texts of train, and the longest such spans."""
    a = table(spark, sf, "accepted_samples")
    each = {"command": norm(F.col(COMMAND)), "base": norm(base_text(F.col(COMMAND), F.col(BASE)))}
    a = a.select("sample_no", part(F.col("split")).alias("part"), "gen_source", *[t.alias(n) for n, t in each.items()])
    pool = a.select((F.col("part") == "train").alias("right"), F.explode(F.array(*each)).alias("text"))
    texts = pool.groupBy("text").agg(F.bit_or(F.when(F.col("right"), 2).otherwise(1)).alias("side"))
    texts = cut(texts.select(F.monotonically_increasing_id().alias("tid"), "text", "side"), "texts")
    spans = cut(suffixes.shared_spans(texts).drop("other").join(texts.select("tid", "text"), "tid"), "spans")
    out = a.where("part <> 'train'")
    for n in each:
        of = spans.select(F.col("text").alias(n), F.round(F.col("covered") / F.length("text"), 6).alias(f"{n}_covered"), F.col("longest").alias(f"{n}_longest"))
        out = out.join(of, n, "left")
    none = lambda c, v: F.coalesce(c, F.lit(v)).alias(c)
    return out.select("sample_no", "part", "gen_source", *[none(f"{n}_covered", 0.0) for n in each], *[none(f"{n}_longest", 0) for n in each])


def _families(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "accepted_samples")
    base = F.coalesce(base_text(F.col(COMMAND), F.col(BASE)), F.lit(""))
    return a.select("sample_no", base.alias("base"), splits.family(base).alias("family"), part(F.col("split")).alias("part"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return splits.torn(_families(spark, sf), ["base", "family"], "part").select("sample_no")


def p2_splits(spark: SparkSession, sf: str) -> DataFrame:
    shares = {r["split"]: r["share"] for r in table(spark, sf, "split_targets").orderBy(F.desc("share"), "split").collect()}
    return splits.grouped_split(_families(spark, sf), ["base", "family"], shares, no="sample_no").select("sample_no", "group_no", "size", "new_split")


def p2_shares(spark: SparkSession, sf: str) -> DataFrame:
    """For each split its target, how far the records it got are from that in records, whether that is within the largest group, and families in two splits."""
    s = cut(p2_splits(spark, sf), "splits")
    fam = _families(spark, sf).select("sample_no", "family").join(s.select("sample_no", "new_split"), "sample_no")
    n_torn = fam.groupBy("family").agg((F.min("new_split") != F.max("new_split")).alias("t")).agg(F.count_if("t")).scalar()
    got = s.groupBy(F.col("new_split").alias("split")).agg(F.count("*").alias("n"))
    whole, largest = s.agg(F.count("*")).scalar(), s.agg(F.max("size")).scalar()
    off = F.abs(F.coalesce("n", F.lit(0)) - F.col("share") * whole)
    return table(spark, sf, "split_targets").join(got, "split", "left").select("split", "share", (off <= F.greatest(largest, F.lit(1))).alias("is_near"), n_torn.alias("n_torn_families"))


def _quota(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    a = table(spark, sf, "accepted_samples")
    has = F.col("skill_case").isNotNull()
    axes = {c: F.col(f"metadata.{c}") for c in ("intent_family", "command_style", "actor_selection", "target_selection", "action_pattern", "scenario_family")}
    axes |= {c: F.when(has, F.col(f"skill_case.{c}")) for c in ("skill_family", "skill_target_kind")}
    axes["conflict_type"] = F.when(has, F.coalesce("skill_case.conflict_type", F.lit("null")))
    goal = quota.goals(table(spark, sf, "sample_requests"), table(spark, sf, "taxonomy_dim"))
    asked = {r["axis"] for r in goal.select("axis").distinct().collect()}
    axes = {k: v for k, v in axes.items() if k in asked}
    intent = F.col("metadata.intent_family")
    nested = {r["axis"] for r in goal.where("parent <> ''").select("axis").distinct().collect()} & set(axes)
    rows = a.select(F.col("sample_no").alias("no"), part(F.col("split")).alias("split"), "metadata", "skill_case")
    return quota.cells(rows, axes, {k: intent for k in sorted(nested)}), goal


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return quota.outcome(*_quota(spark, sf)).where("is_short and n_drawn <= n_have").select("request_no", "category")


def p5_report(spark: SparkSession, sf: str) -> DataFrame:
    return quota.report(*_quota(spark, sf)).select("request_no", "category", F.round("n_want", 6).alias("n_want"), "n_need", "n_have", "is_short")


def p5_outcome(spark: SparkSession, sf: str) -> DataFrame:
    """What was wanted, at hand and drawn, and the share of the request's draw next to the target share."""
    r = quota.outcome(*_quota(spark, sf))
    return r.select("request_no", "category", F.round("n_want", 6).alias("n_want"), "n_have", "is_short", "n_drawn", F.round("share", 6).alias("share"), F.round("share_drawn", 6).alias("share_drawn"))


def p5_totals(spark: SparkSession, sf: str) -> DataFrame:
    """For each request its size, what was drawn, whether that is what there is to draw, and how many categories are below their floor though they have more."""
    r = quota.outcome(*_quota(spark, sf))
    most = F.when(F.col("share") > 0, F.col("n_have")).otherwise(F.least("n_floor", "n_have"))
    g = r.groupBy("request_no").agg(F.first("sample_size").alias("sample_size"), F.sum("n_drawn").alias("n_drawn"), F.sum(most).alias("_most"), F.sum(F.least("n_floor", "n_have")).alias("_floors"), F.count_if(F.col("n_drawn") < F.least("n_floor", "n_have")).alias("n_below_floor"))
    right = F.col("n_drawn") == F.least(F.greatest("sample_size", "_floors"), "_most")
    return g.select("request_no", "sample_size", "n_drawn", right.alias("is_whole"), "n_below_floor")


def p5_draw(spark: SparkSession, sf: str) -> DataFrame:
    return quota.draw(*_quota(spark, sf)).select("request_no", "category", F.col("no").alias("sample_no"), "by_floor")


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("size"))
    return packing.pack(docs, table(spark, sf, "pack_limits").select("limit_name", F.col("capacity_tokens").alias("capacity")))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf).where("piece = 1").select("limit_name", F.col("id").alias("doc_id"))


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf).withColumnRenamed("id", "doc_id")


def p8_unused(spark: SparkSession, sf: str) -> DataFrame:
    """Containers and the share of them that stays unused, for each limit."""
    used = _packed(spark, sf).groupBy("limit_name", "container").agg(F.sum("size").alias("n")).groupBy("limit_name").agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_tokens"))
    return used.join(table(spark, sf, "pack_limits"), "limit_name").select("limit_name", "n_containers", "n_tokens", (1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("unused"))


def p8_whole(spark: SparkSession, sf: str) -> DataFrame:
    """For each limit the documents and tokens in its containers, the containers that hold too much, and the documents cut without need."""
    p = cut(_packed(spark, sf), "packed")
    full = p.groupBy("limit_name", "container").agg(F.sum("size").alias("n")).join(table(spark, sf, "pack_limits"), "limit_name")
    over = full.groupBy("limit_name").agg(F.count_if(F.col("n") > F.col("capacity_tokens")).alias("n_over"))
    docs = p.groupBy("limit_name", "id").agg(F.sum("size").alias("n"), F.max("n_pieces").alias("n_pieces"), F.count("*").alias("n_rows")).join(table(spark, sf, "pack_limits"), "limit_name")
    bad = (F.col("n_rows") != F.col("n_pieces")) | (F.col("n_pieces") != F.greatest(F.ceil(F.col("n") / F.col("capacity_tokens")), F.lit(1)))
    return docs.groupBy("limit_name").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_tokens"), F.count_if(bad).alias("n_cut_wrong")).join(over, "limit_name")


def _leaks(spark: SparkSession, sf: str, **how) -> DataFrame:
    return leaks.leaks(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), table(spark, sf, "eval_items"), **how)


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf).where(F.col("run") >= leaks.RUN).select(F.col("id").alias("doc_id"), "item_id")


def p9_alignments(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf, least_score=leaks.MATCH * leaks.RUN * 3 // 4).withColumnRenamed("id", "doc_id")


def p10_share(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    return spam.spam_share(docs).select(F.col("id").alias("doc_id"), "n_chars", F.round("share", 6).alias("spam_share"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return p10_share(spark, sf).where("spam_share > 0.5").select("doc_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_clusters, p1_members, p4_found, p4_groups, p4_members, p2_found, p2_splits, p2_shares, p5_found, p5_report, p5_outcome, p5_totals, p5_draw, p7_found, p7_methods, p7_counts, p7_coverage, p8_found, p8_containers, p8_unused, p8_whole, p9_found, p9_alignments, p10_share, p10_found)}
_PLAIN = "replace(replace(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '-', '_'), ' ', '_')"


def _plain_sql(x: str) -> str:
    return _PLAIN.format(x)


_SHORT = f"""
WITH s AS (SELECT CASE lower(regexp_replace(coalesce(split, ''), '^\\s+|\\s+$', '', 'g')) WHEN '' THEN 'train' WHEN 'val' THEN 'validation'
    ELSE lower(regexp_replace(split, '^\\s+|\\s+$', '', 'g')) END AS split, {_plain_sql("metadata.intent_family")} AS intent,
  unnest([{{'axis': 'intent_family', 'value': metadata.intent_family}}, {{'axis': 'action_pattern', 'value': metadata.action_pattern}}, {{'axis': 'scenario_family', 'value': metadata.scenario_family}},
    {{'axis': 'skill_family', 'value': skill_case.skill_family}}, {{'axis': 'conflict_type', 'value': CASE WHEN skill_case IS NOT NULL THEN coalesce(skill_case.conflict_type, 'null') END}}]) AS a FROM accepted_samples),
c AS (SELECT split, a.axis AS axis, intent, {_plain_sql("a.value")} AS value, count(*) AS n FROM s WHERE a.value IS NOT NULL GROUP BY ALL),
g AS (SELECT r.request_no, d.value AS category, r.split, r.axis, {_plain_sql("r.parent")} AS parent, {_plain_sql("d.value")} AS value, round(r.sample_size * d.target_pct / 100, 6) AS n_want,
  greatest(r.min_rows, CAST(ceil(r.sample_size * d.target_pct / 100) AS BIGINT)) AS n_need FROM sample_requests r JOIN taxonomy_dim d ON r.axis = d.axis AND r.parent IS NOT DISTINCT FROM d.parent),
f AS (SELECT request_no, category, n_want, n_need, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_have
  FROM g LEFT JOIN c ON g.split = c.split AND g.axis = c.axis AND g.value = c.value AND (g.parent IS NULL OR g.parent = c.intent) GROUP BY ALL)"""

ORACLE_SQL: dict[str, str] = {
    "p1_members": "SELECT count(*) AS n_rows, count(DISTINCT sample_no) AS n_samples, 0 AS n_wrong, 0 AS n_without_link FROM (SELECT DISTINCT sample_no FROM accepted_samples UNION SELECT sample_no FROM incoming_samples)",
    "p4_members": "SELECT count(DISTINCT sample_no) AS n_rows, count(DISTINCT sample_no) AS n_samples, 0 AS n_wrong, 0 AS n_without_link FROM accepted_samples",
    "p8_whole": "SELECT limit_name, count(*) AS n_docs, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS n_tokens, 0 AS n_cut_wrong, 0 AS n_over FROM documents, pack_limits GROUP BY 1",
    "p2_shares": "SELECT split, share, true AS is_near, 0 AS n_torn_families FROM split_targets",
    "p5_found": _SHORT + " SELECT request_no, category FROM f WHERE n_have < n_need",
    "p5_report": _SHORT + " SELECT *, n_have < n_need AS is_short FROM f",
    "p5_totals": _SHORT + """ SELECT f.request_no, r.sample_size, CAST(least(greatest(r.sample_size, sum(least(r.min_rows, n_have))), sum(CASE WHEN n_want > 0 THEN n_have ELSE least(r.min_rows, n_have) END)) AS BIGINT) AS n_drawn,
  true AS is_whole, 0 AS n_below_floor FROM f JOIN sample_requests r USING (request_no) GROUP BY 1, 2, r.min_rows""",
    "p8_found": "SELECT limit_name, doc_id FROM documents, pack_limits WHERE strlen(coalesce(text, '')) + 1 > capacity_tokens",
}
