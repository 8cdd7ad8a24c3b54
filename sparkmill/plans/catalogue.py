"""One query for each operator over the test tables, and its SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import text as X
from ..operators import chat, coverage, dedup, dewey, drift, planner, pool, rank, rules, runs, sanitize, score
from ..session import cut, new_path, table
from ..streaming import ingest
from .registry import AREA, BASE, COMMAND, ORACLE_SQL, QUERIES, query

# Coverage ----------------------------------------------------------------------------------------------------------------


LEVELS = ["intent_family", "actor_selection", "target_selection", "action_pattern", "scenario_family"]
_GROUPED = " - ".join(f"grouping({c})" for c in LEVELS)


@query(f"""
WITH leaf AS (SELECT {", ".join(f"coalesce(metadata.{c}, 'unknown') AS {c}" for c in LEVELS)}, count(*) AS n FROM accepted_samples GROUP BY ALL),
up AS (SELECT {", ".join(LEVELS)}, CAST(sum(n) AS BIGINT) AS n, 5 - {_GROUPED} AS depth FROM leaf GROUP BY ROLLUP ({", ".join(LEVELS)})),
s AS (SELECT *, round(CASE WHEN depth = 0 THEN 1.0 ELSE n / sum(n) OVER (PARTITION BY depth, {", ".join(f"CASE WHEN depth > {i + 1} THEN {c} END" for i, c in enumerate(LEVELS[:-1]))}) END, 6) AS share FROM up)
SELECT s.* EXCLUDE (depth), CAST(depth AS BIGINT) AS depth, d.target_pct FROM s LEFT JOIN taxonomy_dim d
  ON d.axis = ({LEVELS!r})[CAST(depth AS INTEGER)] AND d.value = coalesce(s.scenario_family, s.action_pattern, s.target_selection, s.actor_selection, s.intent_family) AND d.parent IS NOT DISTINCT FROM CASE WHEN depth = 5 THEN s.intent_family END""")
def coverage_rollup(spark, sf):
    leaves = coverage.counted(table(spark, sf, "accepted_samples").select(*[F.col(f"metadata.{c}").alias(c) for c in LEVELS]), LEVELS)
    shares = coverage.rollup_shares(leaves, LEVELS).withColumn("share", F.round("share", 6))
    return coverage.with_targets(shares, LEVELS, table(spark, sf, "taxonomy_dim"), {"scenario_family": "intent_family"})


_AXES = {
    **{c: f"metadata.{c}" for c in ("intent_family", "command_style", "actor_selection", "target_selection", "action_pattern", "scenario_family")},
    **{c: f"skill_case.{c}" for c in ("skill_family", "skill_target_kind", "conflict_type")},
}
_EACH_AXIS = f"""(SELECT metadata.intent_family AS intent, unnest([{", ".join("{" + f"'axis': '{a}', 'value': {c}" + "}" for a, c in _AXES.items())}]) AS x FROM accepted_samples)"""


@query(f"""
SELECT d.axis, coalesce(d.parent, '') AS parent, d.value, d.target_pct, coalesce(c.n, 0) AS n FROM taxonomy_dim d
LEFT JOIN (SELECT x.axis AS axis, CASE WHEN x.axis = 'scenario_family' THEN lower(trim(intent)) END AS parent, lower(trim(x.value)) AS value, count(*) AS n FROM {_EACH_AXIS} GROUP BY ALL) c
  ON d.axis = c.axis AND lower(d.parent) IS NOT DISTINCT FROM c.parent AND lower(d.value) = c.value""")
def coverage_spine(spark, sf):
    plain = lambda c: F.lower(F.trim(F.col(c)))
    nested = lambda a: plain("metadata.intent_family") if a == "scenario_family" else F.lit(None).cast("string")
    each = F.array(*[F.struct(F.lit(a).alias("axis"), F.coalesce(nested(a), F.lit("")).alias("_p"), plain(c).alias("_v")) for a, c in _AXES.items()])
    cells = table(spark, sf, "accepted_samples").select(F.explode(each).alias("x")).select("x.*").where("axis <> 'scenario_family' or _p <> ''")
    dim = table(spark, sf, "taxonomy_dim").withColumns({"_p": F.coalesce(F.lower("parent"), F.lit("")), "_v": F.lower("value")})
    return coverage.spine(dim, coverage.counted(cells, ["axis", "_p", "_v"]), ["axis", "_p", "_v"]).select("axis", F.coalesce("parent", F.lit("")).alias("parent"), "value", "target_pct", "n")


@query(f"""
WITH n AS (SELECT x.axis AS axis, x.value AS value, count(*) AS n FROM {_EACH_AXIS} WHERE x.value IS NOT NULL GROUP BY ALL)
SELECT n.axis, n.value, n, round(n / sum(n) OVER (PARTITION BY n.axis), 6) AS share, d.target_pct FROM n LEFT JOIN taxonomy_dim d ON d.axis = n.axis AND d.value = n.value AND d.parent IS NULL""")
def axis_distribution(spark, sf):
    n = coverage.axis_counts(table(spark, sf, "accepted_samples"), {a: F.col(c) for a, c in _AXES.items()}).withColumn("share", F.round("share", 6))
    return n.join(table(spark, sf, "taxonomy_dim").where("parent is null").select("axis", "value", "target_pct"), ["axis", "value"], "left")


@query("""
WITH leaf AS (SELECT p_brand, p_type, p_name, min(p_partkey) AS first_seen, count(*) AS n FROM part GROUP BY ALL)
SELECT p_brand, p_type, p_name, first_seen, n, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_name, first_seen) AS slot FROM leaf""")
def slot_index(spark, sf):
    return coverage.slot_index(table(spark, sf, "part"), ["p_brand", "p_type"], "p_name", "p_partkey")


@query("""
SELECT n_name, r_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS ordinal FROM nation JOIN region ON n_regionkey = r_regionkey""")
def ordinal_lookup(spark, sf):
    n = coverage.ordinals(table(spark, sf, "nation"), ["n_regionkey"], ["n_nationkey"])
    return n.join(table(spark, sf, "region"), n.n_regionkey == F.col("r_regionkey")).select("n_name", "r_name", "ordinal")


@query("""
WITH v AS (SELECT 'action_pattern' AS axis, metadata.action_pattern AS value FROM accepted_samples UNION ALL SELECT 'difficulty', metadata.difficulty FROM accepted_samples
  UNION ALL SELECT 'intent_family', metadata.intent_family FROM accepted_samples)
SELECT axis, coalesce(value, '') AS value, count(*) AS n FROM v WHERE NOT EXISTS (SELECT 1 FROM taxonomy_dim d WHERE d.axis = v.axis AND d.value = v.value) GROUP BY ALL""")
def outside_dimension(spark, sf):
    axes = ("action_pattern", "difficulty", "intent_family")
    each = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(f"metadata.{a}").alias("value")) for a in axes])
    values = coverage.counted(table(spark, sf, "accepted_samples").select(F.explode(each).alias("x")).select("x.*"), ["axis", "value"])
    return coverage.outside_dimension(values, table(spark, sf, "taxonomy_dim"), ["axis", "value"]).select("axis", F.coalesce("value", F.lit("")).alias("value"), "n")


@query("""
SELECT s.sample_no, CASE WHEN i.value IS NULL THEN 'intent_family' WHEN f.value IS NULL THEN 'scenario_family' ELSE 'none' END AS first_failing
FROM accepted_samples s LEFT JOIN (SELECT value FROM taxonomy_dim WHERE axis = 'intent_family') i ON i.value = s.metadata.intent_family
LEFT JOIN (SELECT parent, value FROM taxonomy_dim WHERE axis = 'scenario_family') f ON f.parent = s.metadata.intent_family AND f.value = s.metadata.scenario_family""")
def first_failing_axis(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", "metadata.intent_family", "metadata.scenario_family")
    dim = table(spark, sf, "taxonomy_dim")
    i = dim.where("axis = 'intent_family'").select(F.col("value").alias("intent_family"), F.lit(1).alias("ok_i"))
    f = dim.where("axis = 'scenario_family'").select(F.col("parent").alias("intent_family"), F.col("value").alias("scenario_family"), F.lit(1).alias("ok_f"))
    joined = a.join(i, "intent_family", "left").join(f, ["intent_family", "scenario_family"], "left")
    return joined.select("sample_no", F.when(F.col("ok_i").isNull(), "intent_family").when(F.col("ok_f").isNull(), "scenario_family").otherwise("none").alias("first_failing"))


# Duplicates and references ---------------------------------------------------------------------------------------------


_STATS = """SELECT source, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_groups, CAST(sum(n - 1) AS BIGINT) AS n_duplicates, count(*) FILTER (n > 1) AS n_duplicate_groups, max(n) AS largest
FROM (SELECT coalesce(source, '') AS source, text, count(*) AS n FROM documents GROUP BY ALL) GROUP BY source"""


@query(_STATS)
def duplicate_stats(spark, sf):
    return dedup.duplicate_stats(table(spark, sf, "documents").withColumn("source", F.coalesce("source", F.lit(""))), ["source"], F.col("text"))


@query(f"SELECT count(*) AS n_leaves, CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS n_rows, CAST(coalesce(sum(n_duplicates), 0) AS BIGINT) AS n_duplicates, coalesce(max(largest), 0) AS largest FROM ({_STATS}) WHERE n_duplicates > 0")
def duplicate_totals(spark, sf):
    return dedup.totals(duplicate_stats(spark, sf), only_duplicates=True)


@query("SELECT text, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def keep_first_dedup(spark, sf):
    return dedup.keep_first(table(spark, sf, "documents").select("text", "doc_id"), ["text"], "doc_id")


@query("SELECT '{\"k\":' || json_extract_string(props, '$.k') || '}' AS canonical, count(*) AS n FROM events GROUP BY 1")
def canonical_json_dup(spark, sf):
    return table(spark, sf, "events").groupBy("props").agg(F.count("*").alias("m")).groupBy(X.canonical_json(F.col("props")).alias("canonical")).agg(F.sum("m").alias("n"))


@query("""
SELECT l_returnflag, count(p_partkey) AS n_loaded, count(*) FILTER (p_partkey IS NULL) AS n_missing FROM lineitem
LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 25) ON l_partkey = p_partkey GROUP BY 1""")
def leaf_refs_missing(spark, sf):
    refs = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_partkey").alias("ref"))
    return dedup.reference_stats(refs, table(spark, sf, "part").where("p_size <= 25").select(F.col("p_partkey").alias("ref")), ["l_returnflag"], "ref")


@query("""
SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_orderkey) AS n_keys, (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders) AS n_repeated_keys,
  (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS n_missing
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def strict_ref_join(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus")
    refs = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"))
    got = dedup.strict_join(refs, o, "key", on_error="report")
    return got.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.countDistinct("key").alias("n_keys"), F.first("n_repeated").alias("n_repeated_keys"), F.first("n_missing").alias("n_missing"))


@query("SELECT count(*) AS n, count(DISTINCT request_key) AS n_keys FROM (SELECT DISTINCT * FROM batch_trace)")
def distinct_rows(spark, sf):
    return table(spark, sf, "batch_trace").distinct().agg(F.count("*").alias("n"), F.countDistinct("request_key").alias("n_keys"))


@query("""
SELECT file_name FROM (SELECT DISTINCT file_name FROM raw_generations WHERE received_at >= TIMESTAMP '2026-06-03') EXCEPT SELECT file_name FROM raw_generations WHERE received_at < TIMESTAMP '2026-06-03'""")
def new_files(spark, sf):
    r = table(spark, sf, "raw_generations")
    cutoff = F.lit("2026-06-03").cast("timestamp_ntz")
    return r.where(F.col("received_at") >= cutoff).select("file_name").distinct().exceptAll(r.where(F.col("received_at") < cutoff).select("file_name").distinct())


# Pools and plans ---------------------------------------------------------------------------------------------------------


@query("""
WITH s AS (SELECT coalesce(split, '') AS split, metadata.intent_family AS intent_family, command_spec.base_command_text AS family, min(sample_no) AS first_seen FROM accepted_samples
  WHERE command_spec.base_command_text IS NOT NULL GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY split, intent_family ORDER BY first_seen, family) AS place FROM s QUALIFY place <= 7""")
def expression_pool(spark, sf):
    a = table(spark, sf, "accepted_samples").select(F.coalesce("split", F.lit("")).alias("split"), "metadata.intent_family", F.col(BASE).alias("family"), "sample_no")
    return pool.first_distinct(a, ["split", "intent_family"], "family", "sample_no", 7)


@query("""
WITH p AS (SELECT DISTINCT coalesce(split, '') AS split, command_spec.base_command_text AS family FROM accepted_samples WHERE command_spec.base_command_text IS NOT NULL)
SELECT * FROM p WHERE family IN (SELECT family FROM p GROUP BY family HAVING count(*) > 1)""")
def reserved_families(spark, sf):
    a = table(spark, sf, "accepted_samples").select(F.coalesce("split", F.lit("")).alias("split"), F.col(BASE).alias("family"))
    return pool.reserved_elsewhere(a, "split", "family")


_REQUESTS = "(SELECT request_key, split, path, requested_count, row_number() OVER (PARTITION BY split, path ORDER BY request_key) - 1 AS existing FROM (SELECT DISTINCT request_key, split, path, coalesce(requested_count, 0) AS requested_count FROM batch_trace))"


def _requests(spark, sf):
    t = table(spark, sf, "batch_trace").select("request_key", "split", "path", F.coalesce("requested_count", F.lit(0)).alias("requested_count")).distinct()
    return rank.running(t, F.lit(1).cast("long"), ["split", "path"], ["request_key"], "existing")


@query(f"""
SELECT request_key, requested_count, existing, greatest(0, least(requested_count, 3 - existing)) AS n_new, requested_count - greatest(0, least(requested_count, 3 - existing)) AS n_cycle FROM {_REQUESTS}""")
def pool_policy(spark, sf):
    return pool.policy(_requests(spark, sf), F.col("requested_count"), F.col("existing"), 3).select("request_key", "requested_count", "existing", "n_new", "n_cycle")


@query(f"""
SELECT request_key, o AS output, (existing + o - 1) % 3 + 1 AS source FROM {_REQUESTS}, unnest(range(1, CAST(requested_count AS BIGINT) + 1)) AS u(o)""")
def cycle_plan(spark, sf):
    return pool.cycle_plan(_requests(spark, sf), F.col("requested_count"), F.lit(3), F.col("existing")).select("request_key", "output", "source")


@query("""
SELECT o_orderkey, k AS chunk_no, least(5, n - 5 * k) AS chunk_size FROM (SELECT l_orderkey AS o_orderkey, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1), unnest(range(0, (n + 4) // 5)) AS u(k)""")
def chunk_plan(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").cast("long").alias("n"))
    return planner.chunks(n, F.col("n"), 5).select("o_orderkey", "chunk_no", "chunk_size")


@query(f"SELECT request_key, CAST(coalesce(sum(requested_count) OVER (PARTITION BY split, path ORDER BY request_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cursor_at FROM {_REQUESTS}")
def cycle_cursor(spark, sf):
    return rank.running(_requests(spark, sf), F.col("requested_count"), ["split", "path"], ["request_key"], "cursor_at").select("request_key", F.col("cursor_at").cast("long").alias("cursor_at"))


@query("""
SELECT o_custkey, o_orderkey FROM (SELECT *, sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS running FROM orders) WHERE running <= 500000""")
def prefix_limit(spark, sf):
    return planner.within_limit(table(spark, sf, "orders"), F.col("o_totalprice"), F.lit(500000), ["o_custkey"], ["o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""
WITH i AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q, sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey ROWS UNBOUNDED PRECEDING) AS e FROM lineitem)
SELECT l_orderkey, o_custkey % 100 AS place, l_linenumber FROM i JOIN orders ON l_orderkey = o_orderkey AND o_custkey % 100 >= e - q AND o_custkey % 100 < e""")
def interval_assign(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("q"))
    outputs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 100).alias("place"))
    return planner.assign_intervals(items, outputs, ["l_orderkey"], "q", ["l_linenumber", "l_partkey"], "place").select("l_orderkey", "place", "l_linenumber")


@query("""
WITH RECURSIVE t AS (SELECT inline_response_file, list({'i': request_key, 'k': path, 's': n} ORDER BY response_index_0_based, request_key) AS l
  FROM (SELECT DISTINCT inline_response_file, request_key, path, coalesce(requested_count, 0) AS n, response_index_0_based FROM batch_trace) GROUP BY 1),
r AS (SELECT inline_response_file, l, CAST(NULL AS VARCHAR) AS item, CAST(NULL AS VARCHAR) AS partner FROM t
  UNION ALL SELECT inline_response_file, list_filter(l[2:], lambda x: p IS NULL OR x.i <> p), l[1].i, p
  FROM (SELECT inline_response_file, l, (list_filter(l[2:], lambda x: x.k IS DISTINCT FROM l[1].k AND x.s + l[1].s <= 10)[1]).i AS p FROM r WHERE len(l) > 0))
SELECT inline_response_file, item, partner FROM r WHERE item IS NOT NULL""")
def greedy_pairs(spark, sf):
    t = table(spark, sf, "batch_trace").select("inline_response_file", "request_key", "path", F.coalesce("requested_count", F.lit(0)).alias("n"), "response_index_0_based").distinct()
    return planner.greedy_pairs(t, "inline_response_file", "request_key", "path", "n", "response_index_0_based", 10)


# Chat rows -----------------------------------------------------------------------------------------------------------------


def _chat(spark, sf):
    a = table(spark, sf, "accepted_samples")
    return a.select("sample_no", chat.messages(F.lit("You command six units."), F.when(F.trim(F.col(COMMAND)) != "", F.col(COMMAND)), F.col("output.thinking")).alias("messages"))


_CHAT = """(SELECT sample_no, [{'role': 'system', 'content': 'You command six units.'}, {'role': 'user', 'content': CASE WHEN trim(command_spec.command_text) <> '' THEN command_spec.command_text END},
  {'role': 'assistant', 'content': output.thinking}] AS messages FROM accepted_samples)"""


@query(f"SELECT sample_no, md5(CAST(to_json(messages) AS VARCHAR)) AS digest FROM {_CHAT}")
def build_messages(spark, sf):
    return _chat(spark, sf).select("sample_no", F.md5(F.to_json("messages", {"ignoreNullFields": "false"})).alias("digest"))


@query(f"SELECT list_transform(messages, lambda m: m.role) = ['system', 'user', 'assistant'] AND len(list_filter(messages, lambda m: m.content IS NULL)) = 0 AS ok, count(*) AS n FROM {_CHAT} GROUP BY 1")
def message_contract(spark, sf):
    return _chat(spark, sf).groupBy(chat.contract(F.col("messages")).alias("ok")).agg(F.count("*").alias("n"))


@query(f"SELECT sample_no, CAST(len(messages[1:len(messages) - 1]) AS BIGINT) AS n_prompt, messages[-1].content AS completion FROM {_CHAT}")
def prompt_completion(spark, sf):
    p = chat.prompt_completion(F.col("messages"))
    return _chat(spark, sf).select("sample_no", F.size(p["prompt"]).cast("long").alias("n_prompt"), p["completion"]["content"].alias("completion"))


@query("""
WITH r AS (SELECT sample_no AS row_no, id, row_number() OVER (PARTITION BY id ORDER BY sample_no) AS k FROM incoming_samples),
s AS (SELECT sample_no AS source_no, id, row_number() OVER (PARTITION BY id ORDER BY sample_no) AS k FROM accepted_samples)
SELECT row_no, id, source_no FROM r LEFT JOIN s USING (id, k)""")
def restore_join(spark, sf):
    r = table(spark, sf, "incoming_samples").select(F.col("sample_no").alias("row_no"), "id")
    s = table(spark, sf, "accepted_samples").select(F.col("sample_no").alias("source_no"), "id")
    return chat.restore(r, s, "id", "row_no", "source_no", consume=True).select("row_no", "id", "source_no")


@query("""
SELECT row_no, id, source_no FROM (SELECT sample_no AS row_no, id FROM incoming_samples) LEFT JOIN (SELECT min(sample_no) AS source_no, id FROM accepted_samples GROUP BY id) USING (id)""")
def restore_reuse(spark, sf):
    r = table(spark, sf, "incoming_samples").select(F.col("sample_no").alias("row_no"), "id")
    s = table(spark, sf, "accepted_samples").select(F.col("sample_no").alias("source_no"), "id")
    return chat.restore(r, s, "id", "row_no", "source_no", consume=False).select("row_no", "id", "source_no")


@query("SELECT doc_id, md5('20260517|' || doc_id) AS shuffle_key FROM documents")
def seeded_shuffle(spark, sf):
    return chat.shuffled(table(spark, sf, "documents").select("doc_id"), 20260517, F.col("doc_id"))


# Rules -----------------------------------------------------------------------------------------------------------------------


def _checked_lines(spark, sf):
    l = table(spark, sf, "lineitem")
    return rules.validate(l, [
        rules.out_of_range("QUANTITY_RANGE", F.col("l_quantity"), 2, 48),
        rules.out_of_range("DISCOUNT_RANGE", F.col("l_discount"), high=0.09),
        rules.not_in("FLAG_UNKNOWN", F.col("l_returnflag"), ["A", "N"]),
        rules.Rule("TAX_ABOVE_DISCOUNT", F.col("l_tax") > F.col("l_discount")),
    ])


_LINES = """(SELECT l_orderkey, l_linenumber, l_partkey, list_sort(list_filter([CASE WHEN l_quantity < 2 OR l_quantity > 48 THEN 'QUANTITY_RANGE' END, CASE WHEN l_discount > 0.09 THEN 'DISCOUNT_RANGE' END,
  CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'FLAG_UNKNOWN' END, CASE WHEN l_tax > l_discount THEN 'TAX_ABOVE_DISCOUNT' END], lambda c: c IS NOT NULL)) AS reasons FROM lineitem)"""


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(reasons, ',') AS reasons, len(reasons) = 0 AS passed FROM {_LINES}")
def rule_validate(spark, sf):
    return _checked_lines(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("failure_reasons", ",").alias("reasons"), "passed")


@query(f"SELECT code, count(*) AS n FROM (SELECT unnest(reasons) AS code FROM {_LINES}) GROUP BY 1")
def reason_histogram(spark, sf):
    return rules.reason_counts(_checked_lines(spark, sf))


@query(f"SELECT len(reasons) = 0 AS passed, count(*) AS n FROM {_LINES} GROUP BY 1")
def accepted_rejected_counts(spark, sf):
    return _checked_lines(spark, sf).groupBy("passed").agg(F.count("*").alias("n"))


def _units(side: str):
    return F.col(f"{AREA}.{side}")


@query("""
WITH u AS (SELECT sample_no, list_concat(list_transform(input.input.area_situation.allies, lambda x: x.hpRatio), list_transform(input.input.area_situation.enemies, lambda x: x.hpRatio)) AS hp,
  list_transform(input.input.area_situation.allies, lambda x: x.unitId) AS ids, list_transform(output.dialog, lambda d: d.unitId) AS speakers FROM accepted_samples)
SELECT sample_no, CAST(len(list_filter(hp, lambda h: h < 0.05)) AS BIGINT) AS n_nearly_dead, list_sort(list_distinct(ids)) = ['A_01', 'A_02', 'A_03', 'A_04', 'A_05', 'A_06'] AS ids_exact,
  CAST(len(list_filter(speakers, lambda s: s IS NOT NULL)) - len(list_distinct(speakers)) AS BIGINT) AS n_repeated_speakers FROM u""")
def unit_rules(spark, sf):
    hp = rules.each_element("HP", F.concat(_units("allies")["hpRatio"], _units("enemies")["hpRatio"]), lambda h: h < 0.05)
    ids = rules.set_is_not("IDS", _units("allies")["unitId"], F.array(*[F.lit(f"A_0{i}") for i in range(1, 7)]))
    twice = rules.repeated("SPEAKER", F.coalesce(F.col("output.dialog.unitId"), F.array().cast("array<string>")))
    return table(spark, sf, "accepted_samples").select("sample_no", hp.bad.cast("long").alias("n_nearly_dead"), (~ids.bad).alias("ids_exact"), twice.bad.cast("long").alias("n_repeated_speakers"))


@query("""
WITH a AS (SELECT sample_no, unnest(input.input.area_situation.allies) AS u, list_transform(list_filter(input.input.area_situation.enemies, lambda e: e.isAlive AND e.canBeTargeted), lambda e: e.unitId) AS c FROM accepted_samples),
p AS (SELECT sample_no, u.unitId AS unit_id, u.closestTargetableOpponent AS n, u.farthestTargetableOpponent AS f, c FROM a WHERE u.isAlive)
SELECT sample_no, unit_id, array_to_string(list_sort(list_filter([CASE WHEN len(c) = 0 AND (n IS NOT NULL OR f IS NOT NULL) THEN 'OPPONENT_SHOULD_BE_NULL' END,
  CASE WHEN len(c) > 0 AND (n IS NULL OR NOT list_contains(c, n)) THEN 'OPPONENT_NEAR_OUTSIDE' END, CASE WHEN len(c) > 0 AND (f IS NULL OR NOT list_contains(c, f)) THEN 'OPPONENT_FAR_OUTSIDE' END,
  CASE WHEN len(c) = 1 AND n IS DISTINCT FROM f THEN 'OPPONENT_SINGLE_MISMATCH' END, CASE WHEN len(c) > 1 AND n IS NOT DISTINCT FROM f THEN 'OPPONENT_SHOULD_DIFFER' END], lambda x: x IS NOT NULL)), ',') AS reasons FROM p""")
def pointer_check(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", _units("enemies").alias("e"), F.explode(_units("allies")).alias("u")).where("u.isAlive")
    c = F.transform(F.filter("e", lambda e: e["isAlive"] & e["canBeTargeted"]), lambda e: e["unitId"])
    a = a.select("sample_no", F.col("u.unitId").alias("unit_id"), F.col("u.closestTargetableOpponent").alias("n"), F.col("u.farthestTargetableOpponent").alias("f"), c.alias("c"))
    return rules.validate(a, rules.pointer_pair("OPPONENT", F.col("n"), F.col("f"), F.col("c"))).select("sample_no", "unit_id", F.array_join("failure_reasons", ",").alias("reasons"))


@query("""
WITH x AS (SELECT sample_no, from_json(gold->'$.required_actors', '["VARCHAR"]') AS required, from_json(gold->'$.forbidden_actors', '["VARCHAR"]') AS forbidden,
  list_distinct(list_transform(output.action, lambda a: a.unitId)) AS actors FROM accepted_samples)
SELECT sample_no, coalesce(len(list_filter(required, lambda r: NOT list_contains(actors, r))) > 0, false) AS required_missing, coalesce(list_has_any(actors, forbidden), false) AS forbidden_used FROM x""")
def set_containment(spark, sf):
    gold = F.from_json("gold", "required_actors array<string>, forbidden_actors array<string>")
    a = table(spark, sf, "accepted_samples").select("sample_no", gold.alias("g"), F.col("output.action.unitId").alias("actors"))
    no = F.lit(False)
    return a.select("sample_no", F.coalesce(rules.missing_from("", F.col("g.required_actors"), F.col("actors")).bad, no).alias("required_missing"), F.coalesce(rules.meets("", F.col("actors"), F.col("g.forbidden_actors")).bad, no).alias("forbidden_used"))


@query("""
SELECT sample_no, list_sort(json_keys(gold)) = list_sort(['required_actors', 'forbidden_actors', 'required_action_types', 'empty_action_allowed', 'expected_action_pattern', 'targets']) AS exact FROM accepted_samples""")
def exact_keys(spark, sf):
    keys = ["required_actors", "forbidden_actors", "required_action_types", "empty_action_allowed", "expected_action_pattern", "targets"]
    return table(spark, sf, "accepted_samples").select("sample_no", (~rules.keys_are_not("", F.col("gold"), keys).bad).alias("exact"))


@query("""
WITH u AS (SELECT sample_no, input.input.area_situation.allies AS a, input.input.area_situation.enemies AS e FROM accepted_samples)
SELECT sample_no, array_to_string(list_transform(list_filter(a, lambda x: x.isAlive), lambda x: x.unitId), ',') AS actors,
  array_to_string(list_transform(list_filter(e, lambda x: x.isAlive AND x.canBeTargeted), lambda x: x.unitId), ',') AS targets,
  array_to_string(list_transform(list_filter(list_concat(list_transform(a, lambda x: {'i': x.unitId, 'l': x.isAlive, 't': x.canBeTargeted}), list_transform(e, lambda x: {'i': x.unitId, 'l': x.isAlive, 't': x.canBeTargeted})),
    lambda x: NOT x.l OR NOT x.t), lambda x: x.i || ':' || CASE WHEN NOT x.l AND NOT x.t THEN 'dead+untargetable' WHEN NOT x.l THEN 'dead' ELSE 'untargetable' END), ',') AS invalid FROM u""")
def constraint_summary(spark, sf):
    a, e = _units("allies"), _units("enemies")
    ids = lambda arr, keep: F.array_join(F.transform(F.filter(arr, keep), lambda u: u["unitId"]), ",")
    flags = lambda arr: F.transform(arr, lambda u: F.struct(u["unitId"].alias("i"), u["isAlive"].alias("l"), u["canBeTargeted"].alias("t")))
    why = lambda u: F.concat_ws("+", F.when(~u["l"], "dead"), F.when(~u["t"], "untargetable"))
    invalid = F.transform(F.filter(F.concat(flags(a), flags(e)), lambda u: ~u["l"] | ~u["t"]), lambda u: F.concat(u["i"], F.lit(":"), why(u)))
    return table(spark, sf, "accepted_samples").select(
        "sample_no", ids(a, lambda u: u["isAlive"]).alias("actors"), ids(e, lambda u: u["isAlive"] & u["canBeTargeted"]).alias("targets"), F.array_join(invalid, ",").alias("invalid")
    )


@query("""
SELECT user_id, event_id FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE event_type = 'purchase' AND before IN ('error', 'signup')""")
def lag_policy(spark, sf):
    before = F.lag("event_type").over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, sf, "events").withColumn("before", before).where("event_type = 'purchase' and before in ('error', 'signup')").select("user_id", "event_id")


@query("""
WITH s AS (SELECT sample_no, unnest(output.action) AS a FROM accepted_samples), k AS (SELECT sample_no, a.unitId AS unit_id, list_transform(a.sequence, lambda x: x.type) AS k FROM s WHERE a.unitId IS NOT NULL)
SELECT sample_no, unit_id, CAST(len(k) AS BIGINT) AS n_items, CAST(len(list_filter(range(2, len(k) + 1), lambda i: k[i] IN ('wait', 'attack') AND k[i - 1] IN ('move', 'attack', 'skill') AND k[i] = 'attack')) AS BIGINT) AS n_attacks_after FROM k WHERE k IS NOT NULL""")
def adjacency_rule(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", F.explode("output.action").alias("a")).where("a.unitId is not null and a.sequence is not null")
    kinds = F.col("a.sequence.type")
    return a.select("sample_no", F.col("a.unitId").alias("unit_id"), F.size(kinds).cast("long").alias("n_items"), rules.followed_by("", kinds, ["move", "attack", "skill"], "attack").bad.cast("long").alias("n_attacks_after"))


@query("""
WITH s AS (SELECT sample_no, unnest(output.action) AS a, input.input.area_situation.allies AS allies FROM accepted_samples)
SELECT sample_no, a.unitId AS unit_id, list_filter(allies, lambda u: u.unitId = a.unitId)[1].isAlive AS actor_alive FROM s WHERE a.unitId IS NOT NULL""")
def row_lookup(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", _units("allies").alias("u"), F.explode("output.action").alias("a")).where("a.unitId is not null")
    return a.select("sample_no", F.col("a.unitId").alias("unit_id"), rules.lookup(F.col("u"), "unitId", F.col("a.unitId"))["isAlive"].alias("actor_alive"))


@query("""
WITH a AS (SELECT sample_no, unnest(output.action) AS a, generate_subscripts(output.action, 1) - 1 AS pos FROM accepted_samples)
SELECT sample_no, pos, array_to_string(list_reduce(list_transform(list_filter(coalesce(a.sequence, []), lambda x: x IS NOT NULL), lambda x: [x.type]),
  lambda k, x: CASE WHEN (x[1] = 'wait' AND coalesce(k[-1], '') IN ('attack', 'skill')) OR len(k) >= 3 THEN k ELSE list_concat(k, x) END, CAST([] AS VARCHAR[])), ',') AS kinds FROM a""")
def sanitize_fold(spark, sf):
    item = "array<struct<type:string,target:string>>"
    a = table(spark, sf, "accepted_samples").select("sample_no", F.posexplode("output.action").alias("pos", "a"))
    items = F.transform("a.sequence", lambda x: F.struct(x["type"].alias("type"), x["target"].alias("target")))
    kept = sanitize.folded(items, "type", {"wait": ["attack", "skill"]}, 3, item)
    return a.select("sample_no", F.col("pos").cast("long").alias("pos"), F.array_join(kept["type"], ",").alias("kinds"))


# Scores and runs ---------------------------------------------------------------------------------------------------------


@query("""
SELECT i.sample_no AS incoming_no, a.sample_no AS accepted_no, i.command_spec.command_text = a.command_spec.command_text AS same_command,
  coalesce(i.command_spec.base_command_text = a.command_spec.base_command_text, false) AS same_base, coalesce(i.command_spec.slots = a.command_spec.slots, false) AS same_slots
FROM incoming_samples i JOIN accepted_samples a USING (id)""")
def score_rows(spark, sf):
    pick = lambda n, p: table(spark, sf, n).select("id", F.col("sample_no").alias(f"{p}_no"), F.col("command_spec").alias(p))
    j = pick("incoming_samples", "incoming").join(pick("accepted_samples", "accepted"), "id")
    same = lambda f: F.coalesce(F.col(f"incoming.{f}") == F.col(f"accepted.{f}"), F.lit(False))
    return j.select("incoming_no", "accepted_no", same("command_text").alias("same_command"), same("base_command_text").alias("same_base"), same("slots").alias("same_slots"))


_SUMMARY = "count(*) AS n, round(avg(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END), 6) AS success_rate, round(avg(v), 6) AS value_mean, round(quantile_cont(v, 0.5), 6) AS value_p50, round(quantile_cont(v, 0.95), 6) AS value_p95"


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.startswith(("success_", "value_"))})


@query(f"SELECT {_SUMMARY} FROM (SELECT *, value AS v FROM events)")
def score_summary(spark, sf):
    return _rounded(score.summary(table(spark, sf, "events"), [], {"success": F.col("event_type") == "purchase"}, {"value": F.col("value")}))


_BREAKDOWN = f"""SELECT 'event_type' AS axis, coalesce(event_type, 'unknown') AS value, {_SUMMARY} FROM (SELECT *, value AS v FROM events) GROUP BY 2
UNION ALL SELECT 'hour', CAST(hour(ts) AS VARCHAR), {_SUMMARY} FROM (SELECT *, value AS v FROM events) GROUP BY 2"""


@query(_BREAKDOWN)
def score_breakdown(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("value", "v")
    return _rounded(score.breakdown(events, {"event_type": F.col("event_type"), "hour": F.hour("ts")}, {"success": F.col("event_type") == "purchase"}, {"value": F.col("v")}))


@query(f"SELECT axis, CAST(sum(n) AS BIGINT) AS n, count(*) FILTER (value LIKE 'unknown%') AS n_unknown, sum(n) = (SELECT count(*) FROM events) AS is_whole FROM ({_BREAKDOWN}) GROUP BY 1")
def breakdown_check(spark, sf):
    events = table(spark, sf, "events")
    parts = score.by_axes(events.withColumnRenamed("value", "v"), {"event_type": F.col("event_type"), "hour": F.hour("ts")}).groupBy("axis", "value").agg(F.count("*").alias("n"))
    return score.breakdown_check(parts, events.agg(F.count("*")).scalar())


@query("""
WITH m AS (SELECT event_type, avg(value) AS mean FROM events GROUP BY 1)
SELECT event_type, round(mean, 6) AS mean, round(mean - (SELECT mean FROM m ORDER BY event_type LIMIT 1), 6) AS mean_delta FROM m""")
def delta_vs_baseline(spark, sf):
    m = table(spark, sf, "events").groupBy("event_type").agg(F.avg("value").alias("mean"))
    return score.minus_first(m, "event_type", ["mean"]).select("event_type", F.round("mean", 6).alias("mean"), F.round("mean_delta", 6).alias("mean_delta"))


@query("""
SELECT coalesce(source, '') AS source, round(avg(length(text)), 6) AS mean, round(quantile_cont(length(text), 0.5), 6) AS p50, round(quantile_cont(length(text), 0.95), 6) AS p95,
  max(length(text)) AS longest, count(*) FILTER (length(text) > 1000) AS n_over FROM documents GROUP BY 1""")
def length_stats(spark, sf):
    d = table(spark, sf, "documents").select(F.coalesce("source", F.lit("")).alias("source"), F.length("text").alias("n"))
    plain = d.groupBy("source").agg(F.round(F.avg("n"), 6).alias("mean"), F.max("n").cast("long").alias("longest"), F.count_if(F.col("n") > 1000).alias("n_over"))
    p = rank.percentiles(d, ["source"], {"n": F.col("n")}, (0.5, 0.95))
    return plain.join(p, "source", "left").select("source", "mean", F.round("n_p50", 6).alias("p50"), F.round("n_p95", 6).alias("p95"), "longest", "n_over")


@query("SELECT o_custkey, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest FROM orders GROUP BY 1")
def arg_min_first(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(score.arg_min("o_totalprice", "o_orderkey", "o_orderkey").alias("cheapest"))


@query("""
SELECT coalesce(split, '') AS split, count(*) AS n_requests, CAST(sum(requested_count) AS BIGINT) AS n_requested, CAST(sum(sample_count) AS BIGINT) AS n_received, count(*) FILTER (count_mismatch) AS n_mismatches,
  round(sum(sample_count) * 60.0 / nullif(date_diff('second', min(created_at), max(created_at)), 0), 6) AS per_minute FROM (SELECT DISTINCT * FROM batch_trace) GROUP BY 1""")
def run_summary(spark, sf):
    t = table(spark, sf, "batch_trace").distinct()
    seconds = F.unix_timestamp(F.date_trunc("second", F.max("created_at").cast("timestamp"))) - F.unix_timestamp(F.date_trunc("second", F.min("created_at").cast("timestamp")))
    return t.groupBy(F.coalesce("split", F.lit("")).alias("split")).agg(
        F.count("*").alias("n_requests"), F.sum("requested_count").alias("n_requested"), F.sum("sample_count").alias("n_received"), F.count_if("count_mismatch").alias("n_mismatches"),
        F.round(runs.per_minute(F.sum("sample_count"), seconds), 6).alias("per_minute"),
    )


@query("SELECT coalesce(split, '') AS split, path, CAST(sum(sample_count) AS BIGINT) AS total, min(request_key) AS first_seen FROM (SELECT DISTINCT * FROM batch_trace) GROUP BY 1, 2")
def first_seen_order(spark, sf):
    t = table(spark, sf, "batch_trace").distinct().withColumn("split", F.coalesce("split", F.lit("")))
    return runs.first_seen_sums(t, ["split", "path"], F.col("sample_count"), "request_key")


@query("""
WITH q AS (SELECT event_id AS q_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place, user_id FROM events WHERE event_type = 'click'),
r AS (SELECT event_id AS r_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place, user_id FROM events WHERE event_type = 'purchase')
SELECT user_id, place, coalesce(q_id, -1) AS q_id, coalesce(r_id, -1) AS r_id, CASE WHEN q_id IS NULL THEN 'no_request' WHEN r_id IS NULL THEN 'no_response' ELSE 'ok' END AS status FROM q FULL JOIN r USING (user_id, place)""")
def positional_full_join(spark, sf):
    def side(kind, name):
        e = table(spark, sf, "events").where(F.col("event_type") == kind)
        return e.select("user_id", F.col("event_id").alias(name), F.row_number().over(W.partitionBy("user_id").orderBy("event_id")).cast("long").alias("place"))

    return runs.reconcile(side("click", "q_id"), side("purchase", "r_id"), ["user_id", "place"], {"q_id": -1, "r_id": -1}).select("user_id", "place", "q_id", "r_id", "status")


@query("SELECT doc_id FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE source = 'battlelog_dump') ")
def ledger_skip(spark, sf):
    d = runs.fingerprints(table(spark, sf, "documents").select("doc_id", "text", "source"), F.col("text"))
    return runs.not_yet_seen(d, d.where("source = 'battlelog_dump'")).select("doc_id")


@query("SELECT CAST(coalesce(max(TRY_CAST(nullif(regexp_extract(file_name, '_([0-9]+)\\.jsonl$', 1), '') AS BIGINT)), 0) + 1 AS BIGINT) AS next_number FROM accepted_samples")
def next_number(spark, sf):
    return table(spark, sf, "accepted_samples").agg(runs.next_number(F.col("file_name"), r"_([0-9]+)\.jsonl$"))


@query("SELECT file_name, count(*) AS n FROM accepted_samples GROUP BY 1 ORDER BY n DESC, file_name LIMIT 10")
def top_groups(spark, sf):
    return table(spark, sf, "accepted_samples").groupBy("file_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "file_name").limit(10)


# Texts -----------------------------------------------------------------------------------------------------------------------


_FAMILY = "regexp_replace(coalesce({0}), '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"
for _ in range(2):  # what ends one unit number may begin the next
    _FAMILY = f"regexp_replace({_FAMILY}, '(^|[^A-Za-z0-9_])([AE])_\\p{{{{Nd}}}}{{{{2}}}}([^A-Za-z0-9_]|$)', '\\1\\2_ID\\3', 'g')"
for _particles, _name in (("은|는|이|가", "JOSA_ST"), ("을|를", "JOSA_OBJ")):
    _FAMILY = f"regexp_replace({_FAMILY}, '([AE]_ID)[\\s\\p{{{{Z}}}}]*({_particles})([\\s\\p{{{{Z}}}},.;!?]|$)', '\\1{{{{{_name}}}}}\\3', 'g')"
_FAMILY = f"trim(regexp_replace(regexp_replace(regexp_replace({_FAMILY}, '[\\s\\p{{{{Z}}}}]+', ' ', 'g'), '[\\s\\p{{{{Z}}}}]*,[\\s\\p{{{{Z}}}}]*', ', ', 'g'), '\\s+([.!?])', '\\1', 'g'))"


@query(f"SELECT sample_no, {_FAMILY.format('command_spec.command_text')} AS family FROM accepted_samples")
def family_key(spark, sf):
    return table(spark, sf, "accepted_samples").select("sample_no", X.family_key(F.col(COMMAND)).alias("family"))


@query("""
SELECT request_key, regexp_extract(request, '^(.*)\\.([0-9]+)$', 1) AS prefix, CAST(nullif(regexp_extract(request, '^(.*)\\.([0-9]+)$', 2), '') AS INTEGER) AS n,
  regexp_matches(request, '^[A-Za-z_]+(\\.[A-Za-z_]+){4}#[0-9]+(/[A-Za-z_.]+)?\\.[0-9]+$') AS ok, split_part(request, '.', 1) AS intent FROM (SELECT DISTINCT request_key, request FROM batch_trace WHERE request IS NOT NULL)""")
def grammar_parse(spark, sf):
    t = table(spark, sf, "batch_trace").where("request is not null").select("request_key", "request").distinct()
    cut = X.split_count(F.col("request"))
    ok = F.col("request").rlike(r"^[A-Za-z_]+(\.[A-Za-z_]+){4}#[0-9]+(/[A-Za-z_.]+)?\.[0-9]+$")
    return t.select("request_key", cut["prefix"].alias("prefix"), cut["count"].alias("n"), ok.alias("ok"), F.split_part("request", F.lit("."), F.lit(1)).alias("intent"))


@query("SELECT sample_no, coalesce(nullif(command_spec.base_command_text, ''), nullif(command_spec.command_text, ''), nullif(input.input.command, ''), '<missing>') AS family FROM accepted_samples")
def fallback_field(spark, sf):
    return table(spark, sf, "accepted_samples").select("sample_no", X.first_filled(F.col(BASE), F.col(COMMAND), F.col("input.input.command"), F.lit("<missing>")).alias("family"))


@query("SELECT sample_no, array_to_string(list_sort(list_distinct(regexp_extract_all(command_spec.command_text, '[AE]_[0-9]{2}'))), ',') AS ids FROM accepted_samples")
def extract_ids(spark, sf):
    return table(spark, sf, "accepted_samples").select("sample_no", F.array_join(F.array_sort(X.ids_in(F.col(COMMAND), "[AE]_[0-9]{2}")), ",").alias("ids"))


@query("SELECT axis, coalesce(parent, 'null') || '.' || value AS path, ord, coalesce(description, '') AS description FROM taxonomy_dim")
def report_line_roundtrip(spark, sf):
    d = table(spark, sf, "taxonomy_dim")
    line = F.concat_ws(" @ ", "axis", X.stable_path(F.col("parent"), F.col("value")), F.col("ord").cast("string"), F.coalesce("description", F.lit("")))
    part = F.split(line, " @ ", 4)
    return d.select(part[0].alias("axis"), part[1].alias("path"), part[2].cast("int").alias("ord"), part[3].alias("description"))


@query("""
SELECT value, CASE WHEN length(description) > 12 THEN substr(description, 1, 11) || '…' ELSE description END AS short, greatest(5.0, least(20.0, target_pct)) AS clamped,
  printf('%.1f', ord * 100.0 / 13) || '%(' || CAST(CAST(target_pct AS INTEGER) AS VARCHAR) || '%) / ' || ord AS ratio FROM taxonomy_dim""")
def scalar_texts(spark, sf):
    d = table(spark, sf, "taxonomy_dim")
    return d.select("value", X.truncated(F.col("description"), 12).alias("short"), X.clamp(F.col("target_pct"), 5.0, 20.0).alias("clamped"), X.ratio_text(F.col("ord"), F.lit(13), F.col("target_pct")).alias("ratio"))


@query("SELECT event_id, props AS found FROM events")
def first_json(spark, sf):
    noisy = F.concat(F.lit("```json\nanswer = "), F.col("props"), F.lit(" } end [1]\n```"))
    return table(spark, sf, "events").select("event_id", X.first_json(X.without_fence(noisy)).alias("found"))


@query("""SELECT '[{"b":1,"props":{"k":' || json_extract_string(props, '$.k') || '}}]' AS canonical, count(*) AS n FROM events GROUP BY 1""")
def canonical_without_id(spark, sf):
    text = F.concat(F.lit('[{"props": '), F.col("props"), F.lit(', "id": '), F.col("event_id").cast("string"), F.lit(', "b": 1}]'))
    e = table(spark, sf, "events").select(X.canonical_json(text, "id").alias("canonical"))
    return e.groupBy("canonical").agg(F.count("*").alias("n"))


@query("""
SELECT j.fullkey AS path, count(*) AS n FROM (SELECT CASE WHEN json_valid(raw) THEN raw ELSE 'null' END AS raw FROM raw_generations) r, json_tree(r.raw) j
WHERE j.key IN ('target', 'mentioned_units') AND j.fullkey NOT LIKE '%]' GROUP BY 1""")
def forbidden_key_paths(spark, sf):
    r = table(spark, sf, "raw_generations").select(F.explode(X.key_paths(F.col("raw"), ["target", "mentioned_units"])).alias("path"))
    return r.groupBy("path").agg(F.count("*").alias("n"))


@query("""
WITH s AS (SELECT sample_no, unnest(output.action) AS a, generate_subscripts(output.action, 1) - 1 AS action_pos FROM accepted_samples),
i AS (SELECT sample_no, action_pos, a.unitId AS unit_id, unnest(a.sequence) AS x, generate_subscripts(a.sequence, 1) - 1 AS seq_pos FROM s)
SELECT sample_no, action_pos, seq_pos, unit_id, x.type AS item_type, count(*) OVER (PARTITION BY sample_no) AS n_items FROM i""")
def flatten_items(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", F.posexplode("output.action").alias("action_pos", "a"))
    i = a.select("sample_no", F.col("action_pos").cast("long").alias("action_pos"), F.col("a.unitId").alias("unit_id"), F.posexplode("a.sequence").alias("seq_pos", "x"))
    return i.select("sample_no", "action_pos", F.col("seq_pos").cast("long").alias("seq_pos"), "unit_id", F.col("x.type").alias("item_type"), F.count("*").over(W.partitionBy("sample_no")).alias("n_items"))


@query("""
SELECT d.value AS skill_family, coalesce(f.is_aoe, d.ord % 2 = 0) AS is_aoe, f.is_aoe IS NULL AS by_default FROM taxonomy_dim d
LEFT JOIN (SELECT skill_case.skill_family AS value, arg_min(skill_case.is_skill_aoe, sample_no) AS is_aoe FROM accepted_samples WHERE skill_case.is_skill_aoe IS NOT NULL GROUP BY 1) f USING (value)
WHERE d.axis = 'skill_family' AND d.parent IS NULL""")
def first_match_default(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", F.col("skill_case.skill_family").alias("value"), F.col("skill_case.is_skill_aoe").alias("f")).where("f is not null")
    first = a.groupBy("value").agg(F.min_by("f", "sample_no").alias("f"))
    d = table(spark, sf, "taxonomy_dim").where("axis = 'skill_family' and parent is null").join(first, "value", "left")
    return d.select(F.col("value").alias("skill_family"), F.coalesce("f", F.col("ord") % 2 == 0).alias("is_aoe"), F.col("f").isNull().alias("by_default"))


@query("""
SELECT coalesce(command_spec.base_command_text, '') AS family, count(DISTINCT skill_case.skill_family) AS n_values, count(DISTINCT skill_case.skill_family) <= 1 AS is_single,
  CASE WHEN count(DISTINCT skill_case.skill_family) = 1 THEN min(skill_case.skill_family) END AS value FROM accepted_samples GROUP BY 1""")
def single_value(spark, sf):
    v = F.col("skill_case.skill_family")
    a = table(spark, sf, "accepted_samples").groupBy(F.coalesce(F.col(BASE), F.lit("")).alias("family")).agg(F.countDistinct(v).alias("n_values"), F.min(v).alias("v"))
    return a.select("family", "n_values", (F.col("n_values") <= 1).alias("is_single"), F.when(F.col("n_values") == 1, F.col("v")).alias("value"))


@query("""
WITH f AS (SELECT coalesce(command_spec.base_command_text, '') AS family, command_spec.command_text AS text, min(sample_no) AS first_no, count(*) AS n, coalesce(arg_min_null(metadata.command_style, sample_no), '') AS style FROM accepted_samples GROUP BY 1, 2)
SELECT family, coalesce(arg_min_null(text, first_no), '') AS first_text, arg_min(style, first_no) AS first_style, CAST(sum(n) AS BIGINT) AS n, count(text) AS n_texts, min(first_no) AS first_no,
  array_to_string(list_transform(list(first_no ORDER BY first_no)[1:3], lambda x: CAST(x AS VARCHAR)), ',') AS first_refs FROM f GROUP BY 1""")
def family_buckets(spark, sf):
    return pool.buckets(table(spark, sf, "accepted_samples").select(F.coalesce(F.col(BASE), F.lit("")).alias("family"), F.col(COMMAND).alias("text"), F.col("metadata.command_style").alias("style"), "sample_no"), "family", "text", "style", "sample_no", 3)


@query("""
WITH u AS (SELECT sample_no, 'ally' AS side, unnest(list_transform(input.input.area_situation.allies, lambda x: {'i': x.unitId, 'h': x.hpRatio})) AS u, generate_subscripts(input.input.area_situation.allies, 1) AS place FROM accepted_samples
  UNION ALL SELECT sample_no, 'enemy', unnest(list_transform(input.input.area_situation.enemies, lambda x: {'i': x.unitId, 'h': x.hpRatio})), generate_subscripts(input.input.area_situation.enemies, 1) FROM accepted_samples)
SELECT sample_no, side, place, u.i AS unit_id, u.h AS hp, round(max(u.h) OVER (PARTITION BY sample_no, side) - u.h, 6) AS below_best FROM u""")
def unit_table(spark, sf):
    def side(name, units):
        best = F.array_max(_units(units)["hpRatio"])
        rows = F.transform(F.sequence(F.lit(1), F.size(_units(units))), lambda i: F.struct(F.lit(name).alias("side"), i.cast("long").alias("place"), F.get(_units(units), i - 1)["unitId"].alias("unit_id"), F.get(_units(units), i - 1)["hpRatio"].alias("hp"), best.alias("best")))
        return F.when(F.size(_units(units)) > 0, rows).otherwise(F.slice(rows, 1, 0))

    a = table(spark, sf, "accepted_samples").select("sample_no", F.explode(F.concat(side("ally", "allies"), side("enemy", "enemies"))).alias("u"))
    return a.select("sample_no", "u.side", "u.place", "u.unit_id", "u.hp", F.round(F.col("u.best") - F.col("u.hp"), 6).alias("below_best"))


@query("""
SELECT feed, file_no, count(*) AS n_lines, count(DISTINCT line_no) AS n_places, count(*) FILTER (raw IS NULL OR trim(raw) = '') AS n_empty, count(DISTINCT sha256(raw)) AS n_contents FROM drift_lines GROUP BY 1, 2""")
def file_profile(spark, sf):
    d = runs.fingerprints(table(spark, sf, "drift_lines").select("feed", "file_no", "line_no", "raw"), F.col("raw"))
    return d.groupBy("feed", "file_no").agg(
        F.count("*").alias("n_lines"), F.countDistinct("line_no").alias("n_places"), F.count_if(F.col("raw").isNull() | (F.trim("raw") == "")).alias("n_empty"),
        F.countDistinct(F.when(F.col("raw").isNotNull(), F.col("sha256"))).alias("n_contents"),
    )


# Streams ------------------------------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT id, command_spec.command_text AS command_text FROM incoming_samples UNION SELECT DISTINCT id, command_spec.command_text FROM accepted_samples")
def stream_ingest(spark, sf):
    narrow = lambda n: table(spark, sf, n).select("id", F.col(COMMAND).alias("command_text"))
    sources = []
    for n in ("accepted_samples", "incoming_samples", "accepted_samples"):  # the first is delivered again, as another file
        sources.append(new_path(spark, "delivery"))
        narrow(n).write.parquet(sources[-1])
    return ingest.ingest_once(spark, sources, ["id", "command_text"])


@query("""
SELECT split, path, CAST(sum(requested_count) AS BIGINT) AS cursor_at FROM (SELECT DISTINCT coalesce(split, '') AS split, path, request_key, coalesce(requested_count, 0) AS requested_count FROM batch_trace) GROUP BY 1, 2""")
def stream_cursor(spark, sf):
    return ingest.cursors(spark, f"{sf}/batch_trace.parquet")


_TASK = "batch_no // 5"
_ACCEPTED = f"""(SELECT sample_no, id, {_TASK} AS task, coalesce(trim(command_spec.command_text), '') <> '' AND command_spec.base_command_text IS NOT NULL AS ok,
  row_number() OVER (PARTITION BY id, coalesce(trim(command_spec.command_text), '') <> '' AND command_spec.base_command_text IS NOT NULL ORDER BY {_TASK}, sample_no) = 1 AS is_first FROM incoming_samples)"""


def _loop(spark, sf):
    rows = table(spark, sf, "incoming_samples").select("sample_no", "id", F.col(COMMAND).alias("command"), F.col(BASE).alias("base"), F.floor(F.col("batch_no") / 5).alias("_task"))
    rules_ = [*rules.blank("COMMAND", F.col("command")), rules.Rule("BASE_NULL", F.col("base").isNull())]
    loop = ingest.Loop(spark, new_path(spark, "loop"), "id", "sample_no", rules_)
    last = rows.agg(F.max("_task")).first()[0]
    for task in range(0 if last is None else last + 1):
        loop.take(rows.where(F.col("_task") == task).drop("_task"), task)
    return loop


@query(f"SELECT sample_no, task FROM {_ACCEPTED} WHERE ok AND is_first")
def loop_accepted(spark, sf):
    return _loop(spark, sf).accepted().select("sample_no", F.col("task").cast("long").alias("task"))


@query(f"""
SELECT task, count(*) AS n_rows, count(*) FILTER (ok AND is_first) AS n_accepted, count(*) FILTER (NOT ok) AS n_rejected, count(*) FILTER (ok AND NOT is_first) AS n_skipped,
  CASE WHEN count(*) FILTER (ok AND is_first) = count(*) THEN 'completed' ELSE 'completed_with_skips_or_errors' END AS status FROM {_ACCEPTED} GROUP BY 1""")
def loop_progress(spark, sf):
    return _loop(spark, sf).progress().withColumn("task", F.col("task").cast("long"))


# Nested records and drifting schemas ---------------------------------------------------------------------------------------

ACTION, ITEM = "output.action", "output.action.sequence"
UNITS = [f"{at}.{side}" for at in ("input.input.area_situation", "input.area_situation") for side in ("allies", "enemies")]


def _nodes(spark, sf, lists, only=None):
    return dewey.label(table(spark, sf, "raw_generations"), "record_no", "raw", lists, only=only)


def _open_sql(x: str) -> str:
    return f"CASE WHEN json_type({x}) = 'VARCHAR' AND json_valid({x}->>'$') THEN json({x}->>'$') ELSE {x} END"


def _each_sql(x: str) -> str:
    return f"CASE json_type({x}) WHEN 'ARRAY' THEN from_json({x}, '[\"JSON\"]') WHEN 'OBJECT' THEN [{x}] ELSE CAST([] AS JSON[]) END"


@query(f"""
WITH raws AS (SELECT DISTINCT record_no, json(raw) AS j FROM raw_generations WHERE json_valid(raw)),
root AS (SELECT record_no, CASE WHEN json_type(j) = 'OBJECT' AND json_type(j->'$.samples') IS NOT NULL THEN {_open_sql("(j->'$.samples')")} ELSE j END AS v FROM raws),
each AS (SELECT record_no, {_each_sql("v")} AS l FROM root), rec AS (SELECT record_no, generate_subscripts(l, 1) - 1 AS sample_pos, unnest(l) AS r FROM each),
ropen AS (SELECT record_no, sample_pos, {_open_sql("r")} AS r FROM rec), o AS (SELECT record_no, sample_pos, {_open_sql("(r->'$.output')")} AS o FROM ropen),
al AS (SELECT record_no, sample_pos, {_open_sql("(o->'$.action')")} AS a FROM o), ae AS (SELECT record_no, sample_pos, {_each_sql("a")} AS l FROM al),
act AS (SELECT record_no, sample_pos, generate_subscripts(l, 1) - 1 AS action_pos, unnest(l) AS a FROM ae), ao AS (SELECT record_no, sample_pos, action_pos, {_open_sql("a")} AS a FROM act),
sl AS (SELECT record_no, sample_pos, action_pos, a->>'$.unitId' AS unit_id, {_open_sql("(a->'$.sequence')")} AS s FROM ao WHERE json_type(a) = 'OBJECT'),
se AS (SELECT record_no, sample_pos, action_pos, unit_id, {_each_sql("s")} AS l FROM sl),
it AS (SELECT record_no, sample_pos, action_pos, unit_id, generate_subscripts(l, 1) - 1 AS seq_pos, unnest(l) AS i FROM se),
io AS (SELECT record_no, sample_pos, action_pos, unit_id, seq_pos, {_open_sql("i")} AS i FROM it)
SELECT record_no, sample_pos, action_pos, seq_pos, unit_id, i->>'$.type' AS item_type FROM io WHERE json_type(i) = 'OBJECT'""")
def p3_found(spark, sf):
    n = _nodes(spark, sf, [ACTION, ITEM]).where(F.col("path").isin(ACTION, ITEM))
    n = n.select("key", "path", "label", "parent_label", "places", F.col("fields")["unitId"].alias("unit_id"), F.col("fields")["type"].alias("item_type"))
    n = cut(n, "nodes").dropDuplicates(["key", "path", "label"])  # read twice, parsed once
    up = n.where(F.col("path") == ACTION).select("key", F.col("label").alias("parent_label"), "unit_id")
    items = n.where(F.col("path") == ITEM).drop("unit_id").join(up, ["key", "parent_label"])
    at = lambda i: F.col("places")[i].alias(("sample_pos", "action_pos", "seq_pos")[i])
    return items.select(F.col("key").alias("record_no"), at(0), at(1), at(2), "unit_id", "item_type")


def _p3_table(name, path, fields):
    """A table of all fields on `path`: those named as columns, the others as JSON in `rest`; what is a row of another table is in neither."""

    def run(spark, sf):
        flat = dewey.flat(_nodes(spark, sf, [ACTION, ITEM, *UNITS], [path] if isinstance(path, str) else path), path, fields, "rest")
        return flat.withColumnRenamed("key", "record_no").withColumn("rest", F.to_json("rest")).drop("places")

    run.__name__ = name
    QUERIES[name] = run


_METADATA = ("intent_family", "command_style", "actor_selection", "target_selection", "action_pattern", "scenario_family", "edge_flags", "difficulty")
_UNIT = ("unitId", "isAlive", "canBeTargeted", "isRanged", "hpRatio", "attackRatioToAvg", "engagedByOpponentCount", "teamFormationRole")
_ALLY = (
    "skillDescription", "IsSkillOnSelf", "IsSkillOnOtherAlly", "isSkillAoe", "canSkillTargetDead",
    "closestTargetableOpponent", "farthestTargetableOpponent", "closestAliveAlly", "farthestAliveAlly",
)
_p3_table("p3_records", "", {
    "id": "id", "split": "split", "command_text": "command_spec.command_text", "base_command_text": "command_spec.base_command_text",
    **{f"slots_{c}": f"command_spec.slots.{c}" for c in ("target", "actors", "mentioned_units")}, **{c: f"metadata.{c}" for c in _METADATA},
    "input_input_command": "input.input.command", "input_command": "input.command", "thinking": "output.thinking", "dialog": "output.dialog",
})
_p3_table("p3_units", UNITS, {c: c for c in (*_UNIT, *_ALLY)})
_p3_table("p3_actions", ACTION, {"unit_id": "unitId"})
_p3_table("p3_items", ITEM, {c: c for c in ("type", "subtype", "movementType", "to", "target", "description", "durationSec", "mode")})


@query()
def p6_found(spark, sf):
    return drift.changes(table(spark, sf, "drift_lines")).select("feed", "file_name", "change", "old_path", "new_path")


@query()
def p6_unified(spark, sf):
    lines = table(spark, sf, "drift_lines")
    return drift.typed(drift.unified(lines, drift.changes(lines)))


_VALID = "(SELECT DISTINCT coalesce(feed, '') AS feed, CAST(file_no AS BIGINT) AS file_no, CAST(line_no AS BIGINT) AS line_no FROM drift_lines WHERE json_valid(raw) AND json_type(raw) = 'OBJECT')"


@query(f"SELECT feed, file_no, count(*) AS n_lines, 0 AS n_lost FROM {_VALID} GROUP BY 1, 2")
def p6_lines(spark, sf):
    """Lines of each file in the unified table, and how many of their values are not there under any name."""
    lines = table(spark, sf, "drift_lines")
    u = drift.unified(lines, drift.changes(lines))
    kept = u.select("feed", "file_no", "line_no", F.size("fields").alias("n_kept"), F.size("kinds").alias("n_kinds"))
    return kept.groupBy("feed", "file_no").agg(F.count("*").alias("n_lines"), F.count_if(F.col("n_kept") != F.col("n_kinds")).alias("n_lost"))


from . import checks, files  # noqa: E402, F401  (they register their queries)
