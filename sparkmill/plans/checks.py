"""Queries of rules, requests, features and scalars beyond the catalogue's first part, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import chat, dedup, features, nested, requests, rules, sanitize
from ..session import table
from .registry import AREA, COMMAND, query

# Nested access ---------------------------------------------------------------------------------------------------------------


@query("""
WITH r AS (SELECT event_id, json(props) AS j FROM events)
SELECT event_id, CASE WHEN json_type(j->'$.k') IN ('UBIGINT', 'BIGINT') THEN CAST(j->>'$.k' AS BIGINT) ELSE -1 END AS k, '' AS text, '{}' AS obj, true AS is_object FROM r""")
def safe_access(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.concat(F.lit('{"p": '), F.col("props"), F.lit("}")).alias("j"))
    at = lambda path, kind, d: nested.json_at(F.col("j"), path, kind, F.lit(d))
    return e.select("event_id", at("$.p.k", "long", -1).alias("k"), at("$.p.k", "string", "").alias("text"), at("$.q", "object", "{}").alias("obj"), (at("$.p", "object", "{}") != "{}").alias("is_object"))


@query("""
WITH d AS (SELECT feed, file_no, line_no, CASE WHEN json_valid(raw) THEN raw ELSE '{}' END AS raw FROM drift_lines),
x AS (SELECT feed, file_no, line_no, CASE WHEN json_type(raw->'$.metadata.edge_flags') = 'ARRAY' THEN list_filter(from_json(raw->'$.metadata.edge_flags', '["JSON"]'), lambda v: json_type(v) = 'VARCHAR') END AS f FROM d)
SELECT array_to_string(coalesce(list_transform(f, lambda v: v->>'$'), []), ',') AS flags, count(*) AS n FROM x GROUP BY 1""")
def edge_flags(spark, sf):
    d = table(spark, sf, "drift_lines").select(nested.json_at(F.col("raw"), "$.metadata.edge_flags", "array").alias("f"))
    return d.groupBy(F.array_join(nested.strings_only(F.col("f")), ",").alias("flags")).agg(F.count("*").alias("n"))


@query("""
SELECT sample_no, coalesce(command_spec.base_command_text, command_spec.command_text) AS base, 'fixed' AS command, '5' || batch_no || '_' || printf('%03d', sample_no % 1000) AS id FROM incoming_samples""")
def set_fields(spark, sf):
    i = table(spark, sf, "incoming_samples")
    spec = nested.with_field(F.col("command_spec"), "base_command_text", F.col(COMMAND))
    inp = nested.with_field(F.col("input"), "input.command", F.lit("fixed"), always=True)
    i = i.select("sample_no", "batch_no", spec["base_command_text"].alias("base"), inp["input"]["command"].alias("command"), (F.col("sample_no") % 1000).alias("at"))
    return nested.numbered_ids(i, "5", F.col("batch_no"), F.col("at")).select("sample_no", "base", "command", "id")


@query("""
WITH j AS (SELECT sample_no, command_spec.base_command_text AS base, unnest([1, 2]) AS scenario FROM incoming_samples)
SELECT sample_no, scenario, coalesce(base, '') || '#' || scenario AS command FROM j""")
def explode_override(spark, sf):
    i = table(spark, sf, "incoming_samples").select("sample_no", F.coalesce("command_spec.base_command_text", F.lit("")).alias("base"), F.col("input.input").alias("input"), F.array(F.lit(1), F.lit(2)).alias("scenarios"))
    out = nested.exploded(i, F.col("scenarios"), "input", "command", lambda s: F.concat("base", F.lit("#"), s.cast("string")))
    return out.select("sample_no", F.element_at(F.split("input.command", "#"), -1).cast("int").alias("scenario"), F.col("input.command").alias("command"))


# Rules -----------------------------------------------------------------------------------------------------------------------

SHAPES = {"move": (["to"], ["durationSec"]), "attack": (["target"], []), "skill": (["target"], ["to"]), "wait": ([], ["target", "to"])}


@query("""
WITH s AS (SELECT sample_no, unnest(output.action) AS a, generate_subscripts(output.action, 1) - 1 AS pos FROM accepted_samples)
SELECT sample_no, pos, CAST(coalesce(len(list_filter(a.sequence, lambda x: NOT coalesce(CASE x.type WHEN 'move' THEN x.to IS NOT NULL AND x.durationSec IS NULL WHEN 'attack' THEN x.target IS NOT NULL
  WHEN 'skill' THEN x.target IS NOT NULL AND x.to IS NULL WHEN 'wait' THEN x.target IS NULL AND x.to IS NULL END, false))), 0) AS BIGINT) AS n_bad FROM s""")
def tagged_items(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", F.posexplode("output.action").alias("pos", "a"))
    return a.select("sample_no", F.col("pos").cast("long").alias("pos"), rules.tagged("ITEM", F.col("a.sequence"), "type", SHAPES).bad.cast("long").alias("n_bad"))


@query("""
SELECT sample_no, array_to_string(list_filter([CASE WHEN trim(coalesce(metadata.intent_family, '')) = '' THEN 'AXIS_0' END, CASE WHEN trim(coalesce(metadata.command_style, '')) = '' THEN 'AXIS_1' END,
  CASE WHEN trim(coalesce(metadata.difficulty, '')) = '' THEN 'AXIS_2' END], lambda x: x IS NOT NULL), ',') AS reasons FROM accepted_samples""")
def required_axes(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", "metadata.intent_family", "metadata.command_style", "metadata.difficulty")
    return rules.validate(a, rules.blank("AXIS", F.col("intent_family"), F.col("command_style"), F.col("difficulty"))).select("sample_no", F.array_join("failure_reasons", ",").alias("reasons"))


@query("""
SELECT sample_no, array_to_string(list_filter([CASE WHEN NOT list_contains(json_keys(gold), 'empty_action_allowed') THEN 'ABSENT' END,
  CASE WHEN NOT list_contains(json_keys(gold), 'targets') OR json_type(gold->'$.targets') <> 'OBJECT' THEN 'TARGETS' END], lambda x: x IS NOT NULL), ',') AS reasons FROM accepted_samples WHERE json_valid(gold)""")
def typed_fields(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", "gold").where(F.try_parse_json("gold").isNotNull())
    return rules.validate(a, [rules.absent("ABSENT", F.col("gold"), "empty_action_allowed"), rules.not_typed("TARGETS", F.col("gold"), "$.targets", "object")]).select("sample_no", F.array_join("failure_reasons", ",").alias("reasons"))


@query("""
SELECT request_key, CASE WHEN requested_count IS NULL OR payload_count_to_generate IS NULL OR requested_count <> payload_count_to_generate THEN 'stated total is not the items'' sum'
  WHEN sample_count IS NULL OR requested_count <> sample_count THEN 'stated total is not what came' ELSE 'ok' END AS contract FROM (SELECT DISTINCT request_key, requested_count, payload_count_to_generate, sample_count FROM batch_trace)""")
def count_contracts(spark, sf):
    t = table(spark, sf, "batch_trace").select("request_key", "requested_count", "payload_count_to_generate", "sample_count").distinct()
    return t.select("request_key", requests.count_contract(F.col("requested_count"), F.array(F.col("payload_count_to_generate").cast("long")), F.col("sample_count")).alias("contract"))


_REQUEST = r"""(SELECT DISTINCT request_key, request, regexp_extract(request, '^([^.#/\s]+)\.([^.#/\s]+)\.([^.#/\s]+)\.([^.#/\s]+)\.([^.#/\s]+)#([0-9]+)(?:/([^.#/\s]+)\.([^.#/\s]+)\.([^.#/\s]+))?\.([0-9]+)$',
  ['intent', 'actor', 'target', 'pattern', 'scenario', 'slot', 'family', 'kind', 'conflict', 'n']) AS q FROM batch_trace WHERE request IS NOT NULL)"""
_CHECKED = f"""(SELECT request_key, request, q, a.ord AS o1, b.ord AS o2, c.ord AS o3, d.ord AS o4, e.ord AS o5,
  CASE WHEN q.n = '' THEN 'format' WHEN CAST(q.slot AS BIGINT) < 1 THEN 'slot below 1' WHEN CAST(q.n AS BIGINT) < 1 THEN 'count below 1' WHEN a.ord IS NULL THEN 'unknown intent_family' WHEN b.ord IS NULL THEN 'unknown actor_selection'
  WHEN c.ord IS NULL THEN 'unknown target_selection' WHEN d.ord IS NULL THEN 'unknown action_pattern' WHEN e.ord IS NULL THEN 'unknown scenario_family' WHEN q.family <> '' AND f.ord IS NULL THEN 'unknown skill_family'
  WHEN q.kind <> '' AND g.ord IS NULL THEN 'unknown skill_target_kind' WHEN q.conflict <> '' AND h.ord IS NULL THEN 'unknown conflict_type' WHEN q.family <> '' AND q.intent <> 'skill' THEN 'skill parts need a skill intent' ELSE '' END AS error
  FROM {_REQUEST} LEFT JOIN taxonomy_dim a ON a.axis = 'intent_family' AND a.value = q.intent LEFT JOIN taxonomy_dim b ON b.axis = 'actor_selection' AND b.value = q.actor
  LEFT JOIN taxonomy_dim c ON c.axis = 'target_selection' AND c.value = q.target LEFT JOIN taxonomy_dim d ON d.axis = 'action_pattern' AND d.value = q.pattern
  LEFT JOIN taxonomy_dim e ON e.axis = 'scenario_family' AND e.parent = q.intent AND e.value = q.scenario LEFT JOIN taxonomy_dim f ON f.axis = 'skill_family' AND f.value = q.family
  LEFT JOIN taxonomy_dim g ON g.axis = 'skill_target_kind' AND g.value = q.kind LEFT JOIN taxonomy_dim h ON h.axis = 'conflict_type' AND h.value = q.conflict)"""


def _asked(spark, sf):
    return table(spark, sf, "batch_trace").where("request is not null").select("request_key", "request").distinct()


@query(f"SELECT request_key, error, CASE WHEN error = '' THEN q.scenario END AS scenario, CASE WHEN q.n <> '' THEN CAST(q.slot AS BIGINT) END AS slot, CASE WHEN q.n <> '' THEN CAST(q.n AS BIGINT) END AS n FROM {_CHECKED}")
def stable_requests(spark, sf):
    r = requests.resolved(_asked(spark, sf), F.col("request"), table(spark, sf, "taxonomy_dim"))
    return r.select("request_key", F.coalesce("error", F.lit("")).alias("error"), F.when(F.col("error").isNull(), F.col("scenario_family")).alias("scenario"), "slot", F.col("count").alias("n"))


@query(f"SELECT request_key, 'c' || o1 || '-' || o2 || '-' || o3 || '-' || o4 || '-' || o5 || '-' || q.slot || '.' || q.n AS numeric, q.intent || '.' || q.actor || '.' || q.target || '.' || q.pattern || '.' || q.scenario AS path FROM {_CHECKED} WHERE error = '' AND q.family = ''")
def numeric_requests(spark, sf):
    """Right requests without skill parts written with ordinals, and what the numeric grammar reads from that."""
    dim = table(spark, sf, "taxonomy_dim")
    r = requests.resolved(_asked(spark, sf), F.col("request"), dim).where("error is null and skill_family is null").select("request_key", *requests.AXES, "slot", "count")
    for a in requests.AXES:
        d = dim.where(F.col("axis") == a).select(F.col("value").alias("_v"), F.col("parent").alias("_p"), F.col("ord").cast("string").alias(f"_{a}"))
        on = (F.col(a) == F.col("_v")) & (F.col("intent_family") == F.col("_p") if a == "scenario_family" else F.col("_p").isNull())
        r = r.join(d, on).drop("_v", "_p")
    numeric = F.concat(F.lit("c"), F.concat_ws("-", *[f"_{a}" for a in requests.AXES], F.col("slot").cast("string")), F.lit("."), F.col("count").cast("string"))
    back = requests.resolved(r.select("request_key", numeric.alias("numeric")), F.col("numeric"), dim)
    return back.where("error is null").select("request_key", "numeric", X.stable_path(*[F.col(a) for a in requests.AXES]).alias("path"))


@query(r"""
WITH t AS (SELECT DISTINCT inline_response_file AS file, task_index, regexp_extract(request, '^(.*)\.([0-9]+)$', 1) AS prefix, CAST(nullif(regexp_extract(request, '^(.*)\.([0-9]+)$', 2), '') AS INTEGER) AS n FROM batch_trace WHERE request IS NOT NULL)
SELECT file, '[' || string_agg('{"prefix":"' || prefix || '","count":' || n || '}', ',' ORDER BY task_index, prefix, n) || ']' AS payload, count(*) AS n_items, CAST(sum(n) AS BIGINT) AS total, count(*) = count(DISTINCT prefix) AS distinct_prefixes FROM t GROUP BY 1""")
def request_payloads(spark, sf):
    q = X.split_count(F.col("request"))
    t = table(spark, sf, "batch_trace").where("request is not null").select(F.col("inline_response_file").alias("file"), "task_index", q["prefix"].alias("prefix"), q["count"].alias("n")).distinct()
    return requests.payloads(t, ["file"], "prefix", "n", "task_index")


@query("""
SELECT axis, coalesce(parent, '') AS parent, count(*) AS n_values, CASE WHEN count(DISTINCT value) <> count(*) THEN 'a value twice' WHEN count(DISTINCT ord) <> count(*) OR min(ord) <> 1 OR max(ord) <> count(*) THEN 'ordinals are not 1 to n'
  WHEN abs(sum(target_pct) - 100) > 1e-6 THEN 'targets are not 100' ELSE '' END AS error FROM (SELECT * FROM taxonomy_dim UNION ALL SELECT 'odd', parent, value, ord, target_pct, description FROM taxonomy_dim WHERE axis = 'scenario_family') GROUP BY axis, parent""")
def dimension_shape(spark, sf):
    d = table(spark, sf, "taxonomy_dim")
    odd = d.where("axis = 'scenario_family'").withColumn("axis", F.lit("odd"))
    s = requests.dimension_shape(d.unionByName(odd))
    return s.select("axis", F.coalesce("parent", F.lit("")).alias("parent"), "n_values", F.coalesce("error", F.lit("")).alias("error"))


@query("""
SELECT s.sample_no, coalesce(a.description, '') AS pattern_text, coalesce(b.description, '') AS style_text FROM accepted_samples s
LEFT JOIN taxonomy_dim a ON a.axis = 'action_pattern' AND a.value = s.metadata.action_pattern LEFT JOIN taxonomy_dim b ON b.axis = 'command_style' AND b.value = s.metadata.command_style""")
def descriptions(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", "metadata.action_pattern", "metadata.command_style")
    d = requests.described(a, table(spark, sf, "taxonomy_dim"), {"action_pattern": "action_pattern", "command_style": "command_style"})
    return d.select("sample_no", F.col("action_pattern_description").alias("pattern_text"), F.col("command_style_description").alias("style_text"))


@query("SELECT axis AS name, CAST(list_position(['difficulty', 'scenario_family', 'intent_family', 'conflict_type'], axis) AS BIGINT) AS place FROM (SELECT DISTINCT axis FROM taxonomy_dim) WHERE place IS NOT NULL")
def preferred_names(spark, sf):
    return requests.preferred(table(spark, sf, "taxonomy_dim"), "axis", ["difficulty", "scenario_family", "intent_family", "conflict_type"])


# Chat and repair ---------------------------------------------------------------------------------------------------------------


@query("SELECT event_id, coalesce(list_sort(json_keys(props)) = ['k'], false) AS ok, false AS other FROM events")
def answer_contract(spark, sf):
    e = table(spark, sf, "events").select("event_id", chat.messages(F.lit("s"), F.lit("u"), F.col("props")).alias("m"))
    return e.select("event_id", chat.answers_json(F.col("m"), ["k"]).alias("ok"), chat.answers_json(F.col("m"), ["k", "z"]).alias("other"))


@query("""
WITH s AS (SELECT sample_no, unnest(output.action) AS a, generate_subscripts(output.action, 1) - 1 AS pos FROM accepted_samples),
i AS (SELECT sample_no, pos, unnest(list_filter(a.sequence, lambda x: coalesce(x.type IN ('move', 'attack', 'wait'), false))) AS x FROM s)
SELECT sample_no, pos, x.type AS type, CASE WHEN x.movementType IS NULL OR x.movementType IN ('direct', 'flank') THEN x.movementType ELSE 'direct' END AS mode,
  CASE WHEN x.durationSec IS NULL AND x.type <> 'wait' THEN NULL ELSE greatest(1.0, least(10.0, coalesce(x.durationSec, 2.0))) END AS seconds, count(*) AS n FROM i GROUP BY ALL""")
def sanitize_items(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", F.posexplode("output.action").alias("pos", "a"))
    kept = sanitize.coerced(F.col("a.sequence"), "type", ["move", "attack", "wait"], {"wait": 2.0}, "durationSec", 1.0, 10.0, "movementType", ["direct", "flank"], "direct")
    i = a.select("sample_no", F.col("pos").cast("long").alias("pos"), F.explode(kept).alias("x"))
    return i.groupBy("sample_no", "pos", F.col("x.type").alias("type"), F.col("x.movementType").alias("mode"), F.col("x.durationSec").alias("seconds")).agg(F.count("*").alias("n"))


@query("""
WITH x AS (SELECT sample_no, list_transform(output.action, lambda a: a.unitId) AS ids, list_transform(output.dialog, lambda d: d.unitId) AS said, list_transform(input.input.area_situation.allies, lambda u: u.unitId) AS known FROM accepted_samples)
SELECT sample_no, array_to_string(list_transform(list_filter(ids, lambda v, i: v IS NOT NULL AND list_position(ids, v) = i), lambda v: v), ',') AS actors,
  array_to_string(CASE WHEN len(list_filter(coalesce(said, []), lambda v: coalesce(list_contains(known, v), false))) > 0 THEN list_filter(said, lambda v: coalesce(list_contains(known, v), false)) ELSE ['A_01'] END, ',') AS speakers FROM x""")
def sanitize_actors(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", "output", F.col(f"{AREA}.allies.unitId").alias("known"))
    line = F.struct(F.lit("A_01").alias("unitId"), F.lit("").alias("text"))
    return a.select(
        "sample_no", F.array_join(sanitize.first_per_key(F.col("output.action"), "unitId")["unitId"], ",").alias("actors"),
        F.array_join(sanitize.spoken(F.col("output.dialog"), "unitId", F.col("known"), line)["unitId"], ",").alias("speakers"),
    )


# Features and scores ---------------------------------------------------------------------------------------------------------


_FEATURES = """(SELECT sample_no, id, list_sort(list_distinct(list_transform(output.action, lambda a: a.unitId))) AS actors,
  list_sort(list_distinct(list_filter(flatten(list_transform(output.action, lambda a: coalesce(list_transform(a.sequence, lambda s: s.target), []))), lambda t: t IS NOT NULL))) AS targets,
  list_sort(list_transform(output.action, lambda a: coalesce(coalesce(a.unitId, '') || ':' || array_to_string(list_transform(a.sequence, lambda s: s.type), ','), ''))) AS signature, output.action AS action FROM accepted_samples)"""


@query(f"SELECT sample_no, array_to_string(list_filter(actors, lambda a: a IS NOT NULL), ',') AS actors, array_to_string(targets, ',') AS targets, array_to_string(signature, ';') AS signature FROM {_FEATURES}")
def output_features(spark, sf):
    a = table(spark, sf, "accepted_samples").select("sample_no", F.col("output.action").alias("a"))
    return a.select("sample_no", *[F.array_join(f(F.col("a")), sep).alias(n) for n, f, sep in (("actors", features.actors, ","), ("targets", features.targets, ","), ("signature", features.signature, ";"))])


@query(f"""
WITH f AS {_FEATURES}, g AS (SELECT id, arg_min(action, sample_no) AS action, min(sample_no) AS gold_no FROM f GROUP BY id)
SELECT f.sample_no, f.action IS NOT DISTINCT FROM g.action AS action_exact, f.actors IS NOT DISTINCT FROM h.actors AS actors_same, f.targets IS NOT DISTINCT FROM h.targets AS targets_same, f.signature IS NOT DISTINCT FROM h.signature AS signature_same,
  f.action IS NOT DISTINCT FROM g.action OR (f.sample_no % 2 = 0 AND f.actors IS NOT DISTINCT FROM h.actors AND f.targets IS NOT DISTINCT FROM h.targets AND f.signature IS NOT DISTINCT FROM h.signature) AS semantic,
  (len(f.action) = 0) = (len(g.action) = 0) AS empty_right FROM f JOIN g USING (id) JOIN f h ON h.sample_no = g.gold_no""")
def gold_comparison(spark, sf):
    """Each output against that of the first sample with its id; the contract is taken to hold for even numbers."""
    a = table(spark, sf, "accepted_samples").select("sample_no", "id", F.col("output.action").alias("action"))
    gold = a.groupBy("id").agg(F.min_by("action", "sample_no").alias("gold"))
    j = a.join(gold, "id").select("sample_no", features.against_gold(F.col("action"), F.col("gold"), F.col("sample_no") % 2 == 0).alias("c"))
    return j.select("sample_no", "c.*")


@query("""
SELECT event_id, true AS same_numbers, false AS other_number, false AS no_json FROM events""")
def tolerant_equality(spark, sf):
    k = F.get_json_object("props", "$.k")
    e = table(spark, sf, "events").select("event_id", F.concat(F.lit('{"b":1,"k":'), k, F.lit("}")).alias("a"), F.concat(F.lit('{"k":'), k, F.lit('.0, "b": 1.0}')).alias("b"))
    return e.select("event_id", features.json_same("a", "b").alias("same_numbers"), features.json_same("a", F.lit('{"b":1,"k":-5}')).alias("other_number"), F.coalesce(features.json_same("a", F.lit("x")), F.lit(False)).alias("no_json"))


@query("""
WITH k AS (SELECT sample_no, row(command_spec.command_text, output.thinking) AS k, row(command_spec.command_text, output.thinking, list_sort(input.input.area_situation.allies), list_sort(input.input.area_situation.enemies)) AS u FROM accepted_samples)
SELECT (SELECT count(DISTINCT k) FROM k) AS n_keys, (SELECT count(DISTINCT u) FROM k) AS n_keys_with_units, count(*) AS n FROM k""")
def duplicate_keys(spark, sf):
    sig = [features.unit_signature(F.col(f"{AREA}.{s}")) for s in ("allies", "enemies")]
    a = table(spark, sf, "accepted_samples").select(features.duplicate_key(F.col(COMMAND), F.col("output.thinking")).alias("k"), features.duplicate_key(F.col(COMMAND), F.col("output.thinking"), *sig).alias("u"))
    return a.agg(F.countDistinct("k").alias("n_keys"), F.countDistinct("u").alias("n_keys_with_units"), F.count("*").alias("n"))


@query("""
SELECT o_orderkey, o_custkey, (SELECT min(c_name) FROM customer WHERE c_custkey = o_custkey) AS c_name FROM orders""")
def strict_lookup(spark, sf):
    refs = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    got = dedup.strict_join(refs, table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey")
    return got.select("o_orderkey", F.col("c_custkey").alias("o_custkey"), "c_name")


# Scalars ---------------------------------------------------------------------------------------------------------------------


@query("""
SELECT c_custkey, trim(regexp_replace(lower(c_name || ' <' || c_mktsegment || '>'), '[^a-z0-9]+', '-', 'g'), '-') AS slug, c_name || ' &lt;&quot;' || c_mktsegment || '&quot;&gt; &amp;' AS html,
  printf('%+.2f pp', (c_custkey % 200 - 100) / 100.0) AS points, CASE c_mktsegment WHEN 'BUILDING' THEN 'Building' ELSE c_mktsegment END AS label, 1.5 * c_custkey AS seconds FROM customer""")
def report_texts(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        "c_custkey", features.slug(F.concat("c_name", F.lit(" <"), "c_mktsegment", F.lit(">"))).alias("slug"), features.escaped(F.concat("c_name", F.lit(' <"'), "c_mktsegment", F.lit('"> &'))).alias("html"),
        features.points((F.col("c_custkey") % 200 - 100) / F.lit(10000.0)).alias("points"), features.label(F.col("c_mktsegment"), {"BUILDING": "Building"}).alias("label"), (F.col("c_custkey") * 1_500_000_000 / F.lit(1e9)).alias("seconds"),
    )


@query("""
WITH u AS (SELECT event_id, CAST('0x' || substr(md5('11|' || event_id), 1, 8) AS BIGINT) / 4294967296.0 AS u,
  1 - CAST('0x' || substr(md5('11|u|' || event_id), 1, 8) AS BIGINT) / 4294967296.0 AS a, 1 - CAST('0x' || substr(md5('11|v|' || event_id), 1, 8) AS BIGINT) / 4294967296.0 AS b FROM events)
SELECT event_id, round(u, 6) AS u, round(greatest(0.5, least(1.8, 1 + 0.25 * sqrt(-2 * ln(a)) * cos(2 * pi() * b))), 5) AS ratio FROM u""")
def seeded_draws(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.round(features.uniform(11, F.col("event_id")), 6).alias("u"), F.round(X.clamp(1 + 0.25 * features.normal(11, F.col("event_id")), 0.5, 1.8), 5).alias("ratio"))


@query("SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def stamps(spark, sf):
    return table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMdd_HHmmss").alias("stamp"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))


@query("""
WITH u AS (SELECT sample_no, list_transform(input.input.area_situation.allies, lambda x: x.unitId) AS a, list_transform(input.input.area_situation.enemies, lambda x: x.unitId) AS e, list_transform(output.action, lambda x: x.unitId) AS acting FROM accepted_samples)
SELECT sample_no, array_to_string(list_sort(list_distinct(list_concat(a, e))), ',') AS all_ids, list_has_any(acting, e) AS enemy_acts, len(list_filter(acting, lambda x: NOT coalesce(list_contains(list_concat(a, e), x), false) AND x IS NOT NULL)) > 0 AS stranger_acts FROM u""")
def id_sets(spark, sf):
    ids = lambda s: F.col(f"{AREA}.{s}.unitId")
    everyone = F.array_union(ids("allies"), ids("enemies"))
    acting = F.array_compact("output.action.unitId")
    return table(spark, sf, "accepted_samples").select("sample_no", F.array_join(F.array_sort(everyone), ",").alias("all_ids"), rules.meets("", acting, ids("enemies")).bad.alias("enemy_acts"), rules.outside("", acting, everyone).bad.alias("stranger_acts"))


@query("""
SELECT request_key, request AS bare, '"' || request || '"' AS quoted, request AS unquoted, 'a|b' AS listed FROM (SELECT DISTINCT request_key, request FROM batch_trace WHERE request IS NOT NULL)""")
def line_texts(spark, sf):
    t = table(spark, sf, "batch_trace").where("request is not null").select("request_key", "request").distinct()
    quoted = F.concat(F.lit('"'), F.col("request"), F.lit('"'))
    return t.select("request_key", X.without_comment(F.concat("request", F.lit("  # a note #2"))).alias("bare"), quoted.alias("quoted"), X.unquoted(quoted).alias("unquoted"), F.array_join(X.listed(F.lit(" a, b ,")), "|").alias("listed"))


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS whole, NULL AS broken, CAST(json_extract_string(props, '$.k') AS BIGINT) + 0.5 AS number, true AS flag FROM events""")
def lenient_casts(spark, sf):
    k = F.get_json_object("props", "$.k")
    e = table(spark, sf, "events")
    parsed = lambda t: F.to_json(X.strict_variant(t))
    return e.select("event_id", X.lenient_int(F.concat(k, F.lit(".0"))).alias("whole"), X.lenient_int(F.concat(k, F.lit(".5"))).alias("broken"), X.lenient_number(F.concat(k, F.lit(".5"))).alias("number"), (X.lenient_bool(F.lit("true"), False) & parsed(F.concat("props", F.lit(" x"))).isNull() & parsed(F.col("props")).isNotNull()).alias("flag"))


@query("SELECT l_returnflag AS name, round(1 - avg(CASE WHEN l_discount > 0.09 THEN 1.0 ELSE 0.0 END), 6) AS ok_rate FROM lineitem GROUP BY 1")
def enriched_rates(spark, sf):
    """A rate that follows from another where it is missing."""
    s = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("name")).agg(F.avg((F.col("l_discount") > 0.09).cast("int")).alias("violation_rate"), F.lit(None).cast("double").alias("ok_rate"))
    return s.select("name", F.round(F.coalesce("ok_rate", 1 - F.col("violation_rate")), 6).alias("ok_rate"))
