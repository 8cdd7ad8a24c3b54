"""Queries of sources and sinks: tables are written in the format of a source, read back by it, and compared with the table by SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import runs
from ..operators.rank import running
from ..session import cut, new_path, table
from ..sources import records, sinks, texts
from .registry import BASE, COMMAND, query


def _lines(spark, sf):
    """The lines of all feeds as text files, one folder a feed's file; null lines are none."""
    path = new_path(spark, "lines")
    d = table(spark, sf, "drift_lines").where("raw is not null").select("file_name", F.col("raw").alias("value"))
    d.repartition("file_name").write.partitionBy("file_name").text(path)
    return path


_KIND = "CASE WHEN json_valid(raw) THEN CASE WHEN json_type(raw) = 'OBJECT' THEN '' ELSE 'not an object' END ELSE 'not JSON' END"
_SOLID = "(SELECT * FROM drift_lines WHERE raw IS NOT NULL AND regexp_replace(raw, '\\s', '', 'g') <> '')"


@query(f"SELECT {_KIND} AS error, count(*) AS n, count(DISTINCT md5(raw)) AS n_texts FROM {_SOLID} GROUP BY 1")
def read_records(spark, sf):
    r = records.read_records(spark, _lines(spark, sf), recursive=True, glob="*")
    return r.groupBy(F.coalesce("error", F.lit("")).alias("error")).agg(F.count("*").alias("n"), F.countDistinct(F.md5(F.coalesce("record", "raw"))).alias("n_texts"))


@query(f"SELECT {_KIND} AS error, count(*) AS n, count(DISTINCT md5(raw)) AS n_texts FROM {_SOLID} GROUP BY 1")
def read_jsonl(spark, sf):
    r = records.read_jsonl(spark, _lines(spark, sf), recursive=True)
    return r.groupBy(F.coalesce("error", F.lit("")).alias("error")).agg(F.count("*").alias("n"), F.countDistinct(F.md5(F.coalesce("record", "raw"))).alias("n_texts"))


@query("SELECT event_id, props FROM events")
def read_strict(spark, sf):
    path = new_path(spark, "strict")
    sinks.write_jsonl(table(spark, sf, "events").select("event_id", "props"), path)
    r = records.read_jsonl(spark, path, on_error="fail").select(F.from_json("record", "event_id long, props string").alias("r"))
    return r.select("r.*")


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def pretty_roundtrip(spark, sf):
    path = new_path(spark, "pretty")
    sinks.write_pretty(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), path)
    return _documents(spark, path)


def _documents(spark, path):
    """Indented objects that follow each other: an object ends where a line is a closing brace alone."""
    each = spark.read.option("lineSep", "\n}").text(path).where(F.col("value").rlike(r"\S")).select(F.concat("value", F.lit("\n}")).alias("value"))
    got = each.select(F.from_json("value", "o_orderkey long, o_custkey long, o_orderstatus string").alias("r"))
    return got.select("r.*")


@query("SELECT p_brand AS file_name, 'list' AS format, count(*) AS n, min(p_partkey) AS first_key, max(p_partkey) AS last_key FROM part GROUP BY 1")
def format_roundtrip(spark, sf):
    """Lists in files, read, written back in the format they had, and read again."""
    one, two = new_path(spark, "lists"), new_path(spark, "lists")
    p = table(spark, sf, "part").select(F.col("p_brand").alias("file_name"), F.col("p_partkey").alias("line_no"), F.to_json(F.struct("p_partkey", "p_name")).alias("record"), F.lit("list").alias("format"))
    sinks.write_texts(records.file_texts(p), one)
    named = lambda path: records.read_records(spark, path, "fail", recursive=True, glob="*.txt")
    sinks.write_texts(records.file_texts(named(one)), two)
    got = named(two).select("format", F.get_json_object("record", "$.p_partkey").cast("long").alias("key"))
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("file_name"))
    return got.join(brands, "key").groupBy("file_name", "format").agg(F.count("*").alias("n"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


def _names(spark, sf):
    return table(spark, sf, "drift_lines").select("file_name").distinct()


@query("""
WITH f AS (SELECT DISTINCT file_name FROM drift_lines), t AS (SELECT file_name, CASE WHEN file_name = 'feed_00000_00' THEN 0 WHEN starts_with(file_name, 'feed_00000_00') THEN 1 WHEN contains(file_name, 'feed_00000_00') THEN 2 END AS tier FROM f)
SELECT file_name FROM t WHERE tier = (SELECT min(tier) FROM t)""")
def resolve_file(spark, sf):
    return records.resolve(_names(spark, sf), "feed_00000_00")


@query("SELECT DISTINCT file_name, CAST(regexp_extract(file_name, '_([0-9]+)\\.jsonl$', 1) AS BIGINT) AS number FROM drift_lines WHERE file_name LIKE 'feed\\_%\\_001.jsonl' ESCAPE '\\'")
def plan_files(spark, sf):
    return records.plan_files(_names(spark, sf), "feed_*.jsonl", 1)


@query("SELECT file_name, row_number() OVER (ORDER BY file_name) AS place FROM (SELECT DISTINCT file_name FROM accepted_samples)")
def file_order(spark, sf):
    names = table(spark, sf, "accepted_samples").select("file_name").distinct().withColumn("_all", F.lit(0))
    return running(names, F.lit(1).cast("long"), ["_all"], ["file_name"], "place").select("file_name", (F.col("place") + 1).alias("place"))


@query("SELECT sample_no FROM accepted_samples WHERE id = (SELECT min(id) FROM accepted_samples) ORDER BY file_name, line_no LIMIT 1")
def find_record(spark, sf):
    a = table(spark, sf, "accepted_samples")
    r = a.select("file_name", "line_no", F.to_json(F.struct("id", "sample_no")).alias("record"))
    return records.find_record(r, a.agg(F.min("id")).first()[0] or "").select(F.get_json_object("record", "$.sample_no").cast("long").alias("sample_no"))


@query("SELECT sample_no, replace(file_name, '.jsonl', '') || '_' || coalesce(id, 'missing_' || printf('%06d', line_no)) AS ref FROM accepted_samples")
def record_refs(spark, sf):
    a = table(spark, sf, "accepted_samples")
    return a.select("sample_no", records.reference(F.regexp_replace("file_name", r"\.jsonl$", ""), F.col("id"), F.col("line_no")).alias("ref"))


@query("""
SELECT '1-2-' || min(sample_no) AS path, coalesce(command_spec.command_text, '') AS command, count(*) AS n, array_to_string(['f_' || min(sample_no), 'f_' || max(sample_no)], '|') AS refs
FROM accepted_samples GROUP BY command_spec.command_text""")
def coverage_lines(spark, sf):
    path = new_path(spark, "report")
    a = table(spark, sf, "accepted_samples").groupBy(F.col(COMMAND).alias("t")).agg(F.min("sample_no").alias("lo"), F.max("sample_no").alias("hi"), F.count("*").alias("n"))
    quoted = F.regexp_extract(F.to_json(F.struct(F.coalesce("t", F.lit("")).alias("t"))), r'(?s)^\{"t":(.*)\}$', 1)
    line = F.concat(F.lit("  c1-2-"), F.col("lo").cast("string"), F.lit(" @ "), quoted, F.lit(" @ "), F.col("n").cast("string"), F.lit(" @ [a, b] @ f_"), F.col("lo").cast("string"), F.lit(", f_"), F.col("hi").cast("string"))
    a.select(line.alias("value")).unionAll(spark.createDataFrame([("# head",), ("",)], "value string")).write.text(path)
    got = texts.coverage_lines(texts.numbered(spark, path))
    return got.select("path", "command", "n", F.array_join("refs", "|").alias("refs"))


@query("""
SELECT request_key, coalesce(split, '') AS split, CASE WHEN split IS NOT NULL THEN regexp_extract(request, '^(.*)\\.([0-9]+)$', 1) END AS request, CASE WHEN split IS NOT NULL THEN CAST(nullif(regexp_extract(request, '^(.*)\\.([0-9]+)$', 2), '') AS INTEGER) END AS n,
  CASE WHEN split IS NULL THEN 'not <split> <request>' ELSE '' END AS error FROM (SELECT DISTINCT request_key, split, request FROM batch_trace WHERE request IS NOT NULL)""")
def plan_lines(spark, sf):
    t = table(spark, sf, "batch_trace").where("request is not null").select("request_key", "split", "request").distinct()
    lines = t.select(F.col("request_key").alias("file_name"), F.lit(1).alias("line_no"), F.concat(F.coalesce(F.concat("split", F.lit("\t")), F.lit("")), "request", F.lit("  # note ")).alias("line"))
    got = texts.plan_lines(lines.unionAll(spark.createDataFrame([("x", 1, "# only a note"), ("x", 2, "")], lines.schema)))
    return got.select(F.col("file_name").alias("request_key"), "split", "request", "n", F.coalesce("error", F.lit("")).alias("error"))


@query("SELECT axis, coalesce(parent, '') AS parent, value, ord FROM taxonomy_dim")
def load_object(spark, sf):
    path = new_path(spark, "object")
    d = table(spark, sf, "taxonomy_dim").select("axis", F.coalesce("parent", F.lit("")).alias("parent"), "value", "ord")
    d.agg(F.to_json(F.struct(F.collect_list(F.struct("*")).alias("rows"))).alias("value")).coalesce(1).write.text(path)  # the dimension is a document of fixed size
    doc = records.load_object(spark, path).select(F.from_json("document", "rows array<struct<axis:string,parent:string,value:string,ord:int>>").alias("d"))
    return doc.select(F.inline("d.rows"))


_TRIMMED = "regexp_replace(text, '^\\s+|\\s+$', '', 'g')"


@query(f"SELECT doc_id, nullif({_TRIMMED}, '') AS block, nullif(text, '') AS literal FROM documents WHERE text IS NOT NULL")
def blocks(spark, sf):
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", "text")
    marked = F.concat(F.lit("head <<BEGIN>>\n"), F.col("text"), F.lit("\n<<END>> tail"))
    source = F.concat(F.lit('import x\n\nPROMPT: str = """'), F.col("text"), F.lit('\n"""\nEND = 1\n'))
    return d.select("doc_id", texts.block_between(marked, "<<BEGIN>>", "<<END>>").alias("block"), F.nullif(F.regexp_replace(texts.literal_of(source, "PROMPT"), r"\n\z", ""), F.lit("")).alias("literal"))


@query("SELECT doc_id, text, lang, title FROM documents")
def jsonl_roundtrip(spark, sf):
    path = new_path(spark, "jsonl")
    sinks.write_jsonl(table(spark, sf, "documents").select("doc_id", "text", "lang", "title"), path)
    return records.read_lines(spark, path, "doc_id long, text string, lang string, title string").drop("_corrupt_record")


@query("SELECT c_custkey, c_name, NULL AS extra, c_mktsegment FROM customer")
def csv_roundtrip(spark, sf):
    path = new_path(spark, "csv")
    sinks.write_csv(table(spark, sf, "customer"), path, ["c_custkey", "c_name", "extra", "c_mktsegment"])
    return spark.read.option("header", True).schema("c_custkey long, c_name string, extra int, c_mktsegment string").csv(path)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_custkey % 7 <> 0")
def drop_rows(spark, sf):
    path = new_path(spark, "orders")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    o.write.partitionBy("o_orderstatus").parquet(path)
    sinks.drop_rows(cut(spark.read.parquet(path)), o.where("o_custkey % 7 = 0").select("o_orderkey"), ["o_orderkey"], "o_orderstatus", path)
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus")


@query("SELECT n_name AS name, sha256(n_name || chr(10)) AS sha256, strlen(n_name) + 1 AS n_bytes FROM nation")
def file_hashes(spark, sf):
    path = new_path(spark, "names")
    n = table(spark, sf, "nation").select("n_name", F.col("n_name").alias("value"))
    n.repartition("n_name").write.partitionBy("n_name").text(path)
    h = texts.file_hashes(spark, path, recursive=True)
    return h.select(F.regexp_replace(F.url_decode(F.regexp_extract("path", r"n_name=([^/]+)/", 1)), r"\+", " ").alias("name"), "sha256", "n_bytes")


@query("SELECT count(*) AS n_files, CAST(sum(strlen(n_name) + 1) AS BIGINT) AS n_bytes, true AS is_same FROM nation")
def tree_hash(spark, sf):
    """The hash of a folder is that of the same files in any other order, and another if one file is left out."""
    h = table(spark, sf, "nation").select(F.concat(F.lit("d/"), "n_name").alias("path"), (F.octet_length("n_name") + 1).cast("long").alias("n_bytes"), F.sha2(F.concat("n_name", F.lit("\n")), 256).alias("sha256"))
    whole, other, less = texts.tree_hash(h), texts.tree_hash(h.repartition(5).withColumn("path", F.concat(F.lit("x/"), "path"))), texts.tree_hash(h.where("path <> 'd/NATION_1'"))
    same = (whole.select("sha256").scalar() == other.select("sha256").scalar()) & (whole.select("sha256").scalar() != less.select("sha256").scalar())
    return h.agg(F.count("*").alias("n_files"), F.sum("n_bytes").alias("n_bytes")).withColumn("is_same", same)


@query("SELECT r_regionkey, '<table><tr><th>n_name</th></tr>' || string_agg('<tr><td>' || n_name || '</td></tr>', '' ORDER BY n_nationkey) || '</table>' AS text FROM (SELECT n_regionkey AS r_regionkey, * FROM nation WHERE n_regionkey = 1) GROUP BY 1")
def html_table(spark, sf):
    n = table(spark, sf, "nation").where("n_regionkey = 1")
    return sinks.html_table(n, ["n_name"], ["n_nationkey"]).select(F.lit(1).cast("long").alias("r_regionkey"), "text")


@query("SELECT n_nationkey AS k, n_name AS name, NULL AS r FROM nation UNION ALL SELECT r_regionkey, NULL, r_name FROM region")
def union_by_name(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    return sinks.union_by_name(n, table(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("r")))


@query("SELECT sample_no, file_name FROM accepted_samples WHERE coalesce(lower(trim(split)), 'train') = 'train' AND metadata.intent_family = 'skill' AND skill_case IS NOT NULL ORDER BY file_name, line_no, sample_no")
def filtered_samples(spark, sf):
    a = table(spark, sf, "accepted_samples")
    return a.where((F.coalesce(F.lower(F.trim("split")), F.lit("train")) == "train") & (F.col("metadata.intent_family") == "skill") & F.col("skill_case").isNotNull()).orderBy("file_name", "line_no", "sample_no").select("sample_no", "file_name")


@query("SELECT DISTINCT request_key, task_index FROM batch_trace WHERE task_index >= 3 ORDER BY task_index")
def restart_from(spark, sf):
    return runs.from_index(table(spark, sf, "batch_trace"), "task_index", 3).select("request_key", "task_index").distinct().orderBy("task_index")


@query("SELECT sample_no, coalesce(nullif(trim(command_spec.base_command_text), ''), '<none>') AS base, coalesce(nullif(trim(split), ''), 'train') AS split FROM accepted_samples")
def defaults(spark, sf):
    filled = lambda c, d: X.first_filled(F.trim(c), F.lit(d))
    return table(spark, sf, "accepted_samples").select("sample_no", filled(F.col(BASE), "<none>").alias("base"), filled(F.col("split"), "train").alias("split"))
