"""Queries of declared sources, units, rules, dictionaries, bundles, manifests, evidence maps and event states."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import bundles
from lectern.operators.graph import shared_folder
from lectern.plans.catalog import query, table
from lectern.sources import declared
from lectern.streaming import states


@query("""SELECT CAST(c_custkey AS VARCHAR) AS path, CASE WHEN k IN (0, 1) THEN 'SCH_001' WHEN k <= 6 THEN 'SCH_002' END AS code,
  CASE k WHEN 0 THEN 'no_object' WHEN 1 THEN 'missing:pages' WHEN 2 THEN 'extra:note' WHEN 3 THEN 'source_id' WHEN 4 THEN 'source_url' WHEN 5 THEN 'pages' WHEN 6 THEN 'edition_part' END AS problem,
  CASE WHEN k NOT IN (0, 1) THEN 2 END AS n_pages FROM (SELECT *, c_custkey % 11 AS k FROM customer)""")
def source_declarations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declaration for each customer, with a fault by its key."""
    k, page = F.col("c_custkey") % 11, F.concat(F.lit("p"), "c_custkey")
    part = F.struct(F.lit("a").alias("artifact_id"), F.when(k != 6, F.lit("l")).alias("label"), F.array(page).alias("pages"))
    second = F.when(k == 5, page).otherwise(F.concat(page, F.lit("_2")))
    fields = F.struct(
        F.when(k != 3, F.col("c_name")).otherwise(" ").alias("source_id"), F.col("c_name").alias("work_title"), F.lit("").alias("edition_note"), F.col("c_mktsegment").alias("technique_id"), F.lit("open").alias("rights_status"), F.lit("all").alias("release_policy"), part.alias("edition_part"),
        F.lit("site").alias("source_site"), F.when(k == 4, "c_name").otherwise("http://x").alias("source_url"), F.sha2("c_name", 256).alias("file_sha256"), F.when(k != 1, F.array(page, second)).alias("pages"), F.when(k == 2, "n").alias("note"),
    )
    found = declared.declarations(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("path"), F.when(k == 0, "[1, 2]").otherwise(F.to_json(fields)).alias("text")))
    return found.select("path", "code", "problem", F.when(F.col("pages").isNotNull(), F.size("pages")).alias("n_pages"))


@query("""SELECT 'ku_' || o_orderkey AS unit_id, CASE k WHEN 0 THEN 'missing:provenance' WHEN 1 THEN 'unparsable:unit' WHEN 2 THEN 'identity' WHEN 3 THEN 'twice:assertions' END AS problem,
  CASE WHEN o_custkey = o_orderkey THEN [CAST(o_custkey AS VARCHAR)] ELSE [CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR)] END AS span_ids FROM (SELECT *, o_orderkey % 9 AS k FROM orders)""")
def unit_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A unit for each order as three files, some with a fault."""
    k, name = F.col("o_orderkey") % 9, F.concat(F.lit("ku_"), "o_orderkey")
    at = lambda file: F.concat(F.lit("/units/"), name, F.lit(f"/{file}"))
    file = lambda path, text: F.struct(at(path).alias("path"), text.alias("text"))
    unit = F.when(k == 1, "{").otherwise(F.concat(F.lit('{"unit_id": "'), F.when(k == 2, "other").otherwise(name), F.lit('"}')))
    claims = F.to_json(F.array(F.struct(F.array(F.col("o_custkey").cast("string")).alias("span_ids")), F.struct(F.array(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")).alias("span_ids"))))
    files = F.array(file("unit.json", unit), F.when(k != 0, file("provenance.json", F.lit("{}"))), file("assertions.json", claims), F.when(k == 3, file("assertions.yaml", claims)))
    each = table(spark, sf_dir, "orders").select(F.explode(F.array_compact(files)).alias("f")).select("f.*")
    return declared.units(each).select("unit_id", "problem", "span_ids")


_RULES = """r AS (SELECT p_partkey // 50 AS file, p_partkey % 50 AS place, p_partkey % 300 AS id, p_name, p_partkey % 13 AS k, p_partkey FROM part WHERE p_partkey // 50 % 10 <> 3),
sound AS (SELECT * FROM r WHERE k NOT IN (0, 1, 2)),
fresh AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY file, place) AS nth FROM sound)"""


def _rule_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of fifty parts each as rules; one file of ten is no list, and some records are faulty."""
    k, size, files = F.col("p_partkey") % 13, 50, table(spark, sf_dir, "part")
    record = F.when(k == 0, "17").otherwise(F.to_json(F.struct(F.when(k != 1, F.concat(F.lit("p"), F.col("p_partkey") % 300)).alias("id"), F.when(k != 2, F.col("p_name")).alias("name"), F.when(k == 3, "大吉").otherwise("?").alias("jiXiong"))))
    placed = files.select(F.floor(F.col("p_partkey") / size).alias("file"), F.struct((F.col("p_partkey") % size).alias("at"), record.alias("text")).alias("r"))
    joined = F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["text"]), ","), F.lit("]"))
    whole = placed.groupBy("file").agg(joined.alias("text"))
    return declared.rule_records(whole.select(F.lpad(F.col("file").cast("string"), 12, "0").alias("path"), F.when(F.col("file") % 10 == 3, "{}").otherwise(F.col("text")).alias("text")))


@query(f"""WITH {_RULES} SELECT 'p' || id AS pattern_id, lpad(CAST(file AS VARCHAR), 12, '0') AS path, p_name AS name, CASE WHEN k = 3 THEN '大吉' ELSE '平' END AS luck FROM fresh WHERE nth = 1 AND id >= 20""")
def rules_imported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rules; the first twenty ids are known already."""
    known = table(spark, sf_dir, "part").where("p_partkey < 20").select(F.concat(F.lit("p"), "p_partkey").alias("pattern_id")).unionByName(spark.range(1).select(F.lit("p0").alias("pattern_id")))
    return declared.imported_rules(_rule_records(spark, sf_dir), known).select("pattern_id", "path", "name", "luck")


@query(f"""WITH {_RULES} SELECT (SELECT count(*) FROM r) AS n_records, (SELECT count(*) FROM fresh WHERE nth = 1) AS n_imported, (SELECT count(*) FROM fresh WHERE nth > 1) AS n_skipped, (SELECT count(*) FROM r WHERE k IN (0, 1, 2)) AS n_errors,
  (SELECT count(DISTINCT p_partkey // 50) FROM part WHERE p_partkey // 50 % 10 = 3) AS n_files_broken, 1 AS n_category, 1 AS n_school""")
def rule_import_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _rule_records(spark, sf_dir)
    return declared.import_counts(records, declared.imported_rules(records, spark.createDataFrame([], "pattern_id string")))


@query("""SELECT p_partkey, chr(CAST(19968 + p_partkey AS INTEGER)) AS char, 'U+' || upper(to_hex(19968 + p_partkey)) AS unicode, CASE WHEN p_partkey % 3 > 0 THEN p_brand END AS radical, CASE WHEN p_partkey % 3 > 0 THEN CAST(p_size AS VARCHAR) END AS strokes,
  CASE WHEN p_partkey % 3 > 0 THEN p_type END AS reading, CAST(NULL AS VARCHAR) AS definition FROM part WHERE p_partkey <= 20000""")
def characters_looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary of lines made of parts, by code point; a third of the parts is only mentioned in comments. There are as many keys as the block has characters."""
    part = table(spark, sf_dir, "part").where("p_partkey <= 20000")
    key = F.concat(F.lit("U+"), F.hex(F.lit(0x4E00) + F.col("p_partkey")))
    tab = lambda field, value: F.concat_ws("\t", key, F.lit(field), value)
    values = F.array(tab("kRSUnicode", F.col("p_brand")), tab("kTotalStrokes", F.concat_ws(" ", F.col("p_size"), F.lit("99"))), tab("kMandarin", F.col("p_type")), F.lit("short\tline"))
    lines = part.select(F.explode(F.when(F.col("p_partkey") % 3 > 0, values).otherwise(F.transform(values, lambda v: F.concat(F.lit("#"), v)))).alias("line"))
    return declared.looked_up(part.select("p_partkey", declared.keyed_character(key).alias("char")), declared.character_fields(lines, "line"))


@query("""SELECT 'nation' AS pack, count(*) AS n, count(*) AS n_reread, CAST(NULL AS VARCHAR) AS problem FROM nation UNION ALL SELECT 'none', 0, 0, NULL UNION ALL SELECT 'orders', count(*), count(*), NULL FROM orders
UNION ALL SELECT 'torn', count(*), 2 * count(*), 'rows_differ' FROM customer""")
def bundle_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs of tables committed as one release, and what a check finds when one of them was written to afterwards."""
    root = f"{shared_folder(spark)}/bundle-{uuid.uuid4().hex}"
    packs = {"orders": table(spark, sf_dir, "orders"), "nation": table(spark, sf_dir, "nation"), "none": table(spark, sf_dir, "orders").where("false"), "torn": table(spark, sf_dir, "customer")}
    bundles.commit_bundle(root, "r1", packs)
    named = bundles.manifests(spark, root).select(F.explode("packs").alias("p")).select("p.*")
    folders = {r["pack"]: f"{root}/{r['folder']}" for r in named.collect()}
    packs["torn"].write.mode("append").parquet(folders["torn"])
    counted = None
    for name, folder in sorted(folders.items()):
        one = spark.read.parquet(folder).agg(F.count(F.lit(1)).alias("n_reread")).select(F.lit(name).alias("pack"), "n_reread")
        counted = one if counted is None else counted.unionByName(one)
    problems = spark.createDataFrame(bundles.bundle_problems(spark, root, "r1"), "pack string, problem string")
    return named.join(counted, "pack").join(problems, "pack", "left").select("pack", "n", "n_reread", "problem")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 4 WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 1 WHEN l_linestatus = 'F' THEN 7 ELSE 4 END AS grade, l_comment IS NULL AS bare FROM (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, CAST(NULL AS VARCHAR) AS l_comment FROM lineitem)")
def bundle_migrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of a pack recoded into one grade by a migration to a new release, read from there."""
    root = f"{shared_folder(spark)}/bundle-{uuid.uuid4().hex}"
    bundles.commit_bundle(root, "v2", {"lines": table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"), "regions": table(spark, sf_dir, "region")})
    flag, done = F.col("l_returnflag"), F.col("l_linestatus") == "F"
    grade = F.when(flag == "N", 4).when(done & (flag == "A"), 1).when(done, 7).otherwise(4)
    bundles.migrate_bundle(spark, root, "v2", "v3", {"lines": lambda df: bundles.recoded(df, {"grade": grade, "bare": F.lit(True)}, drop=["l_returnflag", "l_linestatus"])})
    return bundles.open_bundle(spark, root, "v3")["lines"]


@query("""WITH p AS (SELECT o_custkey AS c, CASE WHEN o_orderkey % 97 = 0 THEN 'odd' ELSE o_orderpriority END AS t, min(sha256(o_orderpriority || o_custkey)) AS h, count(*) AS n FROM orders WHERE o_custkey % 6 <> 3 GROUP BY ALL),
q AS (SELECT c, bool_or(t = 'odd') AS odd, bool_or(n > 1) AS twice, sha256('[' || string_agg('["' || t || '","' || h || '"]', ',' ORDER BY t) || ']') AS canonical_hash, count(*) AS n_packs FROM p GROUP BY c),
i AS (SELECT o_custkey AS c, count(*) AS n_inputs FROM orders GROUP BY c),
j AS (SELECT c_custkey AS release_id, CASE WHEN c_custkey % 5 = 0 THEN 'not_admitted' WHEN q.c IS NULL THEN 'no_pack' WHEN odd THEN 'unknown_pack' WHEN twice THEN 'pack_twice' WHEN c_custkey % 7 = 0 THEN 'watermark' END AS refusal, canonical_hash, n_inputs FROM customer LEFT JOIN q ON q.c = c_custkey LEFT JOIN i ON i.c = c_custkey)
SELECT release_id, refusal, CASE WHEN refusal IS NULL THEN canonical_hash END AS canonical_hash, CASE WHEN refusal IS NULL THEN n_inputs END AS n_inputs FROM j""")
def release_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A release for each customer: packs are its orders by priority, inputs all its orders."""
    k, orders = F.col("c_custkey"), table(spark, sf_dir, "orders")
    releases = table(spark, sf_dir, "customer").select(k.alias("release_id"), (k % 5 != 0).alias("admitted"), F.lit("reader").alias("consumption_level"), F.lit(True).alias("watermark_required"), F.when(k % 7 > 0, F.col("c_name")).alias("watermark_text"), F.array("c_mktsegment").alias("known_defects"))
    packs = orders.where("o_custkey % 6 <> 3").select(F.col("o_custkey").alias("release_id"), F.when(F.col("o_orderkey") % 97 == 0, "odd").otherwise(F.col("o_orderpriority")).alias("pack_type"), F.sha2(F.concat("o_orderpriority", "o_custkey"), 256).alias("sha256"))
    inputs = orders.select(F.col("o_custkey").alias("release_id"), F.col("o_orderkey").alias("artifact_revision_id"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"))
    made = bundles.release_manifests(releases, packs, inputs, ["reader"], ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])
    return made.select("release_id", "refusal", "canonical_hash", "n_inputs")


_ENTRIES = """e AS (SELECT 'b_p' || l_orderkey || '_s' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS span_id, l_linenumber, l_partkey % 3 AS spelled,
  CASE WHEN l_partkey % 31 = 1 THEN 'identity' WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'twice' WHEN l_orderkey % 29 = 2 THEN 'excluded' WHEN l_orderkey % 23 = 3 OR o_orderkey IS NULL THEN 'no_page' WHEN l_partkey % 31 = 4 THEN 'anchor_page' WHEN l_partkey % 31 = 5 THEN 'image' WHEN l_orderkey % 19 = 6 THEN 'frame' WHEN l_partkey % 31 = 7 THEN 'outside' END AS refusal FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey)"""


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as spans on pages of orders, with faults by part or order."""
    key, part, line, orders = F.col("l_orderkey"), F.col("l_partkey") % 31, F.col("l_linenumber").cast("int"), table(spark, sf_dir, "orders")
    page, image = (lambda k: F.concat(F.lit("page_"), k)), (lambda k: F.sha2(k.cast("string"), 256))
    box = lambda x: F.struct(x.cast("double").alias("x"), F.lit(1.0).alias("y"), F.lit(5.0).alias("w"), F.lit(5.0).alias("h"))
    chars = F.array(*(F.struct(F.lit(c).alias("char"), box(F.lit(i)).alias("box")) for i, c in enumerate("ab")))
    anchor = F.struct(page(F.when(part == 4, key + 1).otherwise(key)).alias("page"), image(F.when(part == 5, key + 1).otherwise(key)).alias("image_sha256"), box(F.when(part == 7, 98).otherwise(10)).alias("bbox"), chars.alias("chars"))
    text = F.when(F.col("l_partkey") % 3 == 0, "ab").otherwise("a b")
    spans = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("b_p"), key, F.lit("_s"), F.lpad(line.cast("string"), 2, "0")).alias("span_id"), page(key).alias("page"), F.when(part == 1, line).otherwise(line - 1).alias("line_index"), text.alias("text"), anchor.alias("anchor"))
    k = F.col("o_orderkey")
    pages = orders.where(k % 23 != 3).select(page(k).alias("page"), F.lit(100).alias("width"), F.lit(80).alias("height"), F.when(k % 19 == 6, 99).otherwise(100).alias("asset_width"), F.lit(80).alias("asset_height"), image(k).alias("image_sha256"))
    return bundles.evidence_map(spans, pages, orders.where(k % 29 == 2).select(page(k).alias("page")))


@query(f"WITH {_ENTRIES} SELECT span_id, refusal, CASE WHEN spelled = 0 THEN 'glyph' ELSE 'line_bbox' END AS level FROM e")
def evidence_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(spark, sf_dir).select("span_id", "refusal", "level")


@query(f"WITH {_ENTRIES} SELECT CASE WHEN spelled = 0 THEN 'glyph' ELSE 'line_bbox' END AS level, count(*) AS n, 2 * count(*) AS n_glyphs FROM e WHERE refusal IS NULL GROUP BY 1")
def highlight_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.level_counts(_entries(spark, sf_dir))


@query("SELECT c AS char, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE NOT regexp_matches(c, '^[a-zA-Z .]$') AND c <> '' GROUP BY c")
def rare_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters of documents, as those of pages, of which letters, spaces and stops are common."""
    places = F.transform(F.filter(F.split("text", ""), lambda c: c != ""), lambda c, i: F.struct(i.cast("string").alias("id"), c.alias("char"), c.alias("orig_char"), F.lit("ok").alias("status"), (~c.rlike("^[a-zA-Z .]$")).alias("is_rare"), F.lit("other").alias("rare_reason")))
    pages = table(spark, sf_dir, "documents").select(F.lit("b").alias("book"), F.col("doc_id").alias("page"), F.lit(1).alias("width"), F.lit(1).alias("height"), places.alias("chars"))
    return bundles.page_tables(pages)["rare"]


_LAST = "f AS (SELECT event_type AS target, user_id AS actor, arg_max(event_id % 3 > 0, (ts, event_id)) AS is_on FROM events GROUP BY ALL)"


@query(f"WITH {_LAST} SELECT target, CAST(count(*) FILTER (is_on) AS BIGINT) AS n FROM f GROUP BY target")
def reaction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as reactions of users to event types: the last of each pair counts."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("target"), F.col("user_id").alias("actor"), "event_id", "ts", (F.col("event_id") % 3 > 0).alias("is_on"))
    return states.reaction_counts(states.final_reactions(events))


@query("SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 THEN 'created' ELSE 'exists' END AS outcome FROM events")
def created_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(states.derived_id("ntf_", "user_id", "event_type").alias("id"), "event_id", "ts")
    return states.created_once(events).select("event_id", "outcome")


@query("""WITH s AS (SELECT user_id, event_id % 7 AS step, arg_max(CASE WHEN event_id % 11 = 0 THEN 'failed' WHEN event_id % 5 = 0 THEN 'running' ELSE 'succeeded' END, (ts, event_id)) AS status FROM events GROUP BY ALL)
SELECT user_id AS run_id, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_and(status = 'succeeded') THEN 'succeeded' ELSE 'running' END AS status, count(*) AS n_steps FROM s GROUP BY user_id""")
def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    status = F.when(e % 11 == 0, "failed").when(e % 5 == 0, "running").otherwise("succeeded")
    return states.run_results(table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), (e % 7).alias("step_id"), status.alias("status"), "ts"))
