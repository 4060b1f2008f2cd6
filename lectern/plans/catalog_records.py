"""Queries of record operators: ledger descriptions, filters, joins of evidence, resolution and merge, gates, layout, products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import graph, layout, products, records, resolution, search, validators
from lectern.plans.catalog import query, table


def _c(name: str, alias: str):
    return F.col(name).alias(alias)


# Ledger: customers as artifacts, orders as revisions and steps, nations as packages' stages.


def _ledger(spark: SparkSession, sf_dir: str):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    artifacts = customer.select(_c("c_custkey", "artifact_id"), _c("c_mktsegment", "artifact_type"))
    revisions = orders.select(_c("o_orderkey", "artifact_revision_id"), _c("o_custkey", "artifact_id"), (F.col("o_orderkey") * 2).alias("step_run_id"))
    packages = customer.where("c_acctbal > 5000").select(_c("c_custkey", "artifact_id"), (F.col("c_custkey") + 1000000).alias("stage_package_id"), _c("c_nationkey", "stage"))
    steps = orders.select((F.col("o_orderkey") * 2).alias("step_run_id"), (F.col("o_custkey") % 100).alias("processing_run_id"), _c("o_orderpriority", "stage"), _c("o_orderstatus", "status"))
    return artifacts, revisions, packages, steps


@query("SELECT o_orderkey AS artifact_revision_id, c_mktsegment AS artifact_type, CASE WHEN c_acctbal > 5000 THEN c_custkey + 1000000 END AS stage_package_id FROM orders JOIN customer ON c_custkey = o_custkey")
def described_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    artifacts, revisions, packages, _ = _ledger(spark, sf_dir)
    return records.described_revisions(revisions, artifacts, packages).select("artifact_revision_id", "artifact_type", "stage_package_id")


@query("SELECT c_custkey + 1000000 AS stage_package_id, o_orderkey AS artifact_revision_id, o_orderstatus AS step_status FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 5000")
def package_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, revisions, packages, steps = _ledger(spark, sf_dir)
    return records.package_lineage(packages, revisions, steps).select("stage_package_id", "artifact_revision_id", "step_status")


@query("SELECT o_orderkey AS checkpoint_id, o_custkey % 100 AS processing_run_id FROM orders WHERE o_orderkey % 3 = 0 AND o_orderstatus = 'F'")
def checkpoint_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _ledger(spark, sf_dir)[3]
    checkpoints = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(_c("o_orderkey", "checkpoint_id"), (F.col("o_orderkey") * 2).alias("step_run_id"))
    return records.stage_checkpoints(checkpoints, steps, "F").select("checkpoint_id", "processing_run_id")


@query("SELECT o_orderkey * 2 AS step_run_id FROM orders WHERE o_custkey % 100 % 7 = 3")
def steps_of_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _ledger(spark, sf_dir)[3]
    runs = spark.range(100).select(_c("id", "processing_run_id"), (F.col("id") % 7).cast("string").alias("edition_part_id"))
    return records.steps_of_part(steps, runs, "3").select("step_run_id")


@query("SELECT l_orderkey, l_linenumber, s_name, p_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey WHERE l_quantity > 45")
def bridge_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_orderkey", "l_linenumber", _c("l_suppkey", "s_suppkey"), _c("l_partkey", "p_partkey"))
    return records.bridged(links, table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part"), "s_suppkey", "p_partkey").select("l_orderkey", "l_linenumber", "s_name", "p_name")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def optional_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    found = records.filtered(orders, {"o_orderstatus": "F", "o_custkey": None}, {"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderkey": None})
    return found.select("o_orderkey").unionByName(records.filtered(orders, among={"o_orderkey": []}).select("o_orderkey"))


@query("SELECT p_partkey FROM part WHERE (contains(lower(p_name), 'an') OR contains(lower(p_type), 'an')) AND p_size = 7 AND p_retailprice > 1000")
def faceted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").withColumn("is_active", F.col("p_retailprice") > 1000)
    return records.faceted(parts, "AN", ["p_name", "p_type"], "is_active", p_size=7, p_brand=None).select("p_partkey")


@query("SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS window FROM conversations WHERE length(text) >= 12")
def window_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.windows_to_ask(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text").select("conv_id", "turn", "window")


@query(r"SELECT p_partkey, CASE WHEN regexp_matches(p_name, '[0-9]{3,}') THEN 'coded' WHEN regexp_matches(p_type, '^[A-Z ]+$') THEN 'plain' ELSE 'other' END AS kind FROM part WHERE p_partkey NOT IN (SELECT CAST(floor(p_partkey / 2) AS BIGINT) FROM part)")
def leaf_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of a binary tree that have no children, with a type by pattern."""
    nodes = table(spark, sf_dir, "part").withColumn("parent", F.floor(F.col("p_partkey") / 2))
    kind = records.text_type(F.col("p_name"), [("coded", "[0-9]{3,}")], "")
    kind = F.when(kind != "", kind).otherwise(records.text_type(F.col("p_type"), [("plain", "^[A-Z ]+$")], "other"))
    return records.leaf_nodes(nodes, "p_partkey", "parent").select("p_partkey", kind.alias("kind"))


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS positions FROM events GROUP BY 1 HAVING count(*) >= 3")
def position_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.position_list(table(spark, sf_dir, "events"), "user_id", "event_id", 3)


_GLYPHS = "SELECT l_orderkey % 50 AS page, l_discount > 0.08 AS is_rare, CASE WHEN l_tax > 0.04 THEN 'low_conf' ELSE 'not_common' END AS rare_reason, CASE l_returnflag WHEN 'R' THEN 'corrected' WHEN 'A' THEN 'unrecognized' ELSE CASE WHEN l_linestatus = 'F' THEN 'verified' ELSE 'pending' END END AS status, CASE WHEN l_linenumber = 7 THEN '' ELSE l_linestatus END AS char, CASE WHEN l_quantity > 45 THEN 'x' END AS mapping FROM lineitem"


@query(f"WITH g AS ({_GLYPHS}) SELECT page, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (is_rare) AS BIGINT) AS rare, CAST(count(*) FILTER (is_rare AND rare_reason = 'low_conf') AS BIGINT) AS low_conf, CAST(count(*) FILTER (is_rare AND rare_reason <> 'low_conf') AS BIGINT) AS not_common, CAST(count(*) FILTER (status = 'unrecognized' OR char = '') AS BIGINT) AS unrecognized, CAST(count(*) FILTER (status = 'corrected') AS BIGINT) AS corrected, CAST(count(*) FILTER (mapping IS NOT NULL) AS BIGINT) AS mapped, CAST(count(*) FILTER (status = 'pending') AS BIGINT) AS pending, CAST(count(*) FILTER (status = 'verified') AS BIGINT) AS verified FROM g GROUP BY ROLLUP (page)")
def page_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    status = F.when(F.col("l_returnflag") == "R", "corrected").when(F.col("l_returnflag") == "A", "unrecognized").when(F.col("l_linestatus") == "F", "verified").otherwise("pending")
    glyphs = line.select((F.col("l_orderkey") % 50).alias("page"), (F.col("l_discount") > 0.08).alias("is_rare"), F.when(F.col("l_tax") > 0.04, "low_conf").otherwise("not_common").alias("rare_reason"), status.alias("status"), F.when(F.col("l_linenumber") == 7, "").otherwise(F.col("l_linestatus")).alias("char"), F.when(F.col("l_quantity") > 45, "x").alias("mapping"))
    return records.page_quality(glyphs)


@query("WITH l AS (SELECT o_custkey AS page, (o_orderkey % 10) / 10.0 AS conf, CASE WHEN o_orderkey % 4 = 0 THEN 'x' ELSE o_orderpriority END AS text, o_orderkey % 13 AS w, 10 AS h FROM orders), s AS (SELECT page, count(*) AS n, list_filter([CASE WHEN avg((conf < 0.6)::INT) > 0.20 THEN 'low_conf_lines' END, CASE WHEN avg((length(trim(text)) <= 1)::INT) > 0.15 THEN 'many_single_char_boxes' END, CASE WHEN avg((w >= h)::INT) > 0.07 THEN 'mixed_orientation' END, CASE WHEN sum(CAST(conf AS DECIMAL(38, 12))) < 0.80 * count(*) THEN 'low_mean_conf' END], lambda x: x IS NOT NULL) AS signals FROM l GROUP BY page) SELECT page, CAST(n AS BIGINT) AS n, signals FROM s WHERE len(signals) >= 2")
def layout_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "orders").select(_c("o_custkey", "page"), ((F.col("o_orderkey") % 10) / 10.0).alias("conf"), F.when(F.col("o_orderkey") % 4 == 0, "x").otherwise(F.col("o_orderpriority")).alias("text"), (F.col("o_orderkey") % 13).alias("w"), F.lit(10).alias("h"))
    return records.layout_verdict(lines).select("page", "n", "signals")


@query("SELECT o_orderpriority AS stage, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS done, CAST(count(*) FILTER (o_orderstatus <> 'F') AS BIGINT) AS open FROM orders GROUP BY 1")
def stage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = table(spark, sf_dir, "orders").select(_c("o_orderpriority", "stage"), "o_orderkey", "o_orderstatus")
    return records.stage_gaps(planned, planned.where("o_orderstatus = 'F'"), "stage", "o_orderkey").select("stage", "total", "done", F.size("missing").cast("long").alias("open"))


@query("SELECT user_id, CAST(a AS BIGINT) AS n_a, CAST(b AS BIGINT) AS n_b, CASE WHEN a = 0 OR b = 0 THEN 'missing_lane' WHEN abs(a - b) >= 4 THEN 'far_apart' END AS flag FROM (SELECT user_id, count(*) FILTER (event_type = 'view') AS a, count(*) FILTER (event_type = 'click') AS b FROM events GROUP BY 1) WHERE a > 0 OR b > 0")
def lane_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return records.lane_counts(events.where("event_type = 'view'"), events.where("event_type = 'click'"), "user_id").select("user_id", "n_a", "n_b", "flag")


@query("SELECT user_id, round_even(bad / n, 4) AS ratio, round_even(bad / n, 4) >= 0.30 OR user_id % 5 >= 3 AS warn FROM (SELECT user_id, count(*) AS n, count(*) FILTER (value < 20) AS bad FROM events GROUP BY 1)")
def invalidated_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") < 20).alias("bad"))
    return counts.select("user_id", records.invalidated_ratio(F.col("n"), F.col("bad"), F.col("user_id") % 5).alias("r")).select("user_id", "r.ratio", "r.warn")


@query("SELECT o_custkey, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'refused' WHEN bool_and(o_orderstatus = 'F') THEN 'release' ELSE 'dev' END AS level FROM orders GROUP BY 1")
def release_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "P", "deprecated").when(F.col("o_orderstatus") == "F", "expert_reviewed").otherwise("machine")
    return records.release_level(table(spark, sf_dir, "orders").withColumn("status", status), "o_custkey", "status")


@query("SELECT o_custkey, count(*) = 4 AND bool_and(o_totalprice > 1000) AS complete FROM orders GROUP BY 1")
def edition_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.completeness(table(spark, sf_dir, "orders").withColumn("passed", F.col("o_totalprice") > 1000), "o_custkey", "passed", 4)


@query("WITH l AS (SELECT o_custkey, o_orderpriority, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS v FROM orders GROUP BY 1, 2) SELECT o_custkey, CASE WHEN bool_or(v = 'P') THEN 'P' WHEN bool_or(v = 'F') THEN 'F' ELSE 'draft' END AS maturity FROM l GROUP BY 1")
def content_maturity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.maturity(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_orderstatus", ["o_orderdate", "o_orderkey"], ["P", "F"], "draft")


@query("SELECT conv_id, list(turn ORDER BY turn) AS spans FROM conversations WHERE role = 'user' GROUP BY 1 UNION ALL SELECT DISTINCT conv_id, []::BIGINT[] FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'user')")
def reverse_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found = records.reverse_index(turns, turns.where("role = 'user'").withColumn("t", F.col("turn").cast("string")), "conv_id", "t", "turn")
    return found.select("conv_id", F.transform("spans", lambda s: s.cast("long")).alias("spans"))


@query("SELECT event_id, ts FROM (SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 40) ORDER BY ts, event_id")
def tail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.last_rows(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 40)


@query("SELECT conv_id, turn, coalesce(right(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), 20), '') AS before FROM conversations")
def previous_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.previous_tail(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", 20).select("conv_id", "turn", "before")


_STAGE = "SELECT conv_id, turn, length(text) % 3 = 0 AS started, length(text) % 5 <> 0 AS passed FROM conversations"


@query(f"SELECT conv_id, turn, CASE WHEN passed THEN 'done' WHEN NOT coalesce(bool_and(passed) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 'blocked' WHEN started THEN 'running' ELSE 'not_started' END AS state FROM ({_STAGE})")
def stage_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumns({"started": F.length("text") % 3 == 0, "passed": F.length("text") % 5 != 0})
    return records.stage_states(rows, "conv_id", "turn", "started", "passed").select("conv_id", "turn", "state")


@query(f"SELECT conv_id, min(turn) AS turn FROM ({_STAGE}) WHERE NOT passed GROUP BY 1")
def first_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.first_failing(table(spark, sf_dir, "conversations").withColumn("passed", F.length("text") % 5 != 0), "conv_id", "turn", "passed")


@query("SELECT event_id, row_number() OVER (ORDER BY list_position(['view', 'click', 'purchase', 'signup'], event_type), ts, event_id) AS number FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup')")
def numbered_across(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ["view", "click", "purchase", "signup"]
    return records.numbered(table(spark, sf_dir, "events").where(F.col("event_type").isin(*kinds)), kinds, "event_type", ["ts", "event_id"]).select("event_id", "number")


@query("WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey - 1 END AS sup FROM orders), p AS (SELECT o_orderkey FROM (SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem GROUP BY 1) WHERE n = 1) SELECT o_orderkey FROM r WHERE o_orderkey NOT IN (SELECT sup FROM r WHERE sup IS NOT NULL AND o_orderkey IN (SELECT o_orderkey FROM p))")
def effective_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderkey") - 1).alias("sup"))
    return records.effective_runs(runs, table(spark, sf_dir, "lineitem").select(_c("l_orderkey", "o_orderkey")), "o_orderkey", "sup").select("o_orderkey")


@query("SELECT o_custkey, o_orderdate, last_event FROM (SELECT o_custkey, min(o_orderdate) AS o_orderdate, max(o_orderdate) AS last_event FROM orders GROUP BY 1) WHERE last_event > o_orderdate")
def stale_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    return records.stale_checkpoints(orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("o_orderdate")), orders, "o_custkey", "o_orderdate")


@query("SELECT doc_id, 'unaccounted' AS problem FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND lang <> 'de' UNION ALL SELECT doc_id, 'covered_and_excluded' FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) AND lang = 'de' UNION ALL SELECT doc_id, 'not_in_manifest' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def page_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return records.same_pages(table(spark, sf_dir, "labels"), docs.where("lang = 'de'"), docs, "doc_id")


@query("SELECT o_orderkey, 'in_no_batch' AS problem FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT l_orderkey, 'in_several' FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def batch_bijection(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = table(spark, sf_dir, "lineitem").select("l_linenumber", F.array("l_orderkey").alias("items"))
    return records.bijection_problems(table(spark, sf_dir, "orders"), batches, "o_orderkey", "items")


# Resolution and merge.


@query("SELECT o_custkey AS source_id, CASE WHEN max(o_orderstatus) = 'P' THEN 'new' WHEN count(*) FILTER (o_orderkey % 2 = 0) = 0 THEN 'replacement' WHEN count(*) FILTER (o_orderkey % 2 = 1) = 0 THEN 'extension' ELSE 'refused' END AS mode FROM orders GROUP BY 1")
def view_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view has all of a customer's orders, the base those with odd keys; even ones only are made to share nothing."""
    orders = table(spark, sf_dir, "orders")
    views = orders.groupBy(_c("o_custkey", "source_id")).agg(F.collect_set("o_orderkey").alias("parts"), F.max("o_orderstatus").alias("s"))
    odd = F.filter("parts", lambda p: p % 2 == 1)
    base = views.where("s <> 'P'").select("source_id", F.when(F.size(odd) > 0, odd).otherwise(F.array(F.lit(-1).cast("long"))).alias("parts"))
    return resolution.view_modes(views.select("source_id", "parts"), base)


_MATRIX = """WITH c AS (SELECT c_custkey AS k, c_custkey % 3 = 0 AS has_id, c_custkey % 30 = 0 AS bound, c_custkey % 60 = 0 AS same, c_custkey % 7 AS n, c_custkey % 5 AS r, c_custkey % 4 = 1 AS p, c_custkey % 8 = 1 AS w FROM customer),
h AS (SELECT *, CASE WHEN n < 4 THEN 0 WHEN n < 6 THEN 1 ELSE 2 END AS names, CASE WHEN r < 3 THEN 0 WHEN r < 4 THEN 1 ELSE 2 END AS rules FROM c)"""


@query(_MATRIX + """ SELECT k AS c_custkey, CASE WHEN bound AND same THEN 'R01' WHEN bound THEN 'R01b' WHEN has_id AND names = 0 AND rules = 0 THEN 'R02' WHEN names > 1 OR rules > 1 THEN 'R03d' WHEN NOT has_id AND names = 1 AND rules = 1 THEN 'R03a'
WHEN names = 1 AND (has_id OR rules = 0) THEN 'R03b' WHEN rules = 1 AND names = 0 THEN 'R03c' WHEN p AND w THEN 'R03f' WHEN p THEN 'R03g' ELSE 'R03e' END AS rule FROM h""")
def hit_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every branch of the hit matrix."""
    k = F.col("c_custkey")
    ids = lambda x, one, two: F.when(x < one, F.array().cast("array<string>")).when(x < two, F.array(F.lit("pat_1"))).otherwise(F.array(F.lit("pat_1"), F.lit("pat_2")))
    partners = F.when(k % 4 == 1, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    rule = resolution.hit_rule(k % 3 == 0, k % 30 == 0, k % 60 == 0, ids(k % 7, 4, 6), ids(k % 5, 3, 4), partners, k % 8 == 1)
    return table(spark, sf_dir, "customer").select("c_custkey", rule["rule"].alias("rule"))


@query("SELECT s_suppkey, list_sort(list_distinct(list(c_custkey))) AS hits FROM supplier JOIN customer ON (substr(s_name, -3) = substr(c_name, -3) OR CAST(s_suppkey % 97 AS VARCHAR) = CAST(c_custkey AS VARCHAR)) AND s_suppkey <> c_custkey GROUP BY 1")
def candidate_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers against customers by two keys, without the pairs that are declared distinct."""
    left = table(spark, sf_dir, "supplier").select("s_suppkey", F.array(F.concat(F.lit("n"), F.substring("s_name", -3, 3)), F.concat(F.lit("k"), F.col("s_suppkey") % 97)).alias("keys"))
    right = table(spark, sf_dir, "customer").select("c_custkey", F.array(F.concat(F.lit("n"), F.substring("c_name", -3, 3)), F.concat(F.lit("k"), F.col("c_custkey")), F.lit(None)).alias("keys"))
    distinct = left.select("s_suppkey", _c("s_suppkey", "c_custkey"))
    return resolution.candidate_hits(left, right, "s_suppkey", "c_custkey", "keys", "hits", distinct).where("size(hits) > 0")


@query("SELECT a.s_suppkey, list_sort(list_distinct(list(b.s_suppkey))) AS partners FROM supplier a JOIN supplier b ON (a.s_suppkey % 40 = b.s_suppkey % 40 OR a.s_nationkey = b.s_nationkey AND a.s_suppkey % 4 = b.s_suppkey % 4) AND a.s_suppkey <> b.s_suppkey GROUP BY 1")
def batch_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = F.array(F.concat(F.lit("m"), F.col("s_suppkey") % 40), F.concat_ws("/", F.lit("n"), "s_nationkey", F.col("s_suppkey") % 4))
    return resolution.batch_partners(table(spark, sf_dir, "supplier").select("s_suppkey", keys.alias("keys")), "s_suppkey", "keys")


@query("SELECT c_nationkey, list_sort(list_distinct(list(c_mktsegment))) AS surfaces, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY 1")
def concept_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.concept_groups(table(spark, sf_dir, "customer").withColumn("aliases", F.array("c_mktsegment")), "c_nationkey", "c_mktsegment", "aliases").select("c_nationkey", "surfaces", "n")


_UNITS = "SELECT 'w' || (o_orderkey % 40) AS work_key, o_orderkey // 40 AS ck, 's' || ((o_orderkey // 40 + {0}) % 5) AS source_id, o_orderkey % {1} <> 0 AS present, CASE WHEN o_orderkey % {2} <> 0 THEN '{3}' || o_orderkey END AS aid, CASE WHEN o_orderkey % {4} <> 0 THEN 'e' || (o_custkey % {5}) END AS subj, md5(CAST(o_custkey % {6} AS VARCHAR)) AS sha FROM orders"


@query(f"""WITH n AS ({_UNITS.format(0, 5, 7, 'a', 11, 10, 3)}), o AS ({_UNITS.format(1, 6, 13, 'b', 17, 5, 2)}), j AS (
SELECT n.work_key, n.ck, n.aid AS from_id, o.aid AS to_id, CASE WHEN (n.present AND n.aid IS NULL) OR (o.present AND o.aid IS NULL) THEN NULL WHEN n.present AND NOT o.present THEN 'addition' WHEN NOT n.present AND o.present THEN 'omission' WHEN NOT n.present THEN NULL WHEN NOT coalesce(n.subj = o.subj, false) THEN 'conflict' WHEN n.sha = o.sha THEN 'alignment' ELSE 'variant_reading' END AS relation,
CASE WHEN (n.present AND n.aid IS NULL) OR (o.present AND o.aid IS NULL) THEN 'declared_without_assertion' END AS reason FROM n JOIN o ON n.work_key = o.work_key AND n.ck = o.ck AND n.source_id <> o.source_id)
SELECT * FROM j WHERE relation IS NOT NULL OR reason IS NOT NULL""")
def collation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of a new version against those of another source, with every outcome."""
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")

    def units(shift, present, assertion, prefix, subject, m, sha):
        return orders.select(
            F.concat(F.lit("w"), k % 40).alias("work_key"), F.expr("o_orderkey div 40").alias("collation_key"), F.concat(F.lit("s"), F.expr(f"(o_orderkey div 40 + {shift}) % 5")).alias("source_id"), (k % present != 0).alias("present"),
            F.when(k % assertion != 0, F.concat(F.lit(prefix), k)).alias("assertion_id"), F.when(k % subject != 0, F.concat(F.lit("e"), F.col("o_custkey") % m)).alias("subject_id"), F.md5((F.col("o_custkey") % sha).cast("string")).alias("text_sha256"),
        )

    found = resolution.collation(units(0, 5, 7, "a", 11, 10, 3), units(1, 6, 13, "b", 17, 5, 2))
    return found.select("work_key", _c("collation_key", "ck"), "from_id", "to_id", "relation", "reason")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN o_orderstatus END AS decision, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN 'decided' WHEN o_orderkey % 3 = 0 THEN 'stale' WHEN o_orderkey % 5 = 0 THEN 'auto' ELSE 'open' END AS state FROM orders")
def carried_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    proposals = orders.select("o_orderkey", F.md5(k.cast("string")).alias("basis"), F.when(k % 5 == 0, "auto").otherwise("human").alias("resolution"))
    decisions = orders.where("o_orderkey % 3 = 0").select("o_orderkey", F.when(k % 2 == 0, F.md5(k.cast("string"))).otherwise("old").alias("basis"), _c("o_orderstatus", "choice"))
    return resolution.decided(proposals, decisions, "o_orderkey", "basis").select("o_orderkey", "decision", "state")


@query("SELECT o_orderkey, o_custkey AS source_id, 'base' AS version FROM orders WHERE o_custkey % 4 NOT IN (0, 1) OR o_custkey % 4 = 2 UNION ALL SELECT o_orderkey, o_custkey, 'view' FROM orders WHERE o_custkey % 4 IN (0, 1)")
def merged_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources by rest of four: 0 is replaced, 1 new, 2 an extension that is refused, 3 not in the view."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", _c("o_custkey", "source_id"))
    base, view = orders.where("source_id % 4 <> 1").withColumn("version", F.lit("base")), orders.where("source_id % 4 < 3").withColumn("version", F.lit("view"))
    rest = F.col("source_id") % 4
    modes = view.select("source_id").distinct().withColumn("mode", F.when(rest == 0, "replacement").when(rest == 1, "new").otherwise("extension"))
    return resolution.merge_editions(base, view, modes)[0]


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 1 THEN 'missing' WHEN o_orderkey % 4 = 2 THEN 'allocation_differs' WHEN o_orderkey % 4 = 3 THEN 'referenced' END AS refusal FROM orders")
def split_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, k = table(spark, sf_dir, "orders").select(_c("o_orderkey", "id")), F.col("id")
    span = lambda n: F.concat(F.lit(n), k)
    items = orders.where("id % 4 <> 1").withColumn("spans", F.array(span("a"), span("b")))
    splits = orders.select("id", F.explode(F.array(F.struct(F.lit("p1").alias("placeholder"), F.array(span("a")).alias("spans")), F.struct(F.lit("p2").alias("placeholder"), F.array(F.when(k % 4 == 2, span("c")).otherwise(span("b"))).alias("spans")))).alias("s")).select("id", "s.*")
    return resolution.split_checks(items, splits, orders.where("id % 4 = 3").select(_c("id", "target")), "id", "spans")


@query("WITH m AS (SELECT c_custkey AS a, c_custkey + 1 AS b FROM customer WHERE c_custkey % 2 = 1) SELECT a AS survivor, b AS retired, CASE WHEN a % 50 = 1 THEN 'missing' WHEN a % 20 = 1 THEN 'other_kind' WHEN a % 30 = 1 THEN 'referenced' END AS refusal FROM m")
def merge_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer").select(_c("c_custkey", "k"))
    merges = keys.where("k % 2 = 1").select((F.col("k") + 1).alias("a"), _c("k", "b"))
    ids = merges.select(_c("b", "id"), F.lit("x").alias("kind"), _c("b", "of")).unionByName(merges.where("b % 50 <> 1").select(_c("a", "id"), F.when(F.col("b") % 20 == 1, "y").otherwise("x").alias("kind"), _c("b", "of")))
    relations = merges.where("b % 30 = 1").select(_c("a", "from_id"), (F.col("a") + 5).alias("to_id")).unionByName(merges.select(_c("a", "from_id"), _c("b", "to_id")))
    return resolution.merge_checks(ids, merges, merges.limit(0).select(_c("a", "target")), relations, "id", "kind")


@query("SELECT o_orderkey AS k, lane, item FROM (SELECT o_orderkey, unnest(CASE o_orderkey % 5 WHEN 0 THEN [{'lane': 'a', 'item': o_orderstatus}] WHEN 1 THEN [{'lane': 'b', 'item': o_orderpriority}] WHEN 2 THEN [{'lane': 'a', 'item': o_orderstatus}, {'lane': 'b', 'item': o_orderpriority}] WHEN 4 THEN [{'lane': 'open', 'item': NULL}] END, recursive := true) FROM orders WHERE o_orderkey % 5 <> 3)")
def applied_rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(_c("o_orderkey", "k"), "o_orderstatus", "o_orderpriority")
    rest = F.col("k") % 5
    rulings = orders.where("k % 5 < 4").select("k", F.when(rest == 0, "a").when(rest == 1, "b").when(rest == 2, "both").otherwise("neither").alias("choice"))
    return resolution.ruled(orders, rulings, "k", "o_orderstatus", "o_orderpriority")


@query("WITH i AS (SELECT l_orderkey, l_partkey, l_linenumber AS n FROM lineitem), a AS (SELECT l_orderkey AS s, count(*) AS n FROM i WHERE n % 2 = 1 GROUP BY 1), b AS (SELECT l_orderkey AS s, count(*) AS n FROM i WHERE n % 2 = 0 GROUP BY 1) SELECT CASE WHEN coalesce(a.n, 0) = coalesce(b.n, 0) THEN 'paired' WHEN b.n IS NULL THEN 'a_only' WHEN a.n IS NULL THEN 'b_only' ELSE 'split_merge' END AS status, CAST(sum(CASE WHEN coalesce(a.n, 0) = coalesce(b.n, 0) THEN a.n ELSE coalesce(a.n, 0) + coalesce(b.n, 0) END) AS BIGINT) AS n FROM a FULL JOIN b USING (s) GROUP BY 1")
def compared_drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drafts over the same evidence: as many rows of each status as the numbers of either side ask for."""
    items = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.array(F.col("l_orderkey").cast("string")).alias("spans"), F.col("l_partkey").cast("string").alias("body"), "l_linenumber")
    found = resolution.compared_drafts(items.where("l_linenumber % 2 = 1"), items.where("l_linenumber % 2 = 0"), "id", "spans", "body")
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IS NOT NULL AND false")
def closure_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the nations that edges reach from a region lie in the closure: none is outside."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    edges = customer.select(F.concat(F.lit("n"), "c_nationkey").alias("src"), F.concat(F.lit("c"), "c_custkey").alias("dst")).unionByName(nation.select(F.concat(F.lit("r"), "n_regionkey").alias("src"), F.concat(F.lit("n"), "n_nationkey").alias("dst")))
    reached = graph.reachable(edges, nation.select(F.concat(F.lit("r"), "n_regionkey").alias("node")))
    will = customer.select(F.concat(F.lit("c"), "c_custkey").alias("node"))
    return resolution.outside_closure(will, reached, "node").select(F.substring("node", 2, 20).cast("long").alias("c_custkey"), F.lit(None).cast("int").alias("c_nationkey"))


@query("WITH g AS (SELECT 'c' || c_custkey AS node, 'n' || c_nationkey AS n FROM customer), m AS (SELECT n, min(node) AS component FROM g GROUP BY n) SELECT node, component FROM g JOIN m USING (n) UNION SELECT n, component FROM m")
def edge_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("src"), F.concat(F.lit("n"), "c_nationkey").alias("dst"))
    return graph.components(edges)


# Gates with planted faults.


@query("""WITH t AS (SELECT conv_id || '-' || turn AS k, (conv_id + turn) % 4 AS m, coalesce(text, '') AS text FROM conversations)
SELECT 'SEG_001' AS "check", k AS subject FROM t WHERE m = 0 UNION ALL SELECT 'SEG_003', k || '/1' FROM t WHERE m = 1 UNION ALL SELECT 'SEG_004', k || '/s01' FROM t WHERE m = 2
UNION ALL SELECT 'SEG_005', k || '/' || CASE WHEN m = 1 THEN 'x' ELSE 's01' END FROM t WHERE length(regexp_replace(text, '\\s+', '', 'g')) + CASE WHEN m = 0 THEN 1 ELSE 0 END > 300
UNION ALL SELECT 'SEG_007', k || '/' || CASE WHEN m = 1 THEN 'x' ELSE 's01' END FROM t WHERE regexp_matches(text, '[()\\[\\]]')""")
def segment_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as texts of one segment: a longer one, a wrong id, no note, and what is long or has brackets by itself."""
    turns = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("k"), ((F.col("conv_id") + F.col("turn")) % 4).alias("m"), F.coalesce("text", F.lit("")).alias("text"))
    rest = F.col("m")
    segments = turns.select("k", F.lit(0).alias("seq"), F.when(rest == 1, "x").otherwise("s01").alias("seg_id"), F.when(rest == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text"), F.when(rest == 2, "").otherwise("note").alias("note"))
    return validators.segment_checks(segments, turns, "k").select("check", "subject")


_BAD = "SELECT conv_id, turn, conv_id || '-' || turn AS id, length(text) AS n FROM conversations WHERE length(text) > 3"


@query(f"""WITH s AS ({_BAD}) SELECT 'contiguous' AS "check", id AS subject FROM s WHERE turn % 6 = 1 UNION ALL SELECT 'strict_offset', id FROM s WHERE turn % 6 IN (1, 2) UNION ALL SELECT 'quote_hash', id FROM s WHERE turn % 6 IN (2, 3) UNION ALL SELECT 'evidence_level', id FROM s WHERE turn % 6 = 4 UNION ALL SELECT 'header_counts', id FROM s WHERE turn % 6 = 5""")
def offset_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans that cover a turn each, spoilt in five ways."""
    turns, way = table(spark, sf_dir, "conversations").where("length(text) > 3").withColumn("doc", F.concat_ws("-", "conv_id", "turn")), F.col("turn") % 6
    made = turns.select("doc", _c("doc", "span_id"), F.when(way == 1, 1).otherwise(0).alias("start_offset"), F.length("text").alias("end_offset"), F.when(way == 2, F.upper(F.concat("text", F.lit("x")))).otherwise(F.col("text")).alias("text"), F.when(way == 3, "0").otherwise(F.sha2("text", 256)).alias("quote_sha256"), F.when(way == 4, "none").otherwise("text").alias("evidence_level"))
    told = turns.select("doc", F.when(way == 5, 2).otherwise(1).alias("n"))
    return validators.offset_gate(made, turns.select("doc", "text"), "doc", "text", told).select("check", "subject")


@query("""SELECT 'evidence_required' AS "check", CAST(o_orderkey AS VARCHAR) AS subject FROM orders WHERE o_orderkey % 50 = 1 UNION ALL SELECT 'references', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 50 = 2 UNION ALL SELECT 'strict_quote', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 50 = 3 UNION ALL SELECT 'status_ceiling', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 50 = 4""")
def evidence_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, way = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 50
    assertions = orders.select(_c("o_orderkey", "assertion_id"), F.when(way == 4, "released").otherwise("machine_extracted").alias("status"))
    evidence = orders.where("o_orderkey % 50 <> 1").select(_c("o_orderkey", "assertion_id"), F.when(way == 2, -1).otherwise(F.col("o_custkey")).alias("span_id"), F.when(way == 3, "absent").otherwise("tomer").alias("quote"))
    found = validators.evidence_gate(assertions, evidence, table(spark, sf_dir, "customer").select(_c("c_custkey", "span_id"), F.concat(F.lit("Customer "), "c_name").alias("text")), ["machine_extracted"])
    return found.select("check", "subject")


@query("""SELECT 'COV_001' AS "check", CAST(c_custkey AS VARCHAR) AS subject FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT DISTINCT 'COV_003', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_custkey % 9 = 0""")
def coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select(_c("o_custkey", "c_custkey"))
    return validators.coverage_checks(table(spark, sf_dir, "customer"), keys, keys.where("c_custkey % 9 <> 0"), "c_custkey").select("check", "subject")


@query("""SELECT 'EXT_001' AS "check", CAST(c_custkey AS VARCHAR) AS subject FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) AND c_custkey % 2 = 0 UNION ALL SELECT 'EXT_002', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) AND c_acctbal < 0 UNION ALL SELECT 'EXT_003', 'all'""")
def extraction_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, keys = table(spark, sf_dir, "customer").withColumn("is_case", F.col("c_acctbal") < 0), table(spark, sf_dir, "orders").select(_c("o_custkey", "c_custkey"))
    return validators.extraction_checks(customer, keys, customer.where("c_custkey % 2 = 1"), "c_custkey", 1000.0, "is_case").select("check", "subject")


@query("""SELECT 'CON_003' AS "check", CAST(p_partkey AS VARCHAR) AS subject FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT 'CON_002', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 3 = 1 UNION ALL SELECT 'CON_001', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 3 = 2 AND p_size > 40""")
def concept_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, way = table(spark, sf_dir, "part"), F.col("p_partkey") % 3
    refs = F.when(way == 1, F.array(F.lit(-1).cast("long"))).when((way == 2) & (F.col("p_size") > 40), F.array().cast("array<bigint>")).otherwise(F.array("p_partkey"))
    concepts = part.select("p_partkey", F.when(way == 0, "@@").otherwise(F.col("p_name")).alias("surface"), refs.alias("refs"))
    return validators.surface_checks(concepts, part.select(_c("p_partkey", "span"), "p_name"), "p_partkey", "surface", "refs", "span", "p_name").select("check", "subject")


@query("SELECT o_orderkey, list_filter([CASE WHEN NOT o_totalprice > 1000 THEN 'price' END, CASE WHEN NOT o_orderstatus = 'F' THEN 'status' END], lambda x: x IS NOT NULL) AS unmet, o_totalprice > 1000 AND o_orderstatus = 'F' AS admitted FROM orders")
def level_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validators.admission(table(spark, sf_dir, "orders"), "o_orderkey", [("price", F.col("o_totalprice") > 1000), ("status", F.col("o_orderstatus") == "F")])


@query("""SELECT 'labels' AS "check", 'failed' AS verdict, CAST(count(*) AS BIGINT) AS failures FROM labels WHERE quality = 0 UNION ALL SELECT 'boxes', 'not_applicable', 0 UNION ALL SELECT 'counts', 'passed', 0""")
def publication_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").where("quality = 0").select(F.lit("labels").alias("check"))
    return validators.publication_gate(rows, [("labels", ["text", "image"]), ("boxes", ["image"]), ("counts", ["text"])], "text")


# Products and search.


@query("SELECT o_custkey AS assertion_id, CAST(count(c_custkey) AS BIGINT) AS n_evidence, min(o_orderkey) FILTER (c_custkey IS NOT NULL) AS first_span FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0 GROUP BY 1")
def assertion_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    spans = orders.join(table(spark, sf_dir, "customer").where("c_acctbal > 0").select(_c("c_custkey", "o_custkey"), "c_name"), "o_custkey").select(_c("o_orderkey", "span_id"), _c("c_name", "quote"), F.lit("p").alias("location"))
    found = products.assertion_evidence(orders.select(_c("o_custkey", "assertion_id")).distinct(), orders.select(_c("o_custkey", "assertion_id"), _c("o_orderkey", "span_id"), _c("o_orderstatus", "support_type")), spans)
    return found.select("assertion_id", F.size("evidence").cast("long").alias("n_evidence"), F.get("evidence", F.lit(0))["span_id"].alias("first_span"))


@query("SELECT l_partkey AS concept_id, l_orderkey AS span_id, o_orderstatus AS quote FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 2 = 0")
def concept_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions = table(spark, sf_dir, "lineitem").select(_c("l_partkey", "concept_id"), _c("l_orderkey", "span_id"), F.lit("s").alias("surface"), F.lit("u").alias("unit_id"))
    spans = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(_c("o_orderkey", "span_id"), _c("o_orderstatus", "quote"), F.lit("p").alias("location"))
    return products.concept_hits(mentions, spans).select("concept_id", "span_id", "quote")


@query("SELECT o_orderkey AS assertion_id, CAST(0 AS INTEGER) AS place, CASE WHEN c_nationkey IS NULL THEN 'no_document' END AS broken, CASE WHEN c_acctbal > 0 AND c_nationkey < 20 THEN o_orderstatus END AS quote FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 6 <> 0) ON c_custkey = o_custkey")
def evidence_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders to customers to nations; nations from 20 on and customers in debt are withheld, every sixth customer is missing."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_custkey % 6 <> 0")
    assertions = orders.select(_c("o_orderkey", "assertion_id"), F.array("o_orderkey").alias("span_ids"))
    spans = orders.select(_c("o_orderkey", "span_id"), _c("o_custkey", "doc_key"), _c("o_orderstatus", "quote"))
    documents = customer.select(_c("c_custkey", "doc_key"), F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).otherwise(F.lit(24)).alias("asset_id"))
    assets = table(spark, sf_dir, "nation").select(_c("n_nationkey", "asset_id"), (F.col("n_nationkey") < 20).alias("open"))
    return products.evidence_chain(assertions, spans, documents, assets, F.col("open")).select("assertion_id", "place", "broken", "quote")


@query("WITH o AS (SELECT l_partkey, l_orderkey, min(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END) AS p, arg_min(l_quantity, (CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END, -l_quantity)) AS q FROM lineitem GROUP BY 1, 2) SELECT l_partkey AS concept_id, l_orderkey AS span_id, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY p, q DESC, l_orderkey) AS INTEGER) AS place FROM o) WHERE place <= 3")
def evidence_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = table(spark, sf_dir, "lineitem").select(_c("l_partkey", "concept_id"), _c("l_orderkey", "span_id"), _c("l_returnflag", "status"), _c("l_quantity", "score"))
    return products.evidence_bundle(hits, ["A", "R"], 3).select("concept_id", "span_id", "place")


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'no_citation' WHEN 1 THEN 'not_in_bundle' END AS problem FROM orders WHERE o_orderkey % 3 < 2")
def answer_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.col("o_orderkey") % 3
    answers = table(spark, sf_dir, "orders").select("o_orderkey", F.when(rest == 0, "It is 3.5 m long.").when(rest == 1, "It is so. [9999999999]").otherwise(F.concat(F.lit("It is 3.5 m long. ["), "o_custkey", F.lit("]"))).alias("text"))
    bundle = table(spark, sf_dir, "orders").select(_c("o_custkey", "span_id"))
    return products.answer_check(answers, bundle, "o_orderkey", "text").select("o_orderkey", "problem")


@query("SELECT p_name, CASE WHEN p_partkey % 2 = 0 THEN 'ent_old' || p_partkey ELSE 'ent_' || substr(sha256(CAST(p_partkey AS VARCHAR)), 1, 32) END AS entry_id, p_partkey % 2 = 0 AS carried FROM part")
def carried_entry_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    old = part.where("p_partkey % 2 = 0").select("p_partkey", F.concat(F.lit("ent_old"), "p_partkey").alias("entry_id"))
    return products.carried_entry_ids(part, old, "p_partkey").select("p_name", "entry_id", "carried")


@query("SELECT source, CAST(count(*) AS BIGINT) AS n, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes, sha256(string_agg(sha256(text), chr(10) ORDER BY sha256(text))) AS sha256 FROM documents WHERE text IS NOT NULL GROUP BY 1")
def pack_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.pack_manifest(table(spark, sf_dir, "documents").where("text IS NOT NULL"), "source", "text")


@query("SELECT 'c' || o_custkey AS subject, 'subject' AS track, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1 UNION ALL SELECT 'p' || o_orderpriority, 'concept', CAST(count(*) AS BIGINT) FROM orders GROUP BY 1")
def subjects_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("c"), "o_custkey").alias("subject_id"), F.array(F.concat(F.lit("p"), "o_orderpriority")).alias("refs"))
    return products.subjects_both_ways(rows, "o_orderkey", "subject_id", "refs").select("subject", "track", F.size("items").cast("long").alias("n"))


@query("WITH w AS (SELECT DISTINCT string_split(trim(lower(text)), ' ')[1] AS term FROM conversations WHERE length(trim(text)) > 0), d AS (SELECT doc_id, lower(text) AS low FROM documents) SELECT term, min(doc_id) AS doc_id FROM w JOIN d ON contains(low, term) GROUP BY term")
def first_holder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first words of all turns, wherever documents hold them."""
    terms = table(spark, sf_dir, "conversations").where(F.length(F.trim("text")) > 0).select(F.split(F.trim(F.lower("text")), " ")[0].alias("term")).distinct()
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").alias("order"), "text")
    return products.first_holder(terms, docs, "term", "doc_id", "order", "text")


# Layout.


_BOXES = "SELECT o_orderkey AS line_id, o_orderkey % 1000 AS page, (o_orderkey * 37 % 1000)::DOUBLE AS x, (o_orderkey * 53 % 1000)::DOUBLE AS y, 60.0::DOUBLE AS w, 40.0::DOUBLE AS h FROM orders"


@query(f"WITH l AS ({_BOXES}), g AS (SELECT l_orderkey * 10 + l_linenumber AS glyph_id, l_orderkey % 1000 AS page, (l_partkey % 1000)::DOUBLE AS x, (l_suppkey * 11 % 1000)::DOUBLE AS y, 8.0::DOUBLE AS w, 8.0::DOUBLE AS h FROM lineitem) SELECT DISTINCT l.page, line_id, glyph_id FROM l JOIN g ON l.page = g.page AND g.x >= l.x - 2 AND g.y >= l.y - 2 AND g.x + g.w <= l.x + l.w + 2 AND g.y + g.h <= l.y + l.h + 2")
def glyphs_in_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines and their items as glyphs: every glyph of every line."""
    box = lambda x, y, w, h: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), F.lit(w).alias("w"), F.lit(h).alias("h")).alias("box")
    k = F.col("o_orderkey")
    lines = table(spark, sf_dir, "orders").select(_c("o_orderkey", "line_id"), (k % 1000).alias("page"), box(k * 37 % 1000, k * 53 % 1000, 60.0, 40.0))
    glyphs = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("glyph_id"), (F.col("l_orderkey") % 1000).alias("page"), box(F.col("l_partkey") % 1000, F.col("l_suppkey") * 11 % 1000, 8.0, 8.0))
    return layout.boxed_glyphs(lines, glyphs)


# Rows of one value are in one cluster, whatever their order: gaps are taken between different values.
_CLUSTERS = """v AS (SELECT l_orderkey, l_quantity, coalesce((l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_quantity NULLS FIRST) {} 10)::INT, 0) AS cut FROM (SELECT DISTINCT l_orderkey, l_quantity FROM lineitem) d),
c AS (SELECT l.*, s.cluster FROM lineitem l JOIN (SELECT *, sum(cut) OVER (PARTITION BY l_orderkey ORDER BY l_quantity NULLS FIRST ROWS UNBOUNDED PRECEDING) AS cluster FROM v) s ON s.l_orderkey IS NOT DISTINCT FROM l.l_orderkey AND s.l_quantity IS NOT DISTINCT FROM l.l_quantity)"""


@query(f"WITH {_CLUSTERS.format('>=')} SELECT l_orderkey, l_linenumber, CAST(cluster AS BIGINT) AS cluster FROM c")
def gap_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.gap_groups(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity", 10, "l_linenumber").select("l_orderkey", "l_linenumber", "cluster")


@query(f"WITH {_CLUSTERS.format('>')} SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY cluster DESC, l_extendedprice NULLS FIRST, l_quantity NULLS FIRST, l_linenumber NULLS FIRST) AS INTEGER) AS place FROM c")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.reading_order(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity", "l_extendedprice", "l_linenumber", 10).select("l_orderkey", "l_linenumber", "place")


@query("SELECT l_orderkey, quantile_cont(g, 0.5) AS median_gap FROM (SELECT l_orderkey, l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_quantity) AS g FROM lineitem) WHERE g IS NOT NULL GROUP BY 1")
def median_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.median_gap(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity")


@query("WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity AS pos, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber) AS i FROM lineitem), m AS (SELECT *, (pos + 4 - (60.0 / n) * (i - 0.5)) / (60.0 / n) AS d, 8.0 > 1.6 * 60 / n AS over_, 8.0 < 0.25 * 60 / n AS thin FROM r WHERE n >= 2), b AS (SELECT *, bool_or(over_ OR abs(d) > 0.6) OVER (PARTITION BY l_orderkey) AS bad FROM m) SELECT l_orderkey, l_linenumber, CAST(i AS INTEGER) AS index, CAST(greatest(1, least(n, floor((pos + 4) / (60.0 / n)) + 1)) AS INTEGER) AS slot FROM b WHERE bad")
def slot_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as glyphs of 8 units in an order of 60 units."""
    line = table(spark, sf_dir, "lineitem")
    n = line.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    rows = line.join(n, "l_orderkey").select("l_orderkey", "l_linenumber", F.lit(0.0).alias("start"), F.lit(60.0).alias("size"), _c("l_quantity", "at"), F.lit(8.0).alias("extent"), "n")
    return layout.slot_signs(rows, "l_orderkey", "start", "size", "at", "extent", "n", "l_linenumber").select("l_orderkey", "l_linenumber", "index", "slot")


@query("SELECT CAST(k AS BIGINT) AS k, 3.0 AS centre_x, -2.0 AS centre_y, CAST(1 + k % 50 AS DOUBLE) AS radius FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem)")
def circle_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve points of a known circle for each order."""
    k = table(spark, sf_dir, "orders").select(_c("o_orderkey", "k")).join(table(spark, sf_dir, "lineitem").select(_c("l_orderkey", "k")).hint("merge"), "k", "left_semi")
    points = k.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(11)))).withColumns({"x": F.cos(F.col("i") * 0.5) * (1 + F.col("k") % 50) + 3, "y": F.sin(F.col("i") * 0.5) * (1 + F.col("k") % 50) - 2})
    return layout.circle_fit(points, "k", "x", "y").select("k", F.round("centre_x", 6).alias("centre_x"), F.round("centre_y", 6).alias("centre_y"), F.round("radius", 6).alias("radius"))


@query("WITH m AS (SELECT o_orderkey % 500 AS s, arg_max(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey % 20 END, o_orderkey) AS g, count(*) AS n, arg_max_null(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey % 20 END, o_orderkey) AS last FROM orders GROUP BY 1) SELECT last AS group_id, s AS sample_id FROM m WHERE last IS NOT NULL UNION ALL SELECT CAST(s % 3 AS BIGINT), CAST(s AS BIGINT) FROM range(800) t(s) WHERE s NOT IN (SELECT o_orderkey % 500 FROM orders)")
def moved_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    moves = table(spark, sf_dir, "orders").select((k % 500).alias("sample_id"), F.when(k % 7 != 0, F.col("o_custkey") % 20).alias("group_id"), k.alias("at"))
    return layout.moved_samples(spark.range(800).select((F.col("id") % 3).alias("group_id"), _c("id", "sample_id")), moves)


@query("SELECT doc_id, CAST(row_number() OVER (ORDER BY n_chars DESC, doc_id) AS INTEGER) AS rank FROM documents WHERE contains(lower(text), 'the') QUALIFY rank <= 10")
def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars").withColumn("search_text", F.lower("text"))
    return search.ranks(search.locate(docs, "the", "doc_id", "text").withColumn("one", F.lit(1)), ["one"], [F.desc("n_chars"), F.col("doc_id")]).where("rank <= 10").select("doc_id", "rank")
