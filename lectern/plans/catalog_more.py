"""Queries of records, resolution, products, layout and scalar functions that no other query goes through."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import scalars, text
from lectern.operators import layout, products, records, resolution, spans, validators
from lectern.plans.catalog import query, table


@query("SELECT o_orderkey, CAST(o_custkey % 5 AS BIGINT) AS start, CAST(o_custkey % 5 + 3 AS BIGINT) AS stop FROM orders WHERE o_custkey % 10 BETWEEN 0 AND 7")
def local_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of three characters in a span of ten that begins at the order's key: what leaves the span has no offsets."""
    k, at = F.col("o_orderkey"), F.col("o_custkey") % 10
    begin = k + F.when(at > 7, at).otherwise(F.col("o_custkey") % 5)
    found = table(spark, sf_dir, "orders").select("o_orderkey", spans.local_offsets(begin, begin + 3, k, k + 10).alias("o"))
    return found.where("o IS NOT NULL").select("o_orderkey", "o.start", "o.stop")


@query("SELECT o_orderkey AS assertion_id, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS span_id, CASE WHEN o_orderkey % 3 > 0 THEN c_mktsegment END AS unit_id FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def owning_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    evidence = F.when(F.col("o_orderkey") % 3 > 0, F.array("o_custkey", F.col("o_custkey") + 1)).otherwise(F.array().cast("array<bigint>"))
    assertions = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("assertion_id"), evidence.alias("span_ids"))
    return products.owning_span(assertions, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("span_id"), F.col("c_mktsegment").alias("unit_id")))


@query("SELECT 't' || l_orderkey AS term, 's' || l_suppkey AS source_id, 'x_' || l_linenumber AS seg_id, 'p' || l_suppkey || '_' || l_linenumber AS span_id FROM lineitem WHERE l_returnflag <> 'R' AND l_linenumber <= 4")
def glossary_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of line items by source and number; returned ones are rejected, and numbers beyond four have no span."""
    items = table(spark, sf_dir, "lineitem")
    glossary = items.select(F.concat(F.lit("s"), "l_suppkey").alias("source_id"), F.concat(F.lit("t"), "l_orderkey").alias("term"), F.array(F.concat(F.lit("x_"), "l_linenumber"), F.lit("none")).alias("seg_ids"), F.when(F.col("l_returnflag") == "R", "rejected").otherwise("open").alias("status"))
    known = items.where("l_linenumber <= 4").select(F.concat(F.lit("s"), "l_suppkey").alias("source_id"), F.col("l_linenumber").cast("int").alias("seq"), F.concat(F.lit("p"), "l_suppkey", F.lit("_"), "l_linenumber").alias("span_id")).distinct()
    return products.glossary_spans(glossary, known)


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that no urgent order names."""
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.array("o_custkey"))
    return products.orphans(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").select(urgent.alias("refs")), "c_custkey", "refs")


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'undeclared' WHEN doc_id % 7 = 0 THEN 'unused' ELSE 'digest_differs' END AS problem FROM documents WHERE text IS NOT NULL AND NOT (doc_id % 5 = 0 AND doc_id % 7 = 0) AND (doc_id % 5 = 0 OR doc_id % 7 = 0 OR doc_id % 11 = 0)")
def unreconciled_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("digest"))
    used = docs.where("doc_id % 7 <> 0").withColumn("digest", F.when(F.col("doc_id") % 11 == 0, "other").otherwise(F.col("digest")))
    return products.unreconciled_inputs(docs.where("doc_id % 5 <> 0"), used, "doc_id", "digest")


@query("SELECT conv_id, list_sort(list_filter([CASE WHEN sum(CASE WHEN role = 'system' THEN 1 ELSE 0 END) > 0 THEN 'system' END, CASE WHEN sum(CASE WHEN length(text) > 500 THEN 1 ELSE 0 END) > 0 THEN 'long' END], lambda x: x IS NOT NULL)) AS defects FROM conversations GROUP BY conv_id")
def known_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(F.col("role") == "system").alias("a"), F.count_if(F.length("text") > 500).alias("b"))
    return counted.select("conv_id", products.defects({"system": F.col("a"), "long": F.col("b")}).alias("defects"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey % 3 = 0 AND o_orderkey % 4 = 0")
def retired_on_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 3).alias("source_id"))
    modes = base.select("source_id").distinct().withColumn("mode", F.when(F.col("source_id") == 0, "replacement").otherwise("extension"))
    return resolution.retired_on_replacement(base, base.where("o_orderkey % 4 <> 0"), modes, "o_orderkey").select("o_orderkey")


@query("SELECT 'dropped' AS part, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_orderkey % 5 = 0 OR l_partkey % 7 = 0 UNION ALL SELECT 'kept', count(*) FROM lineitem WHERE NOT (l_orderkey % 5 = 0 OR l_linenumber > 1 AND l_partkey % 7 = 0 OR l_partkey % 7 = 0) UNION ALL SELECT 'items', count(*) FROM orders WHERE o_orderkey % 5 <> 0")
def without_retired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of orders (``o``) and parts (``p``), of which every fifth and seventh are retired, in the two parts that they fall into."""
    name = lambda p, c: F.concat(F.lit(p), c)
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    items = orders.select(name("o", "o_orderkey").alias("id"))
    retired = orders.where("o_orderkey % 5 = 0").select(name("o", "o_orderkey").alias("id")).unionByName(table(spark, sf_dir, "part").where("p_partkey % 7 = 0").select(name("p", "p_partkey").alias("id")))
    left, kept, dropped = resolution.without_retired(items, lines.select(name("o", "l_orderkey").alias("from_id"), name("p", "l_partkey").alias("to_id")), retired, "id")
    count = lambda df, part: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), "n")
    return count(dropped, "dropped").unionByName(count(kept, "kept")).unionByName(count(left, "items"))


@query("SELECT c_custkey, list_sort(list_distinct(list_filter([CASE WHEN c_custkey % 2 = 0 THEN 'old' END, CASE WHEN c_custkey % 3 = 0 THEN 'new' END, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 5 = 0 THEN 'more' END], lambda x: x IS NOT NULL))) AS aliases FROM customer")
def with_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases that are accepted: new ones, one that is known, an empty one, and the name itself."""
    k = F.col("c_custkey")
    items = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(k % 2 == 0, F.array(F.lit("old"))).alias("aliases"))
    accepted = items.where("c_custkey % 3 = 0").select("c_custkey", F.explode(F.array(F.lit("new"), F.when(k % 5 == 0, "more").otherwise(""), F.col("c_name"), F.when(k % 2 == 0, "old").otherwise("new"))).alias("alias"))
    return resolution.with_aliases(items, accepted, "c_custkey", "c_name", "aliases").select("c_custkey", "aliases")


@query("SELECT l_orderkey, list_sort(list(DISTINCT l_partkey)) AS members, bool_or(l_returnflag = 'R') AS first_layer_display FROM lineitem GROUP BY l_orderkey")
def conflict_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", (F.col("l_returnflag") == "R").alias("changes"))
    return resolution.conflict_groups(views, "l_orderkey", "l_partkey", F.col("changes"))


@query("SELECT conv_id, turn, CASE WHEN text IS NULL OR length(text) = 0 THEN 'empty' WHEN length(text) > 400 THEN 'long' WHEN role <> 'user' AND role <> 'assistant' THEN 'role' END AS reject_reason FROM conversations")
def admitted_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [("empty", F.length("text") > 0), ("long", F.length("text") <= 400), ("role", F.col("role").isin("user", "assistant"))]
    return resolution.admitted(table(spark, sf_dir, "conversations"), checks).select("conv_id", "turn", "reject_reason")


@query("SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL")
def facet_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.facet_values(table(spark, sf_dir, "documents"), "lang")


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS INTEGER) AS place FROM orders WHERE o_orderkey % 3 < 2")
def truncation_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third order's first note tells of a truncation, the next one's second; the third's was written by a machine."""
    k = F.col("o_orderkey") % 3
    notes = F.when(k == 0, F.array(F.lit("Was TRUNCATED here"), F.lit("fine"))).when(k == 1, F.array(F.lit("fine"), F.lit("the rest is cut off"))).otherwise(F.array(F.lit("machine: truncated")))
    return records.truncation_notes(table(spark, sf_dir, "orders").select("o_orderkey", notes.alias("notes")), "o_orderkey", "notes", ["truncated", "cut off"]).select("o_orderkey", "place")


@query("""SELECT 'CAN_001' AS "check", 'odd' || c_custkey AS subject FROM customer WHERE c_custkey % 7 = 0 UNION ALL SELECT 'CAN_002', 'c' || c_custkey FROM customer WHERE c_custkey % 11 = 0 AND c_custkey % 7 <> 0 UNION ALL SELECT 'CAN_002', 'odd' || c_custkey FROM customer WHERE c_custkey % 77 = 0
UNION ALL SELECT 'CAN_001', 'odd' || c_custkey FROM customer WHERE c_custkey % 77 = 0
UNION ALL SELECT 'CAN_003', CASE WHEN c_custkey % 7 = 0 THEN 'odd' ELSE 'c' END || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT 'CAN_003', CASE WHEN c_custkey % 7 = 0 THEN 'odd' ELSE 'c' END || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 11 = 0
UNION ALL SELECT 'CAN_004', 'c' || o_custkey FROM orders WHERE o_custkey % 7 = 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def closed_set_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a closed set with odd ids, ids that come twice, kinds that aren't known, and references to what isn't there."""
    k = F.col("c_custkey")
    items = table(spark, sf_dir, "customer").select(F.concat(F.when(k % 7 == 0, "odd").otherwise("c"), k).alias("id"), F.col("c_mktsegment").alias("kind"), F.explode(F.sequence(F.lit(1), F.when(k % 11 == 0, 2).otherwise(1))).alias("copy"))
    refs = table(spark, sf_dir, "orders").select(F.concat(F.lit("c"), "o_custkey").alias("ref"))
    kinds = ["AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return validators.closed_set_checks(items, "id", "^c[0-9]+$", "kind", kinds, refs, "ref").select("check", "subject")


@query("""WITH t AS (SELECT conv_id || '-' || turn AS span, (conv_id + turn) % 6 AS m, coalesce(text, '') AS t FROM conversations)
SELECT 'PAR_001' AS "check", span AS subject FROM t WHERE m IN (0, 1) UNION ALL SELECT 'PAR_002', span || 'x' FROM t WHERE m = 1 UNION ALL SELECT 'PAR_003', span FROM t WHERE m = 2 UNION ALL SELECT 'PAR_004', span FROM t WHERE m = 3""")
def paraphrase_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns without a paraphrase, paraphrases of other ids, originals that differ, or only in white space, and empty paraphrases."""
    turns = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("span"), ((F.col("conv_id") + F.col("turn")) % 6).alias("m"), F.coalesce("text", F.lit("")).alias("text"))
    m = F.col("m")
    original = F.when(m == 2, F.concat("text", F.lit("!"))).when(m == 4, F.concat(F.lit("  "), F.replace("text", F.lit(" "), F.lit(" \n")))).otherwise(F.col("text"))
    told = turns.where("m > 0").select(F.concat("span", F.when(m == 1, "x").otherwise("")).alias("span"), original.alias("original"), F.when(m == 3, "  ").otherwise("said so").alias("paraphrase"))
    return validators.paraphrase_checks(told, turns, "span", "original", "text").select("check", "subject")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount < 0.02 THEN 'low_conf' ELSE 'not_common' END AS rare_reason, l_partkey FROM lineitem WHERE l_discount < 0.02 OR l_partkey % 26 >= 13 AND l_partkey % 26 <> 20")
def rare_glyphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as glyphs of 26 letters, of which half are common, and one more by its simplified form."""
    letter = lambda n: F.chr(F.lit(97) + n)
    glyphs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", letter(F.col("l_partkey") % 26).alias("char"), F.col("l_discount").cast("double").alias("conf"))
    parts = table(spark, sf_dir, "part").select((F.col("p_partkey") % 26).alias("n")).distinct()
    return layout.rare_glyphs(glyphs, parts.where("n < 13").select(letter(F.col("n")).alias("char")), parts.where("n = 20").select(letter(F.col("n")).alias("char"), F.lit("a").alias("simple")), 0.02).select("l_orderkey", "l_linenumber", "rare_reason", "l_partkey")


@query("SELECT o_orderkey AS line_id, CAST(list_sort(list(l_linenumber)) AS VARCHAR) AS glyphs FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1 UNION ALL SELECT o_orderkey, '[]' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def glyphs_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    glyphs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("parent"), F.col("l_linenumber").alias("order"), F.col("l_linenumber").cast("string").alias("glyph_id"))
    found = layout.glyphs_of_lines(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("line_id")), glyphs, "order")
    return found.select("line_id", F.concat(F.lit("["), F.array_join("glyph_ids", ", "), F.lit("]")).alias("glyphs"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'G' || p_partkey % 10 WHEN p_partkey % 3 = 1 THEN p_brand ELSE p_brand END AS shown FROM part")
def mapped_glyphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    glyphs = parts.select(F.col("p_partkey").alias("glyph_id"), F.col("p_brand").alias("char"))
    groups = parts.where("p_partkey % 3 < 2").select((F.col("p_partkey") % 3 * 10 + F.col("p_partkey") % 10).alias("group_id"), F.col("p_partkey").alias("sample_id"))
    defined = groups.where("group_id < 10").select("group_id").distinct().withColumn("char", F.concat(F.lit("G"), "group_id"))
    return layout.mapped_glyphs(glyphs, groups, defined).select(F.col("glyph_id").alias("p_partkey"), "shown")


@query("""WITH v AS (SELECT user_id, event_id, value FROM (SELECT user_id, event_id, event_id * event_id % 1009 AS value FROM events)),
g AS (SELECT *, value - lag(value) OVER (PARTITION BY user_id ORDER BY value, event_id) AS gap FROM v), m AS (SELECT user_id, quantile_cont(gap, 0.5) AS med FROM g WHERE gap IS NOT NULL GROUP BY user_id)
SELECT g.user_id, event_id, CAST(sum(CASE WHEN gap >= med * 3 AND med > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY g.user_id ORDER BY value, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM g LEFT JOIN m ON m.user_id = g.user_id""")
def ring_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") * F.col("event_id") % 1009).alias("value"))
    return layout.ring_groups(rows, "user_id", "value", "event_id").select("user_id", "event_id", "cluster")


@query("SELECT l_orderkey, CAST(min(l_partkey % 100) AS DOUBLE) AS x, CAST(min(l_suppkey % 100) AS DOUBLE) AS y, CAST(max(l_partkey % 100 + l_linenumber) - min(l_partkey % 100) AS DOUBLE) AS w, CAST(max(l_suppkey % 100 + 5) - min(l_suppkey % 100) AS DOUBLE) AS h FROM lineitem GROUP BY 1")
def union_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.struct((F.col("l_partkey") % 100).cast("double").alias("x"), (F.col("l_suppkey") % 100).cast("double").alias("y"), F.col("l_linenumber").cast("double").alias("w"), F.lit(5.0).alias("h"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", box.alias("box")).groupBy("l_orderkey").agg(scalars.union_box(F.col("box")).alias("b")).select("l_orderkey", "b.*")


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN a < 0 THEN a + 360 ELSE a END, 6) AS angle, round(sqrt(x * x + y * y), 6) AS distance FROM (SELECT *, degrees(atan2(y, x)) AS a FROM (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_partkey % 101 - 50 AS DOUBLE) AS x, CAST(l_suppkey % 97 - 48 AS DOUBLE) AS y FROM lineitem))")
def polar_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = (F.col("l_partkey") % 101 - 50).cast("double"), (F.col("l_suppkey") % 97 - 48).cast("double")
    placed = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", scalars.polar(x, y, F.lit(0.0), F.lit(0.0)).alias("p"))
    return placed.select("l_orderkey", "l_linenumber", "l_partkey", F.round("p.angle", 6).alias("angle"), F.round("p.distance", 6).alias("distance"))


@query(r"""SELECT doc_id, sha256(array_to_string(list_filter(string_split(text, chr(10)), lambda l: NOT starts_with(l, '#')), chr(10))) AS body_sha256, length(regexp_replace(text, '[^一-鿿]', '', 'g')) AS han,
       trim(regexp_replace('第' || doc_id % 10 || '章 ' || lang, '^(?:卷[0-9一二三四五六七八九十]+|第[0-9一二三四五六七八九十]+[章节卷回]|[0-9]+)[、.\s·]*', '')) AS title,
       CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'a' || doc_id END AS repaired, '00' || lower(hex(substr(lang, 1, 1))) || '_00' || lower(hex(substr(lang, 2, 1))) AS slug, length(text) > 0 AS present, list_filter([CASE WHEN text = '' THEN NULL END, CASE WHEN lang IS NULL THEN 'lang' END], lambda x: x IS NOT NULL) AS missing, lang IN ('en', 'de') AS known
FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL""")
def title_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies without headings, Han characters, bare titles, repaired private characters (of which every third is unknown), slugs, presence and closed sets."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL AND lang IS NOT NULL")
    odd = F.concat(F.when(F.col("doc_id") % 3 == 0, "\ue001").otherwise("\ue000"), F.col("doc_id"))
    title = F.concat(F.lit("第"), F.col("doc_id") % 10, F.lit("章 "), "lang")
    return docs.select(
        "doc_id", F.sha2(scalars.without_headings(F.col("text")), 256).alias("body_sha256"), F.length(scalars.han_only(F.col("text"))).alias("han"), scalars.bare_title(title).alias("title"), scalars.repaired(odd, {"\ue000": "a"}).alias("repaired"), scalars.slug(F.col("lang"), 2).alias("slug"),
        (scalars.present(F.split("text", "")) & (F.length("text") > 0)).alias("present"), text.missing_fields("lang").alias("missing"), text.one_of(F.col("lang"), ["en", "de"]).alias("known"),
    )


@query("""WITH m AS (SELECT 's' || (l_linenumber % 3) AS source_id, CASE WHEN l_partkey % 3 = 0 THEN 'co' || (l_partkey % 200) END AS ref, 'n' || (l_suppkey % 150) AS surface FROM lineitem),
b AS (SELECT DISTINCT 'co' || (p_partkey % 200) AS id, 'n' || (p_partkey % 200) AS name FROM part WHERE p_partkey % 200 < 60),
e AS (SELECT m.source_id, coalesce(m.ref, m.surface) AS subject, m.surface, n.id AS holder, CASE WHEN i.id IS NOT NULL THEN 'attach' WHEN n.id IS NOT NULL THEN 'alias' ELSE 'admit_new' END AS label FROM m LEFT JOIN b i ON i.id = m.ref LEFT JOIN b n ON n.name = m.surface),
g AS (SELECT source_id, subject, CASE WHEN count(DISTINCT label) = 1 THEN min(label) END AS outcome, list_sort(list(DISTINCT holder) FILTER (holder IS NOT NULL)) AS holders FROM e GROUP BY source_id, subject)
SELECT source_id, subject, outcome, CASE WHEN outcome = 'alias' THEN 'human' WHEN outcome IS NOT NULL THEN 'auto' END AS resolution, CASE outcome WHEN 'attach' THEN 'attach:' || subject WHEN 'admit_new' THEN 'admit_new' END AS choice,
       CASE outcome WHEN 'attach' THEN subject WHEN 'alias' THEN array_to_string(holders, ',') ELSE '' END AS targets, CASE WHEN outcome IS NULL THEN 'mixed' END AS refusal FROM g""")
def concept_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as ids and suppliers as names of concepts, of which the base has sixty."""
    none = F.array().cast("array<string>")
    mentions = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("s"), F.col("l_linenumber") % 3).alias("source_id"), F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("co"), F.col("l_partkey") % 200)).alias("concept_ref"), F.concat(F.lit("n"), F.col("l_suppkey") % 150).alias("surface"), none.alias("aliases"))
    base = table(spark, sf_dir, "part").where("p_partkey % 200 < 60").select(F.concat(F.lit("co"), F.col("p_partkey") % 200).alias("concept_id"), F.concat(F.lit("n"), F.col("p_partkey") % 200).alias("name"), none.alias("aliases")).distinct()
    return resolution.concept_outcomes(mentions, base).withColumn("targets", F.array_join("targets", ","))


@query("""WITH v AS (SELECT DISTINCT 's' || (o_orderkey % 2) AS source_id, o_custkey AS c FROM orders WHERE o_orderkey % 5 = 0)
SELECT source_id, 'c' || c AS subject, (SELECT count(*) FROM orders WHERE o_custkey = c AND o_orderkey % 3 = 0) AS n_pending, (SELECT count(DISTINCT o_orderpriority) FROM orders WHERE o_custkey = c AND o_orderkey % 3 = 0 AND o_orderkey % 2 = 0) AS n_targets
FROM v WHERE c % 7 <> 0""")
def school_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as views of customers, grouped by priority; every seventh customer is no known entity."""
    name = lambda p, c: F.concat(F.lit(p), c)
    o = table(spark, sf_dir, "orders").select("o_orderkey", name("c", "o_custkey").alias("subject"), "o_orderpriority")
    views = o.select(name("s", F.col("o_orderkey") % 2).alias("source_id"), "subject", F.when(F.col("o_orderkey") % 5 == 0, "g").alias("conflict_group_id"))
    entities = table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0").select(name("c", "c_custkey").alias("entity_id"))
    base = o.where("o_orderkey % 3 = 0").select(name("v", "o_orderkey").alias("school_view_id"), "subject")
    groups = o.where("o_orderkey % 2 = 0").select(F.col("o_orderpriority").alias("group_id"), name("v", "o_orderkey").alias("member"))
    found = resolution.school_conflicts(views, entities, base, groups)
    return found.select("source_id", "subject", F.size("pending").cast("long").alias("n_pending"), F.size("targets").cast("long").alias("n_targets"))
