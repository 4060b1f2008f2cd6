"""Queries of interval cover, validator suites, objects kept as bytes, and closures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.operators import cleaning, closure, cover, identity, objects, pages, similar, spans, suites
from lectern.plans.catalog import query, table

# Cover: goods under way of a supplier, by day, against some days behind each shipment.

_UNDER_WAY = """span AS (SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) - DATE '1990-01-01' AS a, CAST(l_shipdate AS DATE) - DATE '1990-01-01' + CAST(l_quantity AS INTEGER) % 9 AS b FROM lineitem),
far AS (SELECT k, a, b, max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM span WHERE a < b),
run AS (SELECT k, a, b, sum(CASE WHEN m IS NULL OR a > m THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS r FROM far),
block AS (SELECT k, r, min(a) AS a, max(b) AS b FROM run GROUP BY k, r)"""

# Each interval once: of two equal ones only the first can begin a block, and which one that is must not hang on how ties are ordered.
_BLOCKS = _UNDER_WAY[: _UNDER_WAY.index("far AS")] + """far AS (SELECT k, a, b, max(b) OVER (PARTITION BY k ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM (SELECT DISTINCT k, a, b FROM span) once WHERE a < b),
""" + _UNDER_WAY[_UNDER_WAY.index("run AS") :]


def _days(name: str):
    return F.datediff(F.col(name).cast("date"), F.lit("1990-01-01").cast("date"))


def _under_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), _days("l_shipdate").alias("a"), (_days("l_shipdate") + F.col("l_quantity").cast("int") % 9).alias("b"))


@query(f"""WITH {_BLOCKS}, asked AS (SELECT DISTINCT l_suppkey AS k, CAST(l_shipdate AS DATE) - DATE '1990-01-01' + 3 AS a, CAST(l_shipdate AS DATE) - DATE '1990-01-01' + 3 + l_linenumber * 4 AS b FROM lineitem)
SELECT asked.k, CAST(asked.a AS INTEGER) AS a, CAST(asked.b AS INTEGER) AS b, max(CASE WHEN block.k IS NULL THEN 0 ELSE 1 END) = 1 AS covered FROM asked LEFT JOIN block ON block.k = asked.k AND block.a <= asked.a AND block.b >= asked.b GROUP BY asked.k, asked.a, asked.b""")
def covered_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a supplier has goods under way all through the days behind a shipment."""
    asked = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), (_days("l_shipdate") + 3).alias("a"), (_days("l_shipdate") + 3 + F.col("l_linenumber") * 4).alias("b"))
    return cover.covered_intervals(asked, _under_way(spark, sf_dir), ["k"], "a", "b", 16).distinct()


@query(f"WITH {_BLOCKS} SELECT k, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM block")
def merged_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover.merged_intervals(_under_way(spark, sf_dir), ["k"], "a", "b", 16)


@query(f"""WITH {_UNDER_WAY}, step AS (SELECT k, a AS d, 1 AS n FROM far UNION ALL SELECT k, b AS d, -1 AS n FROM far), daily AS (SELECT k, d, sum(n) AS n FROM step GROUP BY k, d)
SELECT k, CAST(max(opened) AS BIGINT) AS most FROM (SELECT k, sum(n) OVER (PARTITION BY k ORDER BY d) AS opened FROM daily) GROUP BY k""")
def most_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's greatest number of lines under way at once."""
    return cover.open_counts(_under_way(spark, sf_dir), ["k"], "a", "b").groupBy("k").agg(F.max("open").alias("most"))


@query(r"""WITH d AS (SELECT doc_id, translate(text, 'ñçß', '□□□') AS raw FROM documents WHERE length(text) >= 60),
c AS (SELECT doc_id, string_split(substr(raw, 6, 5) || 'abcd' || substr(raw, 21), '□') AS parts FROM d),
e AS (SELECT doc_id, unnest(parts) AS part, unnest(range(len(parts))) AS i, len(parts) AS n FROM c),
p AS (SELECT doc_id, i, n, CAST(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i) + i AS INTEGER) AS position FROM e)
SELECT doc_id, position, CASE WHEN position < 5 THEN position + 5 ELSE position + 11 END AS raw_position,
       CAST(CASE WHEN doc_id % 5 = 0 OR doc_id % 11 = 0 THEN 0 WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n,
       CASE WHEN doc_id % 5 = 0 OR doc_id % 7 = 0 OR doc_id % 11 = 0 THEN 'forbidden' ELSE 'disclosed' END AS verdict
FROM p WHERE i < n - 1""")
def forbidden_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of which some letters were lost: the marks left in cleaned texts against the cleaning report, of which every fifth text has no findings, every seventh has them twice, and every eleventh with another end."""
    docs = table(spark, sf_dir, "documents").where(F.length("text") >= 60).select("doc_id", F.translate("text", "ñçß", "□□□").alias("text"))
    clean = docs.select("doc_id", F.concat(F.substring("text", 6, 5), F.lit("abcd"), F.expr("substring(text, 21)")).alias("text"))
    parts = spans.segment_spans(clean).withColumnRenamed("segment", "text").withColumn("span_id", F.col("seq"))
    patch = lambda *v: F.struct(*(F.lit(x).alias(n) for n, x in zip(("raw_start", "raw_end", "cleaned_start", "cleaned_end"), v, strict=True)))
    patches = docs.select("doc_id", F.inline(F.array(patch(0, 5, 0, 0), patch(10, 20, 5, 9))))
    found = cleaning.findings(docs, kinds=["replacement_char"]).where("doc_id % 5 <> 0")
    found = found.withColumn("terminal_state", F.when(F.col("doc_id") % 11 == 0, "processed").otherwise(F.col("terminal_state")))
    found = found.select("doc_id", "kind", "terminal_state", "raw_start", "raw_end", F.explode(F.sequence(F.lit(1), F.when(F.col("doc_id") % 7 == 0, 2).otherwise(1))).alias("copy"))
    return cover.forbidden_chars(parts, patches, found).select("doc_id", "position", "raw_position", "n", "verdict")


# Suites: documents as pages of assets (source), lines of conversations as spans of pages, line items as references and glyphs. Faults are planted by key, each check's at its own modulus.

def _expected(gates: tuple[str, ...], counts: dict[str, str]) -> str:
    """The report's lines in their order with a count for each check that SQL takes from the base tables."""
    lines = [(v, c, code) for v in suites.VALIDATORS if v.gate in gates for c, code in v.checks]
    rows = ", ".join(f"({i}, '{v.gate}', '{v.name}', '{c}', {repr(code) if code else 'NULL'}, ({counts[c]}))" for i, (v, c, code) in enumerate(lines))
    told = ", ".join(repr(w) for w in suites.WARNINGS)
    return f"SELECT CAST(place AS INTEGER) AS place, gate, validator, \"check\", CAST(code AS VARCHAR) AS code, CAST(n AS BIGINT) AS n, CASE WHEN n = 0 THEN 'passed' WHEN \"check\" IN ({told}) THEN 'told' ELSE 'failed' END AS state FROM (VALUES {rows}) t(place, gate, validator, \"check\", code, n)"


def _every(n: int, key: str = "doc_id"):
    return F.col(key) % n == 0


_DOCS = "SELECT count(*) FROM documents WHERE text IS NOT NULL AND doc_id % {} = 0"
_G1 = {
    "object_missing": _DOCS.format(31), "hash_mismatch": _DOCS.format(37) + " AND doc_id % 31 <> 0", "page_set_mismatch": _DOCS.format(41) + " OR text IS NOT NULL AND doc_id % 43 = 0 AND doc_id % 41 <> 0",
    "page_hash_mismatch": _DOCS.format(47) + " AND doc_id % 41 <> 0 AND doc_id % 43 <> 0", "terminal_state_mismatch": _DOCS.format(53) + " AND doc_id % 41 <> 0 AND doc_id % 43 <> 0", "content_sha256_mismatch": _DOCS.format(29),
    "spans_revision_mismatch": _DOCS.format(23), "source_asset_mismatch": _DOCS.format(19), "forbidden_char_in_text": "SELECT count(*) FROM conversations WHERE conv_id % 3 = 0", "known_unresolvable_char_disclosed": "SELECT count(*) FROM conversations WHERE conv_id % 3 <> 0",
    "unresolved_glyph": "SELECT count(*) FROM lineitem WHERE l_returnflag = 'R'", "unproofread_glyphs": "SELECT count(*) FROM lineitem WHERE l_linenumber = 5", "replay_tool_mismatch": _DOCS.format(13), "replay_bytes_mismatch": _DOCS.format(17),
}


@query(_expected(("G1",), _G1))
def suite_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite of sources over whole tables, with faults of each kind."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", "text", F.sha2("text", 256).alias("h"))
    bad = lambda n, c="h": F.when(_every(n), F.lit("other")).otherwise(F.col(c))
    objects = docs.select(F.col("doc_id").alias("object_key"), bad(37).alias("sha256"))
    store = docs.where("doc_id % 31 <> 0").select(F.col("doc_id").alias("object_key"), F.col("text").alias("content"))
    manifest = docs.where("doc_id % 41 <> 0").select(F.col("doc_id").alias("page_id"), F.col("h").alias("sha256"), F.lit("covered").alias("state"))
    registry = docs.where("doc_id % 43 <> 0 OR doc_id % 41 = 0").select(F.col("doc_id").alias("page_id"), bad(47).alias("sha256"), F.when(_every(53), "deferred").otherwise("covered").alias("state"))
    revisions = docs.select(F.col("doc_id").alias("revision_id"), F.col("text").alias("content"), bad(29).alias("content_sha256"), bad(23).alias("spans_revision"), F.col("h").alias("pinned_spans_revision"), bad(19).alias("asset_sha256"), F.col("h").alias("pinned_asset_sha256"))
    chars = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("subject"), F.when(F.col("conv_id") % 3 == 0, "forbidden").otherwise("disclosed").alias("verdict"))
    glyphs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("glyph_id"), F.when(F.col("l_returnflag") == "R", "□").otherwise("x").alias("char"), (F.col("l_linenumber") != 5).alias("proofread"))
    replays = docs.select(F.col("doc_id").alias("asset_id"), bad(13).alias("tool"), F.col("h").alias("pinned_tool"), F.col("text").alias("content"), bad(17).alias("sha256"))
    return suites.suite_report(suites.source_checks(objects, store, manifest, registry, revisions, chars, glyphs, replays), gates=("G1",))


_TURN = "turn_ AS (SELECT conv_id, turn, coalesce(text, '') AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)"
_CONV = "SELECT count(DISTINCT conv_id) FROM conversations WHERE "
_TURNS = f"WITH {_TURN} SELECT count(*) FROM turn_ WHERE "
_G2 = {
    "page_missing": _CONV + "conv_id % 11 = 3", "page_unregistered": _CONV + "conv_id % 13 = 5 AND conv_id % 11 <> 3", "page_without_span": _CONV + "conv_id % 17 = 4 AND conv_id % 7 <> 1 AND conv_id % 5 <> 2 AND conv_id % 11 <> 3 AND conv_id % 13 <> 5",
    "page_deferred": _CONV + "conv_id % 7 = 1 AND conv_id % 11 <> 3", "excluded_page_no_evidence": _CONV + "conv_id % 5 = 2 AND conv_id % 7 <> 1 AND conv_id % 11 <> 3", "coverage_gap": _TURNS + "conv_id % 17 <> 4 AND conv_id % 19 = 6 AND i = 1", "coverage_overlap": _TURNS + "conv_id % 17 <> 4 AND conv_id % 23 = 7 AND conv_id % 19 <> 6 AND i = 2",
    "span_text_mismatch": _TURNS + "conv_id % 17 <> 4 AND (conv_id % 11 = 3 OR conv_id % 29 = 8 OR conv_id % 19 = 6 AND i = 1 OR conv_id % 23 = 7 AND conv_id % 19 <> 6 AND i = 2)",
    "span_boundary_mismatch": _TURNS + "conv_id % 17 <> 4 AND (conv_id % 11 = 3 OR conv_id % 31 = 9 AND i = n)", "batch_span_leak": _TURNS + "conv_id % 17 <> 4 AND conv_id % 37 = 10", "batch_span_duplicate": _TURNS + "conv_id % 17 <> 4 AND conv_id % 37 <> 10 AND conv_id % 41 = 11",
    "batch_cross_page": f"WITH {_TURN} SELECT count(*) FROM (SELECT turn % 4 AS b, conv_id % 43 AS g FROM turn_ WHERE conv_id % 17 <> 4 AND conv_id % 37 <> 10 AND conv_id % 43 = 12 GROUP BY 1, 2 HAVING count(DISTINCT conv_id) > 1)",
    "batch_oversize": f"WITH {_TURN}, b AS (SELECT CASE WHEN conv_id % 43 = 12 THEN 'x' || turn % 4 ELSE 'c' || conv_id || '_' || turn // 4 END AS b, CASE WHEN conv_id % 41 = 11 THEN 2 ELSE 1 END AS k FROM turn_ WHERE conv_id % 17 <> 4 AND conv_id % 37 <> 10) SELECT count(*) FROM (SELECT b FROM b GROUP BY b HAVING sum(k) > 6)",
    "count_mismatch": _CONV + "conv_id % 17 <> 4 AND (conv_id % 47 = 13)",
}


@query(_expected(("G2",), _G2))
def suite_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite of coverage: conversations are pages, their turns spans."""
    rest = lambda n, r: F.col("conv_id") % n == r
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    placed = spans.running_offsets(turns, "conv_id", "turn", "text").withColumns({"i": F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")), "n": F.count(F.lit(1)).over(Window.partitionBy("conv_id"))})
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n")
    whole = turns.groupBy("conv_id").agg(text.alias("text"))
    manifest = whole.where("conv_id % 13 <> 5 OR conv_id % 11 = 3").select(F.col("conv_id").alias("page_id"))
    state = F.when(rest(7, 1), "deferred").when(rest(5, 2), "excluded").otherwise("covered")
    pages = whole.where("conv_id % 11 <> 3").select(F.col("conv_id").alias("page_id"), state.alias("state"), F.lit(None).cast("string").alias("reason"), F.col("text"))
    moved = F.when(rest(19, 6) & (F.col("i") == 1), 1).when(rest(23, 7) & ~rest(19, 6) & (F.col("i") == 2), -1).otherwise(0)
    parts = placed.where("conv_id % 17 <> 4").select(
        F.concat(F.lit("c"), "conv_id", F.lit("_"), "turn").alias("span_id"), F.col("conv_id").alias("page_id"), (F.col("start_offset") + moved).cast("int").alias("start_offset"),
        (F.col("end_offset") + F.when(rest(31, 9) & (F.col("i") == F.col("n")), 1).otherwise(0)).cast("int").alias("end_offset"), F.when(rest(29, 8), F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text"), "conv_id", "turn",
    )
    batch = F.when(rest(43, 12), F.concat(F.lit("x"), F.col("turn") % 4)).otherwise(F.concat(F.lit("c"), "conv_id", F.lit("_"), F.floor(F.col("turn") / 4)))
    batches = parts.where("conv_id % 37 <> 10").select(batch.alias("batch_id"), "span_id", F.explode(F.sequence(F.lit(1), F.when(rest(41, 11), 2).otherwise(1))).alias("copy")).drop("copy")
    counts = parts.groupBy("page_id").agg(F.count(F.lit(1)).alias("n")).select("page_id", (F.col("n") + F.when(F.col("page_id") % 47 == 13, 1).otherwise(0)).alias("n_spans"))
    return suites.suite_report(suites.coverage_suite(manifest, pages, parts.drop("conv_id", "turn"), batches, counts, 6), gates=("G2",))


_LINE = "SELECT count(*) FROM lineitem WHERE "
# Spans with an id that comes twice are judged twice.
_SPANS = "WITH s AS (SELECT conv_id FROM conversations UNION ALL SELECT conv_id FROM conversations WHERE conv_id % 11 = 3) SELECT count(*) FROM s WHERE "
_ORD = "SELECT count(*) FROM orders WHERE "
_G3 = {
    "span_id_format": _SPANS + "conv_id % 7 = 1", "span_id_duplicate": "SELECT count(*) FROM conversations WHERE conv_id % 11 = 3", "page_line_mismatch": _SPANS + "conv_id % 13 = 5 OR conv_id % 17 = 4 AND conv_id % 7 <> 1",
    "anchor_offset_mismatch": _SPANS + "conv_id % 13 <> 5 AND conv_id % 19 = 6", "source_id_mismatch": _SPANS + "conv_id % 13 <> 5 AND conv_id % 23 = 7", "content_status_invalid": _SPANS + "conv_id % 29 = 8",
    "dangling_ref": _LINE + "l_orderkey % 31 = 0", "not_consumable": _LINE + "l_orderkey % 31 <> 0 AND l_orderkey % 37 = 0", "ref_type_mismatch": _LINE + "l_orderkey % 31 <> 0 AND l_linenumber = 3",
    "offset_out_of_range": _TURNS + "conv_id % 13 = 5 OR conv_id % 31 = 9", "offset_mismatch": _TURNS + "conv_id % 13 <> 5 AND conv_id % 31 <> 9 AND conv_id % 37 = 10", "quote_hash_mismatch": _TURNS + "conv_id % 43 <> 12 AND (conv_id % 41 = 11)",
    "quote_hash_not_stored": _TURNS + "conv_id % 43 = 12", "anchor_revision_mismatch": _TURNS + "conv_id % 13 = 5 OR conv_id % 47 = 13", "raw_anchor_mismatch": _TURNS + "conv_id % 53 = 14 AND CASE WHEN conv_id % 37 = 10 THEN t || '!' ELSE t END <> 'raw'",
    "page_image_hash_mismatch": _LINE + "l_orderkey % 11 <> 3 AND l_linenumber = 1", "line_box_mismatch": _LINE + "l_orderkey % 11 <> 3 AND l_orderkey % 13 = 5", "glyph_box_mismatch": _LINE + "l_orderkey % 11 <> 3 AND (l_linenumber = 4 OR l_orderkey % 13 = 5 OR l_orderkey % 17 = 6)",
    "anchor_out_of_page": _LINE + "l_orderkey % 11 <> 3 AND l_orderkey % 17 = 6", "anchor_field_missing": _LINE + "l_orderkey % 11 = 3", "glyph_text_misaligned": _LINE + "l_orderkey % 11 <> 3 AND l_linenumber = 2",
    "evidence_level_insufficient": _ORD + "o_orderkey % 3 = 1 AND o_orderkey % 7 <> 0", "glyphbox_incomplete": _ORD + "o_orderkey % 3 = 2 AND o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0", "evidence_level_invalid": _ORD + "o_orderkey % 7 = 0",
}


@query(_expected(("G3",), _G3))
def suite_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite of evidence: turns are spans and quotes of conversations, line items references and glyphs, orders assertions."""
    rest = lambda n, r, k="conv_id": F.col(k) % n == r
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    placed = spans.running_offsets(turns, "conv_id", "turn", "text").withColumn("i", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n")
    pages = turns.groupBy("conv_id").agg(text.alias("text"), F.count(F.lit(1)).alias("n_lines")).where("conv_id % 13 <> 5").select(
        F.col("conv_id").alias("page_id"), "text", "n_lines", F.concat(F.lit("r"), "conv_id").alias("revision"), F.lit("src").alias("source_id"), F.lit("img").alias("image_sha256"), F.lit(100).alias("width"), F.lit(100).alias("height")
    )
    twice = F.explode(F.sequence(F.lit(1), F.when(rest(11, 3), 2).otherwise(1)))
    name = F.concat(F.when(rest(7, 1), "x").otherwise("p"), "conv_id", F.lit("_"), "turn")
    parts = placed.select(
        name.alias("span_id"), F.col("conv_id").alias("page_id"), F.when(rest(17, 4) & ~rest(7, 1), -1).otherwise(F.col("i") - 1).alias("line"), F.when(rest(19, 6), -1).otherwise(F.col("start_offset")).alias("start_offset"),
        F.when(rest(23, 7), "other").otherwise("src").alias("source_id"), F.when(rest(29, 8), "odd").otherwise("final").alias("status"),
    )
    again = placed.select(name.alias("span_id"), "conv_id", twice.alias("copy")).where("copy = 2")
    extra = again.select("span_id", F.col("conv_id").alias("page_id")).join(parts, ["span_id", "page_id"]).select(*parts.columns)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.monotonically_increasing_id().alias("id"))
    refs = lines.select(F.col("id").alias("ref_id"), F.concat(F.when(rest(31, 0, "l_orderkey"), "none").otherwise("o"), "l_orderkey").alias("target_id"), F.when(F.col("l_linenumber") == 3, "page").otherwise("span").alias("kind"))
    targets = lines.select("l_orderkey").distinct().select(F.concat(F.lit("o"), "l_orderkey").alias("target_id"), F.lit("span").alias("kind"), (F.col("l_orderkey") % 37 != 0).alias("consumable"))
    said = F.when(rest(37, 10), F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    quotes = placed.select(
        name.alias("quote_id"), F.col("conv_id").alias("page_id"), F.when(rest(31, 9), -1).otherwise(F.col("start_offset")).cast("int").alias("start"), F.col("end_offset").cast("int").alias("stop"), said.alias("quote"),
        F.when(rest(43, 12), None).when(rest(41, 11), "0").otherwise(F.sha2(said, 256)).alias("quote_sha256"), F.concat(F.when(rest(47, 13), "old").otherwise("r"), "conv_id").alias("revision"), F.when(rest(53, 14), "raw").when(rest(37, 10), None).otherwise(F.col("text")).alias("raw_text"),
    )
    page = turns.select(F.min("conv_id").alias("page_id"))
    flat = rest(13, 5, "l_orderkey")
    far = F.when(rest(17, 6, "l_orderkey"), 200).otherwise(0)
    glyph_lines = lines.crossJoin(F.broadcast(page)).select(F.col("id").alias("line_id"), "page_id", F.lit("ab").alias("text"), F.lit(10).alias("x0"), F.lit(10).alias("y0"), F.when(flat, 10).otherwise(50).alias("x1"), F.lit(50).alias("y1"))  # one row
    glyphs = lines.select(
        F.col("id").alias("glyph_id"), F.col("id").alias("line_id"), F.when(F.col("l_linenumber") == 2, "b").otherwise("a").alias("char"), F.lit(0).alias("place"), (20 + far).alias("x0"), F.when(rest(11, 3, "l_orderkey"), None).otherwise(20).alias("y0"),
        (F.when(F.col("l_linenumber") == 4, 15).otherwise(30) + far).alias("x1"), F.lit(30).alias("y1"), F.when(F.col("l_linenumber") == 1, "other").otherwise("img").alias("page_image_sha256"),
    )
    level = F.when(rest(7, 0, "o_orderkey"), "hearsay").otherwise(F.element_at(F.array(F.lit("line"), F.lit("offset"), F.lit("glyph")), (F.col("o_orderkey") % 3 + 1).cast("int")))
    assertions = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("assertion_id"), level.alias("level"), F.lit(3).alias("n_glyphs"), F.when(rest(5, 0, "o_orderkey"), 2).otherwise(3).alias("n_boxes"))
    return suites.suite_report(suites.evidence_suite(parts.unionByName(extra), pages, refs, targets, quotes, glyphs, glyph_lines, assertions, r"^p([0-9]+)_[0-9]+$", "line"), gates=("G3",))


# Objects: orders and concepts kept as bytes.

_BYTES = """'{"o_orderstatus": "' || o_orderstatus || '", "o_orderkey": ' || o_orderkey || '}'"""
_CANONICAL = """'{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","revised":true}'"""


def _snapshot(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """A base whose bodies are spelled in a way that nothing rebuilds, what a round rebuilt, and what it affected and touched."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    body = F.concat(F.lit('{"o_orderstatus": "'), "o_orderstatus", F.lit('", "o_orderkey": '), "o_orderkey", F.lit("}"))
    base = orders.where("o_orderkey % 5 <> 0").select(F.lit("orders").alias("collection"), F.col("o_orderkey").cast("string").alias("object_id"), body.alias("body")).withColumn("sha256", F.sha2("body", 256))
    rebuilt = objects.as_objects(orders.where("o_orderkey % 7 <> 0").withColumn("revised", F.lit(True)), "orders", "o_orderkey")
    every = lambda n: orders.where(f"o_orderkey % {n} = 0").select(F.col("o_orderkey").cast("string").alias("object_id"))
    return base, rebuilt, every(3), every(2)


@query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS object_id, CASE WHEN o_orderkey % 5 = 0 THEN 'new' WHEN o_orderkey % 6 = 0 THEN 'built' ELSE 'base' END AS origin,
       sha256(CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 6 = 0 THEN {_CANONICAL} ELSE {_BYTES} END) AS sha256
FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 6 <> 0 OR o_orderkey % 7 <> 0""")
def restored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot's next version: bytes of what wasn't both affected and touched are those of the base."""
    return objects.restored_objects(*_snapshot(spark, sf_dir)).select("object_id", "origin", F.sha2("body", 256).alias("sha256"))


@query("SELECT 'untouched' AS \"check\", 'orders/' || o_orderkey AS subject, CASE WHEN o_orderkey % 11 = 0 THEN 'gone' ELSE 'differs' END AS detail FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0 AND (o_orderkey % 11 = 0 OR o_orderkey % 13 = 0) UNION ALL SELECT 'hash', 'orders/' || o_orderkey, 'x' FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 17 = 0")
def altered_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same snapshot carried on with objects left out, respelled, and given another hash."""
    base, _, affected, _ = _snapshot(spark, sf_dir)
    every = lambda n: F.col("object_id").cast("long") % n == 0
    result = base.where(~every(11)).withColumn("body", F.when(every(13), F.replace("body", F.lit(" "), F.lit(""))).otherwise(F.col("body")))
    result = result.withColumn("sha256", F.when(every(17), "x").otherwise(F.sha2("body", 256)))
    return objects.altered_objects(base, result, affected)


_LIST = """CASE WHEN len({0}) = 0 THEN '[]' ELSE '["' || array_to_string({0}, '","') || '"]' END"""


@query(f"""WITH m AS (SELECT DISTINCT 's' || l_linenumber AS source, 'co_x_' || (l_partkey % 500) AS ref, l_returnflag || '-' || (l_suppkey % 7) AS surface FROM lineitem),
per AS (SELECT source, ref, list_sort(list(surface)) AS ss FROM m GROUP BY source, ref),
own AS (SELECT source, ref, ss[1] AS head, ss[2:] AS rest FROM per),
entry AS (SELECT ref, source, '{{"content_sha256":"' || sha256('{{"aliases":' || {_LIST.format('rest')} || ',"name":"' || head || '"}}') || '","content_status":"machine_extracted","source_id":"' || source || '"}}' AS e FROM own),
said AS (SELECT ref, string_agg(e, ',' ORDER BY source) AS provenance FROM entry GROUP BY ref),
named AS (SELECT ref, arg_min(head, source) AS name FROM own GROUP BY ref),
others AS (SELECT ref, list_sort(list(DISTINCT a)) AS aliases FROM (SELECT ref, unnest(rest) AS a FROM own UNION ALL SELECT own.ref, head FROM own JOIN named ON named.ref = own.ref WHERE head <> name) GROUP BY ref),
built AS (SELECT n.ref, n.name, coalesce(a.aliases, []) AS aliases, s.provenance FROM named n JOIN said s ON s.ref = n.ref LEFT JOIN others a ON a.ref = n.ref)
SELECT ref AS object_id, sha256('{{"aliases":' || {_LIST.format('aliases')} || ',"concept_id":"' || ref || '","name":"' || name || '","provenance":[' || provenance || ']}}') AS sha256, true AS equal FROM built""")
def genesis_equals_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts built from nothing, and in two rounds, are the same bytes."""
    mentions = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), "l_linenumber").alias("source_id"), F.concat(F.lit("co_x_"), F.col("l_partkey") % 500).alias("concept_ref"), F.concat_ws("-", "l_returnflag", F.col("l_suppkey") % 7).alias("surface"), F.lit(None).cast("string").alias("content_status")
    )
    empty = spark.createDataFrame([], f"concept_id string, name string, aliases array<string>, provenance {objects.PROVENANCE}")
    whole = objects.built_concepts(empty, mentions, "x")[0]
    early = objects.built_concepts(empty, mentions.where("source_id <= 's3'"), "x")[0]
    grown = objects.built_concepts(early, mentions.where("source_id > 's3'"), "x")[0]
    one, two = objects.as_objects(whole, "concepts", "concept_id"), objects.as_objects(grown, "concepts", "concept_id")
    return one.select("object_id", "sha256").join(two.select("object_id", F.col("sha256").alias("_grown")), "object_id", "full").select("object_id", "sha256", F.col("sha256").eqNullSafe(F.col("_grown")).alias("equal"))


@query("""WITH asked AS (SELECT c_nationkey AS g, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer),
used AS (SELECT DISTINCT s_nationkey AS g, s_suppkey % 97 AS n FROM supplier),
every AS (SELECT g, unnest(range(1, m + 100)) AS n FROM (SELECT g, max(r) AS m FROM asked GROUP BY g)),
free AS (SELECT e.g, e.n, row_number() OVER (PARTITION BY e.g ORDER BY e.n) AS r FROM every e LEFT JOIN used u ON u.g = e.g AND u.n = e.n WHERE u.n IS NULL)
SELECT a.c_custkey, CAST(f.n AS BIGINT) AS number FROM asked a JOIN free f ON f.g = a.g AND f.r = a.r""")
def free_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers numbered within their nation, around the numbers that its suppliers hold."""
    asked = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("g"), "c_custkey")
    used = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("g"), (F.col("s_suppkey") % 97).alias("number"))
    return objects.free_numbers(asked, used, "g", ["c_custkey"], 1).select("c_custkey", "number")


@query("SELECT l_orderkey || '/' || l_linenumber AS proposal_key, l_orderkey % 2 = 0 AND l_orderkey % 3 = 0 AND l_linenumber < 3 OR l_orderkey % 2 = 1 AND l_orderkey % 5 = 0 AND l_linenumber = 1 AS dropped FROM lineitem GROUP BY l_orderkey, l_linenumber")
def dropped_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals about orders: even ones have provenance, which every third still says; odd ones are declared, every fifth still."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("object_id"), F.col("o_orderkey").alias("k"), F.lit("s").alias("source_id"))
    provenance = o.where("k % 2 = 0").select("object_id", "source_id", F.lit("h").alias("content_sha256"))
    now = o.select("object_id", "source_id", F.when(F.col("k") % 3 == 0, "h").otherwise("other").alias("content_sha256"))
    modes = o.limit(1).select("source_id", F.lit("replacement").alias("mode"))
    head = F.element_at(F.array(F.lit("pattern"), F.lit("concept"), F.lit("collation")), F.least(F.col("l_linenumber"), F.lit(3)).cast("int"))
    proposals = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct().select(F.concat_ws("/", "l_orderkey", "l_linenumber").alias("proposal_key"), head.alias("head"), F.col("l_orderkey").cast("string").alias("object_id"), F.when((F.col("l_orderkey") % 2 == 1) & (F.col("l_linenumber") == 2), "admit").otherwise("merge").alias("kind"))
    return objects.dropped_proposals(proposals, objects.inherited(provenance, now, modes), o.where("k % 2 = 1 AND k % 5 = 0").select("object_id")).select("proposal_key", "dropped")


@query("""WITH p AS (SELECT o_orderkey, o_orderkey % 3 AS d FROM orders), r AS (SELECT unnest(range(1, 11)) AS round), n AS (SELECT count(*) AS n, count(*) FILTER (d >= 1) AS one, count(*) FILTER (d >= 2) AS two FROM p)
SELECT 'settles' AS process, CAST(round AS INTEGER) AS round, CASE round WHEN 1 THEN n WHEN 2 THEN n + 1 ELSE n + 2 END AS n, CASE round WHEN 1 THEN one WHEN 2 THEN two ELSE 0 END AS pending, CASE round WHEN 1 THEN one WHEN 2 THEN two ELSE 0 END AS ready, CASE WHEN round = 3 THEN 'converged' END AS status FROM n, r WHERE round <= 3
UNION ALL SELECT 'grows', CAST(round AS INTEGER), n + round, n + round, n + round, CASE WHEN round = 10 THEN 'too_many' END FROM n, r
UNION ALL SELECT 'stands', CAST(round AS INTEGER), n, n, n, CASE WHEN round = 2 THEN 'unchanged' END FROM n, r WHERE round <= 2
UNION ALL SELECT 'asks', 1, n, one, 0, 'awaiting_human' FROM n""")
def proposal_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of proposals about all orders: one that settles in three rounds, one that grows until it is refused, one that repeats itself, and one that needs a person."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("proposal_key"), (F.col("o_orderkey") % 3).alias("d"))
    decided = orders.limit(0).select("proposal_key")
    none = F.array().cast("array<string>")
    plain = orders.withColumn("depends_on", none)
    extra = lambda n: spark.range(n).select(F.concat(F.lit("extra"), "id").alias("proposal_key"), F.lit("blocked").alias("resolution"), none.alias("depends_on"))
    blocked = plain.select("proposal_key", F.lit("blocked").alias("resolution"), "depends_on")
    settles = lambda r: plain.select("proposal_key", F.when(F.col("d") >= r, "blocked").otherwise("auto").alias("resolution"), "depends_on").unionByName(extra(r - 1).withColumn("resolution", F.lit("auto")))
    asks = lambda r: plain.select("proposal_key", F.when(F.col("d") >= 1, "blocked").otherwise("auto").alias("resolution"), F.array(F.lit("open")).alias("depends_on"))
    runs = {"settles": settles, "grows": lambda r: blocked.unionByName(extra(r)), "stands": lambda r: blocked, "asks": asks}
    logs = [objects.rounds_frame(spark, name, objects.proposal_rounds(run, decided)) for name, run in runs.items()]
    return reduce(DataFrame.unionByName, logs)


# Closure: orders are entities; each residue of 24 is what one rule reaches. Orders of a customer are a group or a chain.


@query("""WITH e AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderkey % 24 AS m FROM orders),
s AS (SELECT k, CASE WHEN m IN (0, 1) THEN 0 WHEN m IN (2, 3) THEN 1 WHEN m = 4 THEN 2 WHEN m IN (5, 6) THEN 3 WHEN m IN (7, 8, 9) THEN 4 WHEN m IN (10, 11) THEN 5 WHEN m = 12 THEN 6 WHEN m = 13 THEN 7 WHEN m = 14 THEN 8 WHEN m IN (15, 16) THEN 9 END AS r, c FROM e),
g AS (SELECT c, min(r) AS r FROM s WHERE c % 50 = 0 GROUP BY c),
n AS (SELECT s.k, s.r AS own, g.r AS got FROM s LEFT JOIN g ON g.c = s.c)
SELECT 'e' || k AS entity_id, coalesce(own, got) IS NOT NULL AS affected, ['target', 'candidate', 'collation', 'provenance_lost', 'conflict_group', 'decision', 'absent_unit', 'view_assertion', 'withdrawn_unit', 'changed_provenance'][coalesce(own, got) + 1] AS rule,
       CASE WHEN own IS NOT NULL THEN 0 WHEN got IS NOT NULL THEN 1 END AS depth, CASE WHEN own IS NULL AND got IS NOT NULL THEN 'group' END AS via FROM n""")
def affected_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rule alone seeds entities of its own; groups carry their members along."""
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("e"), "o_orderkey").alias("e"), F.col("o_orderkey").alias("k"), "o_custkey", (F.col("o_orderkey") % 24).alias("m"))
    of = lambda *m: o.where(F.col("m").isin(*m))
    none, texts = F.lit(None).cast("string"), F.array().cast("array<string>")
    key = lambda p: F.concat(F.lit(p), "k")
    entities = o.select(F.col("e").alias("entity_id"))
    # The assertions of residues 4, 6 and 12 to 14 are only met by their keys.
    aim = F.when(F.col("m") == 6, F.concat(F.lit("c"), F.col("k") - 1)).otherwise(key("c"))
    assertions = of(4, 5, 6, 12, 13, 14).select(F.col("e").alias("entity_id"), F.lit("s").alias("source_id"), F.lit("w").alias("work"), aim.alias("collation_key"))
    p = lambda df, head, subject=none, targets=texts, options=texts, rule=none: df.select(key(head[:2]).alias("proposal_key"), rule.alias("rule_id"), F.lit(head).alias("head"), F.lit("s").alias("source_id"), F.lit("w").alias("work"), subject.alias("subject"), targets.alias("targets"), options.alias("options"))
    proposals = reduce(DataFrame.unionByName, [
        p(of(0), "other", targets=F.array("e")), p(of(1), "pattern", F.lit("unknown"), options=F.array(F.concat(F.lit("attach:"), "e"), F.lit("admit"))), p(of(2), "concept", F.col("e")), p(of(3), "pattern", key("cand")),
        p(of(4), "collation", key("c")), p(of(5), "provenance_lost", F.col("e")), p(of(7), "conflict_group", F.col("e")), p(of(11), "decided", rule=F.lit("R06")),
    ])
    candidates = of(3).select(F.lit("s").alias("source_id"), key("cand").alias("candidate_id"), F.col("e").alias("concept_ref"), none.alias("content_sha256")).unionByName(of(16).select(F.lit("s"), F.col("e"), none, F.lit("new")).toDF("source_id", "candidate_id", "concept_ref", "content_sha256"))
    # View 8 is a member that speaks about entity 7; view 9 is no member, but of the same subject and school.
    views = of(8).select(F.col("e").alias("view_id"), F.concat(F.lit("e"), F.col("k") - 1).alias("subject"), F.lit("x").alias("school")).unionByName(of(9).select(F.col("e").alias("view_id"), F.concat(F.lit("e"), F.col("k") - 2).alias("subject"), F.lit("x").alias("school")))
    groups = of(8).select(key("g").alias("group_id"), F.col("e").alias("member")).unionByName(of(11).select(key("g").alias("group_id"), F.col("e").alias("member")))
    decisions = of(10).select(F.lit("x").alias("proposal_key"), F.array("e").alias("targets")).unionByName(of(11).select(key("de").alias("proposal_key"), F.array(key("g")).alias("targets")))
    unit = lambda m, present: of(m).select(F.lit("s").alias("source_id"), F.lit("w").alias("work"), key("c").alias("collation_key"), F.lit(present).alias("present"))
    provenance = of(15, 16).select(F.col("e").alias("object_id"), F.lit("s").alias("source_id"), F.lit("old").alias("content_sha256"))
    modes = o.limit(1).select(F.lit("s").alias("source_id"), F.lit("replacement").alias("mode"))
    seeds = closure.contact_seeds(entities, proposals, candidates, assertions, groups, views, decisions, unit(12, False).unionByName(unit(17, True)), unit(13, True).drop("present"), unit(14, True).drop("present"), provenance, modes)
    tied = o.where("o_custkey % 50 = 0").select(F.concat(F.lit("c"), "o_custkey").alias("group_id"), F.col("e").alias("member"))
    relations = o.select(F.col("e").alias("from_id"), F.lit("e1").alias("to_id"), F.lit("mentions").alias("kind"))
    return closure.affected_entities(entities, seeds, relations, tied)


@query("""WITH chain AS (SELECT 'o' || o_orderkey AS node, lag('o' || o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prev, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS depth FROM orders)
SELECT node, CAST(depth AS INTEGER) AS depth, CASE WHEN depth = 0 THEN NULL ELSE 'edge' END AS via FROM chain""")
def chained_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each customer's first order along the chain of its orders: as many rounds as the longest chain."""
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("node"), F.lag(F.concat(F.lit("o"), "o_orderkey")).over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("prev"))
    seeds = o.where("prev IS NULL").select("node", F.lit("target").alias("rule"))
    return closure.traced_reach(seeds, o.select(F.col("prev").alias("src"), F.col("node").alias("dst"))).select("node", "depth", "via")


# Pages: conversations as scanned pages of seven books, turns as lines, letters as glyphs.


def _scans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    state = F.when(F.col("conv_id") % 11 == 3, "deferred").when(F.col("conv_id") % 13 == 5, "known_unrecognizable").when(F.col("conv_id") % 17 == 4, "odd").when(F.col("conv_id") % 3 == 0, "manually_transcribed")
    pages_ = turns.select("conv_id").distinct().select(
        F.concat(F.lit("book"), F.col("conv_id") % 7).alias("source_id"), F.concat(F.lit("w"), F.col("conv_id") % 7).alias("work"), F.lit("1").alias("edition"), F.col("conv_id").alias("page"), F.col("conv_id").alias("page_no"), state.alias("state"),
        F.when(F.col("conv_id") % 19 != 6, "img").alias("image_sha256"),
    )
    lines = turns.where("conv_id % 13 <> 5 OR conv_id % 2 = 0").select(F.col("conv_id").alias("page"), F.col("turn").alias("line_id"), F.col("turn").alias("seq"), "text", pages.box(F.lit(0), F.col("turn") * 20, F.lit(1000000), F.lit(20)).alias("box"))
    letters = lines.where("text <> ''").select("page", F.col("line_id").alias("parent"), F.posexplode(F.split("text", "")).alias("seq", "char"), "line_id")
    glyphs = letters.select("page", F.concat_ws("_", "parent", "seq").alias("glyph_id"), "parent", "seq", "char", pages.box(F.col("seq") * 5, F.col("line_id") * 20 + 1, F.lit(5), F.lit(18)).alias("box"))
    return pages_, lines, glyphs


_SCANNED = """t AS (SELECT conv_id AS page, turn, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
fine AS (SELECT * FROM t WHERE page % 11 <> 3 AND page % 13 <> 5 AND page % 17 <> 4 AND page % 19 <> 6 AND n <= 99),
firsts AS (SELECT page, coalesce(sum(b) OVER (PARTITION BY page % 7 ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM (SELECT page, (max(n) + 2) // 3 AS b FROM fine GROUP BY page))"""


@query(f"""WITH {_SCANNED}
SELECT 'ss_w' || (f.page % 7) || '_ed1_p' || printf('%04d', f.page) || '_s' || printf('%02d', f.i + 1) AS span_id, 'w' || (f.page % 7) || '_b' || printf('%03d', CAST(firsts.first + f.i // 3 + 1 AS BIGINT)) AS batch_id,
       CAST(sum(length(text) + 1) OVER w - length(text) - 1 AS INTEGER) AS start_offset, CAST(sum(length(text) + 1) OVER w - 1 AS INTEGER) AS end_offset, sha256(text) AS glyphs_sha256
FROM fine f JOIN firsts ON firsts.page = f.page WINDOW w AS (PARTITION BY f.page ORDER BY f.i)""")
def structural_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of pages as spans, in batches of three that are numbered through a book, spelled by their glyphs."""
    found, _ = pages.structural_spans(*_scans(spark, sf_dir), batch_lines=3)
    return found.select("span_id", "batch_id", "start_offset", "end_offset", F.sha2(F.array_join(F.transform("anchor.chars", lambda c: c["char"]), ""), 256).alias("glyphs_sha256"))


@query("SELECT conv_id AS page, CASE WHEN conv_id % 11 = 3 THEN 'deferred' WHEN conv_id % 13 = 5 THEN 'unrecognizable_with_lines' WHEN conv_id % 17 = 4 THEN 'unknown_state' WHEN conv_id % 19 = 6 THEN 'no_image' ELSE 'too_many_lines' END AS refusal FROM conversations GROUP BY conv_id HAVING conv_id % 11 = 3 OR conv_id % 13 = 5 AND conv_id % 2 = 0 OR conv_id % 13 <> 5 AND (conv_id % 17 = 4 OR conv_id % 19 = 6 OR count(*) > 99)")
def refused_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.structural_spans(*_scans(spark, sf_dir))[1].select("page", "refusal")


_GOOD = f"WITH {_SCANNED} SELECT count(*) AS n FROM fine WHERE "


@query(f"""SELECT "check", CAST(n AS BIGINT) AS n FROM (
SELECT 'page_accounting' AS "check", (WITH {_SCANNED} SELECT count(DISTINCT page) FROM t WHERE page % 13 <> 5 AND page NOT IN (SELECT page FROM fine) OR page % 13 = 5 AND page % 11 = 3) AS n
UNION ALL SELECT 'concat_equals_block', (WITH {_SCANNED} SELECT count(DISTINCT page) FROM fine WHERE page % 23 = 7 OR page % 31 = 9 AND n > 1)
UNION ALL SELECT 'contiguous_coverage', ({_GOOD} page % 31 = 9 AND n > 1 AND (i = 1))
UNION ALL SELECT 'strict_offset', ({_GOOD} page % 23 = 7 AND (page % 31 <> 9 OR i > 0 OR n = 1))
UNION ALL SELECT 'glyphbox_anchors', ({_GOOD} (page % 23 = 7 OR page % 29 = 8 AND length(text) > 0) AND (page % 31 <> 9 OR i > 0 OR n = 1))
UNION ALL SELECT 'span_identity', (WITH {_SCANNED} SELECT count(DISTINCT page) FROM fine WHERE page % 37 = 10 AND n > CASE WHEN page % 31 = 9 THEN 2 ELSE 1 END)
UNION ALL SELECT 'batch_rules', (WITH {_SCANNED} SELECT count(*) FROM (SELECT page % 7 FROM fine WHERE page % 41 = 11 AND (page % 31 <> 9 OR i > 0 OR n = 1) GROUP BY 1 HAVING count(DISTINCT page) > 1 OR count(*) > 3))
UNION ALL SELECT 'header_counts', (WITH {_SCANNED} SELECT count(DISTINCT page % 7) FROM fine WHERE page % 7 < 3)) WHERE n > 0""")
def structural_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over structural spans of which some were tampered with: texts, anchors, ids, batches, a page's first line left out, and counts."""
    pages_, lines, glyphs = _scans(spark, sf_dir)
    found, _ = pages.structural_spans(pages_, lines, glyphs, batch_lines=3)
    rest = lambda n, r: F.col("page") % n == r
    several = F.count(F.lit(1)).over(Window.partitionBy("page")) > 1
    found = found.withColumn("several", several).where(~(rest(31, 9) & F.col("several") & (F.col("line_index") == 0)))
    found = found.withColumn("text", F.when(rest(23, 7), F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    moved = F.transform("anchor.chars", lambda c: c.withField("glyph_box", c["glyph_box"].withField("y", F.lit(-5.0))))
    found = found.withColumn("anchor", F.when(rest(29, 8), F.col("anchor").withField("chars", moved)).otherwise(F.col("anchor")))
    found = found.withColumn("span_id", F.when(rest(37, 10), F.concat(F.lit("same"), "page")).otherwise(F.col("span_id"))).withColumn("batch_id", F.when(rest(41, 11), "one").otherwise(F.col("batch_id")))
    told = found.groupBy("source_id").agg(F.count(F.lit(1)).alias("n")).select("source_id", (F.col("n") + F.when(F.col("source_id") < "book3", 1).otherwise(0)).alias("n_spans"))
    return pages.structural_gate(found, pages_, lines, glyphs, told, 3).groupBy("check").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH b AS (SELECT event_id, user_id, (event_id * 7919) % 400 AS top, (event_id * 7919) % 400 + event_id % 50 AS bottom, (event_id * 104729) % 300 AS x FROM events),
f AS (SELECT *, max(bottom) OVER (PARTITION BY user_id ORDER BY top, bottom, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM b),
c AS (SELECT *, sum(CASE WHEN top - far >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY top, bottom, event_id ROWS UNBOUNDED PRECEDING) AS band FROM f),
g AS (SELECT *, x - lag(x) OVER (PARTITION BY user_id, band ORDER BY x, event_id) AS step FROM c),
k AS (SELECT *, sum(CASE WHEN step > 30 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, band ORDER BY x, event_id ROWS UNBOUNDED PRECEDING) AS col FROM g),
r AS (SELECT *, max(col) OVER (PARTITION BY user_id, band) - col AS fromright FROM k)
SELECT event_id, CAST(band AS BIGINT) AS band, CAST(fromright AS BIGINT) AS "column", CAST(row_number() OVER (PARTITION BY user_id ORDER BY band, fromright, (top + bottom) / 2.0, event_id) AS INTEGER) AS place FROM r""")
def banded_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as boxes on their user's page: bands, columns from the right, and reading order."""
    top, x = (F.col("event_id") * 7919) % 400, (F.col("event_id") * 104729) % 300
    boxes = table(spark, sf_dir, "events").select("event_id", "user_id", top.alias("top"), (top + F.col("event_id") % 50).alias("bottom"), x.alias("x"))
    placed = pages.banded_order(boxes.withColumn("y", (F.col("top") + F.col("bottom")) / 2), "user_id", "top", "bottom", "x", "y", "event_id", 5)
    return placed.select("event_id", "band", "column", "place")


# Sets, identities and trees.


@query("""WITH w AS (SELECT user_id AS span, event_type || '-' || (event_id * 31 % 97) AS t, event_id % 2 AS side FROM events),
s AS (SELECT DISTINCT span, t, side, list_sort(list_distinct(string_split(replace(t, '-', ''), ''))) AS cs FROM w)
SELECT b.span, b.t FROM s b WHERE b.side = 1 AND NOT EXISTS (SELECT 1 FROM s a WHERE a.side = 0 AND a.span = b.span AND len(list_intersect(a.cs, b.cs)) >= 0.6 * (len(a.cs) + len(b.cs) - len(list_intersect(a.cs, b.cs))))""")
def unmatched_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a user's odd events say that none of the even ones says in much the same letters."""
    said = table(spark, sf_dir, "events").select(F.col("user_id").alias("span"), F.concat_ws("-", "event_type", F.col("event_id") * 31 % 97).alias("t"), (F.col("event_id") % 2).alias("side"))
    return similar.unmatched(said.where("side = 0").select("span", "t"), said.where("side = 1").select("span", "t"), "span", "t").distinct()


@query("""WITH o AS (SELECT o_orderkey AS k FROM orders), m AS (SELECT k, CASE WHEN k % 5 = 0 THEN NULL WHEN k % 3 = 0 THEN k + 10000000 ELSE k END AS one FROM o)
SELECT 'o' || k AS id, CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN NULL WHEN k % 3 = 0 THEN 'o' || (k + 30000000) WHEN k % 11 = 0 THEN 'o' || (k + 20000000) ELSE 'o' || k END AS now,
       CASE WHEN k % 5 = 0 THEN 'lost' WHEN k % 7 = 0 THEN 'split' WHEN k % 3 = 0 OR k % 11 = 0 THEN 'moved' ELSE 'kept' END AS state, CASE WHEN k % 5 = 0 THEN 'r1' WHEN k % 7 = 0 THEN 'r2' END AS release FROM o""")
def remapped_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders over two releases: moved once or twice, lost in the first, split in the second."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    name = lambda k: F.concat(F.lit("o"), k)
    first = o.where("k % 5 = 0 OR k % 3 = 0").select(F.lit("r1").alias("release"), name("k").alias("from_id"), F.when(F.col("k") % 5 != 0, name(F.col("k") + 10000000)).alias("to_id"))
    now = F.when(F.col("k") % 3 == 0, F.col("k") + 10000000).otherwise(F.col("k"))
    split = o.where("k % 5 <> 0 AND k % 7 = 0").select(F.lit("r2").alias("release"), name(now).alias("from_id"), F.explode(F.array(name(now), F.concat(name(now), F.lit("b")))).alias("to_id"))
    again = o.where("k % 5 <> 0 AND k % 7 <> 0 AND (k % 3 = 0 OR k % 11 = 0)").select(F.lit("r2").alias("release"), name(now).alias("from_id"), name(now + 20000000).alias("to_id"))
    return identity.remapped(o.select(name("k").alias("id")), first.unionByName(split).unionByName(again), ["r1", "r2"])


@query("SELECT l_orderkey AS submission_id, 'd' AS source_id, CAST(s AS INTEGER) AS seq, CASE WHEN s <= 5 THEN 'p' || s END AS span_id, CASE WHEN s > 5 THEN 'unknown' WHEN n > 1 THEN 'repeated' END AS problem FROM (SELECT l_orderkey, l_linenumber AS s, count(*) AS n FROM lineitem GROUP BY 1, 2)")
def reselected_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers of orders as numbers of spans, of which there are five."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("submission_id")).agg(F.collect_list(F.col("l_linenumber").cast("int")).alias("seqs")).withColumn("source_id", F.lit("d"))
    known = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").cast("int").alias("seq")).distinct().where("seq <= 5").select(F.lit("d").alias("source_id"), "seq", F.concat(F.lit("p"), "seq").alias("span_id"))
    return identity.reselected(known, lines)


@query("SELECT event_id AS glyph_id, user_id AS page, CASE WHEN event_id % 3 = 0 THEN 'l' || event_id WHEN user_id % 2 = 0 THEN 'p' || user_id END AS span_id, CASE WHEN event_id % 3 = 0 THEN 'line' WHEN user_id % 2 = 0 THEN 'page' END AS found_by FROM events")
def spans_of_glyphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as glyphs: a third of their lines have a span, some belong to another page, and half of the pages have one."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("page"))
    lines = e.where("event_id % 3 < 2").select(F.col("event_id").alias("line_id"), F.when(F.col("event_id") % 3 == 1, -1).otherwise(F.col("page")).alias("page"))
    line_spans = e.where("event_id % 3 < 2").select(F.col("event_id").alias("line_id"), F.concat(F.lit("l"), "event_id").alias("span_id"))
    page_spans = e.where("page % 2 = 0").select("page", F.concat(F.lit("p"), "page").alias("span_id")).distinct()
    return identity.spans_of_glyphs(e.select(F.col("event_id").alias("glyph_id"), "page", F.col("event_id").alias("parent")), lines, line_spans, page_spans)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '$' WHEN o_orderkey % 3 = 0 THEN 'steps[1].result.status' WHEN o_orderkey % 7 = 0 THEN 'steps[0].n' ELSE 'kind' END AS path,
       CASE WHEN o_orderkey % 5 = 0 THEN 'left_only' WHEN o_orderkey % 3 = 0 THEN 'changed' WHEN o_orderkey % 7 = 0 THEN 'right_only' ELSE 'left_only' END AS change
FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0""")
def substitution_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two adapters' outcomes of all orders: the same but for ids and times, and planted differences at three depths."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    k = F.col("o_orderkey")
    shape = '{"run_id": "%s", "kind": "x", "steps": [{"step_id": %d}, {"result": {"status": "%s", "finished_at": %d, "log": []}}]}'
    left = o.select("o_orderkey", F.format_string(shape, F.col("o_custkey").cast("string"), k, "o_orderstatus", k).alias("body"))
    status = F.when(k % 3 == 0, F.concat("o_orderstatus", F.lit("?"))).otherwise(F.col("o_orderstatus"))
    body = F.format_string(shape, F.lit("other"), k + 1, status, k * 2)
    body = F.when((k % 3 != 0) & (k % 7 == 0), F.replace(body, F.lit('"step_id"'), F.lit('"n": 1, "step_id"'))).when((k % 3 != 0) & (k % 11 == 0), F.replace(body, F.lit('"kind": "x", '), F.lit(""))).otherwise(body)
    right = o.where("o_orderkey % 5 <> 0").select("o_orderkey", body.alias("body"))
    return identity.substitution_report(left, right, "o_orderkey", "body").select("o_orderkey", "path", "change")
