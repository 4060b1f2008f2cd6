"""Queries of text operators: cleaning rules, offsets through patches, proposals, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import canonical, scalars, text
from lectern.operators import cleaning, records, spans
from lectern.plans.catalog import query, table

_COUNT = "SELECT doc_id, '{0}' AS kind, CAST(len(regexp_extract_all(text, '{1}')) AS BIGINT) AS n FROM documents WHERE len(regexp_extract_all(text, '{1}')) > 0"


@query(" UNION ALL ".join(_COUNT.format(k, p) for k, p in (
    ("replacement_char", r"[?□\x{FFFD}]"), ("private_use_area", r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]"), ("control_char", r"[\x{200B}\x{200C}\x{200D}\x00-\x08\x0b\x0e-\x1f]"),
    ("escape_residue", r"\\[-\[\]*_\\]"), ("watermark", r"https?://\S+|www\.\S+"), ("suspected_error", "teh"),
)) + " UNION ALL SELECT doc_id, 'variant_mixed', CAST(len(regexp_extract_all(text, '[ß]')) AS BIGINT) FROM documents WHERE contains(text, 'ß') AND contains(text, 's')")
def cleaning_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings by text and kind, of the rules that a pattern defines."""
    kinds = ("replacement_char", "private_use_area", "control_char", "escape_residue", "watermark", "suspected_error", "variant_mixed")
    found = cleaning.findings(table(spark, sf_dir, "documents"), variants={"ß": "s"}, suspects=["teh"], kinds=kinds)
    return found.groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(r"""WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents
), o AS (
  SELECT doc_id, line, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS raw_start,
         count(*) OVER (PARTITION BY doc_id, trim(line)) AS n FROM l
) SELECT doc_id, raw_start, CAST(raw_start + length(line) AS INTEGER) AS raw_end, line AS excerpt FROM o WHERE n >= 3 AND length(trim(line)) BETWEEN 2 AND 40""")
def running_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of lines that come three times or more in a text."""
    found = cleaning.findings(table(spark, sf_dir, "documents"), kinds=["header_footer"])
    return found.select("doc_id", "raw_start", "raw_end", "excerpt")


@query("SELECT CAST(place AS INTEGER) AS place, kind FROM (VALUES (0,'encoding_issue'),(1,'replacement_char'),(2,'private_use_area'),(3,'control_char'),(4,'escape_residue'),(5,'watermark'),(6,'header_footer'),(7,'duplicate'),(8,'missing'),(9,'textualized_diagram'),(10,'suspected_error'),(11,'variant_mixed')) t(place, kind)")
def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report has every kind in the fixed order, found or not."""
    return cleaning.report(cleaning.findings(table(spark, sf_dir, "documents"))).select("place", "kind")


@query("SELECT 'excerpt' AS \"check\", CAST(doc_id AS VARCHAR) AS subject FROM documents WHERE text LIKE '%http%' AND doc_id % 7 = 0 AND regexp_matches(text, 'https?://\\S+') UNION ALL SELECT 'replay', CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 11 = 0")
def cleaning_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over links, with excerpts of every seventh text and cleaned texts of every eleventh tampered with."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    links = cleaning.findings(docs, kinds=["watermark"]).withColumn("finding_id", F.col("doc_id").cast("string"))
    told = links.withColumn("excerpt", F.when(F.col("doc_id") % 7 == 0, F.lit("tampered")).otherwise(F.col("excerpt")))
    done = spans.apply_patches(docs, spans.patches_from(links.select("doc_id", "raw_start", "raw_end", "replacement"))).withColumn("cleaned", F.when(F.col("doc_id") % 11 == 0, F.concat("cleaned", F.lit("!"))).otherwise(F.col("cleaned")))
    summary = links.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    none = links.limit(0).select("finding_id")
    return cleaning.gate(docs, told, done, none, summary).select("check", "subject").distinct()


_PATCHES = """docs AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) >= 60), pos AS (SELECT doc_id, n, unnest([0, 5, 10, 12, 15, 20, 21, 30, 31, 40, 45, n]) AS p FROM docs)"""


def _patched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with three patches: [10, 20) becomes 4 characters, two are inserted at 30, [40, 45) goes."""
    docs = table(spark, sf_dir, "documents").where("length(text) >= 60").select("doc_id", "text")
    patch = lambda a, b, r: F.struct(F.lit(a).alias("raw_start"), F.lit(b).alias("raw_end"), F.lit(r).alias("replacement"))
    rows = docs.select("doc_id", F.explode(F.array(patch(10, 20, "abcd"), patch(30, 30, "xy"), patch(40, 45, ""))).alias("p")).select("doc_id", "p.*")
    folded = spans.patches_from(rows).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("raw_start", "raw_end", "cleaned_start", "cleaned_end"))).alias("patches"))
    return docs.join(folded, "doc_id")


@query(f"""WITH {_PATCHES} SELECT doc_id, p AS position, CAST(CASE WHEN p <= 10 THEN p WHEN p < 20 THEN 10 + round_even((p - 10) * 0.4, 0) WHEN p = 20 THEN 14 WHEN p < 30 THEN p - 6 WHEN p = 30 THEN 26 WHEN p < 40 THEN p - 4 WHEN p <= 45 THEN 36 ELSE p - 9 END AS INTEGER) AS as_start,
CAST(CASE WHEN p <= 10 THEN p WHEN p < 20 THEN 10 + round_even((p - 10) * 0.4, 0) WHEN p = 20 THEN 14 WHEN p <= 30 THEN p - 6 WHEN p < 40 THEN p - 4 WHEN p <= 45 THEN 36 ELSE p - 9 END AS INTEGER) AS as_end FROM pos""")
def raw_to_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw positions before, in, between and behind patches, moved as starts and as ends of intervals."""
    at = _patched(spark, sf_dir).select("doc_id", "patches", F.explode(F.array(*(F.lit(x) for x in (0, 5, 10, 12, 15, 20, 21, 30, 31, 40, 45)), F.length("text"))).alias("position"))
    return at.select("doc_id", "position", spans.map_position(F.col("position"), F.col("patches")).alias("as_start"), spans.map_position(F.col("position"), F.col("patches"), True).alias("as_end"))


@query(f"""WITH {_PATCHES}, c AS (SELECT doc_id, unnest([0, 10, 12, 14, 20, 24, 25, 26, 30, 36, 37, n - 9]) AS p FROM docs)
SELECT doc_id, p AS position, CAST(CASE WHEN p <= 10 THEN p WHEN p < 14 THEN 10 + round_even((p - 10) * 2.5, 0) WHEN p < 24 THEN p + 6 WHEN p <= 26 THEN 30 WHEN p < 36 THEN p + 4 WHEN p = 36 THEN 45 ELSE p + 9 END AS INTEGER) AS as_start,
CAST(CASE WHEN p <= 10 THEN p WHEN p < 14 THEN 10 + round_even((p - 10) * 2.5, 0) WHEN p < 24 THEN p + 6 WHEN p <= 26 THEN 30 WHEN p <= 36 THEN p + 4 ELSE p + 9 END AS INTEGER) AS as_end FROM c""")
def cleaned_to_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _patched(spark, sf_dir).select("doc_id", "patches", F.explode(F.array(*(F.lit(x) for x in (0, 10, 12, 14, 20, 24, 25, 26, 30, 36, 37)), F.length("text") - 9)).alias("position"))
    return at.select("doc_id", "position", spans.map_position_back(F.col("position"), F.col("patches")).alias("as_start"), spans.map_position_back(F.col("position"), F.col("patches"), True).alias("as_end"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN 'quote_differs' WHEN 2 THEN 'forward_differs' WHEN 3 THEN 'out_of_range' WHEN 4 THEN 'no_anchor' END AS problem FROM documents WHERE length(text) >= 60")
def anchor_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors of the first fourteen cleaned characters, four in five of them spoilt in one way each."""
    rows = _patched(spark, sf_dir).withColumn("cleaned", F.concat(F.substring("text", 1, 10), F.lit("abcd"), F.substring("text", 21, 10), F.lit("xy"), F.substring("text", 31, 10), F.expr("substring(text, 46)")))
    rows = rows.withColumns({"start_offset": F.lit(0), "end_offset": F.lit(14)}).withColumn("segment", F.substring("cleaned", 1, 14))
    made = spans.anchor_of(rows, F.lit("rev_raw"), F.lit("rev_cleaned"))
    kind = F.pmod(F.col("doc_id"), F.lit(5))
    bad = (
        F.when(kind == 1, F.col("anchor").withField("quote_sha256", F.lit("0"))).when(kind == 2, F.col("anchor").withField("raw_end", F.lit(25)))
        .when(kind == 3, F.col("anchor").withField("end_offset", F.lit(1 << 30))).when(kind == 4, None).otherwise(F.col("anchor"))
    )
    return made.select("doc_id", spans.anchor_problem(bad, F.col("cleaned"), F.col("patches")).alias("problem"))


_CASES = "conv_id * 7 + turn"
_ERRORS = "CASE (conv_id * 7 + turn) % 10 WHEN 1 THEN 'json' WHEN 2 THEN 'shape' WHEN 3 THEN 'empty' WHEN 4 THEN 'type' WHEN 5 THEN 'range' WHEN 6 THEN 'coverage' WHEN 7 THEN 'gap' WHEN 8 THEN 'overlap' WHEN 9 THEN 'coverage' END"


def _proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of ten characters or more, each with a proposal of one kind of the ten."""
    turns = table(spark, sf_dir, "conversations").where("length(text) >= 10").withColumn("n", F.length("text"))
    form = lambda a, b, c, d: F.format_string('{"segments": [{"start_offset": %s, "end_offset": %s, "text": "x"}, {"start_offset": %s, "end_offset": %s}]}', *(x.cast("string") for x in (a, b, c, d)))
    zero, five, n, lit = F.lit(0), F.lit(5), F.col("n"), F.lit
    case = F.pmod(F.expr(_CASES), lit(10))
    response = (
        F.when(case == 1, "{not json").when(case == 2, '{"segments": 5}').when(case == 3, '{"segments": []}').when(case == 4, form(zero, lit("5.5"), five, n)).when(case == 5, form(zero, five, five, n + 1))
        .when(case == 6, form(lit(1), five, five, n)).when(case == 7, form(zero, five, lit(6), n)).when(case == 8, form(zero, five, lit(4), n)).when(case == 9, form(zero, five, five, n - 1)).otherwise(form(zero, five, five, n))
    )
    return turns.withColumn("response", response)


@query(f"SELECT conv_id, turn, {_ERRORS} AS error, CASE WHEN (conv_id * 7 + turn) % 10 = 0 THEN 2 END AS n_segments FROM conversations WHERE length(text) >= 10")
def proposal_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _proposals(spark, sf_dir).withColumn("p", spans.parsed_proposal(F.col("response"), F.col("n")))
    return parsed.select("conv_id", "turn", "p.error", F.when(F.col("p.segments").isNotNull(), F.size("p.segments")).alias("n_segments"))


_OUTCOME = "CASE WHEN (conv_id * 7 + turn) % 10 <> 0 THEN 'proposal_invalid' WHEN turn % 2 = 1 THEN 'boundary_mismatch' END"


@query(f"SELECT conv_id, turn, CASE WHEN {_OUTCOME} IS NULL THEN 'agreed' ELSE 'disputed' END AS status, {_OUTCOME} AS reason FROM conversations WHERE length(text) >= 10")
def proposal_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each proposal against one that cuts at 5, or for odd turns at 4."""
    other = F.when(F.col("turn") % 2 == 1, 4).otherwise(5)
    rows = _proposals(spark, sf_dir).withColumns({"a": spans.parsed_proposal(F.col("response"), F.col("n")), "b": spans.parsed_proposal(F.format_string('{"segments": [{"start_offset": 0, "end_offset": %d}, {"start_offset": %d, "end_offset": %d}]}', other, other, F.col("n")), F.col("n"))})
    return rows.withColumn("c", spans.compared_proposals(F.col("a"), F.col("b"))).select("conv_id", "turn", "c.status", "c.reason")


@query(f"""WITH t AS (SELECT conv_id, turn, text, conv_id * 1000 + turn AS window_id, CASE WHEN {_OUTCOME} IS NULL THEN 'agreed' WHEN turn % 3 = 0 THEN 'ruled' ELSE 'untouched' END AS origin FROM conversations WHERE length(text) >= 10)
SELECT window_id, 0 AS seq, 100 AS start_offset, CAST(100 + CASE origin WHEN 'agreed' THEN 5 WHEN 'ruled' THEN 3 ELSE length(text) END AS INTEGER) AS end_offset, substr(text, 1, CASE origin WHEN 'agreed' THEN 5 WHEN 'ruled' THEN 3 ELSE length(text) END) AS segment, origin FROM t
UNION ALL SELECT window_id, 1, CAST(100 + CASE origin WHEN 'agreed' THEN 5 ELSE 3 END AS INTEGER), CAST(100 + length(text) AS INTEGER), substr(text, CASE origin WHEN 'agreed' THEN 6 ELSE 4 END), origin FROM t WHERE origin <> 'untouched'""")
def semantic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows cut by agreement, by a ruling at 3 for every third turn, or left whole."""
    other = F.when(F.col("turn") % 2 == 1, 4).otherwise(5)
    rows = _proposals(spark, sf_dir).withColumns({"a": spans.parsed_proposal(F.col("response"), F.col("n")), "b": spans.parsed_proposal(F.format_string('{"segments": [{"start_offset": 0, "end_offset": %d}, {"start_offset": %d, "end_offset": %d}]}', other, other, F.col("n")), F.col("n"))})
    rows = rows.withColumns({"outcome": spans.compared_proposals(F.col("a"), F.col("b")), "window_id": F.expr("conv_id * 1000 + turn"), "start_offset": F.lit(100)})
    long = lambda c: c.cast("long")
    rulings = rows.where("turn % 3 = 0").select("window_id", F.array(F.struct(long(F.lit(0)).alias("start"), long(F.lit(3)).alias("stop")), F.struct(long(F.lit(3)).alias("start"), long(F.col("n")).alias("stop"))).alias("segments"))
    out = spans.assembled_spans(rows, rulings)
    return out.select("window_id", "seq", F.col("start_offset").cast("int").alias("start_offset"), F.col("end_offset").cast("int").alias("end_offset"), "segment", "origin")


@query("SELECT conv_id, sha256(string_agg(coalesce(text, ''), chr(10) ORDER BY turn, text)) AS block_sha256 FROM conversations GROUP BY conv_id")
def page_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.page_blocks(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text").select("conv_id", F.sha2("block", 256).alias("block_sha256"))


@query("SELECT doc_id, CAST(CASE WHEN doc_id % 2 = 1 AND strpos(text, 'e') > 0 THEN strpos(text, 'e') - 1 END AS INTEGER) AS at FROM documents")
def first_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("u", F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.replace("text", F.lit("e"), F.lit("E"))))
    return docs.select("doc_id", text.first_difference(F.col("text"), F.col("u")).alias("at"))


@query("SELECT id, is_span, kind, work, page FROM (SELECT CASE o_orderkey % 6 WHEN 0 THEN 'ss_work' || o_custkey || '_ed01_p' || lpad(CAST(o_custkey % 9999 AS VARCHAR), 4, '0') || '_s01' WHEN 1 THEN 'co_shared_x_01' WHEN 2 THEN 'co_x_000001' WHEN 3 THEN 'prun_1' WHEN 4 THEN 'ss_bad_id' ELSE 'zz_1' END AS id, o_orderkey % 6 = 0 AS is_span, CASE o_orderkey % 6 WHEN 0 THEN 'source_span_id' WHEN 1 THEN 'shared_concept_id' WHEN 2 THEN 'technique_concept_id' WHEN 3 THEN 'processing_run_id' WHEN 4 THEN 'source_span_id' END AS kind, CASE WHEN o_orderkey % 6 = 0 THEN 'work' || o_custkey END AS work, CASE WHEN o_orderkey % 6 = 0 THEN CAST(o_custkey % 9999 AS INTEGER) END AS page FROM orders)")
def id_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("o_orderkey") % 6
    span = F.concat(F.lit("ss_work"), "o_custkey", F.lit("_ed01_p"), F.lpad((F.col("o_custkey") % 9999).cast("string"), 4, "0"), F.lit("_s01"))
    value = F.when(kind == 0, span).when(kind == 1, "co_shared_x_01").when(kind == 2, "co_x_000001").when(kind == 3, "prun_1").when(kind == 4, "ss_bad_id").otherwise("zz_1")
    rows = table(spark, sf_dir, "orders").select(value.alias("id"))
    i = F.col("id")
    return rows.select("id", scalars.is_id("source_span_id", i).alias("is_span"), scalars.id_kind(i).alias("kind"), scalars.id_part(i, "work").alias("work"), scalars.id_part(i, "page").alias("page"))


@query(r"SELECT doc_id, length(regexp_replace(text, '\s+', '', 'g')) AS bare, CAST(len(regexp_extract_all(text, '\pP')) AS INTEGER) AS marks, sha256(regexp_replace(text, '[^a-zA-Z0-9 ]', '', 'g')) AS allowed_sha256, CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' ELSE 'other' END AS language FROM documents")
def text_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(scalars.without_space(t)).alias("bare"), scalars.punctuation_count(t).alias("marks"), F.sha2(scalars.allowed_only(t, ["a-z", "A-Z", "0-9 "]), 256).alias("allowed_sha256"), scalars.mapped(F.col("lang"), {"en": "English", "de": "German"}, "other").alias("language"),
    )


@query("SELECT p_partkey, sha256('4:part' || CASE WHEN p_size % 2 = 0 THEN strlen(p_name) || ':' || p_name ELSE '-1:' END || strlen(p_brand) || ':' || p_brand) AS joined, CASE WHEN p_name <> p_brand AND p_size % 3 <> 0 THEN sha256('3:set2|' || list_aggregate(list_transform(list_sort([p_name, p_brand]), lambda x: strlen(x) || ':' || x), 'string_agg', '')) END AS of_set, sha256(p_name || ':' || p_size) AS token FROM part")
def domain_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length-prefixed hashes; a null part differs from an empty one, a set with a repeated entry has none."""
    items = F.when(F.col("p_size") % 3 == 0, F.array("p_name", "p_name")).otherwise(F.array("p_name", "p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", scalars.joined_hash("part", F.when(F.col("p_size") % 2 == 0, F.col("p_name")), F.col("p_brand")).alias("joined"), scalars.set_hash("set", items).alias("of_set"), scalars.token_hash(F.col("p_name"), F.col("p_size")).alias("token"))


@query(r"SELECT conv_id, turn, list_sort(list_distinct(string_split(lower(text), ' '))) AS words, CASE WHEN text = '' THEN '□' ELSE coalesce(substr(text, 1, 1), '□') END AS shown, substr(replace(text, chr(10), ' '), greatest(6 - 3, 0) + 1, 9 + 3 - 3) AS context FROM conversations")
def array_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", scalars.sorted_set(F.split(F.lower("text"), " ")).alias("words"), scalars.shown(F.substring("text", 1, 1)).alias("shown"), records.context(F.col("text"), F.lit(6), F.lit(9), 3).alias("context"))


@query("SELECT doc_id, nfc_normalize(trim(text, ' ')) = trim(text, ' ') AS composed FROM documents WHERE regexp_full_match(text, '(?s)[^\\s].*[^\\s]')")
def nfc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where(F.col("text").rlike(r"(?s)\A[^\s].*[^\s]\z"))
    return docs.select("doc_id", (text.nfc(F.col("text")) == F.trim("text")).alias("composed"))


@query()
def canonical_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical JSON hashes of the events' properties."""
    return table(spark, sf_dir, "events").select("event_id", canonical.canonical_hash(F.col("props")).alias("hash"))
