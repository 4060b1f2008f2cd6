"""Validators with named codes; each gives rows (check, subject, detail), and uses nothing of the producers' modules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rows(df: DataFrame, check: str, subject: Column, detail: Column | None = None) -> DataFrame:
    return df.select(F.lit(check).alias("check"), subject.cast("string").alias("subject"), (F.lit("") if detail is None else F.coalesce(detail.cast("string"), F.lit(""))).alias("detail"))


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def segment_checks(segments: DataFrame, sources: DataFrame, doc: str = "doc_id", kind: str = "B") -> DataFrame:
    """Segments (doc, seq, seg_id, text, note) against their sources (doc, text).

    SEG_001 joined segments differ from the source, white space apart; SEG_002 (kind A) ends in a comma; SEG_003 wrong running id; SEG_004 empty text or note; SEG_005 (kind B) more than 300 characters;
    SEG_006 five or more equal notes in a row; SEG_007 brackets.
    """
    order = Window.partitionBy(doc).orderBy("seq")
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", "")
    name = F.concat_ws("/", F.col(doc), "seg_id")
    seg = segments.withColumn("_due", F.row_number().over(order))
    due = F.concat(F.lit("s"), F.lpad(F.col("_due").cast("string"), F.greatest(F.lit(2), F.length(F.col("_due").cast("string"))), F.lit("0")))
    ordered = F.sort_array(F.collect_list(F.struct("seq", bare(F.col("text")).alias("t"))))
    joined = segments.groupBy(doc).agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["t"]), ""), 256).alias("_have"))
    told = sources.select(doc, F.sha2(bare(F.col("text")), 256).alias("_told"), (F.length(bare(F.col("text"))) == 0).alias("_empty"))
    cover = told.join(joined, doc, "left").where(F.when(F.col("_have").isNull(), ~F.col("_empty")).otherwise(F.col("_have") != F.col("_told")))
    empty = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    runs = seg.where(~empty("note")).withColumn("_run", F.col("_due") - F.row_number().over(Window.partitionBy(doc, "note").orderBy("seq"))).groupBy(doc, "note", "_run").agg(F.count(F.lit(1)).alias("n"), F.min("_due").alias("first")).where("n >= 5")
    checks = [
        _rows(cover, "SEG_001", F.col(doc)),
        _rows(seg.where(~F.coalesce(F.col("seg_id") == due, F.lit(False))), "SEG_003", F.concat_ws("/", F.col(doc), "_due"), due),
        _rows(seg.where(empty("text")), "SEG_004", name, F.lit("text")), _rows(seg.where(empty("note")), "SEG_004", name, F.lit("note")),
        _rows(runs, "SEG_006", F.concat_ws("/", F.col(doc), "first"), F.col("n")), _rows(seg.where(F.col("text").rlike(r"[()（）\[\]【】]")), "SEG_007", name),
    ]
    if kind == "A":
        checks.append(_rows(seg.where(F.rtrim("text").rlike("[，、；]$")), "SEG_002", name))
    if kind == "B":
        checks.append(_rows(seg.where(F.length(bare(F.col("text"))) > 300), "SEG_005", name, F.length(bare(F.col("text")))))
    return _all(checks)


def offset_gate(spans: DataFrame, texts: DataFrame, doc: str, level: str, told_count: DataFrame) -> DataFrame:
    """Offset spans (doc, span_id, start_offset, end_offset, text, quote_sha256, evidence_level) against their texts.

    ``contiguous``: no gap nor overlap from 0 to the end; ``strict_offset``: the slice is the text; ``quote_hash``; ``identity``: ids once each; ``evidence_level``; ``header_counts``: as many spans as told (doc, n).
    """
    order = Window.partitionBy(doc).orderBy("start_offset", "end_offset")
    far = F.coalesce(F.max("end_offset").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = spans.join(texts.select(doc, F.col("text").alias("_whole")), doc, "left")
    steps = spans.withColumn("_far", far).where(F.col("start_offset") != F.col("_far"))
    ends = texts.select(doc, F.length(F.coalesce("text", F.lit(""))).alias("_n")).join(spans.groupBy(doc).agg(F.max("end_offset").alias("_last")), doc, "left").where(F.coalesce("_last", F.lit(0)) != F.col("_n"))
    slice_is = F.substring("_whole", F.col("start_offset") + 1, F.col("end_offset") - F.col("start_offset")) == F.col("text")
    counts = spans.groupBy(doc).agg(F.count(F.lit(1)).alias("_have")).join(told_count.select(doc, F.col("n").alias("_told")), doc, "full").where(F.coalesce("_have", F.lit(0)) != F.coalesce("_told", F.lit(0)))
    name = F.col("span_id")
    return _all([
        _rows(steps, "contiguous", name, F.col("start_offset") - F.col("_far")), _rows(ends, "contiguous", F.col(doc), F.col("_n")),
        _rows(joined.where(~F.coalesce(slice_is, F.lit(False))), "strict_offset", name), _rows(spans.where(~F.coalesce(F.sha2("text", 256) == F.col("quote_sha256"), F.lit(False))), "quote_hash", name),
        _rows(spans.groupBy("span_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "identity", name, F.col("n")),
        _rows(spans.where(~F.coalesce(F.col("evidence_level") == level, F.lit(False))), "evidence_level", name, F.col("evidence_level")), _rows(counts, "header_counts", F.col(doc), F.col("_have")),
    ])


def evidence_gate(assertions: DataFrame, evidence: DataFrame, spans: DataFrame, ceiling: Sequence[str]) -> DataFrame:
    """Assertions (assertion_id, status), evidence (assertion_id, span_id, quote) and spans (span_id, text).

    ``evidence_required``; ``references``: evidence names known spans and assertions; ``strict_quote``: the quote stands in its span; ``status_ceiling``: statuses beyond machine work; ``identity``.
    """
    known = evidence.join(spans.select("span_id", F.col("text").alias("_t")), "span_id", "left")
    return _all([
        _rows(assertions.join(evidence.select("assertion_id"), "assertion_id", "left_anti"), "evidence_required", F.col("assertion_id")),
        _rows(known.where("_t IS NULL"), "references", F.col("assertion_id"), F.col("span_id")),
        _rows(evidence.join(assertions.select("assertion_id"), "assertion_id", "left_anti"), "references", F.col("assertion_id"), F.lit("assertion")),
        _rows(known.where(F.col("_t").isNotNull() & ~F.coalesce(F.contains("_t", F.col("quote")) & (F.col("quote") != ""), F.lit(False))), "strict_quote", F.col("assertion_id"), F.col("span_id")),
        _rows(assertions.where(~F.coalesce(F.col("status").isin(*ceiling), F.lit(False))), "status_ceiling", F.col("assertion_id"), F.col("status")),
        _rows(assertions.groupBy("assertion_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "identity", F.col("assertion_id"), F.col("n")),
    ])


def coverage_checks(outline: DataFrame, batches: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """COV_001 outline nodes in no batch, COV_002 batch entries that the outline lacks, COV_003 batch entries without a file."""
    o, b, f = (x.select(key).distinct() for x in (outline, batches, files))
    return _all([_rows(o.join(b, key, "left_anti"), "COV_001", F.col(key)), _rows(b.join(o, key, "left_anti"), "COV_002", F.col(key)), _rows(b.join(f, key, "left_anti"), "COV_003", F.col(key))])


def extraction_checks(spans: DataFrame, assertions: DataFrame, skipped: DataFrame, span: str, ratio: float, cases: str) -> DataFrame:
    """EXT_001 spans neither asserted nor skipped, EXT_002 marked cases without an assertion, EXT_003 too few assertions by span, for the whole table."""
    open_spans = spans.join(assertions.select(span), span, "left_anti")
    counts = spans.agg(F.count(F.lit(1)).alias("s")).crossJoin(assertions.agg(F.count(F.lit(1)).alias("a")))  # a row each
    return _all([
        _rows(open_spans.join(skipped.select(span), span, "left_anti"), "EXT_001", F.col(span)), _rows(open_spans.where(F.coalesce(cases, F.lit(False))), "EXT_002", F.col(span)),
        _rows(counts.where((F.col("s") > 0) & (F.col("a") / F.col("s") < ratio)), "EXT_003", F.lit("all"), F.col("a")),
    ])


def closed_set_checks(items: DataFrame, key: str, pattern: str, kind: str, kinds: Sequence[str], refs: DataFrame, ref: str) -> DataFrame:
    """CAN_001 ids of another form, CAN_002 repeated ids, CAN_003 unknown kinds, CAN_004 references to no item."""
    return _all([
        _rows(items.where(~F.coalesce(F.col(key).rlike(pattern), F.lit(False))), "CAN_001", F.col(key)), _rows(items.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "CAN_002", F.col(key), F.col("n")),
        _rows(items.where(~F.coalesce(F.col(kind).isin(*kinds), F.lit(False))), "CAN_003", F.col(key), F.col(kind)), _rows(refs.where(F.col(ref).isNotNull()).join(items.select(F.col(key).alias(ref)), ref, "left_anti"), "CAN_004", F.col(ref)),
    ])


def surface_checks(concepts: DataFrame, spans: DataFrame, key: str, surface: str, refs: str, span: str, text_col: str) -> DataFrame:
    """CON_001 no span named, CON_002 a named span is unknown, CON_003 the surface isn't in a named span."""
    each = concepts.select(key, surface, F.explode(refs).alias(span)).join(spans.select(span, F.col(text_col).alias("_t")), span, "left")
    return _all([
        _rows(concepts.where(F.coalesce(F.size(refs), F.lit(0)) <= 0), "CON_001", F.col(key)), _rows(each.where("_t IS NULL"), "CON_002", F.col(key), F.col(span)),
        _rows(each.where(F.col("_t").isNotNull() & ~F.coalesce(F.contains("_t", F.col(surface)), F.lit(False))), "CON_003", F.col(key), F.col(span)),
    ])


def paraphrase_checks(paraphrases: DataFrame, spans: DataFrame, span: str, original: str, text_col: str) -> DataFrame:
    """PAR_001 spans without a paraphrase, PAR_002 paraphrases of unknown spans, PAR_003 originals that differ beyond white space, PAR_004 empty paraphrases."""
    squeezed = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    joined = paraphrases.join(spans.select(span, F.col(text_col).alias("_t")), span, "left")
    return _all([
        _rows(spans.join(paraphrases.select(span), span, "left_anti"), "PAR_001", F.col(span)), _rows(joined.where("_t IS NULL"), "PAR_002", F.col(span)),
        _rows(joined.where(F.col("_t").isNotNull() & ~squeezed(F.col(original)).eqNullSafe(squeezed(F.col("_t")))), "PAR_003", F.col(span)), _rows(joined.where(F.trim(F.coalesce("paraphrase", F.lit(""))) == ""), "PAR_004", F.col(span)),
    ])


def admission(levels: DataFrame, key: str, requirements: Sequence[tuple[str, Column]]) -> DataFrame:
    """Whether each row meets all requirements, and the names of those it doesn't; unknown outcomes don't."""
    unmet = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in requirements)))
    return levels.select(key, unmet.alias("unmet"), (F.size(unmet) == 0).alias("admitted"))


def publication_gate(checks: DataFrame, names: Sequence[tuple[str, Sequence[str]]], level: str) -> DataFrame:
    """A closed list of checks with the evidence levels that they apply to: ``not_applicable``, ``passed`` or ``failed`` with the number of failures. A check that isn't in the list fails the row ``unknown_check``."""
    spark = checks.sparkSession
    listed = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.lit(level in ls).alias("applies")) for n, ls in names))).alias("c")).select("c.*")
    counts = checks.groupBy("check").agg(F.count(F.lit(1)).alias("n"))
    known = listed.join(counts, "check", "left").select("check", F.when(~F.col("applies"), "not_applicable").when(F.col("n").isNull(), "passed").otherwise("failed").alias("verdict"), F.when(F.col("applies"), F.coalesce("n", F.lit(0))).otherwise(0).alias("failures"))
    return known.unionByName(counts.join(listed, "check", "left_anti").agg(F.sum("n").alias("failures")).where("failures IS NOT NULL").select(F.lit("unknown_check").alias("check"), F.lit("failed").alias("verdict"), "failures"))
