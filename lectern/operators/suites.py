"""Suites of validators: a fixed order of named checks, each table looked at once.

A check is a predicate over a row of a joined table. All checks of a table are evaluated in one scan: each row gives an array of what it
fails, and that array is exploded, so another check costs an expression and not another pass. A suite folds the rows of all its
scans into one line for each check, in the registered order: how often it failed, its code, and whether what it depends on let it count.

Suites recompute everything from the tables that they are given, and use nothing of the producers' modules.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Check(NamedTuple):
    """A name and when a row fails it; an unknown outcome fails."""

    name: str
    wrong: Column
    detail: Column | None = None


class Validator(NamedTuple):
    """A validator's id, its gate, its checks with their codes (None: there is no code for it), and validators that have to pass before it counts."""

    name: str
    gate: str
    checks: tuple[tuple[str, str | None], ...]
    needs: tuple[str, ...] = ()


# The validators in their order, their checks, and the codes that checks report.
VALIDATORS = (
    Validator("g1_frozen_bytes", "G1", (("object_missing", "SRC_001"), ("hash_mismatch", "SRC_003"))),
    Validator("g1_page_registry", "G1", (("page_set_mismatch", "REF_001"), ("page_hash_mismatch", "SRC_003"), ("terminal_state_mismatch", "REF_001"))),
    Validator("g1_content_hashes", "G1", (("content_sha256_mismatch", "SRC_003"), ("spans_revision_mismatch", "REF_001"), ("source_asset_mismatch", "SRC_003"))),
    Validator("g1_unresolved_chars", "G1", (("forbidden_char_in_text", "TXT_001"), ("known_unresolvable_char_disclosed", None), ("unresolved_glyph", "SRC_001"), ("unproofread_glyphs", None))),
    Validator("g1_replay", "G1", (("replay_tool_mismatch", None), ("replay_bytes_mismatch", "SRC_003"))),
    Validator("g2_page_accounting", "G2", (("page_missing", "REF_001"), ("page_unregistered", "REF_001"), ("page_without_span", "SRC_001"), ("page_deferred", "REF_001"), ("excluded_page_no_evidence", "SEM_001"))),
    Validator("g2_contiguous_coverage", "G2", (("coverage_gap", "TXT_001"), ("coverage_overlap", "TXT_001"), ("span_text_mismatch", "TXT_001"), ("span_boundary_mismatch", "TXT_001"))),
    Validator("g2_batch_partition", "G2", (("batch_span_leak", "REF_001"), ("batch_span_duplicate", "ID_002"), ("batch_cross_page", "ID_002"), ("batch_oversize", "SCH_002"))),
    Validator("g2_count_reconciliation", "G2", (("count_mismatch", None),)),
    Validator("g3_span_identity", "G3", (("span_id_format", "ID_001"), ("span_id_duplicate", "ID_002"), ("page_line_mismatch", "REF_001"), ("anchor_offset_mismatch", "REF_001"), ("source_id_mismatch", "REF_001"), ("content_status_invalid", "SCH_002"))),
    Validator("g3_references", "G3", (("dangling_ref", "REF_001"), ("not_consumable", "REF_001"), ("ref_type_mismatch", "REF_001"))),
    Validator("g3_strict_offset_quote", "G3", (("offset_out_of_range", "TXT_001"), ("offset_mismatch", "TXT_001"), ("quote_hash_mismatch", "TXT_001"), ("quote_hash_not_stored", "SCH_001"), ("anchor_revision_mismatch", "REF_001"), ("raw_anchor_mismatch", "TXT_001"))),
    Validator("g3_glyphbox_anchor", "G3", (("page_image_hash_mismatch", "SRC_003"), ("line_box_mismatch", "TXT_001"), ("glyph_box_mismatch", "TXT_001"), ("anchor_out_of_page", "TXT_001"), ("anchor_field_missing", "SCH_001"), ("glyph_text_misaligned", "TXT_001"))),
    Validator("g3_evidence_level", "G3", (("evidence_level_insufficient", "SEM_001"), ("glyphbox_incomplete", "SCH_001"), ("evidence_level_invalid", "SCH_002"))),
)
#: What is only told, and fails nothing.
WARNINGS = ("known_unresolvable_char_disclosed", "unproofread_glyphs")
STATUSES = ("draft", "reviewed", "final")
#: Levels of evidence from weak to strong, with whether each needs boxes of glyphs.
LEVELS = {"offset": False, "line": False, "glyph": True}
STATES = ("covered", "excluded", "deferred")


def scanned(df: DataFrame, subject: Column, checks: Sequence[Check]) -> DataFrame:
    """What the rows of a table fail: (check, subject, detail), from one scan however many checks there are."""
    told = lambda c: F.struct(F.lit(c.name).alias("check"), F.coalesce((F.lit("") if c.detail is None else c.detail).cast("string"), F.lit("")).alias("detail"))
    failed = F.array_compact(F.array(*(F.when(F.coalesce(c.wrong, F.lit(True)), told(c)) for c in checks)))
    return df.select(subject.cast("string").alias("subject"), F.explode(failed).alias("_f")).select("_f.check", "subject", "_f.detail")


def suite_report(rows: DataFrame, validators: Sequence[Validator] = VALIDATORS, gates: Sequence[str] | None = None, warnings: Sequence[str] = WARNINGS) -> DataFrame:
    """One line for each registered check, in order: place, gate, validator, check, code, n, state.

    ``passed``, ``failed``, ``told`` (a warning), or ``blocked``: a validator that this one needs has failed, so that its own result says nothing.
    Rows with an unregistered check fail the line ``unregistered``, which comes last.
    """
    spark = rows.sparkSession
    listed = [(v, c, code) for v in validators if gates is None or v.gate in gates for c, code in v.checks]
    lines = [F.struct(F.lit(i).alias("place"), F.lit(v.gate).alias("gate"), F.lit(v.name).alias("validator"), F.lit(c).alias("check"), F.lit(code).cast("string").alias("code"), F.array(*(F.lit(n) for n in v.needs)).cast("array<string>").alias("needs")) for i, (v, c, code) in enumerate(listed)]
    table = spark.range(1).select(F.inline(F.array(*lines)))
    counts = rows.groupBy("check").agg(F.count(F.lit(1)).alias("n"))
    known = table.join(counts, "check", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    known = known.withColumn("_bad", (F.col("n") > 0) & ~F.col("check").isin(*warnings))
    # A validator that is blocked blocks those that need it in turn: the chain is as long as the registry at most.
    bad = F.sort_array(F.collect_set(F.when(F.col("_bad"), F.col("validator"))).over(Window.partitionBy(F.lit(0)))) if any(v.needs for v in validators) else F.array().cast("array<string>")
    known = known.withColumn("_blocked", F.size(F.array_intersect(_all_needs(validators), bad)) > 0)
    state = F.when(F.col("_blocked"), "blocked").when(F.col("_bad"), "failed").when(F.col("n") > 0, "told").otherwise("passed")
    out = known.select("place", "gate", "validator", "check", "code", "n", state.alias("state"))
    extra = counts.join(table.select("check"), "check", "left_anti").agg(F.sum("n").alias("n")).where("n IS NOT NULL")
    none = F.lit(None).cast("string")
    return out.unionByName(extra.select(F.lit(len(listed)).alias("place"), none.alias("gate"), none.alias("validator"), F.lit("unregistered").alias("check"), none.alias("code"), "n", F.lit("failed").alias("state")))


def _all_needs(validators: Sequence[Validator]) -> Column:
    """Everything that a validator depends on, directly or not, as an array by the column ``validator``."""
    direct = {v.name: set(v.needs) for v in validators}
    for _ in direct:
        direct = {v: ns | {m for n in ns for m in direct.get(n, ())} for v, ns in direct.items()}
    pairs = [x for v, ns in direct.items() for x in (F.lit(v), F.array(*(F.lit(n) for n in sorted(ns))).cast("array<string>"))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("validator")), F.array().cast("array<string>")) if pairs else F.array().cast("array<string>")


def _differ(a: str, b: str) -> Column:
    return ~F.col(a).eqNullSafe(F.col(b))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def source_checks(objects: DataFrame, store: DataFrame, manifest: DataFrame, registry: DataFrame, revisions: DataFrame, chars: DataFrame, glyphs: DataFrame, replays: DataFrame) -> DataFrame:
    """G1, sources and their replay.

    objects (object_key, sha256) and store (object_key, content); manifest and registry (page_id, sha256, state); revisions (revision_id, content, content_sha256,
    spans_revision, pinned_spans_revision, asset_sha256, pinned_asset_sha256); chars (subject, verdict) as forbidden_chars gives them;
    glyphs (glyph_id, char, proofread); replays (asset_id, tool, pinned_tool, content, sha256).
    """
    held = objects.join(store.select("object_key", "content"), "object_key", "left")
    pages = manifest.select("page_id", F.struct("sha256", "state").alias("told")).join(registry.select("page_id", F.struct("sha256", "state").alias("have")), "page_id", "full")
    both = F.col("told").isNotNull() & F.col("have").isNotNull()
    return _union([
        scanned(held, F.col("object_key"), [Check("object_missing", F.col("content").isNull()), Check("hash_mismatch", F.col("content").isNotNull() & ~F.sha2("content", 256).eqNullSafe(F.col("sha256")))]),
        scanned(pages, F.col("page_id"), [Check("page_set_mismatch", ~both), Check("page_hash_mismatch", both & _differ("told.sha256", "have.sha256")), Check("terminal_state_mismatch", both & _differ("told.state", "have.state"), F.col("have.state"))]),
        scanned(revisions, F.col("revision_id"), [
            Check("content_sha256_mismatch", ~F.sha2("content", 256).eqNullSafe(F.col("content_sha256"))), Check("spans_revision_mismatch", _differ("spans_revision", "pinned_spans_revision")), Check("source_asset_mismatch", _differ("asset_sha256", "pinned_asset_sha256")),
        ]),
        scanned(chars, F.col("subject"), [Check("forbidden_char_in_text", F.col("verdict") != "disclosed"), Check("known_unresolvable_char_disclosed", F.coalesce(F.col("verdict") == "disclosed", F.lit(False)))]),
        scanned(glyphs, F.col("glyph_id"), [Check("unresolved_glyph", F.coalesce("char", F.lit("")).isin("", "□", "?")), Check("unproofread_glyphs", ~F.col("proofread"))]),
        scanned(replays, F.col("asset_id"), [Check("replay_tool_mismatch", _differ("tool", "pinned_tool"), F.col("tool")), Check("replay_bytes_mismatch", ~F.sha2("content", 256).eqNullSafe(F.col("sha256")))]),
    ])


def coverage_suite(manifest: DataFrame, pages: DataFrame, spans: DataFrame, batches: DataFrame, counts: DataFrame, batch_size: int) -> DataFrame:
    """G2, the whole of the book.

    manifest (page_id); pages (page_id, state, reason, text); spans (span_id, page_id, start_offset, end_offset, text), of which a page's follow each other with one
    character between; batches (batch_id, span_id); counts (page_id, n_spans) as told. A page is covered, excluded (with a reason) or deferred.
    """
    order = Window.partitionBy("page_id").orderBy("start_offset", "end_offset")
    before = F.max("end_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    due = F.coalesce(before + 1, F.lit(0))
    slice_of = F.substring("page_text", F.col("start_offset") + 1, F.col("end_offset") - F.col("start_offset"))
    whole = spans.withColumns({"due": due, "last": F.lead("span_id").over(order).isNull()}).join(pages.select("page_id", F.col("text").alias("page_text")), "page_id", "left")
    have = spans.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_have"))
    told = manifest.select("page_id", F.lit(True).alias("listed")).distinct().join(pages.select("page_id", "state", "reason"), "page_id", "full").join(have, "page_id", "left").join(counts.select("page_id", F.col("n_spans").alias("n_told")), "page_id", "left")
    there = F.col("listed").isNotNull() & F.col("state").isNotNull()
    dealt = batches.groupBy("span_id").agg(F.count_distinct("batch_id").alias("n_batches"), F.count(F.lit(1)).alias("n_rows"))
    members = spans.select("span_id", "page_id").withColumn("known", F.lit(True)).join(dealt, "span_id", "full")
    sized = batches.join(spans.select("span_id", "page_id"), "span_id", "left").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("n_pages"))
    return _union([
        scanned(told, F.col("page_id"), [
            Check("page_missing", F.col("state").isNull()), Check("page_unregistered", F.col("listed").isNull()), Check("page_without_span", there & (F.col("state") == "covered") & F.col("n_have").isNull()),
            Check("page_deferred", F.coalesce(F.col("state") == "deferred", F.lit(False))), Check("excluded_page_no_evidence", F.coalesce(F.col("state") == "excluded", F.lit(False)) & (F.trim(F.coalesce("reason", F.lit(""))) == "")),
            Check("count_mismatch", F.col("n_have").isNotNull() & ~F.col("n_have").eqNullSafe(F.col("n_told")), F.col("n_have")),
        ]),
        scanned(whole, F.col("span_id"), [
            Check("coverage_gap", F.col("start_offset") > F.col("due")), Check("coverage_overlap", F.col("start_offset") < F.col("due")), Check("span_text_mismatch", ~slice_of.eqNullSafe(F.col("text"))),
            Check("span_boundary_mismatch", (F.col("start_offset") < 0) | (F.col("end_offset") < F.col("start_offset")) | (F.col("end_offset") > F.length("page_text")) | (F.col("last") & (F.col("end_offset") != F.length("page_text")))),
        ]),
        scanned(members, F.col("span_id"), [Check("batch_span_leak", F.col("known").isNull() | F.col("n_batches").isNull()), Check("batch_span_duplicate", F.coalesce(F.col("n_rows") > 1, F.lit(False)))]),
        scanned(sized, F.col("batch_id"), [Check("batch_cross_page", F.col("n_pages") > 1), Check("batch_oversize", F.col("n") > batch_size, F.col("n"))]),
    ])


def evidence_suite(spans: DataFrame, pages: DataFrame, refs: DataFrame, targets: DataFrame, quotes: DataFrame, glyphs: DataFrame, lines: DataFrame, assertions: DataFrame, id_pattern: str, least_level: str) -> DataFrame:
    """G3, evidence.

    spans (span_id, page_id, line, start_offset, source_id, status); pages (page_id, text, revision, source_id, image_sha256, width, height, n_lines);
    refs (ref_id, target_id, kind) and targets (target_id, kind, consumable); quotes (quote_id, page_id, start, stop, quote, quote_sha256, revision, raw_text);
    glyphs (glyph_id, line_id, char, place, x0, y0, x1, y1, page_image_sha256); lines (line_id, page_id, text, x0, y0, x1, y1); assertions (assertion_id, level, n_glyphs, n_boxes).
    """
    often = spans.groupBy("span_id").agg(F.count(F.lit(1)).alias("n"))
    named = F.regexp_extract("span_id", id_pattern, 1).try_cast("long")
    placed = spans.join(pages.select("page_id", F.col("source_id").alias("page_source"), "n_lines", F.length("text").alias("page_length")), "page_id", "left")
    aimed = refs.join(targets.select("target_id", F.col("kind").alias("have"), "consumable"), "target_id", "left")
    cited = quotes.join(pages.select("page_id", "text", F.col("revision").alias("page_revision")), "page_id", "left")
    inside = (F.col("start") >= 0) & (F.col("start") <= F.col("stop")) & (F.col("stop") <= F.length("text"))
    piece = F.substring("text", F.col("start") + 1, F.col("stop") - F.col("start"))
    box = lambda p: [F.col(c).alias(f"{p}{c}") for c in ("x0", "y0", "x1", "y1")]
    drawn = glyphs.join(lines.select("line_id", "page_id", F.col("text").alias("line_text"), *box("line_")), "line_id", "left").join(pages.select("page_id", "width", "height", "image_sha256"), "page_id", "left")
    complete = F.col("x0").isNotNull() & F.col("y0").isNotNull() & F.col("x1").isNotNull() & F.col("y1").isNotNull() & F.col("line_text").isNotNull()
    proper = lambda p: (F.col(f"{p}x0") < F.col(f"{p}x1")) & (F.col(f"{p}y0") < F.col(f"{p}y1"))
    within = (F.col("x0") >= F.col("line_x0")) & (F.col("y0") >= F.col("line_y0")) & (F.col("x1") <= F.col("line_x1")) & (F.col("y1") <= F.col("line_y1"))
    rank = F.array_position(F.array(*(F.lit(x) for x in LEVELS)), F.coalesce("level", F.lit("")))
    return _union([
        scanned(placed, F.col("span_id"), [
            Check("span_id_format", ~F.col("span_id").rlike(id_pattern)), Check("page_line_mismatch", F.col("page_source").isNull() | (F.col("line") < 0) | (F.col("line") >= F.col("n_lines")) | F.coalesce(named != F.col("page_id"), F.lit(False))),
            Check("anchor_offset_mismatch", F.col("page_source").isNotNull() & ~F.coalesce(F.col("start_offset").between(0, F.col("page_length")), F.lit(False))), Check("source_id_mismatch", F.col("page_source").isNotNull() & _differ("source_id", "page_source")),
            Check("content_status_invalid", ~F.col("status").isin(*STATUSES), F.col("status")),
        ]),
        scanned(often, F.col("span_id"), [Check("span_id_duplicate", F.col("n") > 1, F.col("n"))]),
        scanned(aimed, F.col("ref_id"), [Check("dangling_ref", F.col("have").isNull()), Check("not_consumable", F.col("have").isNotNull() & ~F.coalesce("consumable", F.lit(False))), Check("ref_type_mismatch", F.col("have").isNotNull() & _differ("kind", "have"))]),
        scanned(cited, F.col("quote_id"), [
            Check("offset_out_of_range", ~F.coalesce(inside, F.lit(False))), Check("offset_mismatch", F.coalesce(inside, F.lit(False)) & ~piece.eqNullSafe(F.col("quote"))), Check("quote_hash_not_stored", F.col("quote_sha256").isNull()),
            Check("quote_hash_mismatch", F.col("quote_sha256").isNotNull() & ~F.sha2("quote", 256).eqNullSafe(F.col("quote_sha256"))), Check("anchor_revision_mismatch", _differ("revision", "page_revision")),
            Check("raw_anchor_mismatch", F.col("raw_text").isNotNull() & _differ("raw_text", "quote")),
        ]),
        scanned(drawn, F.col("glyph_id"), [
            Check("anchor_field_missing", ~complete), Check("page_image_hash_mismatch", complete & _differ("page_image_sha256", "image_sha256")), Check("line_box_mismatch", complete & ~F.coalesce(proper("line_"), F.lit(False))),
            Check("glyph_box_mismatch", complete & ~(proper("") & within)), Check("anchor_out_of_page", complete & ~F.coalesce((F.col("x0") >= 0) & (F.col("y0") >= 0) & (F.col("x1") <= F.col("width")) & (F.col("y1") <= F.col("height")), F.lit(False))),
            Check("glyph_text_misaligned", complete & ~F.substring("line_text", F.col("place") + 1, F.lit(1)).eqNullSafe(F.col("char"))),
        ]),
        scanned(assertions, F.col("assertion_id"), [
            Check("evidence_level_invalid", rank == 0, F.col("level")), Check("evidence_level_insufficient", (rank > 0) & (rank <= list(LEVELS).index(least_level))),
            Check("glyphbox_incomplete", F.coalesce(F.col("level").isin(*(x for x, boxes in LEVELS.items() if boxes)), F.lit(False)) & ~F.coalesce(F.col("n_boxes") >= F.col("n_glyphs"), F.lit(False))),
        ]),
    ])
