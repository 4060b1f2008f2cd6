"""From scanned pages to structural spans: bands, columns and reading order; spans of lines with offsets, batches and glyph boxes; and the gate that checks them.

Levels are nested: a page has bands, a band columns, a column lines, a line glyphs. Each level is one window over its own keys, so a
page's rows stay together and pages are independent of each other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import padded_id
from lectern.operators.suites import Check, scanned

#: Pixels between bands and between columns; lines in a batch; lines that a page's ids can number.
BAND_GAP, COLUMN_GAP, BATCH_LINES, MOST_LINES = 40.0, 30.0, 10, 99
#: States of a page in which it has no lines, in which it has to have some, and in which it can't go on.
EXCLUDED, COVERED, BLOCKED = "known_unrecognizable", "manually_transcribed", "deferred"


def interval_clusters(rows: DataFrame, keys: list[str], start: str, stop: str, gap: float, key: str, name: str = "cluster", inclusive: bool = True) -> DataFrame:
    """Numbers clusters of intervals from 0 within their keys.

    In the order of their starts, a cluster ends where the next start lies ``gap`` or more (more, if not inclusive) behind the furthest stop so far; an interval that reaches beyond later ones
    keeps them together. Intervals with a null end have a null cluster and part nothing.
    """
    order = Window.partitionBy(*keys).orderBy(start, stop, key)
    whole = F.col(start).isNotNull() & F.col(stop).isNotNull()
    furthest = F.max(F.when(whole, F.greatest(start, stop))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    step = F.col(start) - furthest
    cut = whole & F.coalesce((step >= gap) if inclusive else (step > gap), F.lit(False))
    return rows.withColumn("_cut", cut.cast("int")).withColumn(name, F.when(whole, F.sum("_cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))).drop("_cut")


def banded_order(rows: DataFrame, page: str, top: str, bottom: str, x: str, y: str, key: str, band_gap: float = BAND_GAP, column_gap: float = COLUMN_GAP) -> DataFrame:
    """Adds ``band`` (from the top), ``column`` (from the right within its band) and ``place`` (over the page): bands downwards, columns from right to left, boxes down each column.

    Ties go by ``key``. Boxes without a top, bottom or centre have neither band nor column and come last.
    """
    banded = interval_clusters(rows, [page], top, bottom, band_gap, key, "band")
    columned = interval_clusters(banded, [page, "band"], x, x, column_gap, key, "_column", inclusive=False)
    widest = F.max("_column").over(Window.partitionBy(page, "band"))
    placed = columned.withColumn("column", F.when(F.col("band").isNotNull(), widest - F.col("_column"))).drop("_column")
    return placed.withColumn("place", F.row_number().over(Window.partitionBy(page).orderBy(F.col("band").asc_nulls_last(), F.col("column").asc_nulls_last(), y, key)))


def structural_spans(pages: DataFrame, lines: DataFrame, glyphs: DataFrame, batch_lines: int = BATCH_LINES) -> tuple[DataFrame, DataFrame]:
    """Spans of the lines of pages, and refused pages (source_id, page, refusal).

    pages (source_id, work, edition, page, page_no, state, image_sha256); lines (page, line_id, seq, text, box); glyphs (page, glyph_id, parent, seq, char, box).
    Lines follow each other with one character between. Batches hold up to ``batch_lines`` lines of one page and are numbered through a source, in the order of its pages.
    A span's anchor names the page's image, the line and its box, and the glyphs of the line in order.

    Refused: ``deferred`` pages; ``unknown_state``; ``unrecognizable_with_lines``; ``no_lines`` without being unrecognizable; ``no_image``; and ``too_many_lines`` for the ids. A null state asks for lines.
    """
    counts = lines.groupBy("page").agg(F.count(F.lit(1)).alias("n_lines"))
    told = pages.join(counts, "page", "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0)))
    state, some = F.col("state"), F.col("n_lines") > 0
    refusal = (
        F.when(state == BLOCKED, "deferred").when(state.isNotNull() & ~state.isin(EXCLUDED, COVERED), "unknown_state").when((state == EXCLUDED) & some, "unrecognizable_with_lines").when(state == EXCLUDED, None)
        .when(~some, "no_lines").when(F.col("image_sha256").isNull(), "no_image").when(F.col("n_lines") > MOST_LINES, "too_many_lines")
    )
    judged = told.withColumn("refusal", refusal)
    order = Window.partitionBy("source_id").orderBy("page_no", "page").rowsBetween(Window.unboundedPreceding, -1)
    covered = judged.where(F.col("refusal").isNull() & ~F.coalesce(state == EXCLUDED, F.lit(False)))
    covered = covered.withColumn("first_batch", F.coalesce(F.sum(F.ceil(F.col("n_lines") / batch_lines)).over(order), F.lit(0)))
    within = Window.partitionBy("page").orderBy("seq", "line_id")
    text = F.coalesce("text", F.lit(""))
    end = F.sum(F.length(text) + 1).over(within.rowsBetween(Window.unboundedPreceding, 0)) - 1
    cut = lines.withColumns({"line_index": F.row_number().over(within) - 1, "end_offset": end.cast("int"), "text": text}).withColumn("start_offset", F.col("end_offset") - F.length("text"))
    drawn = glyphs.groupBy(F.col("page"), F.col("parent").alias("line_id")).agg(F.array_sort(F.collect_list(F.struct("seq", "glyph_id", "char", F.col("box").alias("glyph_box")))).alias("chars"))
    joined = cut.join(covered, "page").join(drawn, ["page", "line_id"], "left").withColumn("chars", F.coalesce("chars", F.array().cast(drawn.schema["chars"].dataType)))
    number = F.col("first_batch") + F.floor(F.col("line_index") / batch_lines) + 1
    spans = joined.select(
        "source_id", "page", F.concat(F.lit("ss_"), "work", F.lit("_ed"), "edition", padded_id("_p", F.col("page_no")), padded_id("_s", F.col("line_index") + 1, 2)).alias("span_id"),
        F.concat("work", padded_id("_b", number, 3)).alias("batch_id"), "line_index", "start_offset", "end_offset", "text", F.struct("image_sha256", "line_id", "box", "chars").alias("anchor"),
    )
    return spans, judged.where("refusal IS NOT NULL").select("source_id", "page", "refusal")


def page_blocks(lines: DataFrame) -> DataFrame:
    """Each page's text: its lines in order, joined by line breaks."""
    said = F.array_sort(F.collect_list(F.struct("seq", "line_id", F.coalesce("text", F.lit("")).alias("t"))))
    return lines.groupBy("page").agg(F.array_join(F.transform(said, lambda x: x["t"]), "\n").alias("block"))


def structural_gate(spans: DataFrame, pages: DataFrame, lines: DataFrame, glyphs: DataFrame, told: DataFrame, batch_lines: int = BATCH_LINES) -> DataFrame:
    """Eight checks of structural spans against pages, lines and glyphs, each computed anew: (check, subject, detail).

    ``page_accounting``: a page has spans, unless it is unrecognizable, and spans have a page; ``contiguous_coverage``: spans of a page begin one character behind the last, the first at 0, the last ends with the block;
    ``strict_offset``: the slice is the text; ``concat_equals_block``: joined spans are the block; ``glyphbox_anchors``: as many glyphs as characters, each one's character
    and a proper box inside the line's, of the page's image; ``span_identity``: ids once each; ``batch_rules``: a batch is of one page and not too large; ``header_counts``: spans of a source as told (source_id, n_spans).
    """
    blocks = page_blocks(lines)
    order = Window.partitionBy("page").orderBy("start_offset", "end_offset")
    due = F.coalesce(F.lag("end_offset").over(order) + 1, F.lit(0))
    whole = spans.withColumns({"due": due, "last": F.lead("span_id").over(order).isNull()}).join(blocks, "page", "left").join(pages.select("page", F.col("image_sha256").alias("page_image")), "page", "left")
    piece = F.substring("block", F.col("start_offset") + 1, F.col("end_offset") - F.col("start_offset"))
    chars = F.col("anchor.chars")
    inside = lambda g: (g.x >= F.col("anchor.box.x")) & (g.y >= F.col("anchor.box.y")) & (g.x + g.w <= F.col("anchor.box.x") + F.col("anchor.box.w")) & (g.y + g.h <= F.col("anchor.box.y") + F.col("anchor.box.h")) & (g.w > 0) & (g.h > 0)
    boxed = F.forall(chars, lambda c: F.coalesce(inside(c["glyph_box"]), F.lit(False)))
    spelled = F.array_join(F.transform(chars, lambda c: F.coalesce(c["char"], F.lit(""))), "") == F.col("text")
    parts = spans.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_index", "text"))), lambda x: x["text"]), "\n"), 256).alias("have"))
    accounted = pages.select("page", "state").withColumn("known", F.lit(True)).join(parts, "page", "full").join(blocks.select("page", F.sha2("block", 256).alias("want")), "page", "left")
    excluded = F.coalesce(F.col("state") == EXCLUDED, F.lit(False))
    often = spans.groupBy("span_id").agg(F.count(F.lit(1)).alias("n"))
    batches = spans.groupBy("source_id", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page").alias("n_pages"))
    counted = spans.groupBy("source_id").agg(F.count(F.lit(1)).alias("n")).join(told.select("source_id", "n_spans"), "source_id", "full")
    return reduce(DataFrame.unionByName, [
        scanned(accounted, F.col("page"), [Check("page_accounting", F.col("known").isNull() | (excluded == F.col("n").isNotNull())), Check("concat_equals_block", F.col("n").isNotNull() & ~F.col("have").eqNullSafe(F.col("want")))]),
        scanned(whole, F.col("span_id"), [
            Check("contiguous_coverage", (F.col("start_offset") != F.col("due")) | (F.col("last") & (F.col("end_offset") != F.length("block")))), Check("strict_offset", ~piece.eqNullSafe(F.col("text"))),
            Check("glyphbox_anchors", ~F.coalesce(spelled & boxed & (F.col("anchor.image_sha256") == F.col("page_image")), F.lit(False))),
        ]),
        scanned(often, F.col("span_id"), [Check("span_identity", F.col("n") > 1, F.col("n"))]),
        scanned(batches, F.col("batch_id"), [Check("batch_rules", (F.col("n_pages") > 1) | (F.col("n") > batch_lines), F.col("n"))]),
        scanned(counted, F.col("source_id"), [Check("header_counts", ~F.col("n").eqNullSafe(F.col("n_spans")), F.col("n"))]),
    ])


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), w.cast("double").alias("w"), h.cast("double").alias("h"))
