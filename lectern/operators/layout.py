"""Layout of pages: bands and columns by gaps, reading order, boxes in boxes, glyph slots, circles, glyph groups."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.scalars import contains_box
from lectern.operators.graph import kept
from lectern.operators.similar import packs

#: A box more than so many slots long spans several characters, one below the second figure holds a stroke, and one further off than the third is out of place.
OVER, THIN, DRIFT = 1.6, 0.25, 0.6


def gap_groups(rows: DataFrame, group: str, value: str, gap: float, key: str, inclusive: bool = True) -> DataFrame:
    """Numbers the clusters of a sorted value within each group from 0; a cluster ends where the next value is ``gap`` or more away (more, if not inclusive)."""
    order = Window.partitionBy(group).orderBy(value, key)
    step = F.col(value) - F.lag(value).over(order)
    cut = F.coalesce((step >= gap) if inclusive else (step > gap), F.lit(False)).cast("int")
    return rows.withColumn("_cut", cut).withColumn("cluster", F.sum("_cut").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_cut")


def median_gap(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Exact median of the gaps between consecutive values of each group."""
    step = F.col(value) - F.lag(value).over(Window.partitionBy(group).orderBy(value))
    return rows.withColumn("_g", step).where("_g IS NOT NULL").groupBy(group).agg(F.percentile("_g", 0.5).alias("median_gap"))


def ring_groups(rows: DataFrame, group: str, value: str, key: str, factor: float = 3.0) -> DataFrame:
    """Clusters of a value whose gaps are ``factor`` medians or more."""
    order = Window.partitionBy(group).orderBy(value, key)
    joined = rows.join(median_gap(rows, group, value), group, "left")
    far = (F.col(value) - F.lag(value).over(order)) >= F.col("median_gap") * factor
    return joined.withColumn("_cut", F.coalesce(far & (F.col("median_gap") > 0), F.lit(False)).cast("int")).withColumn("cluster", F.sum("_cut").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_cut", "median_gap")


def reading_order(rows: DataFrame, group: str, x: str, y: str, key: str, column_gap: float = 30.0, vertical: bool = True) -> DataFrame:
    """Adds ``place`` within each group: columns from right to left and down each, or lines from the top and left to right."""
    if not vertical:
        return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(y, x, key)))
    columned = gap_groups(rows, group, x, column_gap, key, inclusive=False)
    return columned.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("cluster"), y, x, key))).drop("cluster")


def glyphs_in_lines(lines: DataFrame, glyphs: DataFrame, page: str = "page", tolerance: float = 2.0, cell: float = 64.0) -> DataFrame:
    """Glyphs whose box lies in a line's box, give or take ``tolerance``: page, part, line_id, line_no, glyph_id, glyph_no, member.

    Equal boxes of a page are one, named by the least id that has it, and by a number from 1 as an id may have several boxes. Rows of the part ``pair`` say which line's box holds which glyph's; those of the parts ``line`` and
    ``glyph`` give each ``member`` that has such a box. Copies are never paired with each other. Boxes meet in the cells of a grid that a line's box touches, not page by page.
    """
    sides, side = ("x", "y", "w", "h"), {"line": ("line_id", "line_no"), "glyph": ("glyph_id", "glyph_no")}

    def classes(df: DataFrame, part: str) -> tuple[DataFrame, DataFrame]:
        name, number = side[part]
        rows = df.select(page, F.col(name).alias("member"), *(F.col(f"box.{n}").alias(n) for n in sides))
        one = rows.groupBy(page, *sides).agg(F.min("member").alias(name))
        return rows, one.withColumn(number, F.row_number().over(Window.partitionBy(page, name).orderBy(*sides)))

    (all_lines, one_line), (all_glyphs, one_glyph) = classes(lines, "line"), classes(glyphs, "glyph")
    box = F.struct(*sides)
    span = lambda a, n: F.sequence(F.floor((a - tolerance) / cell), F.floor((a + n + tolerance) / cell))
    tall = one_line.select(page, *side["line"], box.alias("line_box"), F.explode(span(F.col("x"), F.col("w"))).alias("_i")).withColumn("_j", F.explode(span(F.col("line_box.y"), F.col("line_box.h"))))
    placed = one_glyph.select(page, *side["glyph"], box.alias("glyph_box"), F.floor(F.col("x") / cell).alias("_i"), F.floor(F.col("y") / cell).alias("_j"))
    met = placed.join(tall, [page, "_i", "_j"]).where(contains_box(F.col("line_box"), F.col("glyph_box"), tolerance))
    pairs = kept(met.select(page, *side["line"], *side["glyph"], "line_box", "glyph_box"))
    blank = lambda column: F.lit(None).cast(pairs.schema[column].dataType).alias(column)

    def members(part: str, rows: DataFrame) -> DataFrame:
        taken = pairs.select(page, f"{part}_box.*", *side[part]).distinct()
        return rows.join(taken, [page, *sides]).select(page, F.lit(part).alias("part"), *(F.col(c) if p == part else blank(c) for p, names in side.items() for c in names), "member")

    linked = pairs.select(page, F.lit("pair").alias("part"), *side["line"], *side["glyph"], F.lit(None).cast(all_lines.schema["member"].dataType).alias("member"))
    return linked.unionByName(members("line", all_lines)).unionByName(members("glyph", all_glyphs))


def boxed_glyphs(lines: DataFrame, glyphs: DataFrame, page: str = "page", tolerance: float = 2.0, cell: float = 64.0) -> DataFrame:
    """Every glyph that has a box in a line's box, give or take ``tolerance``: page, line_id, glyph_id, once each.

    Ids of a page that have the same boxes are packed into lists; packs meet in the cells of a grid that a line's box touches, not page by page, are paired once however many of their boxes
    meet, and dealt out. So a pair of ids is a row only where it is returned.
    """

    def packed(df: DataFrame, name: str) -> DataFrame:
        boxes = df.groupBy(page, F.col(name).alias("id")).agg(F.array_sort(F.collect_set("box")).alias("boxes"))
        return packs(boxes, [page, "boxes"], F.col("id")).select(page, F.col("items").alias(f"{name}s"), F.col("items")[0].alias(name), F.explode("boxes").alias(f"{name}_box"))

    span = lambda a, n: F.sequence(F.floor((a - tolerance) / cell), F.floor((a + n + tolerance) / cell))
    line, glyph = F.col("line_id_box"), F.col("glyph_id_box")
    tall = packed(lines, "line_id").withColumn("_i", F.explode(span(line["x"], line["w"]))).withColumn("_j", F.explode(span(line["y"], line["h"])))
    placed = packed(glyphs, "glyph_id").withColumns({"_i": F.floor(glyph["x"] / cell), "_j": F.floor(glyph["y"] / cell)})
    met = placed.join(tall, [page, "_i", "_j"]).where(contains_box(line, glyph, tolerance))
    once = [page, "line_id", "glyph_id"]
    many = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.select(*once, "line_ids", "glyph_ids").repartition(many, *once).dropDuplicates(once)
    return dealt.select(page, F.explode("line_ids").alias("line_id"), "glyph_ids").select(page, "line_id", F.explode("glyph_ids").alias("glyph_id"))


def glyphs_of_lines(lines: DataFrame, glyphs: DataFrame, order: str) -> DataFrame:
    """Lines with the glyphs that name them as parent, in order; lines without any have an empty list."""
    listed = glyphs.groupBy(F.col("parent").alias("line_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct(order, "glyph_id"))), lambda g: g["glyph_id"]).alias("glyph_ids"))
    return lines.join(listed, "line_id", "left").withColumn("glyph_ids", F.coalesce("glyph_ids", F.array().cast("array<string>")))


def slot_signs(glyphs: DataFrame, line: str, start: str, size: str, at: str, extent: str, n_chars: str, key: str) -> DataFrame:
    """Glyphs of lines with as many glyphs as characters, at least two: index, slot, drift and sign.

    A line is cut into slots of equal pitch. Signs: ``over`` (spans several slots), ``drift`` (its middle is off its slot), ``thin``; lines that only have thin glyphs are in order and left out.
    """
    whole = Window.partitionBy(line)
    pitch = F.col(size) / F.col(n_chars)
    rows = glyphs.withColumn("_n", F.count(F.lit(1)).over(whole)).where((F.col("_n") == F.col(n_chars)) & (F.col(n_chars) >= 2) & (F.col(size) > 0))
    rows = rows.withColumn("index", F.row_number().over(whole.orderBy(at, key)))
    middle = F.col(at) + F.col(extent) / 2
    drift = (middle - (F.col(start) + pitch * (F.col("index") - 0.5))) / pitch
    slot = F.greatest(F.lit(1), F.least(F.col(n_chars), F.floor((middle - F.col(start)) / pitch) + 1))
    signs = F.array_compact(F.array(F.when(F.col(extent) > OVER * pitch, "over"), F.when(F.col(extent) < THIN * pitch, "thin"), F.when(F.abs(drift) > DRIFT, "drift")))
    marked = rows.withColumns({"slot": slot.cast("int"), "drift": F.bround(drift, 2), "signs": signs})
    bad = F.max(F.array_contains("signs", "over") | F.array_contains("signs", "drift")).over(whole)
    return marked.withColumn("_bad", bad).where("_bad").select(line, key, "index", "slot", "drift", "signs")


def circle_fit(points: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Least-squares circle of each group's points from sums of moments: centre, radius and relative residual. Fewer than three points, or points on a line, give nulls.

    Joins are by sorting: points that a plan takes for few, such as generated ones, are never gathered in the driver to be sent to all.
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    mean = points.groupBy(group).agg(F.avg(a).alias("_mx"), F.avg(b).alias("_my"))
    u, v = a - F.col("_mx"), b - F.col("_my")
    s = points.hint("merge").join(mean.hint("merge"), group).withColumns({"_u": u, "_v": v})
    sums = {f"_{p}{q}": F.sum(F.pow("_u", F.lit(p)) * F.pow("_v", F.lit(q))) for p, q in ((2, 0), (1, 1), (0, 2), (3, 0), (2, 1), (1, 2), (0, 3))}
    m = s.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.first("_mx").alias("_mx"), F.first("_my").alias("_my"), *(c.alias(n) for n, c in sums.items()))
    det = F.col("_20") * F.col("_02") - F.col("_11") * F.col("_11")
    p, q = (F.col("_30") + F.col("_12")) / 2, (F.col("_03") + F.col("_21")) / 2
    ok = (F.col("n") >= 3) & (F.abs(det) > 1e-9)
    cu, cv = F.when(ok, (p * F.col("_02") - q * F.col("_11")) / det), F.when(ok, (q * F.col("_20") - p * F.col("_11")) / det)
    circles = m.select(group, "n", (cu + F.col("_mx")).alias("centre_x"), (cv + F.col("_my")).alias("centre_y"), F.sqrt(cu * cu + cv * cv + (F.col("_20") + F.col("_02")) / F.col("n")).alias("radius"))
    off = F.abs(F.hypot(a - F.col("centre_x"), b - F.col("centre_y")) - F.col("radius")) / F.col("radius")
    values = [c for c in circles.columns if c != group]
    fitted = points.hint("merge").join(circles.hint("merge"), group).groupBy(group).agg(*(F.first(c).alias(c) for c in values), F.avg(off).alias("residual"))
    return fitted.select(group, *values, "residual")


def rare_glyphs(glyphs: DataFrame, common: DataFrame, simplified: DataFrame, least: float = 0.5) -> DataFrame:
    """Glyphs that need a look: low confidence, or a character that isn't common, neither by itself nor by its simplified form. Adds ``rare_reason``."""
    c, s = common.select("char", F.lit(True).alias("_common")), simplified.select("char", "simple")
    joined = glyphs.join(c, "char", "left").join(s, "char", "left").join(c.select(F.col("char").alias("simple"), F.col("_common").alias("_simple")), "simple", "left")
    reason = F.when(F.col("conf") < least, "low_conf").when(F.coalesce("_common", "_simple", F.lit(False)), None).otherwise("not_common")
    return joined.withColumn("rare_reason", reason).where("rare_reason IS NOT NULL").select(*glyphs.columns, "rare_reason")


def moved_samples(groups: DataFrame, moves: DataFrame) -> DataFrame:
    """Glyph groups (group_id, sample_id) after moves (sample_id, group_id; the last by ``at`` counts, a null group removes): a sample is in one group at most."""
    last = moves.groupBy("sample_id").agg(F.max_by("group_id", "at").alias("group_id"))
    return groups.join(last, "sample_id", "left_anti").select("group_id", "sample_id").unionByName(last.where("group_id IS NOT NULL").select("group_id", "sample_id"))


def mapped_glyphs(glyphs: DataFrame, groups: DataFrame, defined: DataFrame) -> DataFrame:
    """Glyphs with the character that their group is defined as; the others keep their own."""
    meaning = groups.join(defined.select("group_id", F.col("char").alias("mapping")), "group_id").select(F.col("sample_id").alias("glyph_id"), "mapping")
    return glyphs.join(meaning, "glyph_id", "left").withColumn("shown", F.coalesce("mapping", "char"))


def fitted_segments(segments: DataFrame, line: str, start: str, end: str, wanted: str) -> DataFrame:
    """Segments of each line brought to the wanted number: too many, and the two with the least gap are joined, the first on ties; too few, and the longest is halved. A line is the unit of work."""

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        parts = sorted(zip(group[start].astype(float), group[end].astype(float), strict=True))
        n = int(group[wanted].iloc[0])
        while len(parts) > max(n, 1):
            i = int(np.argmin([b[0] - a[1] for a, b in zip(parts[:-1], parts[1:], strict=True)]))
            parts[i : i + 2] = [(parts[i][0], max(parts[i][1], parts[i + 1][1]))]
        while 0 < len(parts) < n:
            i = int(np.argmax([b - a for a, b in parts]))
            a, b = parts[i]
            parts[i : i + 1] = [(a, (a + b) / 2), ((a + b) / 2, b)]
        return pd.DataFrame({line: group[line].iloc[0], "place": range(len(parts)), start: [a for a, _ in parts], end: [b for _, b in parts]})

    return segments.groupBy(line).applyInPandas(fit, f"{line} {segments.schema[line].dataType.simpleString()}, place int, {start} double, {end} double")
