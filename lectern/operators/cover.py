"""Unions of intervals: which intervals they hold, and characters that exactly one finding has to answer for.

Intervals are half open and over whole numbers. Work is dealt out by key and bin, never by key alone: an interval is cut at the
borders of bins, so a key that holds most of the rows still spreads over as many tasks as it has bins. Inside a bin, one
sort and two sweeps are enough.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.intervals import as_of, points_in_intervals
from lectern.operators.spans import map_position_back


def _cut(df: DataFrame, start: str, stop: str, width: int) -> DataFrame:
    """Intervals that aren't empty, cut at the borders of bins: adds ``_bin``, ``_a`` and ``_b``."""
    begin, end = F.col(start).cast("long"), F.col(stop).cast("long")
    binned = df.where(begin < end).withColumn("_bin", F.explode(F.sequence(F.floor(begin / width), F.floor((end - 1) / width))))
    return binned.withColumns({"_a": F.greatest(begin, F.col("_bin") * width), "_b": F.least(end, (F.col("_bin") + 1) * width)})


def _blocks(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The disjoint blocks (keys, _bin, _a, _b) of pieces that overlap or touch, in each bin."""
    order = Window.partitionBy(*keys, "_bin").orderBy("_a", "_b")
    fresh = F.coalesce(F.col("_a") > F.max("_b").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    return pieces.withColumn("_fresh", fresh.cast("int")).withColumn("_block", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "_bin", "_block").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b"))


def merged_intervals(df: DataFrame, keys: Sequence[str], start: str, stop: str, width: int) -> DataFrame:
    """The maximal blocks of each key's union: keys, start, stop. Intervals that touch are one block; empty ones, and those with a null end, add nothing.

    Blocks of bins are joined at their borders in a second sweep, which sees a row for each block of a bin and not each interval.
    """
    parts = _blocks(_cut(df.select(*keys, start, stop), start, stop, width), keys)
    order = Window.partitionBy(*keys).orderBy("_a")
    fresh = F.coalesce(F.col("_a") > F.lag("_b").over(order), F.lit(True)).cast("int")
    named = parts.withColumn("_fresh", fresh).withColumn("_run", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return named.groupBy(*keys, "_run").agg(F.min("_a").alias(start), F.max("_b").alias(stop)).select(*keys, start, stop)


def covered_intervals(asked: DataFrame, cover: DataFrame, keys: Sequence[str], start: str, stop: str, width: int) -> DataFrame:
    """The asked rows with ``covered``: whether the union of their key's cover holds them whole.

    Both sides have the columns ``start`` and ``stop``. Empty intervals are covered; null ends give null. Null keys meet nothing and aren't
    covered, unless empty. Repeated rows stay. ``width`` should be about the usual length of an interval.
    """
    wanted = asked.select(*keys, start, stop).distinct()
    pieces = _cut(wanted.dropna(subset=list(keys)), start, stop, width)
    blocks = _blocks(_cut(cover.select(*keys, start, stop), start, stop, width), keys)
    # In a bin, blocks don't overlap: the last one that begins at or before a piece is the only one that may hold it.
    last = as_of(pieces, blocks.withColumnRenamed("_b", "_until"), [*keys, "_bin"], "_a", "_a", "_until")
    held = last.groupBy(*keys, start, stop).agg(F.bool_and(F.coalesce(F.col("_b") <= F.col("_until"), F.lit(False))).alias("_held"))
    known = asked.join(held.select(*(F.col(c).alias(f"_k_{c}") for c in (*keys, start, stop)), "_held"), [asked[c] == F.col(f"_k_{c}") for c in (*keys, start, stop)], "left")
    covered = F.when(F.col(start).isNull() | F.col(stop).isNull(), None).when(F.col(start) >= F.col(stop), True).otherwise(F.coalesce("_held", F.lit(False)))
    return known.withColumn("covered", covered).select(*asked.columns, "covered")


# Characters that a text may only keep if the cleaning report answers for them, by the kind of finding.
FORBIDDEN = {"replacement_char": r"[?□\x{FFFD}]", "private_use_area": r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]"}
UNRESOLVABLE = "known_unresolvable"


def forbidden_chars(spans: DataFrame, patches: DataFrame, findings: DataFrame, key: str = "doc_id", forbidden: Mapping[str, str] = FORBIDDEN, state: str = UNRESOLVABLE, width: int = 4096, usual: int = 4) -> DataFrame:
    """Every forbidden character of spans (key, span_id, start_offset, text) with the number of findings that answer for it.

    A character's place in the cleaned text is mapped back through patches (key, raw_start, raw_end, cleaned_start, cleaned_end); findings (key, kind, terminal_state,
    raw_start, raw_end) answer if they are of its kind, end in ``state`` and hold the raw place. Exactly one has to (``disclosed``); none, or
    several, is ``forbidden``. Spans without text or offset have no characters. Rows: key, span_id, position, raw_position, char, kind, n, verdict.
    ``usual`` is the usual length of a finding: characters meet the findings of so short a stretch, not those of ``width``.
    """
    any_of = "|".join(forbidden.values())
    kind = F.coalesce(*(F.when(F.col("char").rlike(p), k) for k, p in forbidden.items()))
    chars = spans.where(F.col("start_offset").isNotNull() & F.col("text").rlike(any_of)).select(key, "span_id", "start_offset", F.posexplode(F.split("text", "")).alias("i", "char")).where(F.col("char").rlike(any_of))
    chars = chars.select(key, "span_id", (F.col("start_offset") + F.col("i")).cast("int").alias("position"), "char", kind.alias("kind"))
    patch = F.struct(*(F.col(c).cast("int").alias(c) for c in ("raw_start", "raw_end", "cleaned_start", "cleaned_end")))
    # Of patches that begin together only an empty one may come before another, and both give the same place.
    latest = patches.groupBy(key, "cleaned_start").agg(F.max_by(patch, "cleaned_end").alias("patch"))
    moved = as_of(chars, latest, [key], "position", "cleaned_start", "patch", width)
    placed = moved.withColumn("raw_position", F.when(F.col("patch").isNull(), F.col("position")).otherwise(map_position_back(F.col("position"), F.array("patch")))).drop("patch")
    answers = findings.where(F.col("terminal_state") == state).select(key, "kind", "raw_start", "raw_end")
    hits = points_in_intervals(placed, answers, "raw_position", "raw_start", "raw_end", usual, [key, "kind"])
    counted = hits.groupBy(key, "span_id", "position").agg(F.count(F.lit(1)).alias("n"))
    judged = placed.join(counted, [key, "span_id", "position"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return judged.select(key, "span_id", "position", "raw_position", "char", "kind", "n", F.when(F.col("n") == 1, "disclosed").otherwise("forbidden").alias("verdict"))


def open_counts(df: DataFrame, keys: Sequence[str], start: str, stop: str) -> DataFrame:
    """How many intervals are open from each point on where that changes: keys, at, open. At a point, ends come before begins."""
    ends: Column = F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("step")), F.struct(F.col(stop).alias("at"), F.lit(-1).alias("step"))))
    steps = df.where(F.col(start) < F.col(stop)).select(*keys, ends.alias("_e")).groupBy(*keys, F.col("_e.at").alias("at")).agg(F.sum("_e.step").alias("step")).where("step <> 0")
    return steps.withColumn("open", F.sum("step").over(Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, 0))).select(*keys, "at", "open")
