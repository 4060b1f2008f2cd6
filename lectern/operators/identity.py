"""Identities over releases and routes: maps from old ids to new ones, spans named by number, glyphs to their spans; and trees compared by path."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lectern.operators.graph import kept


def remapped(ids: DataFrame, maps: DataFrame, releases: Sequence[str]) -> DataFrame:
    """Each id's name after some releases: id, now, state, release.

    maps (release, from_id, to_id) are applied in the order of ``releases``; an id that a release doesn't mention stays. ``kept`` and ``moved`` ids have a name; one with several targets (``split``) or a null
    target (``lost``) has none from that release on, and ``release`` says which it was. Ids that several others move to are ``merged`` only in that they share a name. Repeated rows of maps count once.
    """
    state = kept(ids.select("id").distinct().select("id", F.col("id").alias("now"), F.lit("kept").alias("state"), F.lit(None).cast("string").alias("release")))
    for release in releases:
        step = maps.where(F.col("release") == release).groupBy(F.col("from_id").alias("now")).agg(F.count_distinct("to_id").alias("_n"), F.min("to_id").alias("_to"), F.bool_or(F.col("to_id").isNull()).alias("_none"))
        joined = state.join(step, "now", "left")
        broken = F.when(F.col("_n") + F.col("_none").cast("int") > 1, "split").when(F.col("_none"), "lost")
        moved = F.col("_to").isNotNull() & (F.col("_to") != F.col("now"))
        state = kept(joined.select(
            "id", F.when(broken.isNull(), F.coalesce("_to", "now")).alias("now"), F.coalesce(broken, F.when(moved, "moved"), F.col("state")).alias("state"), F.when(broken.isNotNull(), F.lit(release)).otherwise(F.col("release")).alias("release"),
        ))
    return state


def reselected(spans: DataFrame, submissions: DataFrame) -> DataFrame:
    """The spans (source_id, seq, span_id) that submissions (submission_id, source_id, seqs) name by number, in the order of their numbers: submission_id, source_id, seq, span_id, problem.

    A number that a submission names twice comes once, ``problem`` says so (``repeated``), or that there is no such span (``unknown``).
    """
    named = submissions.select("submission_id", "source_id", F.explode("seqs").alias("seq")).groupBy("submission_id", "source_id", "seq").agg(F.count(F.lit(1)).alias("_n"))
    joined = named.join(spans.select("source_id", "seq", "span_id"), ["source_id", "seq"], "left")
    return joined.select("submission_id", "source_id", "seq", "span_id", F.when(F.col("span_id").isNull(), "unknown").when(F.col("_n") > 1, "repeated").alias("problem"))


def spans_of_glyphs(glyphs: DataFrame, lines: DataFrame, line_spans: DataFrame, page_spans: DataFrame) -> DataFrame:
    """Each glyph (glyph_id, page, parent) with its span and how it was found.

    By its line (line_id, page) and that line's span (line_id, span_id): ``line``; else by its page's span (page, span_id): ``page``; else not at all. A glyph of a line of another page isn't that line's.
    """
    by_line = lines.join(line_spans.select("line_id", F.col("span_id").alias("_line_span")), "line_id").select(F.col("line_id").alias("parent"), "page", "_line_span")
    joined = glyphs.join(by_line, ["parent", "page"], "left").join(page_spans.select("page", F.col("span_id").alias("_page_span")), "page", "left")
    how = F.when(F.col("_line_span").isNotNull(), "line").when(F.col("_page_span").isNotNull(), "page")
    return joined.select("glyph_id", "page", F.coalesce("_line_span", "_page_span").alias("span_id"), how.alias("found_by"))


#: Ends of names that two runs never share.
VOLATILE = ("_id", "_at", "_time", "_revision")


def _leaves(text: str, ends: tuple[str, ...]) -> list[tuple[str, str]]:
    def walk(value, path: str, out: list) -> None:
        if isinstance(value, dict) and value:
            for k in sorted(value):
                if not k.endswith(ends):
                    walk(value[k], f"{path}.{k}" if path else k, out)
        elif isinstance(value, list) and value:
            for i, v in enumerate(value):
                walk(v, f"{path}[{i}]", out)
        else:
            out.append((path, json.dumps(value, ensure_ascii=False, sort_keys=True)))

    out: list = []
    try:
        walk(json.loads(text), "", out)
    except ValueError:
        return [("!", text)]
    return out


_CHANGES = ArrayType(StructType([StructField(c, StringType()) for c in ("path", "left_value", "right_value", "change")]))


def tree_changes(left: F.Column, right: F.Column, volatile: Sequence[str] = VOLATILE) -> F.Column:
    """Where the leaves of two lists of JSON texts differ, as an array of (path, left_value, right_value, change).

    Leaves have names joined by dots, and list places in brackets. Names that end in one of ``volatile`` are left out with all below; empty lists and objects are leaves. Broken JSON is one leaf, ``!``. Of several
    texts on a side, each leaf meets each of the other side that has its path.
    """
    ends = tuple(volatile)

    def by_path(texts) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for t in texts:
            for path, value in _leaves(t, ends):
                out.setdefault(path, []).append(value)
        return out

    def changes(one, two) -> list[dict]:
        if one is None or two is None or len(one) == len(two) == 1 and one[0] == two[0]:
            return []
        a, b = by_path(one), by_path(two)
        met = [(p, x, y) for p in a.keys() | b.keys() for x in a.get(p, [None]) for y in b.get(p, [None])]
        return [{"path": p, "left_value": x, "right_value": y, "change": "right_only" if x is None else "left_only" if y is None else "changed"} for p, x, y in met if x != y]

    @F.pandas_udf(_CHANGES)
    def run(one: pd.Series, two: pd.Series) -> pd.Series:
        return pd.Series([changes(x, y) for x, y in zip(one, two, strict=True)], dtype=object)

    return run(left, right)


def substitution_report(left: DataFrame, right: DataFrame, key: str, body: str, volatile: Sequence[str] = VOLATILE) -> DataFrame:
    """Where two adapters' outcomes (key, JSON body) differ once ids and times are left out: key, path, left_value, right_value, change.

    ``changed``, ``left_only``, ``right_only`` by path, at any depth. A key that only one side has is one row with the path ``$``. Trees that are equal give no rows.
    Both sides' bodies meet once, by key, before they are taken apart: leaves that are equal never become rows.
    """
    side = lambda df, name: df.select(F.col(key).alias("key"), *(F.when(F.lit(n == name), F.col(body)).alias(n) for n in ("one", "two")), F.lit(name).alias("side"))
    met = side(left, "one").unionByName(side(right, "two")).groupBy("key").agg(F.collect_list("one").alias("one"), F.collect_list("two").alias("two"), F.array_sort(F.collect_set("side")).alias("sides"))
    # A null key is on one side only, as it equals no other.
    both = (F.size("sides") == 2) & F.col("key").isNotNull()
    none = F.lit(None).cast("string")
    alone = F.transform("sides", lambda s: F.struct(F.lit("$").alias("path"), none.alias("left_value"), none.alias("right_value"), F.when(s == "one", "left_only").otherwise("right_only").alias("change")))
    found = met.select("key", both.alias("both"), tree_changes(F.when(both, F.col("one")), F.when(both, F.col("two")), volatile).alias("changes"), alone.alias("alone"))
    return found.select("key", F.inline(F.when(F.col("both"), F.col("changes")).otherwise(F.col("alone")))).withColumnRenamed("key", key)
