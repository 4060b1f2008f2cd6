"""Joins of sets by how much they share, without a join on what everybody has.

Items are ordered from rare to frequent. Two sets that share enough must share an item among the first few of each (the prefix), so only prefixes
meet; the most frequent items are in the prefix of hardly any set. Equal sets are one set, with all who have it as members. Small sets that must share
two items meet by two at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.graph import kept


#: Groups of up to so many items that others have too meet by pairs of items; larger ones by prefixes.
FEW = 16


def shared_items(groups: DataFrame, group: str, item: str, least: int = 2) -> DataFrame:
    """Pairs of groups that share ``least`` different items or more: left_id, right_id, shared. Null groups and items pair nothing.

    Groups of ``FEW`` items or less meet by two items at once, so that only those meet which share two: the times that they do tell how many they share.
    A larger group is found by all its items but the ``least - 1`` most frequent ones, so that an item of many groups joins nobody by itself.
    """
    items = groups.select(F.col(group).alias("id"), F.col(item).alias("item")).where("id IS NOT NULL AND item IS NOT NULL").distinct()
    often = items.groupBy("item").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    placed = items.join(often, "item").withColumns({"place": F.row_number().over(Window.partitionBy("id").orderBy("often", "item")), "n": F.count(F.lit(1)).over(Window.partitionBy("id"))})
    placed = kept(placed.where(F.col("n") >= least))
    large = F.col("n") > (FEW if least > 1 else 0)
    few = _by_two(placed.where(~large), least)
    if placed.where(large).isEmpty():
        return few
    prefix = placed.where(F.col("place") <= F.col("n") - (least - 1)).select("id", "item", large.alias("large"))
    met = prefix.where("large").select(F.col("id").alias("one"), "item").join(prefix.select(F.col("id").alias("other"), "item"), "item").where("one <> other")
    maybe = met.select(F.least("one", "other").alias("left_id"), F.greatest("one", "other").alias("right_id")).distinct()
    side = lambda c: placed.select(F.col("id").alias(c), "item")
    counted = maybe.join(side("left_id"), "left_id").join(side("right_id"), ["right_id", "item"]).groupBy("left_id", "right_id").agg(F.count(F.lit(1)).alias("shared"))
    return few.unionByName(counted.where(F.col("shared") >= least).select("left_id", "right_id", "shared"))


def _by_two(placed: DataFrame, least: int) -> DataFrame:
    """Pairs of groups that share two items or more: s shared items are s * (s - 1) / 2 shared pairs of items."""
    listed = placed.groupBy("id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    twos = F.flatten(F.transform("items", lambda a, i: F.transform(F.slice("items", i + 2, F.size("items")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    each = listed.select("id", F.explode(twos).alias("two")).select("id", "two.*")
    pairs = each.withColumnRenamed("id", "left_id").join(each.withColumnRenamed("id", "right_id"), ["a", "b"]).where("left_id < right_id")
    times = pairs.groupBy("left_id", "right_id").agg(F.count(F.lit(1)).alias("times"))
    return times.select("left_id", "right_id", F.round((F.sqrt(F.col("times") * 8 + 1) + 1) / 2).cast("long").alias("shared")).where(F.col("shared") >= least)


def _sets(rows: DataFrame, items: str) -> DataFrame:
    """Each different (scope, set) once: scope, set (sorted), set_id."""
    sets = rows.select("scope", F.array_sort(F.array_distinct(F.filter(items, lambda x: x.isNotNull()))).alias("set")).where(F.size("set") > 0).distinct()
    return sets.withColumn("set_id", F.sha2(F.to_json(F.struct("scope", "set")), 256))


def similar_sets(left: DataFrame, right: DataFrame, scope: str, items: str, least: float) -> DataFrame:
    """Pairs of different sets of one scope with a Jaccard similarity of ``least`` or more: scope, left_set, right_set (sorted arrays), similarity.

    Members of a set are found by the set. Empty and null sets, and null scopes, are similar to nothing. Sizes filter first (a set ``least`` times as large can't do), then prefixes, then the sets themselves.
    """
    a, b = (kept(_sets(x.select(F.col(scope).alias("scope"), F.col(items).alias("items")).where("scope IS NOT NULL"), "items")) for x in (left, right))
    each = a.select("scope", F.explode("set").alias("item")).unionAll(b.select("scope", F.explode("set").alias("item")))
    often = kept(each.groupBy("scope", "item").agg(F.count(F.lit(1)).alias("often")))

    def prefix(sets: DataFrame, name: str) -> DataFrame:
        rows = sets.select("scope", "set_id", F.size("set").alias("n"), F.explode("set").alias("item")).join(often, ["scope", "item"])
        placed = rows.withColumn("place", F.row_number().over(Window.partitionBy("set_id").orderBy("often", "item")))
        return placed.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1).select("scope", "item", F.col("set_id").alias(name), F.col("n").alias(f"n_{name}"))

    met = prefix(a, "l").join(prefix(b, "r"), ["scope", "item"])
    sized = met.where((F.col("n_l") >= F.col("n_r") * least - 1e-9) & (F.col("n_r") >= F.col("n_l") * least - 1e-9)).select("scope", "l", "r").distinct()
    whole = sized.join(a.select(F.col("set_id").alias("l"), F.col("set").alias("left_set")), "l").join(b.select(F.col("set_id").alias("r"), F.col("set").alias("right_set")), "r")
    both = F.size(F.array_intersect("left_set", "right_set"))
    similarity = both / (F.size("left_set") + F.size("right_set") - both)
    return whole.withColumn("similarity", similarity).where(F.col("similarity") >= least).select("scope", "left_set", "right_set", "similarity")


#: So many sets that begin with one item, or items of one key, at most are packed into one row, which sets or packs of the other side meet.
PACK = 512


def packs(rows: DataFrame, keys: Sequence[str], item: Column) -> DataFrame:
    """Items of equal keys in sorted lists of at most ``PACK``: the keys, items. Rows without a key are left out; null items stay."""
    placed = rows.where(reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))).select(*keys, item.alias("item"))
    numbered = placed.withColumn("part", F.row_number().over(Window.partitionBy(*keys).orderBy("item")).cast("long"))
    return numbered.groupBy(*keys, F.floor((F.col("part") - 1) / PACK).alias("part")).agg(F.sort_array(F.collect_list(F.struct("item")))["item"].alias("items")).drop("part")


def _met_sets(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """The sets (scope, set) of the right that are similar to one of the left. The left ones that begin with an item are packed into rows, so that a pair of sets is never a row."""
    each = left.select("scope", F.explode("set").alias("item")).unionAll(right.select("scope", F.explode("set").alias("item")))
    often = each.groupBy("scope", "item").agg(F.count(F.lit(1)).alias("often"))

    def prefix(sets: DataFrame) -> DataFrame:
        counted = sets.select("scope", "set", F.explode("set").alias("item")).join(often, ["scope", "item"])
        ordered = counted.groupBy("scope", "set").agg(F.sort_array(F.collect_list(F.struct("often", "item"))).alias("order"))
        n = F.size("set") - F.ceil(F.size("set") * F.lit(least) - 1e-9) + 1
        return ordered.select("scope", "set", F.explode(F.slice("order", F.lit(1), n.cast("int"))).alias("o")).select("scope", "set", "o.item")

    begun = prefix(left).withColumn("part", F.row_number().over(Window.partitionBy("scope", "item").orderBy("set")).cast("long"))
    packs = begun.groupBy("scope", "item", F.floor((F.col("part") - 1) / PACK).alias("part")).agg(F.collect_list("set").alias("sets"))
    n, m = F.size("set"), lambda x: F.size(x)
    both = lambda x: F.size(F.array_intersect(x, F.col("set")))
    fits = lambda x: (m(x) >= n * least - 1e-9) & (n >= m(x) * least - 1e-9)
    alike = F.exists("sets", lambda x: F.when(fits(x), both(x) / (m(x) + n - both(x)) >= least).otherwise(False))
    return prefix(right).join(packs, ["scope", "item"]).where(alike).select("scope", "set").distinct()


def unmatched(a: DataFrame, b: DataFrame, span: str, text_col: str, least: float = 0.6) -> DataFrame:
    """Rows of the second draft that the first doesn't have: no text of it in the same span is made of the same letters, by a Jaccard similarity of ``least``.

    Case, white space and punctuation don't count. A text without letters matches nothing; repeated rows stay; null spans match nothing.
    Sets that both drafts have are matched by that alone; only the others are compared.
    """
    from lectern.functions.text import search_key

    letters = lambda df: df.withColumn("_set", F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(search_key(F.col(text_col)), F.lit("")), ""), lambda c: c != ""))))
    theirs = letters(b)
    ours, asked = (kept(df.select(F.col(span).alias("scope"), F.col("_set").alias("set")).where("scope IS NOT NULL AND size(set) > 0").distinct()) for df in (letters(a), theirs))
    same = asked.join(ours, ["scope", "set"], "left_semi")
    open_ = kept(asked.join(ours, ["scope", "set"], "left_anti"))
    found = same.unionByName(_met_sets(ours, open_, least)).select(F.col("scope").alias(span), F.col("set").alias("_set"))
    return theirs.join(found, [span, "_set"], "left_anti").select(*b.columns)
