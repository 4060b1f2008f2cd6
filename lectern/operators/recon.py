"""Reconciliation: comparing two lanes, pairing, precedence of verdicts, incremental merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.similar import packs, shared_items


def lanes_agree(a: DataFrame, b: DataFrame, key: str, body: str) -> DataFrame:
    """Per key: bodies of either lane, and whether they are equal as multisets; keys of one lane only are kept."""
    fold = lambda x, name: x.groupBy(key).agg(F.sort_array(F.collect_list(body)).alias(name))
    both = fold(a, "left_bodies").join(fold(b, "right_bodies"), key, "full")
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return both.select(key, size("left_bodies").cast("long").alias("n_left"), size("right_bodies").cast("long").alias("n_right"), F.coalesce(F.col("left_bodies") == F.col("right_bodies"), F.lit(False)).alias("agreed"))


def overlap_pairs(groups: DataFrame, group: str, item: str, least: int = 2) -> DataFrame:
    """Pairs of groups that share ``least`` items or more. Groups meet at their rarer items; see ``shared_items``."""
    return shared_items(groups, group, item, least)


def ranked_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Pairs that agree by any rule, with the best (first) rule that they agree by: left_id, right_id, rule.

    Each rule is an equality of two columns; null keys match nothing. Rules are joined one by one, since a disjunction would become a nested loop, and a pair that an earlier rule has is left out.
    Rows meet in packs, which are dealt out by key and pack, so that no key is one task's; a pair is a row only where it is returned, unless an id has several rows.
    """
    names = [f"key_{i}" for i in range(len(rules))]
    a = left.select(F.col(left_id).alias("id"), *(F.col(c).alias(n) for n, (c, _) in zip(names, rules, strict=True)))
    b = right.select(F.col(right_id).alias("id"), *(F.col(c).alias(n) for n, (_, c) in zip(names, rules, strict=True)))
    many = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits = []
    for i, key in enumerate(names):
        x, y = (packs(side, [key], F.struct("id", *names[:i])).withColumnRenamed("items", name) for side, name in ((a, "xs"), (b, "ys")))
        met = x.join(y, key).repartition(many, key, F.col("xs")[0], F.col("ys")[0])
        each = met.select(F.explode("xs").alias("x"), "ys").select("x", F.explode("ys").alias("y"))
        for n in names[:i]:
            each = each.where(~F.coalesce(F.col(f"x.{n}") == F.col(f"y.{n}"), F.lit(False)))
        hits.append(each.select(F.col("x.id").alias("left_id"), F.col("y.id").alias("right_id"), F.lit(i).alias("rule")))
    united = reduce(DataFrame.unionByName, hits)
    several = a.groupBy("id").count().unionAll(b.groupBy("id").count()).where("count > 1")
    return united if several.isEmpty() else united.groupBy("left_id", "right_id").agg(F.min("rule").alias("rule"))


def linked_classes(left: DataFrame, right: DataFrame, left_id: str, right_id: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Each row of both sides with its class and its number of links: side, id, class_id, key_0, key_1, ..., links_0, links_1, ...

    Each rule is an equality of two columns; null keys match nothing. Two rows of different sides are linked if any of their keys are equal, by the first rule whose keys are. ``links_i`` counts
    the links by rule i. Rows of a side with the same keys are one class, named by its least id: they have the same links, so classes
    and keys tell every pair, and no pair becomes a row. Links that an earlier rule takes are subtracted by counts of rows that agree by both.
    """
    names = [f"key_{i}" for i in range(len(rules))]

    def packed(df: DataFrame, id_col: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        rows = df.select(F.col(id_col).alias("id"), *(F.col(c).alias(n) for c, n in zip(columns, names, strict=True)))
        return rows, rows.groupBy(*names).agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("_n"))

    def counted(classes: DataFrame, others: DataFrame) -> DataFrame:
        for i, last in enumerate(names):
            terms = []
            for size in range(i + 1):
                for some in combinations(names[:i], size):
                    term = f"_t{i}_{'_'.join(some)}"
                    agree = others.groupBy(*some, last).agg(F.sum("_n").alias(term))
                    classes = classes.join(agree, [*some, last], "left")
                    terms.append(F.coalesce(term, F.lit(0)) * (-1) ** size)
            classes = classes.withColumn(f"links_{i}", reduce(Column.__add__, terms))
        return classes.select(*names, "class_id", *(f"links_{i}" for i in range(len(rules))))

    def told(side: str, rows: DataFrame, classes: DataFrame) -> DataFrame:
        same = reduce(Column.__and__, (F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names))
        joined = rows.join(classes.withColumnsRenamed({n: f"_{n}" for n in names}), same)
        return joined.select(F.lit(side).alias("side"), "id", "class_id", *names, *(f"links_{i}" for i in range(len(rules))))

    (a, of_a), (b, of_b) = packed(left, left_id, [x for x, _ in rules]), packed(right, right_id, [y for _, y in rules])
    return told("left", a, counted(of_a, of_b)).unionByName(told("right", b, counted(of_b, of_a)))


def precedence(rows: DataFrame, key: str, verdict: str, ranking: Sequence[str]) -> DataFrame:
    """Each key's strongest verdict; the first of ``ranking`` is the strongest. Verdicts outside it don't count."""
    rank = F.array_position(F.array(*(F.lit(v) for v in ranking)), F.col(verdict))
    return rows.where(rank > 0).groupBy(key).agg(F.min(rank).alias("_r")).select(key, F.element_at(F.array(*(F.lit(v) for v in ranking)), F.col("_r").cast("int")).alias("outcome"))


def changed_rows(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Full outer comparison of two versions: key and whether it was added, removed or changed; equal rows are left out."""
    pack = lambda x, name: x.select(key, F.struct(*columns).alias(name))
    both = pack(old, "_old").join(pack(new, "_new"), key, "full")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    return both.withColumn("change", change).where("change IS NOT NULL").select(key, "change")


def merge_version(base: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The base with every key that comes anew replaced whole; what isn't touched stays as it is."""
    return base.join(incoming.select(*keys).distinct(), list(keys), "left_anti").unionByName(incoming.select(*base.columns))


def fingerprint(columns: Sequence[str]) -> Column:
    """An order-free hash of the columns, as an aggregate."""
    return F.sum(F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in sorted(columns))).cast("decimal(38,0)"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free hash, to compare an incremental table with a full one."""
    return df.agg(F.count(F.lit(1)).alias("n"), fingerprint(df.columns).alias("fingerprint"))


def not_comparable(rows: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows that fail a check, with the first that they fail; an unknown outcome fails too, so that missing is never taken for equal."""
    reason = F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks))
    return rows.withColumn("reason", reason).where("reason IS NOT NULL")


def next_ids(existing: Sequence[Column], prefix: str) -> Column:
    """The largest number behind ``prefix`` in the id columns, as an aggregate; 0 where there is none."""
    return F.coalesce(F.max(F.greatest(*(F.coalesce(F.regexp_extract(c, rf"^{prefix}(\d+)$", 1).try_cast("long"), F.lit(0)) for c in existing), F.lit(0))), F.lit(0))


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_r") <= n).drop("_r")
