"""Integrity gates: checks give rows (check, subject, detail) and never raise; a verdict folds them.

Gates compute everything anew and use nothing of the producers' modules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def failures(df: DataFrame, check: str, subject: str, wrong: Column, detail: Column | None = None) -> DataFrame:
    return df.where(F.coalesce(wrong, F.lit(True))).select(F.lit(check).alias("check"), F.col(subject).cast("string").alias("subject"), (F.lit("") if detail is None else detail.cast("string")).alias("detail"))


def unique(df: DataFrame, check: str, key: str) -> DataFrame:
    """Keys that come more than once."""
    many = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return many.select(F.lit(check).alias("check"), F.col(key).cast("string").alias("subject"), F.col("n").cast("string").alias("detail"))


def references(df: DataFrame, check: str, subject: str, key: str, targets: DataFrame, target_key: str) -> DataFrame:
    """Rows whose key isn't null and has no target."""
    gone = df.where(F.col(key).isNotNull()).join(targets.select(F.col(target_key).alias(key)), key, "left_anti")
    return gone.select(F.lit(check).alias("check"), F.col(subject).cast("string").alias("subject"), F.col(key).cast("string").alias("detail"))


def same_sets(a: DataFrame, b: DataFrame, check: str, key: str) -> DataFrame:
    """Keys that only one side has."""
    x, y = (t.select(F.col(key).cast("string").alias("subject")).distinct() for t in (a, b))
    one = x.join(y, "subject", "left_anti").withColumn("detail", F.lit("left only"))
    return one.unionByName(y.join(x, "subject", "left_anti").withColumn("detail", F.lit("right only"))).select(F.lit(check).alias("check"), "subject", "detail")


def consecutive(df: DataFrame, check: str, group: str, seq: str, first: int = 0) -> DataFrame:
    """Rows whose number isn't the one due in its group."""
    due = F.row_number().over(Window.partitionBy(group).orderBy(seq)) - 1 + first
    return failures(df.withColumn("_due", due), check, group, F.col(seq) != F.col("_due"), F.concat_ws("!=", F.col(seq), F.col("_due")))


def all_of(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def verdict(checks: DataFrame, names: list[str]) -> DataFrame:
    """Each named check with its number of failures and whether it passed; checks without rows passed."""
    spark = checks.sparkSession
    known = spark.range(1).select(F.explode(F.array(*(F.lit(n) for n in names))).alias("check"))
    counts = checks.groupBy("check").agg(F.count(F.lit(1)).alias("n"))
    return known.join(counts, "check", "left").select("check", F.coalesce("n", F.lit(0)).alias("failures"), F.col("n").isNull().alias("passed"))
