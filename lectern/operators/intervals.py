"""Interval and as-of joins by bins, without nested loops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def points_in_intervals(points: DataFrame, intervals: DataFrame, point: str, start: str, stop: str, width: int, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs of a point and an interval [start, stop) that holds it, over whole numbers; with ``keys``, of the same keys.

    Intervals are entered in each bin of ``width`` that they touch and points in one, so the join is an equality with a filter.
    ``width`` should be about the usual length of an interval.
    """
    binned = intervals.where(F.col(start) < F.col(stop)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(stop) - 1) / width))))
    return points.withColumn("_bin", F.floor(F.col(point) / width)).join(binned, [*keys, "_bin"]).where((F.col(point) >= F.col(start)) & (F.col(point) < F.col(stop))).drop("_bin")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, right_time: str, value: str, width: int | None = None) -> DataFrame:
    """Each left row with the value of the last right row of its key at or before its time; null if there is none.

    One sort of both sides together; a right row stands before left rows of the same time. With ``width``, times are numbers and keys are
    split into bins of it: each bin sorts its own rows, and is told what the bins before it ended with, so that no key is one task's work.
    """
    if width is None:
        return _as_of(left, right, keys, time, right_time, value)
    of = lambda c: F.floor(F.col(c) / width)
    a, b = left.withColumn("_bin", of(time)), right.select(*keys, right_time, value).withColumn("_bin", of(right_time))
    final = b.groupBy(*keys, "_bin").agg(F.max_by(F.struct(value), right_time).alias("_end"))
    bins = final.unionByName(a.select(*keys, "_bin").distinct().withColumn("_end", F.lit(None).cast(final.schema["_end"].dataType))).groupBy(*keys, "_bin").agg(F.max_by("_end", F.col("_end").isNotNull()).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    told = bins.withColumn("_before", F.last("_end", ignorenulls=True).over(before)).where("_before IS NOT NULL").select(*keys, "_bin", "_before")
    # A bin's first row is what came before it.
    first = told.select(*keys, "_bin", (F.col("_bin") * width).cast(right.schema[right_time].dataType).alias(right_time), F.col(f"_before.{value}").alias(value), F.lit(0).alias("_own"))
    return _as_of(a, b.withColumn("_own", F.lit(1)).unionByName(first), [*keys, "_bin"], time, right_time, value, ["_own"]).select(*left.columns, value)


def _as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, right_time: str, value: str, then: Sequence[str] = ()) -> DataFrame:
    rest = [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.col(time).alias("_t"), F.lit(1).alias("_side"), *(F.lit(0).alias(f"_then_{c}") for c in then), F.struct(*rest).alias("_row"), F.lit(None).cast(right.schema[value].dataType).alias("_value"), F.lit(False).alias("_has"))
    b = right.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), *(F.col(c).alias(f"_then_{c}") for c in then), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"), F.col(value).alias("_value"), F.lit(True).alias("_has"))
    upto = Window.partitionBy(*keys).orderBy("_t", "_side", *(f"_then_{c}" for c in then)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("_has"), F.struct("_value")), ignorenulls=True).over(upto)
    return a.unionByName(b).withColumn("_last", last).where("_side = 1").select(*keys, "_row.*", F.col("_last._value").alias(value))
