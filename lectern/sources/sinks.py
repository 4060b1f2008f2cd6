"""Sinks: exports in text forms, partitions replaced whole, task packages, manifests and reports. All writes go where the caller says, by Spark's writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def export_text(rows: DataFrame, path: str, form: str, columns: Sequence[str]) -> None:
    """Writes the columns as ``json`` lines, ``tsv`` with a header, or ``txt`` (one column)."""
    picked = rows.select(*columns)
    if form == "json":
        picked.write.mode("overwrite").json(path)
    elif form == "tsv":
        picked.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
    elif form == "txt":
        picked.write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown form {form}")


def replace_partitions(rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replaces the partitions that the rows belong to, and leaves all others as they are."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def rebuild(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def append_events(events: DataFrame, path: str) -> None:
    """Appends to a table that nothing is ever removed from."""
    events.write.mode("append").parquet(path)


def task_packages(rows: DataFrame, path: str, batch: str, columns: Sequence[str]) -> None:
    """One folder of JSON lines for each batch."""
    rows.select(batch, *columns).repartition(batch).write.mode("overwrite").partitionBy(batch).json(path)


def put_by_content(table: DataFrame, blobs: DataFrame, content: str = "content") -> DataFrame:
    """Blobs (binary) that the content-addressed table doesn't have yet: sha256, size_bytes, content, once each."""
    keyed = blobs.where(F.col(content).isNotNull()).select(F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("long").alias("size_bytes"), F.col(content).alias("content"))
    return keyed.dropDuplicates(["sha256"]).join(table.select("sha256"), "sha256", "left_anti")


def corpus_manifest(rows: DataFrame, key: str, content: Column) -> DataFrame:
    """One row for each exported item: key, bytes and SHA-256."""
    return rows.select(key, F.octet_length(content).cast("long").alias("n_bytes"), F.sha2(content, 256).alias("sha256"))


def report_lines(quality: DataFrame, page: str = "page") -> DataFrame:
    """A Markdown table of page statistics, as numbered lines: a head, then the pages in order, then their sum (null page)."""
    spark: SparkSession = quality.sparkSession
    head = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(i).alias("part"), F.lit("").alias("at"), F.lit(t).alias("line")) for i, t in enumerate(("| page | characters | rare | low confidence | unrecognized | corrected |", "|---|---|---|---|---|---|"))))).alias("r")).select("r.*")
    body = quality.select(F.when(F.col(page).isNull(), 3).otherwise(2).alias("part"), F.coalesce(F.col(page).cast("string"), F.lit("")).alias("at"), F.format_string("| %s | %d | %d | %d | %d | %d |", F.coalesce(F.col(page).cast("string"), F.lit("all")), "total", "not_common", "low_conf", "unrecognized", "corrected").alias("line"))
    return head.unionByName(body).orderBy("part", "at")
