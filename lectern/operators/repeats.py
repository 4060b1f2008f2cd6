"""Repeated lines, paragraphs and documents, and runs of like rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def repeated_parts(df: DataFrame, separator: str, least: int, most: int, times: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Trimmed parts of a text that occur in it ``times`` or more: id, part, n, first_index. Parts of other lengths don't count."""
    parts = df.select(id_col, F.posexplode(F.split(text_col, separator)).alias("index", "part")).withColumn("part", F.trim("part"))
    sized = parts.where(F.length("part").between(least, most))
    return sized.groupBy(id_col, "part").agg(F.count(F.lit(1)).alias("n"), F.min("index").alias("first_index")).where(F.col("n") >= times)


def repeated_lines(df: DataFrame, **columns: str) -> DataFrame:
    return repeated_parts(df, "\n", 2, 40, 3, **columns)


def repeated_paragraphs(df: DataFrame, **columns: str) -> DataFrame:
    return repeated_parts(df, "\n", 8, 1 << 30, 2, **columns)


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts that several rows have: content hash, number and least id. Only hashes are shuffled."""
    return df.select(F.sha2(text_col, 256).alias("sha256"), id_col).where("sha256 IS NOT NULL").groupBy("sha256").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first_id")).where("n > 1")


def islands(df: DataFrame, keys: list[str], order: list[str], same: Column, least: int = 1) -> DataFrame:
    """Runs of rows that follow each other with an equal value: keys, value, n, first and last of the first order column."""
    whole = Window.partitionBy(*keys).orderBy(*order)
    alike = Window.partitionBy(*keys, "value").orderBy(*order)
    marked = df.withColumn("value", same).withColumn("island", F.row_number().over(whole) - F.row_number().over(alike))
    return marked.groupBy(*keys, "value", "island").agg(F.count(F.lit(1)).alias("n"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last")).where(F.col("n") >= least).drop("island")


def diagram_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", marks: str = r"[|+*=#$%&_\-]", per_line: int = 3, lines: int = 2) -> DataFrame:
    """Blocks of consecutive lines with several drawing marks: id, first and last line, number of lines."""
    each = df.select(id_col, F.posexplode(F.split(text_col, "\n")).alias("line", "content")).withColumn("drawn", F.regexp_count("content", F.lit(marks)) >= per_line)
    return islands(each, [id_col], ["line"], F.col("drawn"), lines).where("value").drop("value")
