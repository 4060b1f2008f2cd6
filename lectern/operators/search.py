"""Search products: substring and token search, character index, nearest rows, rank fusion."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import search_key


def search_index(spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Spans with the normalised text that searches look at."""
    return spans.withColumn("search_text", search_key(F.col(text_col)))


def tokens(spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Inverted index: token, id, number."""
    words = F.filter(F.split(F.lower(text_col), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return spans.select(id_col, F.explode(words).alias("token")).groupBy("token", id_col).agg(F.count(F.lit(1)).alias("n"))


def locate(index: DataFrame, query: str, id_col: str, text_col: str) -> DataFrame:
    """Spans whose normalised text holds the normalised query; if there are none, those that have all of its words.

    ``_`` in a query stands for any character, an empty query fits all, as in SQL's LIKE.
    """
    key = index.sparkSession.range(1).select(search_key(F.lit(query))).first()[0]
    hits = index.where(F.col("search_text").like(f"%{key}%")).withColumn("how", F.lit("substring"))
    if not hits.isEmpty():
        return hits
    wanted = sorted({w for w in query.lower().split() if w})
    found = tokens(index, id_col, text_col).where(F.col("token").isin(*wanted)).groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(wanted))
    return index.join(found.select(id_col), id_col, "left_semi").withColumn("how", F.lit("words"))


def character_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How often each text has each character that isn't white space. Characters are counted within their text, so only distinct ones are made rows."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = [Counter(t or "") for t in batch.column("text").to_pylist()]
                flat = [(i, c, n) for i, counts in enumerate(found) for c, n in counts.items() if c not in " \t\n\x0b\f\r"]
                ids = batch.column("id").take(pa.array([f[0] for f in flat], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([f[1] for f in flat], pa.string()), pa.array([f[2] for f in flat], pa.int64())], names=["id", "char", "n"])

    counted = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, char string, n long").withColumnRenamed("id", id_col)
    return counted.groupBy(id_col, "char").agg(F.sum("n").alias("n"))


def rare_characters(index: DataFrame, id_col: str = "doc_id", at_most: int = 20) -> DataFrame:
    """Characters with few occurrences in all, and the texts that have them in order. Totals come first, so that common characters gather nothing."""
    rare = index.groupBy("char").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_docs")).where(F.col("total") <= at_most)
    places = index.join(rare.select("char"), "char", "left_semi").groupBy("char").agg(F.array_join(F.sort_array(F.collect_list(id_col)), ",").alias("doc_ids"))
    return rare.join(places, "char")


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def nearest_to(df: DataFrame, query: DataFrame, id_col: str, vector_col: str, k: int, threshold: float = 0.5) -> DataFrame:
    """Exact nearest rows of one query vector (a table of one row, ``q``), above a threshold; ties to the smaller id."""
    scored = df.join(F.broadcast(query.limit(1))).select(id_col, cosine(F.col(vector_col), F.col("q")).alias("score")).where(F.col("score") >= threshold)
    return scored.orderBy(F.col("score").desc(), id_col).limit(k)


def fuse_ranks(lists: list[DataFrame], id_col: str, k: int = 60) -> DataFrame:
    """Reciprocal rank fusion of ranked lists (id, rank)."""
    every = lists[0]
    for x in lists[1:]:
        every = every.unionByName(x)
    return every.groupBy(id_col).agg(F.sum(1.0 / (F.col("rank") + k)).alias("fused"))


def ranks(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
