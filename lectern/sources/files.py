"""Sources: text files of unknown encoding, page documents, logs, e-books and HTML."""

from __future__ import annotations

import codecs
import html
import posixpath
import re
import zipfile
from collections.abc import Iterator
from io import BytesIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = (
    "page string, book string, image string, width int, height int, "
    "lines array<struct<id:string,box:struct<x:double,y:double,w:double,h:double>,level:string,parent:string,text:string,children:array<string>,conf:double,angle:double>>, "
    "chars array<struct<id:string,box:struct<x:double,y:double,w:double,h:double>,level:string,parent:string,angle:double,char:string,orig_char:string,conf:double,source:string,status:string,is_rare:boolean,rare_reason:string>>"
)


def decode_bytes(data: bytes) -> tuple[str | None, str | None]:
    """Text and encoding: UTF-8 with its mark, UTF-8, GB 18030, else nothing."""
    for name in ("utf-8-sig",) if data.startswith(codecs.BOM_UTF8) else ("utf-8", "gb18030"):
        try:
            return data.decode(name), name
        except UnicodeDecodeError:
            continue
    return None, None


def read_text_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, size, sha256 of the raw bytes, encoding, text (line ends as ``\\n``) and its sha256; encoding and text are null where no encoding fits."""

    @F.pandas_udf("struct<text:string,encoding:string>")
    def decoded(content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decode_bytes(bytes(c)) for c in content], columns=["text", "encoding"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    rows = files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), decoded("content").alias("d"))
    return rows.select("path", "size", "sha256", "d.encoding", F.regexp_replace("d.text", "\r\n?", "\n").alias("text")).withColumn("text_sha256", F.sha2("text", 256))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page documents with a fixed schema; what can't be parsed is in ``_corrupt_record``."""
    return spark.read.schema(PAGE_SCHEMA + ", _corrupt_record string").option("multiLine", True).option("pathGlobFilter", "*.json").json(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; broken ones are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def split_pages(transcripts: DataFrame, text_col: str = "text") -> DataFrame:
    """Bodies of transcripts that have ``<!-- p0001 -->`` marks: other columns, page and body."""
    parts = F.regexp_extract_all(text_col, F.lit(r"(?s)<!--\s*(p\d+)\s*-->(.*?)(?=<!--\s*p\d+\s*-->|\z)"), F.lit(0))
    rest = [c for c in transcripts.columns if c != text_col]
    one = transcripts.select(*rest, F.explode(parts).alias("_part"))
    return one.select(*rest, F.regexp_extract("_part", r"p\d+", 0).alias("page"), F.regexp_replace("_part", r"^<!--\s*p\d+\s*-->\s*|\s+\z", "").alias("body"))


#: What ``html.unescape`` takes for a reference.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def with_html_text(df: DataFrame, fragment: str, text: str) -> DataFrame:
    """Adds the text of HTML: tags away, entities resolved, white space squeezed. Only the references to characters go to Python, not the texts that they stand in."""

    @F.pandas_udf("array<string>")
    def unescaped(references: pd.Series) -> pd.Series:
        return references.map(lambda xs: None if xs is None else [html.unescape(x) for x in xs])

    bare = F.regexp_replace(F.regexp_replace(fragment, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<!--.*?-->|<[^>]*>", " ")
    parts = df.withColumn("_bare", bare).withColumn("_meant", unescaped(F.regexp_extract_all("_bare", F.lit(REFERENCE), F.lit(0))))
    whole = F.array_join(F.zip_with(F.split("_bare", REFERENCE), "_meant", lambda piece, meant: F.concat(piece, F.coalesce(meant, F.lit("")))), "")
    return parts.withColumn(text, F.trim(F.regexp_replace(whole, r"\s+", " "))).drop("_bare", "_meant")


def epub_sections(data: bytes) -> list[tuple[int, str, str]]:
    """(place, file, text) of an e-book's files in reading order."""
    with zipfile.ZipFile(BytesIO(data)) as book:
        container = ElementTree.fromstring(book.read("META-INF/container.xml"))
        package = next(e.get("full-path") for e in container.iter() if e.tag.endswith("rootfile"))
        opf = ElementTree.fromstring(book.read(package))
        items = {e.get("id"): e.get("href") for e in opf.iter() if e.tag.endswith("}item")}
        out = []
        for place, ref in enumerate(e.get("idref") for e in opf.iter() if e.tag.endswith("}itemref")):
            name = posixpath.normpath(posixpath.join(posixpath.dirname(package), items[ref]))
            body = re.sub(r"(?s)<[^>]*>", " ", book.read(name).decode("utf-8", "replace"))
            out.append((place, name, " ".join(html.unescape(body).split())))
        return out


def read_epub(spark: SparkSession, path: str) -> DataFrame:
    """path, place, file, text and error: sections of e-books; a broken book gives one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows += [(name, *s, None) for s in epub_sections(bytes(content))]
                except (KeyError, StopIteration, ValueError, zipfile.BadZipFile, ElementTree.ParseError) as e:
                    rows.append((name, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "place", "file", "text", "error"]).astype({"place": "Int32"})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").load(path).select("path", "content").mapInPandas(run, "path string, place int, file string, text string, error string")
