"""Scalar functions over text; all offsets count code points and intervals are half open."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def occurrences(text: Column, part: Column) -> Column:
    """How often ``part`` occurs in ``text`` without overlap; 0 for an empty part, null if either is null."""
    n = F.length(part)
    return F.when(n == 0, F.lit(0)).otherwise(((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / n).cast("int"))


def slice_between(text: Column, start: Column, stop: Column) -> Column:
    """Code points [start, stop) of text."""
    return F.substring(text, start + 1, stop - start)


def search_key(text: Column) -> Column:
    """Lower case without white space and punctuation, apart from ``_``."""
    return F.lower(F.regexp_replace(text, r"[\s\p{P}&&[^_]]+", ""))


def squeeze(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def letters_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two texts' sets of characters; null if both are empty."""
    x, y = (F.array_distinct(F.filter(F.split(c, ""), lambda ch: ch != "")) for c in (a, b))
    return F.size(F.array_intersect(x, y)) / F.nullif(F.size(F.array_union(x, y)), F.lit(0))


def first_difference(a: Column, b: Column) -> Column:
    """Offset of the first code point in which two texts differ; null where they are equal or one is null. A text that the other begins with differs at its end."""
    x, y = F.split(a, ""), F.split(b, "")
    differ = F.zip_with(x, y, lambda p, q: ~p.eqNullSafe(q))
    at = F.array_position(differ, F.lit(True))
    return F.when(a != b, F.when((a == "") | (b == ""), F.lit(0)).otherwise((at - 1).cast("int")))


def padded_id(prefix: str, number: Column, width: int = 4) -> Column:
    """The prefix and the number with zeros up to a width; longer numbers stay whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def stable_key(kind: str, *parts: Column) -> Column:
    """``kind:`` and 32 hex digits of a SHA-256 over the parts, each with its length, so that no two lists of parts run together. Null counts as empty."""
    joined = F.concat_ws("|", *(F.concat_ws(":", F.octet_length(F.coalesce(p.cast("string"), F.lit(""))), F.coalesce(p.cast("string"), F.lit(""))) for p in parts))
    return F.concat(F.lit(f"{kind}:"), F.substring(F.sha2(joined, 256), 1, 32))


def one_of(column: Column, allowed: Iterable[str]) -> Column:
    """Whether a value is in a closed set; null isn't."""
    return F.coalesce(column.isin(*allowed), F.lit(False))


def missing_fields(*names: str) -> Column:
    """Names of the columns that are null, as an array."""
    return F.array_compact(F.array(*(F.when(F.col(n).isNull(), n) for n in names)))


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition without white space at the ends; Spark has no built-in for it."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t).strip())
