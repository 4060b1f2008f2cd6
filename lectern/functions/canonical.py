"""Canonical JSON and hashes of it."""

from __future__ import annotations

import json
from typing import Any

import pandas as pd
from pyspark.sql import functions as F


_ENCODER = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def canonical_text(value: Any, final_newline: bool = False) -> str:
    """Sorted keys, no spaces, characters as they are; not-a-number is refused."""
    return _ENCODER.encode(value) + "\n" * final_newline


def without_keys(value: Any, suffixes: tuple[str, ...]) -> Any:
    """The value without the keys that end in one of the suffixes, at any depth."""
    if isinstance(value, dict):
        return {k: without_keys(v, suffixes) for k, v in value.items() if not k.endswith(suffixes)}
    return [without_keys(v, suffixes) for v in value] if isinstance(value, list) else value


def canonical_json(final_newline: bool = False, drop_suffixes: tuple[str, ...] = ()):
    """A pandas UDF from JSON text to canonical JSON; null where it can't be parsed or holds a number that isn't one."""

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else canonical_text(without_keys(json.loads(text), drop_suffixes) if drop_suffixes else json.loads(text), final_newline)
        except ValueError:
            return None

    @F.pandas_udf("string")
    def run(text: pd.Series) -> pd.Series:
        return text.map(one)

    return run


def canonical_hash(text: F.Column, drop_suffixes: tuple[str, ...] = ()) -> F.Column:
    return F.sha2(canonical_json(drop_suffixes=drop_suffixes)(text), 256)
