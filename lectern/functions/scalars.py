"""Identifiers, closed mappings, cleaned titles, sets, boxes and domain-separated hashes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The families of identifiers.
_HEX, _WORK, _EDITION = "[0-9a-f]{32}", "[a-z][a-z0-9]*", "ed[0-9]{2}"
ID_FAMILIES = {
    "artifact_id": f"art_{_HEX}",
    "artifact_revision_id": f"rev_{_HEX}",
    "processing_run_id": f"prun_{_HEX}",
    "step_run_id": f"srun_{_HEX}",
    "stage_package_id": f"pkg_m[1-8]_{_HEX}",
    "release_id": f"rel_{_HEX}",
    "school_id": "sch_[a-z][a-z0-9]*_[0-9]{3}",
    "school_view_id": f"sv_{_HEX}",
    "conflict_group_id": f"cg_{_HEX}",
    "pattern_id": "pat_[a-z][a-z0-9]*_[0-9]{6}",
    "entry_id": f"ent_{_HEX}",
    "source_id": f"src_{_WORK}_{_EDITION}",
    "source_span_id": f"ss_{_WORK}_{_EDITION}_(?:p[0-9]{{4}}_s[0-9]{{2}}|o[0-9]{{7}})",
    "semantic_span_id": f"sem_{_WORK}_{_EDITION}_o[0-9]{{7}}",
    "knowledge_unit_id": "ku_[a-z][a-z0-9]*_[0-9]{6}",
    "assertion_id": "as_[a-z][a-z0-9]*_[0-9]{6}",
    "proposition_id": "pr_[a-z][a-z0-9]*_[0-9]{6}",
    "shared_concept_id": "co_shared_[a-z][a-z0-9]*_[0-9]{2}",
    "technique_concept_id": "co_[a-z][a-z0-9]*_[0-9]{6}",
    "homograph_anchor_id": "hg_[0-9]{4}",
}


def is_id(kind: str, value: Column) -> Column:
    """Whether a value is an identifier of a family; null isn't."""
    return F.coalesce(value.rlike(f"^{ID_FAMILIES[kind]}$"), F.lit(False))


def id_kind(value: Column) -> Column:
    """The family whose prefix a value begins with; of several the longest prefix's. Null where none is."""
    prefixes = {kind: ("co_shared_" if kind == "shared_concept_id" else pattern.split("_", 1)[0] + "_") for kind, pattern in ID_FAMILIES.items()}
    return F.coalesce(*(F.when(value.startswith(p), kind) for kind, p in sorted(prefixes.items(), key=lambda x: (-len(x[1]), x[1]))))


def id_part(value: Column, part: str) -> Column:
    """``work``, ``edition``, ``page`` or ``offset`` of a span's identifier; null where it has none."""
    pattern = {"work": rf"^(?:ss|sem|src)_({_WORK})_{_EDITION}", "edition": rf"^(?:ss|sem|src)_{_WORK}_({_EDITION})", "page": r"_p([0-9]{4})_s[0-9]{2}$", "offset": r"_o([0-9]{7})$"}[part]
    found = F.nullif(F.regexp_extract(value, pattern, 1), F.lit(""))
    return found.cast("int") if part in ("page", "offset") else found


def without_space(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def without_headings(text: Column) -> Column:
    """The lines that don't begin with ``#``."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~line.startswith("#")), "\n")


def han_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^一-鿿]", "")


def shown(char: Column) -> Column:
    """A character, or a box for one that is null or empty."""
    return F.coalesce(F.nullif(char, F.lit("")), F.lit("□"))


def repaired(text: Column, table: Mapping[str, str]) -> Column:
    """Private characters replaced by a table of single characters; null if one remains that the table doesn't know."""
    known = sorted(table)
    out = F.translate(text, "".join(known), "".join(table[k] for k in known)) if known else text
    return F.when(~out.rlike(r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]"), out)


#: Fixed value: what numbers a title.
TITLE_NUMBER = r"^(?:卷[0-9一二三四五六七八九十]+|第[0-9一二三四五六七八九十]+[章节卷回]|[0-9]+)[、.\s·]*"


def bare_title(title: Column) -> Column:
    """A title without its volume, chapter or running number."""
    return F.trim(F.regexp_replace(title, TITLE_NUMBER, ""))


def punctuation_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\p{P}"))


def mapped(value: Column, table: Mapping[str, str], default: str) -> Column:
    """A closed mapping with a default for unknown and null values."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), value), F.lit(default)) if pairs else F.lit(default)


def allowed_only(text: Column, classes: Sequence[str]) -> Column:
    """Only characters of the listed classes (inner parts of a bracket expression)."""
    return F.regexp_replace(text, f"[^{''.join(classes)}]", "")


def slug(name: Column, units: int = 4) -> Column:
    """Hex of the first UTF-16 units of a name, four digits each, joined by underscores."""
    digits = F.substring(F.lower(F.hex(F.encode(name, "UTF-16BE"))), 1, 4 * units)
    return F.array_join(F.regexp_extract_all(digits, F.lit("[0-9a-f]{4}"), F.lit(0)), "_")


@F.pandas_udf(DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matching characters by the length of both texts, matched as Python's ``SequenceMatcher`` does; nulls count as empty."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype=float)


def sorted_set(items: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(items)))


def present(items: Column) -> Column:
    """Whether a list has any entry; a null list hasn't."""
    return F.coalesce(F.size(items) > 0, F.lit(False)) & items.isNotNull()


def first_of(items: Column) -> Column:
    return F.get(items, F.lit(0))


def joined_hash(domain: str, *parts: Column) -> Column:
    """SHA-256 over a domain and length-prefixed parts, so that no two lists of parts, and no two domains, run together. Null differs from empty."""
    piece = lambda c: F.when(c.isNull(), F.lit("-1:")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")))
    return F.sha2(F.concat(F.lit(f"{len(domain.encode())}:{domain}"), *(piece(p) for p in parts)), 256)


def set_hash(domain: str, items: Column) -> Column:
    """Hash of a collection whatever its order; null if an entry comes twice or is null."""
    piece = lambda x: F.concat(F.octet_length(x).cast("string"), F.lit(":"), x)
    body = F.array_join(F.transform(F.array_sort(items), piece), "")
    return F.when((F.size(F.array_distinct(items)) == F.size(items)) & ~F.exists(items, lambda x: x.isNull()), F.sha2(F.concat(F.lit(f"{len(domain.encode())}:{domain}"), F.size(items).cast("string"), F.lit("|"), body), 256))


def token_hash(token: Column, version: Column) -> Column:
    """A token's hash, bound to the version of the row that it was given for."""
    return F.sha2(F.concat_ws(":", token, version.cast("string")), 256)


def contains_box(outer: Column, inner: Column, tolerance: float = 0.0) -> Column:
    """Whether a box (struct x, y, w, h) lies in another one, give or take ``tolerance``."""
    return (
        (inner["x"] >= outer["x"] - tolerance) & (inner["y"] >= outer["y"] - tolerance)
        & (inner["x"] + inner["w"] <= outer["x"] + outer["w"] + tolerance) & (inner["y"] + inner["h"] <= outer["y"] + outer["h"] + tolerance)
    )


def union_box(box: Column) -> Column:
    """Aggregate: the least box that holds all boxes."""
    x, y = F.min(box["x"]), F.min(box["y"])
    return F.struct(x.alias("x"), y.alias("y"), (F.max(box["x"] + box["w"]) - x).alias("w"), (F.max(box["y"] + box["h"]) - y).alias("h"))


def polar(x: Column, y: Column, centre_x: Column, centre_y: Column) -> Column:
    """Angle in degrees (0 to 360) and distance of a point from a centre."""
    angle = F.degrees(F.atan2(y - centre_y, x - centre_x))
    return F.struct(F.when(angle < 0, angle + 360).otherwise(angle).alias("angle"), F.hypot(x - centre_x, y - centre_y).alias("distance"))
