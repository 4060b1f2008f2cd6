"""Declared sources, unit folders, rule files and character dictionaries: rows where a record is sound, and its reason where it isn't.

Files are read by Spark's readers, so any store will do, and parsed to VARIANT; a broken file or record never stops a job. Each reader is a check of (path, text) rows
that works on tables as well. A JSON file has to fit in one row.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lectern.functions.canonical import canonical_text

#: The keys of a declaration, and of its edition part.
REQUIRED = ("source_id", "work_title", "edition_note", "technique_id", "rights_status", "release_policy", "edition_part", "source_site", "source_url", "file_sha256", "pages")
OPTIONAL = ("repo_commit", "yaml_metadata")
PART = ("artifact_id", "label", "pages")
FILLED = ("source_id", "work_title", "technique_id", "rights_status", "release_policy", "source_site")
#: Words of rules, and what stands for others.
LUCK = ("大吉", "吉", "小吉", "平", "小凶", "凶", "大凶")
KINDS = ("贵", "富", "贫", "贱", "夭", "寿", "贤", "愚")
OTHER_LUCK, OTHER_KIND, NO_CATEGORY, NO_SCHOOL = "平", "贵", "通用格局", "自定义"
UNIT_FILES = ("unit", "provenance", "assertions")


def read_whole(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, text) of UTF-8 files below a folder. Files of no bytes are left out, as in all of Spark's file scans."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return found.select("path", F.col("content").cast("string").alias("text"))


def _at(value: Column | str, key: str) -> Column:
    return F.try_variant_get(value, f"$.{key}", "variant")


def _kind(value: Column) -> Column:
    """The JSON type of a value in capitals; null where there is no value."""
    return F.regexp_extract(F.schema_of_variant(value), r"^\w+", 0)


def _string(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", F.variant_get(value, "$", "string"))


def _strings(value: Column) -> Column:
    """The items of an array, null for each that isn't a string; null where it is no array."""
    return F.transform(F.when(_kind(value) == "ARRAY", F.variant_get(value, "$", "array<variant>")), _string)


def _false(ok: Column) -> Column:
    return ~F.coalesce(ok, F.lit(False))


def declarations(rows: DataFrame) -> DataFrame:
    """Declarations of sources from (path, text), with ``code`` and ``problem`` null if they are sound.

    ``SCH_001``: no JSON object (repeated keys count as none), or a key is missing; ``SCH_002``: a key that doesn't belong, or a value of the wrong form. The first problem in the order of keys counts.
    Columns of refused declarations hold what can be read of them.
    """
    one = rows.select("path", "text", F.try_parse_json("text").alias("v")).withColumn("keys", F.when(_kind(F.col("v")) == "OBJECT", F.json_object_keys("text")))
    v = F.col("v")
    texts = {k: _string(_at(v, k)) for k in (*FILLED, "edition_note", "source_url", "file_sha256")}
    part, pages, commit = _at(v, "edition_part"), _strings(_at(v, "pages")), _at(v, "repo_commit")
    part_keys = F.array_sort(F.json_object_keys(F.when(_kind(part) == "OBJECT", F.to_json(part))))
    filled = lambda c: F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, REQUIRED)), "keys"))
    extra = F.array_sort(F.array_except("keys", F.array(*map(F.lit, (*REQUIRED, *OPTIONAL)))))
    named = lambda label, items: F.concat(F.lit(f"{label}:"), F.array_join(items, ","))
    wrong = [(k, ~filled(texts[k])) for k in ("source_id", "work_title")]
    wrong += [("edition_note", texts["edition_note"].isNull())] + [(k, ~filled(texts[k])) for k in FILLED[2:]]
    wrong += [("source_url", _false(texts["source_url"].rlike("^https?://"))), ("file_sha256", _false(texts["file_sha256"].rlike("^[0-9a-f]{64}$")))]
    wrong += [("pages", _false((F.size(pages) > 0) & F.forall(pages, lambda p: F.coalesce(p.rlike("^[a-zA-Z0-9_-]+$"), F.lit(False))) & (F.size(F.array_distinct(pages)) == F.size(pages))))]
    wrong += [("edition_part", _false(part_keys == F.array(*map(F.lit, sorted(PART)))) | ~filled(_string(_at(part, "artifact_id"))) | ~filled(_string(_at(part, "label"))) | _false(_kind(_at(part, "pages")) == "ARRAY"))]
    wrong += [("repo_commit", ~F.coalesce(_kind(commit), F.lit("VOID")).isin("STRING", "VOID"))]
    form = F.coalesce(*(F.when(bad, F.lit(k)) for k, bad in wrong))
    early = F.when(F.col("keys").isNull(), "no_object").when(F.size(missing) > 0, named("missing", missing))
    judged = one.withColumn("_early", early).withColumn("_late", F.when(F.size(extra) > 0, named("extra", extra)).otherwise(form))
    return judged.select(
        "path", *(texts[k].alias(k) for k in texts), pages.alias("pages"), F.struct(_string(_at(part, "artifact_id")).alias("artifact_id"), _string(_at(part, "label")).alias("label"), _strings(_at(part, "pages")).alias("pages")).alias("edition_part"),
        _string(commit).alias("repo_commit"), F.to_json(_at(v, "yaml_metadata")).alias("yaml_metadata"), F.when(F.col("_early").isNotNull(), "SCH_001").when(F.col("_late").isNotNull(), "SCH_002").alias("code"), F.coalesce("_early", "_late").alias("problem"),
    )


def read_declarations(spark: SparkSession, path: str) -> DataFrame:
    return declarations(read_whole(spark, path, "*.json"))


@F.pandas_udf(StringType())
def json_or_yaml(text: pd.Series) -> pd.Series:
    """Canonical JSON of a text that is JSON or, failing that, YAML; null for neither, and for YAML where no YAML library is installed. Dates become text."""
    try:
        import yaml
    except ImportError:  # optional
        yaml = None

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        try:
            return canonical_text(json.loads(t))
        except ValueError:
            pass
        try:
            return None if yaml is None else canonical_text(json.loads(json.dumps(yaml.safe_load(t), default=str)))
        except (ValueError, TypeError, yaml.YAMLError):
            return None

    return text.map(one)


def units(files: DataFrame, prefix: str = "ku_") -> DataFrame:
    """Unit folders from (path, text) of files ``<unit>/unit|provenance|assertions.<ending>``, JSON or YAML.

    unit_id, provenance and assertions (JSON), span_ids (those of all assertions, flat, each once, in their order) and problem: ``missing:..``, ``twice:..`` (two endings), ``unparsable:..``, ``identity`` (the unit names another id), ``assertions`` (no list).
    Folders without the prefix and other files are left out; a skipped unit stays in the table with its problem.
    """
    at = files.select(F.element_at(F.split("path", "/"), -2).alias("unit_id"), F.regexp_extract("path", r"([^/]+)\.(?:json|ya?ml)$", 1).alias("file"), "text")
    parsed = at.where(F.startswith("unit_id", F.lit(prefix)) & F.col("file").isin(*UNIT_FILES)).withColumn("json", json_or_yaml("text"))
    # max over repeats keeps the row small whatever a folder holds; repeats are refused anyway.
    count = lambda f: F.count_if(F.col("file") == f).alias(f"n_{f}")
    one = parsed.groupBy("unit_id").agg(*(F.max(F.when(F.col("file") == f, F.col("json"))).alias(f) for f in UNIT_FILES), *map(count, UNIT_FILES))
    listed = lambda label, test: F.array_join(F.array_compact(F.array(*(F.when(test(f), F.lit(f"{label}:{f}")) for f in UNIT_FILES))), ",")
    named = lambda label, test: F.when(listed(label, test) != "", listed(label, test))
    # Each text is parsed once, into columns of its own; only arrays can be read as arrays.
    named_id, items = _string(F.col("_id")), F.col("_items")
    one = one.withColumn("_id", _at(F.try_parse_json("unit"), "unit_id")).withColumn("_items", F.try_variant_get(F.try_parse_json("assertions"), "$", "array<variant>"))
    ids = lambda a: F.filter(F.transform(F.try_variant_get(a, "$.span_ids", "array<variant>"), _string), lambda s: s.isNotNull())
    spans = F.array_distinct(F.flatten(F.transform(items, lambda a: F.coalesce(ids(a), F.array().cast("array<string>")))))
    problem = F.coalesce(named("missing", lambda f: F.col(f"n_{f}") == 0), named("twice", lambda f: F.col(f"n_{f}") > 1), named("unparsable", lambda f: F.col(f).isNull()), F.when(_false(named_id == F.col("unit_id")), "identity"), F.when(items.isNull(), "assertions"))
    return one.select("unit_id", "provenance", "assertions", spans.alias("span_ids"), problem.alias("problem"))


def read_units(spark: SparkSession, path: str) -> DataFrame:
    return units(read_whole(spark, path, "*"))


def rule_records(files: DataFrame) -> DataFrame:
    """The records of rule files (path, text), each file a JSON list, with a problem or null: ``file`` (no list; place is null), ``record`` (no object), ``id``, ``name``, or the field that isn't text.

    A broken record says nothing about its neighbours. Missing fields have their defaults, words of luck and kind that aren't known become the neutral one, and conditions stay as JSON.
    """
    parsed = files.select("path", F.try_parse_json("text").alias("v"))
    items = F.when(_kind(F.col("v")) == "ARRAY", F.variant_get("v", "$", "array<variant>"))
    broken = parsed.where(_kind(F.col("v")).isNull() | (_kind(F.col("v")) != "ARRAY")).select("path", F.lit(None).cast("int").alias("place"), F.lit(None).cast("variant").alias("r"))
    each = parsed.select("path", F.posexplode(items).alias("place", "r")).unionByName(broken)
    r = F.col("r")
    field = lambda key, default=None: F.coalesce(_string(_at(r, key)), F.lit(default).cast("string"))
    odd = lambda key: ~F.coalesce(_kind(_at(r, key)), F.lit("VOID")).isin("STRING", "VOID")
    optional = ("className", "books", "source", "description", "jiXiong", "geJuType", "scope")
    problem = F.when(F.col("place").isNull(), "file").when(_false(_kind(r) == "OBJECT"), "record").when(_string(_at(r, "id")).isNull(), "id").when(_string(_at(r, "name")).isNull(), "name").otherwise(F.coalesce(*(F.when(odd(k), F.lit(k)) for k in optional)))
    known = lambda key, words, other: F.when(field(key).isin(*words), field(key)).otherwise(other)
    conditions = _at(r, "conditions")
    return each.select(
        "path", "place", _string(_at(r, "id")).alias("pattern_id"), _string(_at(r, "name")).alias("name"), field("className", NO_CATEGORY).alias("category"), field("books", NO_SCHOOL).alias("school"), known("jiXiong", LUCK, OTHER_LUCK).alias("luck"),
        known("geJuType", KINDS, OTHER_KIND).alias("kind"), field("scope", "both").alias("scope"), F.when(_kind(conditions) != "VOID", F.to_json(conditions)).alias("conditions"), field("source").alias("chapter"), field("description").alias("description"), problem.alias("problem"),
    )


def imported_rules(records: DataFrame, known: DataFrame) -> DataFrame:
    """The sound records that bring a new pattern: of each id the first by path and place, unless ``known`` (pattern_id) has it. Aggregated before the shuffle, however often an id comes."""
    values = [c for c in records.columns if c not in ("pattern_id", "problem")]
    first = records.where("problem IS NULL").groupBy("pattern_id").agg(F.min(F.struct("path", "place", *(c for c in values if c not in ("path", "place")))).alias("r"))
    return first.select("pattern_id", "r.*").join(known.select("pattern_id").distinct(), "pattern_id", "left_anti")


def import_counts(records: DataFrame, imported: DataFrame) -> DataFrame:
    """One row: records read, imported, skipped (sound, but not new), with errors; broken files; categories and schools named by sound records."""
    sound = F.col("problem").isNull()
    read = records.agg(F.count("place").alias("n_records"), F.count_if(sound).alias("_sound"), F.count_if(~sound & F.col("place").isNotNull()).alias("n_errors"), F.count_if(F.col("place").isNull()).alias("n_files_broken"))
    named = [records.where(sound).select(c).distinct().agg(F.count(F.lit(1)).alias(f"n_{c}")) for c in ("category", "school")]
    counts = read
    for part in (imported.agg(F.count(F.lit(1)).alias("n_imported")), *named):
        counts = counts.unionByName(part, allowMissingColumns=True)
    one = counts.agg(*(F.max(c).alias(c) for c in counts.columns))
    return one.select("n_records", "n_imported", (F.col("_sound") - F.col("n_imported")).alias("n_skipped"), "n_errors", "n_files_broken", "n_category", "n_school")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    return rule_records(read_whole(spark, path, "*.json"))


def keyed_character(key: Column) -> Column:
    """The character that a key means: itself, if it is one of the common Han block, else by its code point, as ``U+4E00`` or ``4e00``; null for anything else."""
    digits = F.regexp_extract(F.upper(F.trim(key)), r"^(?:U\+)?([0-9A-F]{1,6})$", 1)
    code = F.conv(digits, 16, 10).try_cast("int")
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(key.rlike(r"^[一-鿿]$"), key).when(valid, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32"))


def character_fields(lines: DataFrame, line: str) -> DataFrame:
    """(char, field, value) of dictionary lines ``U+4E00<tab>field<tab>value``, one row for each character and field; of several values the greatest. Comments, short lines and keys that mean no character are left out."""
    parts = F.split(F.col(line), "\t")
    cut = lines.where((F.col(line) != "") & ~F.startswith(line, F.lit("#"))).select(parts.alias("p")).where(F.size("p") >= 3)
    each = cut.select(keyed_character(F.get("p", F.lit(0))).alias("char"), F.trim(F.get("p", F.lit(1))).alias("field"), F.trim(F.get("p", F.lit(2))).alias("value"))
    return each.where("char IS NOT NULL").groupBy("char", "field").agg(F.max("value").alias("value"))


def character_documents(rows: DataFrame) -> DataFrame:
    """The same of JSON files (path, text) whose keys are characters or code points and whose values are objects of fields. Values that aren't text are left out."""
    keys = rows.select(F.from_json("text", "map<string,map<string,string>>").alias("m")).select(F.explode("m").alias("key", "fields"))
    each = keys.select(keyed_character(F.col("key")).alias("char"), F.explode("fields").alias("field", "value"))
    return each.where("char IS NOT NULL AND value IS NOT NULL").groupBy("char", "field").agg(F.max("value").alias("value"))


def read_characters(spark: SparkSession, path: str) -> DataFrame:
    """The fields of all ``Unihan*.txt`` and JSON files below a folder."""
    texts = character_fields(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "Unihan*.txt").text(path), "value")
    both = texts.unionByName(character_documents(read_whole(spark, path, "*.json")))
    return both.groupBy("char", "field").agg(F.max("value").alias("value"))


#: The fields that a look-up gives.
LOOKED_UP: Mapping[str, str] = {"radical": "kRSUnicode", "strokes": "kTotalStrokes", "reading": "kMandarin", "definition": "kDefinition"}


def looked_up(chars: DataFrame, fields: DataFrame, char: str = "char", own: Sequence[str] = ()) -> DataFrame:
    """Characters with their code point, radical, strokes (the first number), reading and definition; null where the dictionary has none. Values of ``own`` columns of that name stand in for those.

    The dictionary is joined, not broadcast by force; it has one row a character, so even a very frequent one only repeats on the other side.
    """
    entry = fields.groupBy(F.col("char").alias("_char")).agg(*(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f"_{name}") for name, f in LOOKED_UP.items())).withColumn("_strokes", F.split_part("_strokes", F.lit(" "), F.lit(1)))
    value = lambda name: (F.coalesce(F.col(f"_{name}"), F.col(name)) if name in own else F.col(f"_{name}")).alias(name)
    code = F.regexp_replace(F.hex(F.encode(F.col(char), "UTF-32")), "^0{0,4}", "")
    rest = [c for c in chars.columns if c not in LOOKED_UP]
    return chars.join(entry, chars[char] == entry["_char"], "left").select(*rest, F.when(F.length(char) == 1, F.concat(F.lit("U+"), code)).alias("unicode"), *map(value, LOOKED_UP))
