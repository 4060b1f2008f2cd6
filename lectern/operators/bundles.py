"""Bundles: packs of one release that become visible together or not at all, and the manifests that name them.

Packs are written aside, each to a folder that nothing else uses, then read back and hashed as they lie there. Only then does one manifest
row name them, in a file that Spark's committer puts in place at once. Readers go by manifests alone, so a job that dies leaves folders that
nobody sees; its attempt stays in the list of unfinished ones.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.canonical import canonical_json, canonical_text
from lectern.operators.graph import kept

MANIFEST = "release_id string, attempt string, parent string, canonical_hash string, packs array<struct<pack:string,folder:string,n:bigint,sha256:string,columns:string>>"
NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")
#: Hex digits of a part of a row's hash, and bits of the pieces that its 64 bits are summed in (the first has one more); whole numbers hold the sums of any 2^41 rows.
WORD, PIECE = 16, 21


class BundleRefused(ValueError):
    """A bundle that can't be committed or opened."""


def rows_digest(rows: DataFrame) -> DataFrame:
    """One row: n, and a SHA-256 that doesn't depend on the order of rows or columns. Every row's JSON (nulls kept) is hashed, the parts of the hashes are made numbers and summed in pieces, and the sums are hashed.

    It aggregates before it shuffles. It finds damage and lost, added or repeated rows; it isn't meant against an adversary. An empty table has a digest too.
    """
    names = [f"`{c}`" for c in sorted(rows.columns)]
    hashed = rows.select(F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256).alias("h"))
    parts = hashed.select(*(F.xxhash64(F.substring("h", 1 + WORD * i, WORD)).alias(f"x{i}") for i in range(4)))
    low = F.lit((1 << PIECE) - 1).cast("long")
    pieces = [p for x in parts.columns for p in (F.shiftrightunsigned(x, 2 * PIECE), F.shiftrightunsigned(x, PIECE).bitwiseAND(low), F.col(x).bitwiseAND(low))]
    summed = parts.agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(p), F.lit(0)).cast("string").alias(f"s{i}") for i, p in enumerate(pieces)))
    return summed.select("n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), *(f"s{i}" for i in range(len(pieces)))), 256).alias("sha256"))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at a path; None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _measured(spark: SparkSession, root: str, pack: str, folder: str) -> dict:
    """What lies in a folder: rows, digest and columns, read from there."""
    rows = _stored(spark, f"{root}/{folder}")
    if rows is None:
        return {"pack": pack, "folder": folder, "n": None, "sha256": None, "columns": None}
    n, sha256 = rows_digest(rows).first()
    return {"pack": pack, "folder": folder, "n": n, "sha256": sha256, "columns": rows.schema.simpleString()}


def canonical_hash(packs: Sequence[Mapping]) -> str:
    """The hash of a bundle: over names and digests of its packs, in the order of names."""
    return hashlib.sha256(canonical_text(sorted([p["pack"], p["sha256"]] for p in packs)).encode()).hexdigest()


def manifests(spark: SparkSession, root: str) -> DataFrame:
    return _lines(spark, f"{root}/manifests", MANIFEST)


def _manifest_of(spark: SparkSession, root: str, release_id: str):
    """The release's manifest or None. Two writers at once with different contents leave two manifests: such a release is contested and refused."""
    found = manifests(spark, root).where(F.col("release_id") == release_id).orderBy("attempt").collect()
    if len({m["canonical_hash"] for m in found}) > 1:
        raise BundleRefused(f"{release_id} is contested: {len(found)} manifests")
    return found[0] if found else None


def _publish(spark: SparkSession, root: str, release_id: str, attempt: str, parent: str | None, packs: list[dict]) -> str:
    """Writes the manifest row unless the release has an equal one; a different one is refused."""
    digest, known = canonical_hash(packs), _manifest_of(spark, root, release_id)
    if known is not None:
        if known["canonical_hash"] != digest:
            raise BundleRefused(f"{release_id} exists with other contents")
        return digest
    spark.createDataFrame([(release_id, attempt, parent, digest, [tuple(p.values()) for p in packs])], MANIFEST).coalesce(1).write.mode("append").json(f"{root}/manifests")
    return digest


def _begin(spark: SparkSession, root: str, release_id: str, names: Sequence[str]) -> str:
    if not names:
        raise BundleRefused("a bundle needs a pack")
    for name in (release_id, *names):
        if not NAME.fullmatch(name):
            raise BundleRefused(f"not a name: {name!r}")
    attempt = uuid.uuid4().hex
    spark.createDataFrame([(release_id, attempt)], "release_id string, attempt string").coalesce(1).write.mode("append").json(f"{root}/attempts")
    return attempt


def _write(spark: SparkSession, root: str, release_id: str, attempt: str, packs: Mapping[str, DataFrame]) -> list[dict]:
    done = []
    for name in sorted(packs):
        folder = f"packs/{release_id}/{attempt}/{name}"
        packs[name].write.parquet(f"{root}/{folder}")
        done.append(_measured(spark, root, name, folder))
    return done


def commit_bundle(root: str, release_id: str, packs: Mapping[str, DataFrame]) -> str:
    """Writes the packs (any schemas; empty ones too) as one release under ``root`` and returns its canonical hash.

    Committing equal contents again changes nothing and gives the same hash; other contents for a release that exists are refused, as are names that aren't plain.
    """
    spark = next((p.sparkSession for p in packs.values()), None)
    attempt = _begin(spark, root, release_id, list(packs))
    return _publish(spark, root, release_id, attempt, None, _write(spark, root, release_id, attempt, packs))


def unfinished_attempts(spark: SparkSession, root: str) -> DataFrame:
    """(release_id, attempt) of commits that no manifest names: cut off, refused, or repeats of a release. Their folders hold nothing that is visible."""
    named = manifests(spark, root).select(F.explode("packs.folder").alias("f")).select(F.split_part("f", F.lit("/"), F.lit(3)).alias("attempt")).distinct()
    return _lines(spark, f"{root}/attempts", "release_id string, attempt string").join(named, "attempt", "left_anti").select("release_id", "attempt")


def bundle_problems(spark: SparkSession, root: str, release_id: str) -> list[tuple[str, str]]:
    """(pack, problem) of a visible release, everything read and hashed anew: ``missing``, ``columns_differ``, ``rows_differ`` (another number), ``digest_differs``; ``manifest`` where its own hash is wrong."""
    manifest = _manifest_of(spark, root, release_id)
    if manifest is None:
        raise BundleRefused(f"no release {release_id}")
    problems = [] if canonical_hash(manifest["packs"]) == manifest["canonical_hash"] else [("", "manifest")]
    for p in manifest["packs"]:
        now = _measured(spark, root, p["pack"], p["folder"])
        problem = "missing" if now["columns"] is None else next((label for field, label in (("columns", "columns_differ"), ("n", "rows_differ"), ("sha256", "digest_differs")) if now[field] != p[field]), None)
        problems += [(p["pack"], problem)] if problem else []
    return problems


def open_bundle(spark: SparkSession, root: str, release_id: str) -> dict[str, DataFrame]:
    """The packs of a release; a torn one (any problem) is refused whole."""
    problems = bundle_problems(spark, root, release_id)
    if problems:
        raise BundleRefused(f"{release_id} is torn: {problems}")
    return {p["pack"]: spark.read.parquet(f"{root}/{p['folder']}") for p in _manifest_of(spark, root, release_id)["packs"]}


def migrate_bundle(spark: SparkSession, root: str, release_id: str, target: str, recodings: Mapping[str, Callable[[DataFrame], DataFrame]]) -> str:
    """A new release with some packs recoded to another schema; the others are named again where they lie and not copied. Returns its canonical hash.

    The source has to be whole, and every recoding has to give one row for each row: a rebuild that loses rows is refused before anything of it is visible.
    """
    packs = open_bundle(spark, root, release_id)
    if set(recodings) - set(packs):
        raise BundleRefused(f"no packs {sorted(set(recodings) - set(packs))}")
    source = _manifest_of(spark, root, release_id)
    attempt = _begin(spark, root, target, list(packs))
    built = _write(spark, root, target, attempt, {name: recode(packs[name]) for name, recode in recodings.items()})
    before = {p["pack"]: p["n"] for p in source["packs"]}
    lost = [b["pack"] for b in built if b["n"] != before[b["pack"]]]
    if lost:
        raise BundleRefused(f"recoding changes the number of rows of {lost}")
    stays = [p.asDict() for p in source["packs"] if p["pack"] not in recodings]
    return _publish(spark, root, target, attempt, release_id, sorted(built + stays, key=lambda p: p["pack"]))


def recoded(rows: DataFrame, columns: Mapping[str, Column], drop: Sequence[str] = ()) -> DataFrame:
    """The rows with columns computed anew (in place; further ones at the end) and others gone; computed from the old values, whatever their order."""
    kept_names = [c for c in rows.columns if c not in drop]
    return rows.select(*((columns[c].alias(c) if c in columns else F.col(f"`{c}`")) for c in kept_names), *(v.alias(c) for c, v in columns.items() if c not in kept_names))


def tree_digests(items: DataFrame, group: str, key: str, digest: str, widths: Sequence[int] = (4, 2)) -> DataFrame:
    """For each group: n, and the root of a tree over its items' hashes, whatever their order. Leaves are hashed ``key:digest``; nodes hash their sorted children, by leading hex digits (four, then two, then all).

    Work and rows are spread over the first level's 65,536 nodes, so no group comes together in one row. Nulls count as empty.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    leaf = F.sha2(F.concat(text(key), F.lit(":"), text(digest)), 256)
    nodes = items.select(group, leaf.alias("h"), F.lit(1).cast("long").alias("n")).withColumn("at", F.substring("h", 1, widths[0]))
    for width in (*widths[1:], 0):
        joined = nodes.groupBy(group, "at").agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("h"))
        nodes = joined.withColumn("at", F.substring("at", 1, width))
    return nodes.groupBy(group).agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("sha256"))


def release_manifests(releases: DataFrame, packs: DataFrame, inputs: DataFrame, levels: Sequence[str], types: Sequence[str]) -> DataFrame:
    """A manifest for each release, or the reason why it has none.

    releases (release_id, admitted, consumption_level, watermark_required, watermark_text, known_defects), packs (release_id, pack_type, sha256), inputs (release_id, artifact_revision_id, sha256).
    Refusals, the first that holds: ``not_admitted`` (anything but a clear yes and a level of ``levels``), ``no_pack``, ``unknown_pack``, ``pack_twice``, ``pack_hash`` (not 64 hex digits), ``watermark`` (needed, but empty).
    Returns release_id, refusal, canonical_hash (over [type, hash] in the order of types), n_inputs, inputs_sha256 (`tree_digests`), manifest (canonical JSON) and sha256 of it; all but the first two are null if refused.
    The manifest holds the inputs' number and root, as a release may have any number; its packs are at most one of each of ``types``.
    """
    known = F.col("pack_type").isin(*types)
    # Repeats and unknown types are counted, never collected: a release keeps one entry for each known type.
    each = packs.groupBy("release_id", F.when(known, F.col("pack_type")).alias("t")).agg(F.count(F.lit(1)).alias("c"), F.min("sha256").alias("sha256"), F.bool_and(F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))).alias("ok"))
    entry = F.when(F.col("t").isNotNull(), F.struct(F.col("t").alias("pack_type"), "sha256"))
    per = each.groupBy("release_id").agg(F.array_sort(F.collect_list(entry)).alias("packs"), F.bool_or(F.col("t").isNull()).alias("_unknown"), F.bool_or(F.col("c") > 1).alias("_twice"), F.bool_and("ok").alias("_ok"))
    roots = tree_digests(inputs, "release_id", "artifact_revision_id", "sha256").select("release_id", F.col("n").alias("n_inputs"), F.col("sha256").alias("inputs_sha256"))
    both = releases.join(per, "release_id", "left").join(roots, "release_id", "left")
    admitted = F.coalesce(F.col("admitted") & F.col("consumption_level").isin(*levels), F.lit(False))
    bare = F.coalesce(F.col("watermark_required"), F.lit(True)) & (F.trim(F.coalesce("watermark_text", F.lit(""))) == "")
    refusal = F.when(~admitted, "not_admitted").when(F.col("packs").isNull(), "no_pack").when(F.col("_unknown"), "unknown_pack").when(F.col("_twice"), "pack_twice").when(~F.col("_ok"), "pack_hash").when(bare, "watermark")
    pairs = F.transform("packs", lambda p: F.array(p["pack_type"], p["sha256"]))
    judged = both.withColumn("refusal", refusal).withColumn("n_inputs", F.coalesce("n_inputs", F.lit(0).cast("long"))).withColumn("canonical_hash", F.sha2(canonical_json()(F.to_json(pairs)), 256))
    body = F.to_json(F.struct(F.lit("release_manifest").alias("manifest_type"), "release_id", "consumption_level", "packs", "canonical_hash", "n_inputs", "inputs_sha256", F.struct(F.col("watermark_required").alias("required"), F.col("watermark_text").alias("text")).alias("watermark"), "known_defects", F.lit("partial").alias("completeness_claim"), F.lit(False).alias("authoritative")), {"ignoreNullFields": "false"})
    made = judged.withColumn("manifest", canonical_json()(body))
    held = lambda c: F.when(F.col("refusal").isNull(), F.col(c)).alias(c)
    return made.withColumn("sha256", F.sha2("manifest", 256)).select("release_id", "refusal", *(held(c) for c in ("canonical_hash", "n_inputs", "inputs_sha256", "manifest", "sha256")))


def evidence_map(spans: DataFrame, pages: DataFrame, excluded: DataFrame) -> DataFrame:
    """Entries of an evidence map, each with its refusal or null.

    spans (span_id like ``..p0012_s03``, page, line_index, text, anchor struct<page, image_sha256, bbox, chars array<struct<char, box>>>), boxes being struct<x, y, w, h>; pages (page, width, height, asset_width, asset_height, image_sha256), one
    row each; excluded (page). Refusals, the first that holds: ``identity`` (page or line number isn't the id's), ``twice``, ``excluded``, ``no_page``, ``anchor_page``, ``image``, ``frame`` (document and asset differ in size), ``outside`` (a box leaves the
    page). The level is ``glyph`` where the characters spell the text, else ``line_bbox``. Null boxes are outside; no characters at all spell an empty text.
    """
    twice = spans.groupBy("span_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("span_id", F.lit(True).alias("_twice"))
    known = pages.select("page", "width", "height", "asset_width", "asset_height", "image_sha256", F.lit(True).alias("_known"))
    out = excluded.select("page").distinct().withColumn("_excluded", F.lit(True))
    rows = spans.join(twice, "span_id", "left").join(known, "page", "left").join(out, "page", "left")
    number = lambda c, pattern: F.regexp_extract(c, pattern, 1).try_cast("long")
    same = (number("span_id", r"p(\d+)_s\d+$") == number("page", r"(\d+)$")) & (number("span_id", r"_s(\d+)$") == F.col("line_index") + 1)
    within = lambda b: F.coalesce((b["x"] >= 0) & (b["y"] >= 0) & (b["w"] > 0) & (b["h"] > 0) & (b["x"] + b["w"] <= F.col("width")) & (b["y"] + b["h"] <= F.col("height")), F.lit(False))
    chars = F.coalesce(F.col("anchor.chars"), F.array())
    no = lambda c: ~F.coalesce(c, F.lit(False))
    refusal = (
        F.when(no(same), "identity").when(F.col("_twice"), "twice").when(F.col("_excluded"), "excluded").when(F.col("_known").isNull(), "no_page").when(no(F.col("anchor.page") == F.col("page")), "anchor_page")
        .when(no(F.col("anchor.image_sha256") == F.col("image_sha256")), "image").when(no((F.col("width") == F.col("asset_width")) & (F.col("height") == F.col("asset_height"))), "frame")
        .when(~within(F.col("anchor.bbox")) | F.exists(chars, lambda c: ~within(c["box"])), "outside")
    )
    spelled = F.array_join(F.transform(chars, lambda c: F.coalesce(c["char"], F.lit(""))), "") == F.coalesce("text", F.lit(""))
    return rows.select("span_id", "page", "line_index", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("quote_sha256"), F.when(spelled, "glyph").otherwise("line_bbox").alias("level"), F.size(chars).cast("long").alias("n_glyphs"), refusal.alias("refusal"))


def level_counts(entries: DataFrame) -> DataFrame:
    """Number of entries and glyphs of each level, of those that weren't refused."""
    return entries.where("refusal IS NULL").groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.sum("n_glyphs").alias("n_glyphs"))


#: So many pages that come again, or that have a character twice, are told to all tasks; more are joined by sorting.
TOLD = 100_000


def page_tables(docs: DataFrame) -> dict[str, DataFrame]:
    """The tables of page documents (page, book, width, height, chars) that searches need, for a bundle: ``pages`` with their number of characters, ``characters`` one row each, ``rare`` counts and ``rare_places`` every place.

    Of repeated pages, and of repeated characters of a page (page, id), the greatest row stays; a rare one without a character counts under its original one, and is left out if it has neither.
    Only pages that have something twice are dealt out by character; they are found first, by their ids.
    """
    ids = F.col("chars.id")
    twice = F.coalesce(F.max(F.size(F.array_distinct(ids)) < F.size(ids)), F.lit(False))
    again = kept(docs.groupBy("page").agg((twice | (F.count(F.lit(1)) > 1)).alias("again")).where("again").select(F.col("page").alias("_page")))
    n = again.count()
    told, same = F.broadcast(again) if n <= TOLD else again, F.col("page").eqNullSafe(F.col("_page"))
    values = ["book", "char", "orig_char", "status", "is_rare", "rare_reason"]

    def characters(rows: DataFrame, chars: Column) -> DataFrame:
        each = rows.select("book", "page", F.explode(chars).alias("c"))
        return each.select("page", F.col("c.id").alias("char_id"), "book", "c.char", "c.orig_char", "c.status", F.coalesce("c.is_rare", F.lit(False)).alias("is_rare"), "c.rare_reason")

    def once(chars: Column) -> DataFrame:
        """Characters of pages that have all things once, as far as they are in ``chars``, and all of the others."""
        if n == 0:
            return characters(docs, chars)
        greatest = characters(docs.join(told, same, "left_semi"), F.col("chars")).groupBy("page", "char_id").agg(F.max(F.struct(*values)).alias("v")).select("page", "char_id", "v.*")
        return characters(docs, chars).join(told, same, "left_anti").unionByName(greatest)

    named = lambda c: F.when(F.col(c) != "", F.col(c))
    rare = once(F.filter("chars", lambda c: c["is_rare"])).where("is_rare")
    places = rare.select(F.coalesce(named("char"), named("orig_char")).alias("char"), "page", "char_id", "rare_reason").where("char IS NOT NULL")
    sized = F.struct("book", "width", "height", F.coalesce(F.size("chars"), F.lit(0)).alias("n_chars"))
    pages = docs.groupBy("page").agg(F.max(sized).alias("v")).select("page", "v.*")
    return {"pages": pages, "characters": once(F.col("chars")), "rare": places.groupBy("char").agg(F.count(F.lit(1)).alias("n")), "rare_places": places}
