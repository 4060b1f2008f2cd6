"""Objects of a snapshot: built from the views of sources, kept as canonical bytes, and restored byte by byte where nothing touched them.

An object is a row of (collection, object_id, body, sha256); ``body`` is its canonical JSON. A merge carries bodies on and doesn't
build them anew, so an object that isn't affected can't change, not even in the order of its keys. A first snapshot is the same code over an
empty base.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions.canonical import canonical_json
from lectern.functions.text import nfc, padded_id
from lectern.operators.graph import kept
from lectern.operators.intervals import as_of
from lectern.operators.recon import fingerprint
from lectern.operators.records import numbered

PROVENANCE = "array<struct<source_id:string,content_sha256:string,content_status:string>>"
DEFAULT_STATUS = "machine_extracted"
#: Choices by which a candidate asks for an object of its own.
OWN_OBJECT = ("admit_new", "reject_alias")


def _json(*columns: str) -> Column:
    return canonical_json()(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def as_objects(df: DataFrame, collection: str, key: str) -> DataFrame:
    """Rows as objects: all columns in one canonical JSON text, with its hash. Null fields are kept as null."""
    bodies = df.select(F.lit(collection).alias("collection"), F.col(key).cast("string").alias("object_id"), _json(*sorted(df.columns)).alias("body"))
    return bodies.withColumn("sha256", F.sha2("body", 256))


def restored_objects(base: DataFrame, rebuilt: DataFrame, affected: DataFrame, touched: DataFrame) -> DataFrame:
    """The objects of the next snapshot with their ``origin``.

    A base object is carried on as it is (``base``), unless it is both affected (object_id) and touched (object_id) by this round: then it is
    as rebuilt (``built``), or gone if it wasn't rebuilt. What is rebuilt and no base object has is ``new``. Repeated rows of affected or touched don't matter.
    """
    keys = ["collection", "object_id"]
    changing = affected.select("object_id").distinct().join(touched.select("object_id").distinct(), "object_id")
    stays = base.join(changing, "object_id", "left_anti")
    carried = stays.select(*keys, "body", "sha256").withColumn("origin", F.lit("base"))
    built = rebuilt.join(stays.select(*keys), keys, "left_anti").join(base.select(*keys, F.lit(True).alias("_old")), keys, "left")
    return carried.unionByName(built.select(*keys, "body", "sha256", F.when(F.col("_old"), "built").otherwise("new").alias("origin")))


def altered_objects(base: DataFrame, result: DataFrame, affected: DataFrame) -> DataFrame:
    """Base objects outside the affected ones that are gone or whose bytes differ, and bodies that don't have their hash: (check, subject, detail). Hashes are computed anew."""
    outside = base.join(affected.select("object_id").distinct(), "object_id", "left_anti").join(result.select("collection", "object_id", F.col("body").alias("_body")), ["collection", "object_id"], "left")
    row = lambda name, df, detail: df.select(F.lit(name).alias("check"), F.concat_ws("/", "collection", "object_id").alias("subject"), detail.cast("string").alias("detail"))
    differs = outside.where(~F.col("body").eqNullSafe(F.col("_body")))
    return row("untouched", differs, F.when(F.col("_body").isNull(), "gone").otherwise("differs")).unionByName(row("hash", result.where(~F.sha2("body", 256).eqNullSafe(F.col("sha256"))), F.col("sha256")))


def built_concepts(base: DataFrame, mentions: DataFrame, technique: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Concepts after a round, refused mentions, and the ids that were touched.

    base (concept_id, name, aliases, provenance); mentions (source_id, concept_ref, surface, content_status) of approved views. A source's surfaces (NFC, sorted, each once) name a concept that is
    new: the first is its name, the others aliases. A known one gets them as further aliases, in the order of sources, and each source once in its provenance.

    Refused, with all mentions of that source and id: ``family`` (no ``co_`` id), ``technique`` (another one's id), and ``collision`` (the source has declared the id before, and
    shares no surface with it now). Mentions without an id or surface add nothing.
    """
    said = mentions.where(F.col("concept_ref").isNotNull() & (F.trim("surface") != "")).select("source_id", "concept_ref", nfc("surface").alias("surface"), F.coalesce("content_status", F.lit(DEFAULT_STATUS)).alias("content_status"))
    by_source = said.groupBy("source_id", "concept_ref").agg(F.array_sort(F.collect_set("surface")).alias("surfaces"), F.min("content_status").alias("content_status"))
    known = by_source.join(base.select(F.col("concept_id").alias("concept_ref"), "name", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), F.coalesce("provenance", F.array().cast(PROVENANCE)).alias("provenance")), "concept_ref", "left")
    before = Window.partitionBy("concept_ref").orderBy("source_id").rowsBetween(Window.unboundedPreceding, -1)
    declared = F.coalesce(F.array_contains(F.transform("provenance", lambda p: p.source_id), F.col("source_id")), F.lit(False))
    heard = F.array_union(F.array_union("aliases", F.array("name")), F.flatten(F.collect_list("surfaces").over(before)))
    parts = F.split("concept_ref", "_")
    refusal = F.when(~F.startswith("concept_ref", F.lit("co_")), "family").when(F.get(parts, F.lit(1)) != technique, "technique").when(declared & ~F.arrays_overlap(heard, "surfaces"), "collision")
    judged = kept(known.withColumn("refusal", refusal).withColumn("declared", declared))
    good = judged.where("refusal IS NULL")
    rest = F.slice("surfaces", 2, F.greatest(F.size("surfaces") - 1, F.lit(1)))
    own = good.withColumns({"first": F.get("surfaces", F.lit(0)), "rest": F.when(F.size("surfaces") > 1, rest).otherwise(F.array().cast("array<string>"))})
    # Provenance hashes what the source itself says.
    source = own.withColumn("entry", F.struct("source_id", F.sha2(canonical_json()(F.to_json(F.struct(F.col("rest").alias("aliases"), F.col("first").alias("name")))), 256).alias("content_sha256"), "content_status"))
    told = source.groupBy("concept_ref").agg(F.min_by("first", "source_id").alias("first"), F.array_distinct(F.flatten(F.collect_list("rest"))).alias("others"), F.collect_set("first").alias("firsts"), F.array_sort(F.collect_list(F.when(~F.col("declared"), F.col("entry")))).alias("entries"))
    merged = base.select("concept_id", "name", "aliases", "provenance").join(told.withColumnRenamed("concept_ref", "concept_id"), "concept_id", "full")
    name = F.coalesce("name", "first")
    none = F.array().cast("array<string>")
    merged = merged.withColumn("_name", name).withColumn("_nfc", nfc("_name"))
    aliases = F.when(F.col("first").isNull(), F.col("aliases")).otherwise(F.array_sort(F.array_distinct(F.concat(F.coalesce("aliases", none), "others", F.array_except("firsts", F.array("_nfc"))))))
    concepts = merged.select("concept_id", F.col("_name").alias("name"), aliases.alias("aliases"), F.concat(F.coalesce("provenance", F.array().cast(PROVENANCE)), F.coalesce("entries", F.array().cast(PROVENANCE))).cast(PROVENANCE).alias("provenance"))
    return concepts, judged.where("refusal IS NOT NULL").select("source_id", F.col("concept_ref").alias("concept_id"), "refusal"), good.where("name IS NOT NULL").select(F.col("concept_ref").alias("object_id")).distinct()


def free_numbers(asked: DataFrame, used: DataFrame, group: str, order: Sequence[str], start: int) -> DataFrame:
    """The asked rows with ``number``: in order, each gets the least number from ``start`` on that is neither used (group, number) nor given to one before it.

    The r-th free number is start + r - 1 + the used ones below it; a used number stands behind as many free ones as its distance from the start less the used
    ones before it. So ranks and used numbers meet in an as-of join, and no row waits for another.
    """
    ranked = numbered(asked.withColumn("_one", F.lit("x")), ["x"], "_one", [group, *order]).drop("_one").withColumnRenamed("number", "_all")
    firsts = ranked.groupBy(group).agg(F.min("_all").alias("_first"))
    ranked = ranked.join(firsts, group).withColumn("_rank", F.col("_all") - F.col("_first")).drop("_all", "_first")
    taken = used.where(F.col("number") >= start).select(group, "number").distinct().withColumn("_before", F.row_number().over(Window.partitionBy(group).orderBy("number")))
    gaps = taken.select(group, (F.col("number") - start - F.col("_before") + 1).alias("_gap"), "_before").groupBy(group, "_gap").agg(F.max("_before").alias("_taken"))
    return as_of(ranked, gaps, [group], "_rank", "_gap", "_taken", 1 << 16).withColumn("number", F.lit(start).cast("long") + F.col("_rank") + F.coalesce("_taken", F.lit(0))).drop("_rank", "_taken")


def built_patterns(base: DataFrame, candidates: DataFrame, retired: DataFrame, technique: str, watermark: int, range_start: int = 1) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Patterns after a round, refusals, allocated ids and touched ids.

    base (pattern_id, assertion_ids, provenance); candidates (source_id, candidate_key, pattern_id, approved, assertion_ids, content, content_status, choice); retired (pattern_id).
    Candidates that aren't approved add nothing. One without an id gets the next free number above the watermark, in the order of source and key. One with a known id is
    attached to it: assertions united, the source once in the provenance. One with an unknown id is admitted under it. Refused: ``retired`` ids,
    and ``occupied`` ones for which the choice is an object of its own.
    """
    fine = candidates.where(F.coalesce("approved", F.lit(False)))
    pattern_id = padded_id(f"pat_{technique}_", F.col("number"), 6)
    digits = lambda df: df.select(F.lit(technique).alias("technique"), F.regexp_extract("pattern_id", rf"^pat_{technique}_([0-9]+)$", 1).try_cast("long").alias("number")).where("number IS NOT NULL")
    used = digits(base).unionByName(digits(retired)).unionByName(digits(fine.where("pattern_id IS NOT NULL")))
    new = free_numbers(fine.where("pattern_id IS NULL").drop("pattern_id").withColumn("technique", F.lit(technique)), used, "technique", ["source_id", "candidate_key"], max(watermark + 1, range_start)).withColumn("pattern_id", pattern_id)
    allocated = new.select("source_id", "candidate_key", "pattern_id")
    named = fine.where("pattern_id IS NOT NULL").join(base.select("pattern_id", F.lit(True).alias("_old")), "pattern_id", "left").join(retired.select("pattern_id", F.lit(True).alias("_gone")).distinct(), "pattern_id", "left")
    refusal = F.when(F.col("_gone"), "retired").when(F.col("_old") & F.col("choice").isin(*OWN_OBJECT), "occupied")
    named = kept(named.withColumn("refusal", refusal))
    columns = ["pattern_id", "source_id", "assertion_ids", "content", "content_status"]
    added = named.where("refusal IS NULL").select(*columns).unionByName(new.select(*columns))
    entry = F.struct("source_id", F.sha2("content", 256).alias("content_sha256"), F.coalesce("content_status", F.lit(DEFAULT_STATUS)).alias("content_status"))
    by_source = added.groupBy("pattern_id", "source_id").agg(F.flatten(F.collect_list("assertion_ids")).alias("ids"), F.min(entry).alias("entry"))
    told = by_source.groupBy("pattern_id").agg(F.flatten(F.collect_list("ids")).alias("ids"), F.array_sort(F.collect_list("entry")).alias("entries"))
    joined = base.select("pattern_id", "assertion_ids", "provenance").join(told, "pattern_id", "full")
    have = F.coalesce("provenance", F.array().cast(PROVENANCE))
    fresh = F.filter(F.coalesce("entries", F.array().cast(PROVENANCE)), lambda e: ~F.exists(have, lambda p: p.source_id == e.source_id))
    ids = F.when(F.col("ids").isNull(), F.col("assertion_ids")).otherwise(F.array_sort(F.array_distinct(F.concat(F.coalesce("assertion_ids", F.array().cast("array<string>")), "ids"))))
    patterns = joined.select("pattern_id", ids.alias("assertion_ids"), F.concat(have, fresh).cast(PROVENANCE).alias("provenance"))
    return patterns, named.where("refusal IS NOT NULL").select("source_id", "pattern_id", "refusal"), allocated, named.where("refusal IS NULL AND _old").select(F.col("pattern_id").alias("object_id")).distinct()


def inherited(provenance: DataFrame, candidates: DataFrame, modes: DataFrame) -> DataFrame:
    """Objects (object_id) that a replaced source still says the same of.

    provenance (object_id, source_id, content_sha256) of the base; candidates (object_id, source_id, content_sha256) of the views; modes (source_id, mode). The first provenance of a source counts.
    """
    mine = provenance.join(modes.where("mode = 'replacement'").select("source_id"), "source_id", "left_semi")
    same = mine.join(candidates.select("object_id", "source_id", F.col("content_sha256").alias("_now")), ["object_id", "source_id"]).where("content_sha256 = _now")
    return same.select("object_id").distinct()


def dropped_proposals(proposals: DataFrame, unchanged: DataFrame, declared: DataFrame, kinds: Sequence[str] = ("merge", "alias", "conflict"), heads: Sequence[str] = ("pattern", "concept", "provenance_lost")) -> DataFrame:
    """Proposals (proposal_key, head, object_id, kind) with ``dropped``.

    A replacement inherits what hasn't changed: proposals of some kinds about an object that is unchanged (object_id), or an assertion whose key is still declared (object_id), go.
    """
    still = unchanged.select("object_id").unionByName(declared.select("object_id")).distinct().withColumn("_still", F.lit(True))
    about = F.col("head").isin(*heads) & F.col("kind").isin(*kinds)
    return proposals.join(still, "object_id", "left").withColumn("dropped", F.coalesce(F.col("_still") & about, F.lit(False))).select(*proposals.columns, "dropped")


class Rounds(NamedTuple):
    """How rounds of proposals ended: ``converged``, ``awaiting_human``, ``unchanged`` or ``too_many``; the last proposals; and a row for each round."""

    status: str
    proposals: DataFrame
    log: list[tuple[int, int, int, int]]


def _round_counts(proposals: DataFrame, keys: DataFrame) -> Row:
    """A round's counts from one look at its rows: n, an order-free mark of its keys, pending ones, those of them that are human or blocked, and those that depend on anything (waiting)."""
    rows = proposals.join(keys.withColumn("_decided", F.lit(True)), "proposal_key", "left")
    pending = F.col("resolution").isin("human", "blocked") & F.col("_decided").isNull()
    counts = {"pending": pending, "human": pending & (F.col("resolution") == "human"), "blocked": pending & (F.col("resolution") == "blocked"), "waiting": pending & (F.size("depends_on") > 0)}
    return rows.agg(F.count(F.lit(1)).alias("n"), fingerprint(["proposal_key"]).alias("mark"), *(F.count_if(c).alias(name) for name, c in counts.items())).first()


def _ready(proposals: DataFrame, keys: DataFrame) -> int:
    """Number of pending blocked rows of which no row waits for anything that isn't decided."""
    pending = proposals.where(F.col("resolution").isin("human", "blocked")).join(keys, "proposal_key", "left_anti")
    waits = pending.select("proposal_key", F.explode("depends_on").alias("on")).join(keys.select(F.col("proposal_key").alias("on")), "on", "left_anti").select("proposal_key").distinct()
    return pending.where("resolution = 'blocked'").join(waits, "proposal_key", "left_anti").count()


def proposal_rounds(propose: Callable[[int], DataFrame], decided: DataFrame, most: int = 10) -> Rounds:
    """Proposes until nothing is pending.

    ``propose`` gives a round's proposals (proposal_key, resolution, depends_on). Those with resolution ``human`` or ``blocked`` that aren't decided (proposal_key) are pending. A human one ends
    the loop, and so do blocked ones of which none has all it depends on decided. Otherwise the next round follows, unless it
    proposes the same keys again, or ``most`` rounds are over. Only counts and an order-free fingerprint reach the driver: the log holds round, proposals, pending ones, and those ready.
    """
    log, last = [], None
    keys = kept(decided.select("proposal_key").distinct())
    for number in range(1, most + 1):
        proposals = kept(propose(number)) if number == most else propose(number)
        seen = _round_counts(proposals, keys)
        if number < most and (seen.waiting or not seen.blocked or seen.human or (seen.n, seen.mark) == last):
            # Rows that are looked at twice or returned are kept, and counted as they are kept.
            proposals = kept(proposals)
            seen = _round_counts(proposals, keys)
        ready = _ready(proposals, keys) if seen.waiting else seen.blocked
        log.append((number, seen.n, seen.pending, ready))
        if not seen.pending:
            return Rounds("converged", proposals, log)
        if seen.human or not ready:
            return Rounds("awaiting_human", proposals, log)
        if (seen.n, seen.mark) == last:
            return Rounds("unchanged", proposals, log)
        last = seen.n, seen.mark
    return Rounds("too_many", proposals, log)


def rounds_frame(spark: SparkSession, name: str, rounds: Rounds) -> DataFrame:
    """The log of rounds as rows: process, round, n, pending, ready, and the status in the last one."""
    rows = [(name, *r, rounds.status if r is rounds.log[-1] else None) for r in rounds.log]
    return spark.createDataFrame(rows, "process string, round int, n long, pending long, ready long, status string")
