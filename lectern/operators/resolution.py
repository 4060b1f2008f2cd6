"""Entity resolution and incremental merge: modes, hit matrix, collation, split, merge and retirement with their refusals.

Nothing is guessed: whatever the rules don't settle comes out as a row for people, or as a refusal with its reason.
"""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lectern.functions.text import nfc, padded_id
from lectern.operators.graph import kept


def view_modes(views: DataFrame, base: DataFrame, source: str = "source_id", parts: str = "parts") -> DataFrame:
    """How each view (source, parts) meets the base: ``new``, ``replacement`` (equal parts), ``extension`` (none in common) or ``refused`` (some)."""
    joined = views.join(base.select(source, F.col(parts).alias("_base")), source, "left")
    mine, theirs = F.array_sort(F.array_distinct(parts)), F.array_sort(F.array_distinct("_base"))
    mode = F.when(F.col("_base").isNull(), "new").when((mine == theirs) & (F.size(mine) > 0), "replacement").when(~F.arrays_overlap(parts, "_base"), "extension").otherwise("refused")
    return joined.select(source, mode.alias("mode"))


def candidate_hits(candidates: DataFrame, base: DataFrame, key: str, base_id: str, keys_col: str, name: str, distinct_pairs: DataFrame | None = None) -> DataFrame:
    """For each candidate the sorted ids of base objects that share a key with it. Null keys match nothing, declared distinct pairs (key, base id) don't count."""
    left = candidates.select(key, F.explode(keys_col).alias("_k")).where("_k IS NOT NULL").distinct()
    right = base.select(base_id, F.explode(keys_col).alias("_k")).where("_k IS NOT NULL").distinct()
    hits = left.join(right, "_k").select(key, base_id).distinct()
    if distinct_pairs is not None:
        hits = hits.join(distinct_pairs, [key, base_id], "left_anti")
    return candidates.select(key).distinct().join(hits.groupBy(key).agg(F.sort_array(F.collect_list(base_id)).alias(name)), key, "left").withColumn(name, F.coalesce(name, F.array().cast(hits.schema[base_id].dataType.simpleString().join(["array<", ">"]))))


def batch_partners(candidates: DataFrame, key: str, keys_col: str) -> DataFrame:
    """For each candidate the sorted other candidates of its batch that share a key.

    The list of all who have a key of some set is made once for each different set of keys; a candidate takes its set's list without itself. So no pairs
    travel, only lists; what is returned still grows with the square of the candidates that share a key.
    """
    each = candidates.select(F.col(key).alias("_id"), F.explode(keys_col).alias("_k")).where("_id IS NOT NULL AND _k IS NOT NULL").distinct()
    sets = kept(each.groupBy("_id").agg(F.array_sort(F.collect_list("_k")).alias("_keys")))
    members = sets.select("_id", F.explode("_keys").alias("_k")).groupBy("_k").agg(F.collect_list("_id").alias("_members"))
    wanted = sets.select("_keys").distinct().select("_keys", F.explode("_keys").alias("_k"))
    lists = wanted.join(members, "_k").groupBy("_keys").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_members")))).alias("_all"))
    others = sets.join(lists, "_keys").select(F.col("_id").alias(key), F.array_remove("_all", F.col("_id")).alias("partners"))
    return others.where(F.size("partners") > 0)


def hit_rule(has_id: Column, bound: Column, consistent: Column, names: Column, rules: Column, partners: Column, partner_waits: Column) -> Column:
    """Which rule a candidate falls under, as a struct of rule, resolution and choice.

    ``bound`` is whether its id is in the base, ``consistent`` whether it then means the same; ``names`` and ``rules`` are its hits in the base, ``partners`` those in
    its batch, and ``partner_waits`` whether one of these awaits a person by its name.
    """
    outcome = lambda rule, resolution, choice=None: F.struct(F.lit(rule).alias("rule"), F.lit(resolution).alias("resolution"), (F.lit(None).cast("string") if choice is None else choice).alias("choice"))
    n, r = F.size(names), F.size(rules)
    attach = F.concat(F.lit("attach:"), F.get(names, F.lit(0)))
    admit = F.lit("admit_new")
    return (
        F.when(bound & consistent, outcome("R01", "auto", F.lit("attach")))
        .when(bound, outcome("R01b", "human"))
        .when(has_id & (n == 0) & (r == 0), outcome("R02", "auto", admit))
        .when((n > 1) | (r > 1), outcome("R03d", "human"))
        .when(~has_id & (n == 1) & (names == rules), outcome("R03a", "auto", attach))
        .when((n == 1) & (has_id | (r == 0)), outcome("R03b", "human"))
        .when((r == 1) & (n == 0), outcome("R03c", "human"))
        .when((F.size(partners) > 0) & partner_waits, outcome("R03f", "blocked"))
        .when(F.size(partners) > 0, outcome("R03g", "human"))
        .otherwise(outcome("R03e", "auto", admit))
    )


def concept_groups(mentions: DataFrame, subject: str, surface: str, aliases: str) -> DataFrame:
    """Mentions of one subject folded to one candidate: sorted surfaces and aliases, each once, and their number."""
    return mentions.groupBy(subject).agg(F.sort_array(F.collect_set(surface)).alias("surfaces"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(aliases, F.array().cast("array<string>")))))).alias("aliases"), F.count(F.lit(1)).alias("n"))


def collation(view: DataFrame, base: DataFrame) -> DataFrame:
    """The new version's units against those of other sources of the same work: relation, or why there is none.

    Both have source_id, work_key, collation_key, present, assertion_id, subject_id and text_sha256. Relations: ``alignment`` (same subject and text), ``variant_reading``, ``addition`` and
    ``omission``; ``conflict`` where subjects differ or are unknown. Declared units without an assertion come with the reason ``declared_without_assertion``, and undeclared keys with ``undeclared``.
    """
    keys = ["work_key", "collation_key"]
    side = lambda x, p: x.select(*keys, *(F.col(c).alias(f"{p}_{c}") for c in ("source_id", "present", "assertion_id", "subject_id", "text_sha256")))
    joined = side(view, "new").join(side(base, "old"), keys).where("new_source_id <> old_source_id")
    hollow = (F.col("new_present") & F.col("new_assertion_id").isNull()) | (F.col("old_present") & F.col("old_assertion_id").isNull())
    same_subject = F.coalesce(F.col("new_subject_id") == F.col("old_subject_id"), F.lit(False))
    relation = (
        F.when(hollow, None).when(F.col("new_present") & ~F.col("old_present"), "addition").when(~F.col("new_present") & F.col("old_present"), "omission")
        .when(~F.col("new_present"), None).when(~same_subject, "conflict").when(F.col("new_text_sha256") == F.col("old_text_sha256"), "alignment").otherwise("variant_reading")
    )
    compared = joined.select(*keys, F.col("new_source_id").alias("source_id"), F.col("old_source_id").alias("base_source_id"), F.col("new_assertion_id").alias("from_id"), F.col("old_assertion_id").alias("to_id"), relation.alias("relation"), F.when(hollow, "declared_without_assertion").alias("reason"))
    alone = view.join(base.select(*keys, F.col("source_id").alias("_s")), [*(view[k] == base[k] for k in keys), view["source_id"] != F.col("_s")], "left_anti")
    undeclared = alone.select(*keys, "source_id", F.lit(None).cast("string").alias("base_source_id"), F.col("assertion_id").alias("from_id"), F.lit(None).cast("string").alias("to_id"), F.lit(None).cast("string").alias("relation"), F.when(F.col("collation_key").isNull(), "missing_collation_key").otherwise("undeclared").alias("reason"))
    return compared.unionByName(undeclared).where("relation IS NOT NULL OR reason IS NOT NULL")


def concept_outcomes(mentions: DataFrame, base: DataFrame) -> DataFrame:
    """What becomes of each concept that a source mentions: source_id, subject, outcome, resolution, choice, targets, refusal.

    mentions (source_id, concept_ref, surface, aliases) with one id, or without an id one surface, are one subject. A mention with an id of the base (concept_id, name, aliases) is attached;
    else one that shares a name with a base concept may be its ``alias``, for a person to say; else it is admitted. If a subject's mentions fall apart, it is refused as ``mixed``. Names are compared in NFC.
    Mentions with neither id nor surface are no subject. A name that many share joins each mention once, and each subject of aliases with all its holders.
    """
    strings = F.array().cast("array<string>")
    told = mentions.select("source_id", "concept_ref", F.coalesce("concept_ref", "surface").alias("subject"), F.concat(F.array("surface"), F.coalesce("aliases", strings)).alias("names")).where("subject IS NOT NULL").distinct()
    named = base.select("concept_id", F.explode(F.concat(F.array("name"), F.coalesce("aliases", strings))).alias("name")).where("name <> ''").select("concept_id", nfc("name").alias("name")).distinct()
    each = told.select("source_id", "concept_ref", "subject", "names", F.explode_outer("names").alias("name")).withColumn("name", nfc("name"))
    same = each.join(named.select("name").distinct().withColumn("_same", F.lit(True)), "name", "left")
    known = base.select(F.col("concept_id").alias("concept_ref"), F.lit(True).alias("_known")).distinct()
    labelled = same.groupBy("source_id", "subject", "concept_ref", "names").agg(F.bool_or(F.coalesce("_same", F.lit(False))).alias("_same")).join(known, "concept_ref", "left")
    label = F.when(F.col("_known"), "attach").when(F.col("_same"), "alias").otherwise("admit_new")
    groups = labelled.groupBy("source_id", "subject").agg(F.min(label).alias("outcome"), F.count_distinct(label).alias("_n"))
    groups = groups.withColumns({"refusal": F.when(F.col("_n") > 1, "mixed"), "outcome": F.when(F.col("_n") == 1, F.col("outcome"))})
    holders = each.join(groups.where("outcome = 'alias'").select("source_id", "subject"), ["source_id", "subject"], "left_semi").join(named, "name").groupBy("source_id", "subject").agg(F.array_sort(F.collect_set("concept_id")).alias("_holders"))
    outcome = F.col("outcome")
    targets = F.when(outcome == "attach", F.array("subject")).when(outcome == "alias", F.col("_holders")).otherwise(strings)
    choice = F.when(outcome == "attach", F.concat(F.lit("attach:"), "subject")).when(outcome == "admit_new", F.lit("admit_new"))
    return groups.join(holders, ["source_id", "subject"], "left").select("source_id", "subject", "outcome", F.when(outcome == "alias", "human").when(outcome.isNotNull(), "auto").alias("resolution"), choice.alias("choice"), targets.alias("targets"), "refusal")


def school_conflicts(views: DataFrame, entities: DataFrame, base_views: DataFrame, groups: DataFrame) -> DataFrame:
    """Subjects about which a new view (source_id, subject, conflict_group_id) disagrees: source_id, subject, pending, targets; a person decides.

    Only views with a conflict group, about a known entity (entity_id), count, and a source's subject comes once. ``pending`` are the base's views (school_view_id, subject) of it, ``targets`` the groups (group_id, member) that
    one of these is in; both sorted, empty if there are none.
    """
    about = views.where("conflict_group_id IS NOT NULL").select("source_id", "subject").distinct().join(entities.select(F.col("entity_id").alias("subject")), "subject", "left_semi")
    pending = base_views.groupBy("subject").agg(F.array_sort(F.collect_set("school_view_id")).alias("pending"))
    targets = groups.join(base_views.select(F.col("school_view_id").alias("member"), "subject"), "member").groupBy("subject").agg(F.array_sort(F.collect_set("group_id")).alias("targets"))
    none = F.array().cast("array<string>")
    return about.join(pending, "subject", "left").join(targets, "subject", "left").select("source_id", "subject", F.coalesce("pending", none).alias("pending"), F.coalesce("targets", none).alias("targets"))


def retired_on_replacement(base: DataFrame, view: DataFrame, modes: DataFrame, key: str, source: str = "source_id") -> DataFrame:
    """Base objects of a replaced source that the new view doesn't have any more."""
    return base.join(modes.where("mode = 'replacement'").select(source), source, "left_semi").join(view.select(key), key, "left_anti")


def decided(proposals: DataFrame, decisions: DataFrame, key: str = "proposal_key", basis: str = "basis_sha256") -> DataFrame:
    """Proposals with their decision carried forward: only one made on the same basis counts; the others are ``stale``."""
    joined = proposals.join(decisions.select(key, F.col(basis).alias("_basis"), F.col("choice").alias("_choice")), key, "left")
    fits = F.col("_choice").isNotNull() & F.col("_basis").eqNullSafe(F.col(basis))
    return joined.withColumns({"decision": F.when(fits, F.col("_choice")), "state": F.when(fits, "decided").when(F.col("_choice").isNotNull(), "stale").when(F.col("resolution") == "auto", "auto").otherwise("open")}).drop("_basis", "_choice")


def merge_editions(base: DataFrame, view: DataFrame, modes: DataFrame, source: str = "source_id") -> tuple[DataFrame, DataFrame]:
    """The base with new sources appended and replaced ones exchanged, and the refused views: extensions and partial overlaps (source, mode)."""
    good = modes.where("mode IN ('new', 'replacement')").select(source)
    kept = base.join(view.join(good, source, "left_semi").select(source).distinct(), source, "left_anti")
    return kept.unionByName(view.join(good, source, "left_semi").select(*base.columns)), modes.join(good, source, "left_anti")


def split_checks(items: DataFrame, splits: DataFrame, references: DataFrame, key: str, spans: str) -> DataFrame:
    """Each split (key, placeholder, spans) with its refusal, null where it may go ahead: ``missing`` object, ``allocation_differs`` from the object's spans, or ``referenced``."""
    told = splits.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(spans)))).alias("_told"))
    joined = told.join(items.select(key, F.array_sort(F.array_distinct(spans)).alias("_have")), key, "left").join(references.select(F.col("target").alias(key), F.lit(True).alias("_used")).distinct(), key, "left")
    return joined.select(key, F.when(F.col("_have").isNull(), "missing").when(F.col("_told") != F.col("_have"), "allocation_differs").when(F.col("_used"), "referenced").alias("refusal"))


def split_items(items: DataFrame, splits: DataFrame, references: DataFrame, key: str, spans: str, prefix: str, last: Column) -> tuple[DataFrame, DataFrame]:
    """The items after all splits that may go ahead, and identity rows (from_id, to_id, change). New ids follow ``last`` in the order of old id and placeholder."""
    fine = split_checks(items, splits, references, key, spans).where("refusal IS NULL").select(key)
    due = splits.join(fine, key, "left_semi")
    # Splits are decisions of people; their number is small, whatever the items are.
    fresh = due.withColumn("_n", F.row_number().over(Window.orderBy(key, "placeholder"))).select(F.col(key).alias("_old"), padded_id(prefix, last + F.col("_n"), 6).alias("_new"), F.col(spans).alias("_spans"))
    cloned = items.join(fresh, F.col(key) == F.col("_old")).withColumns({key: F.col("_new"), spans: F.array_sort("_spans")}).select(*items.columns)
    return items.join(fine, key, "left_anti").unionByName(cloned), fresh.select(F.col("_old").alias("from_id"), F.col("_new").alias("to_id"), F.lit("split").alias("change"))


def merge_checks(items: DataFrame, merges: DataFrame, references: DataFrame, relations: DataFrame, key: str, kind: str) -> DataFrame:
    """Each merge (a, b): survivor (the lower id), retired, and refusal (null where it may go ahead): ``same``, ``missing``, ``other_kind``, or a third party that refers to the retired one (``referenced``)."""
    pairs = merges.select(F.least("a", "b").alias("survivor"), F.greatest("a", "b").alias("retired"))
    of = lambda p: items.select(F.col(key).alias(p), F.col(kind).alias(f"{p}_kind"))
    used = references.select(F.col("target").alias("retired"), F.lit(True).alias("_used")).distinct()
    ends = relations.select(F.col("from_id").alias("retired"), F.col("to_id").alias("_other")).unionByName(relations.select(F.col("to_id").alias("retired"), F.col("from_id").alias("_other")))
    outside = pairs.join(ends, "retired").where("_other <> survivor").select("survivor", "retired", F.lit(True).alias("_linked")).distinct()
    joined = pairs.join(of("survivor"), "survivor", "left").join(of("retired"), "retired", "left").join(used, "retired", "left").join(outside, ["survivor", "retired"], "left")
    refusal = F.when(F.col("survivor") == F.col("retired"), "same").when(F.col("survivor_kind").isNull() | F.col("retired_kind").isNull(), "missing").when(F.col("survivor_kind") != F.col("retired_kind"), "other_kind").when(F.col("_used") | F.col("_linked"), "referenced")
    return joined.select("survivor", "retired", refusal.alias("refusal"))


def without_retired(items: DataFrame, relations: DataFrame, retired: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items and relations after retirement (rows of ``key``), and the relations that went with it: each is in one of the two, as often as it came. A null end is no retired one."""
    gone = retired.select(key).distinct()
    end = lambda c: gone.select(F.col(key).alias(c), F.lit(True).alias(f"_gone_{c}"))
    told = relations.join(end("from_id"), "from_id", "left").join(end("to_id"), "to_id", "left").withColumn("_out", F.coalesce("_gone_from_id", "_gone_to_id", F.lit(False)))
    return items.join(gone, key, "left_anti"), told.where("NOT _out").select(*relations.columns), told.where("_out").select(*relations.columns)


def with_aliases(items: DataFrame, accepted: DataFrame, key: str, name: str, aliases: str) -> DataFrame:
    """Items with accepted aliases (key, alias) added: sorted, each once, never the name itself."""
    new = accepted.groupBy(key).agg(F.collect_set("alias").alias("_new"))
    have = F.coalesce(aliases, F.array().cast("array<string>"))
    merged = F.array_sort(F.filter(F.array_distinct(F.concat(have, F.coalesce("_new", F.array().cast("array<string>")))), lambda a: (a != F.col(name)) & (a != "")))
    return items.join(new, key, "left").withColumn(aliases, merged).select(*items.columns)


def conflict_groups(views: DataFrame, group: str, member: str, changes_judgement: str) -> DataFrame:
    """Each group's members in order, and whether any of them changes the current judgement."""
    return views.where(F.col(group).isNotNull()).groupBy(group).agg(F.sort_array(F.collect_set(member)).alias("members"), F.bool_or(F.coalesce(changes_judgement, F.lit(False))).alias("first_layer_display"))


def outside_closure(will_modify: DataFrame, affected: DataFrame, key: str) -> DataFrame:
    """Objects that would be modified though the closure doesn't hold them; none if it is sound."""
    return will_modify.select(key).distinct().join(affected, key, "left_anti")


def contact_edges(relations: DataFrame, groups: DataFrame, kinds: Sequence[str] = ("alias_of", "distinct_from", "merged_into")) -> DataFrame:
    """Undirected edges (src, dst) of the closure: relations of some kinds, and members of one conflict group, tied to its first member so that a group gives as many edges as members."""
    tied = groups.select(F.array_sort("members").alias("m")).select(F.get("m", F.lit(0)).alias("src"), F.explode("m").alias("dst")).where("src <> dst")
    return relations.where(F.col("kind").isin(*kinds)).select(F.col("from_id").alias("src"), F.col("to_id").alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL").unionByName(tied)


def admitted(items: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """Items with the first reason to reject them (null: admitted). An unknown outcome rejects."""
    return items.withColumn("reject_reason", F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks)))


def ruled(disputes: DataFrame, rulings: DataFrame, key: str, a_col: str, b_col: str) -> DataFrame:
    """What rulings leave of disputes: side a, side b, both, or neither; disputes without a ruling come as ``open`` with no item."""
    joined = disputes.join(rulings.select(key, "choice"), key, "left")
    item = lambda c, lane: F.struct(F.lit(lane).alias("lane"), F.col(c).alias("item"))
    a, b, none = item(a_col, "a"), item(b_col, "b"), F.struct(F.lit("open").alias("lane"), F.lit(None).cast(disputes.schema[a_col].dataType).alias("item"))
    chosen = F.when(F.col("choice") == "a", F.array(a)).when(F.col("choice") == "b", F.array(b)).when(F.col("choice") == "both", F.array(a, b)).when(F.col("choice") == "neither", F.array().cast(f"array<struct<lane:string,item:{disputes.schema[a_col].dataType.simpleString()}>>")).otherwise(F.array(none))
    return joined.select(key, F.explode(chosen).alias("_c")).select(key, "_c.lane", "_c.item")


def compared_drafts(a: DataFrame, b: DataFrame, key: str, spans: str, body: str) -> DataFrame:
    """Two drafts by their evidence: rows of a_id, b_id and status.

    Equal sets of spans with as many items on either side are ``paired``, each item of the first draft in turn (by id) with the most similar body that is left; with other numbers they are ``split_merge``.
    Of the rest, an item of the first draft meets the first one of the second that shares a span and isn't taken (``partial``); what remains is ``a_only`` or ``b_only``.
    Items meet where they share evidence, so one set of spans, or one group of items that spans connect, is the unit of work.
    """
    side = lambda x, lane: x.select(F.lit(lane).alias("lane"), F.col(key).cast("string").alias("id"), F.array_sort(F.array_distinct(F.coalesce(spans, F.array().cast("array<string>")))).alias("spans"), F.coalesce(body, F.lit("")).alias("body"))
    items = side(a, "a").unionByName(side(b, "b"))
    counted = items.join(items.groupBy("spans").agg(F.count_if(F.col("lane") == "a").alias("n_a"), F.count_if(F.col("lane") == "b").alias("n_b")), "spans")

    @F.pandas_udf(ArrayType(StructType([StructField("a_id", StringType()), StructField("b_id", StringType())])))
    def pair(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for ones, others in zip(left, right, strict=True):
            rest, found = [(x["id"], x["body"]) for x in others], []
            for x in ones:
                best = max(range(len(rest)), key=lambda j: (SequenceMatcher(None, x["body"], rest[j][1]).ratio(), -j)) if len(rest) > 1 else 0
                found.append((x["id"], rest.pop(best)[0]))
            out.append(found)
        return pd.Series(out)

    counted = counted.withColumn("n_b", F.when(F.size("spans") > 0, F.col("n_b")).otherwise(0))  # what has no evidence meets nothing
    counted = counted.withColumn("n_a", F.when(F.size("spans") > 0, F.col("n_a")).otherwise(0))
    counted = kept(counted)
    # Many sets go to Python at once: a call for each would cost more than its work.
    mine = lambda lane: F.array_sort(F.collect_list(F.when(F.col("lane") == lane, F.struct("id", "body"))))
    sets = counted.where("n_a = n_b AND n_a > 0").groupBy("spans").agg(mine("a").alias("left"), mine("b").alias("right"))
    equal = sets.select(F.inline(pair("left", "right"))).withColumn("status", F.lit("paired"))
    uneven = counted.where("n_a <> n_b AND n_a > 0 AND n_b > 0").select(F.when(F.col("lane") == "a", F.col("id")).alias("a_id"), F.when(F.col("lane") == "b", F.col("id")).alias("b_id"), F.lit("split_merge").alias("status"))
    alone = counted.where("n_a = 0 OR n_b = 0").select("lane", "id", "spans")
    each = alone.select("lane", "id", F.explode("spans").alias("span"))
    touching = each.where("lane = 'a'").select("span", F.col("id").alias("a_id")).join(each.where("lane = 'b'").select("span", F.col("id").alias("b_id")), "span").select("a_id", "b_id").distinct()
    partial = _first_free(touching)
    left = alone.where("lane = 'a'").join(partial.select(F.col("a_id").alias("id")), "id", "left_anti").select(F.col("id").alias("a_id"), F.lit(None).cast("string").alias("b_id"), F.lit("a_only").alias("status"))
    right = alone.where("lane = 'b'").join(partial.select(F.col("b_id").alias("id")), "id", "left_anti").select(F.lit(None).cast("string").alias("a_id"), F.col("id").alias("b_id"), F.lit("b_only").alias("status"))
    return equal.unionByName(uneven).unionByName(partial.withColumn("status", F.lit("partial"))).unionByName(left).unionByName(right)


def _first_free(pairs: DataFrame) -> DataFrame:
    """Greedy matching: in the order of a_id, each takes the least b_id that is left. Groups that pairs connect are matched by themselves."""
    from lectern.operators.graph import components

    edges = pairs.select(F.concat(F.lit("a"), "a_id").alias("src"), F.concat(F.lit("b"), "b_id").alias("dst"))
    grouped = pairs.join(components(edges).select(F.expr("substring(node, 2)").alias("a_id"), F.substring("node", 1, 1).alias("_lane"), "component").where("_lane = 'a'"), "a_id")

    def match(group: pd.DataFrame) -> pd.DataFrame:
        used, out = set(), []
        for a_id, choices in group.sort_values(["a_id", "b_id"]).groupby("a_id", sort=True):
            free = next((b for b in choices.b_id if b not in used), None)
            if free is not None:
                used.add(free)
                out.append((a_id, free))
        return pd.DataFrame(out, columns=["a_id", "b_id"])

    return grouped.groupBy("component").applyInPandas(match, "a_id string, b_id string")
