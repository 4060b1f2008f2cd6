"""What a round of changes reaches: seeds by named rules, and a closure over edges and groups that remembers how each node was reached.

A group (of a conflict, a bundle, shared evidence) is a node of its own between its members. It gives as many edges as it has members, where
a clique would give the square of them; a step from member to member passes through it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.graph import kept

#: The rules that seed a contact set, in the order in which one is named if several apply; relations that carry a change on.
SEED_RULES = ("target", "candidate", "collation", "provenance_lost", "conflict_group", "decision", "absent_unit", "view_assertion", "withdrawn_unit", "changed_provenance")
CLOSURE_KINDS = ("alias_of", "distinct_from", "merged_into")


def traced_reach(seeds: DataFrame, edges: DataFrame, groups: DataFrame | None = None, group: str = "group_id", member: str = "member") -> DataFrame:
    """Nodes that seeds (node, rule) reach over undirected edges (src, dst) and groups (group_id, member): node, rule, depth, via.

    ``depth`` counts steps between nodes; passing a group is one. ``rule`` is that of the seed, the first in ``SEED_RULES`` (others by name) if several are as near;
    ``via`` says whether the last step was an ``edge`` or a ``group`` (edges first), and is null for seeds. Null ends and members reach nothing.
    Each round joins the newest nodes only, and ends when there are none. As steps go both ways, a node next to the newest ones is new, one of them, or of the round before; older ones aren't looked at.
    Edges into nodes that are reached, and members of groups that are entered, are dropped whenever the nodes reached since are a quarter of what is left, so that many rounds don't read all edges each.
    """
    rank = F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(r) for r in SEED_RULES)), F.col("rule")), F.lit(0).cast("long")), F.lit(len(SEED_RULES) + 1))
    best = lambda df: df.groupBy("node").agg(F.min(F.struct("rank", "rule", "way")).alias("b")).select("node", "b.rank", "b.rule", "b.way")
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    both = kept(both)
    members = None if groups is None else kept(groups.select(F.col(group).alias("g"), F.col(member).alias("node")).where("g IS NOT NULL AND node IS NOT NULL").distinct())
    size = lambda: both.count() + (0 if members is None else members.count())
    frontier = kept(best(seeds.where("node IS NOT NULL").select("node", "rule", rank.alias("rank"), F.lit(None).cast("int").alias("way"))).withColumn("depth", F.lit(0)))
    seen, near, depth, entered, left = frontier, frontier.select("node"), 0, None, size()
    # What was reached and entered since edges were dropped.
    reached, passed, newest = near, None, frontier.count()
    fresh = newest
    while newest:
        if fresh * 4 >= left > 0:
            both = kept(both.join(reached.select(F.col("node").alias("dst")), "dst", "left_anti").select("src", "dst"))
            members = members if passed is None else kept(members.join(passed, "g", "left_anti").select("g", "node"))
            reached, passed, fresh, left = None, None, 0, size()
        depth += 1
        found = frontier.join(both, frontier["node"] == both["src"]).select(F.col("dst").alias("node"), "rank", "rule", F.lit(0).alias("way"))
        if members is not None:
            # A group is entered once: those who come from it find all its members reached, and nobody comes later.
            into = frontier.join(members, "node").groupBy("g").agg(F.min(F.struct("rank", "rule")).alias("b"))
            into = kept(into if entered is None else into.join(entered, "g", "left_anti"))
            entered = into.select("g")
            passed = entered if passed is None else passed.unionByName(entered)
            found = found.unionByName(into.join(members, "g").select("node", "b.rank", "b.rule", F.lit(1).alias("way")))
        last = frontier.select("node")
        frontier = kept(best(found.join(near, "node", "left_anti")).withColumn("depth", F.lit(depth)))
        newest = frontier.count()
        near = last.unionByName(frontier.select("node"))
        reached = frontier.select("node") if reached is None else reached.unionByName(frontier.select("node"))
        fresh += newest
        seen = seen.unionByName(frontier)
    return seen.select("node", "rule", "depth", F.when(F.col("way") == 0, "edge").when(F.col("way") == 1, "group").alias("via"))


def _seed(rule: str, df: DataFrame, node: Column | str) -> DataFrame:
    return df.select((F.col(node) if isinstance(node, str) else node).alias("node"), F.lit(rule).alias("rule"))


def contact_seeds(
    entities: DataFrame, proposals: DataFrame, candidates: DataFrame, assertions: DataFrame, groups: DataFrame, school_views: DataFrame, decisions: DataFrame,
    units: DataFrame, view_assertions: DataFrame, base_units: DataFrame, provenance: DataFrame, modes: DataFrame,
) -> DataFrame:
    """The contact set before its closure: (node, rule), each pair once; only known entities (entity_id) are in it.

    - ``target``: what proposals name (targets), and what an option ``attach:id`` of a pattern's proposal names
    - ``candidate``: the subject of a pattern's or concept's proposal, and the concept that its source's candidate (source_id, candidate_id, concept_ref) refers to
    - ``collation``: assertions (entity_id, source_id, work, collation_key) with the key of a collation's proposal, in its work
    - ``provenance_lost``: the subject of such a proposal, and assertions with the same key in the same work
    - ``conflict_group``: the subject of such a proposal, members of groups (group_id, member) that speak about it, and all views (view_id, subject, school) of the same subject and school
    - ``decision``: what decisions (proposal_key, targets) name, and the members of the groups that decisions about rule R06 name
    - ``absent_unit``, ``view_assertion``: assertions with the key of a unit (source_id, work, collation_key, present) that isn't present, or of a view's assertion
    - ``withdrawn_unit``: the same for keys that the base declared for a source that has a view, and the view doesn't
    - ``changed_provenance``: objects (object_id, source_id, content_sha256) of a replaced source (modes) that it has no candidate for, or one of other content

    proposals: proposal_key, rule_id, head, source_id, work, subject, targets, options.
    """
    keyed = lambda df: assertions.join(df.select("work", "collation_key").where("collation_key IS NOT NULL").distinct(), ["work", "collation_key"], "left_semi")
    head = lambda *names: proposals.where(F.col("head").isin(*names))
    attached = head("pattern").select(F.explode("options").alias("o")).where(F.startswith("o", F.lit("attach:"))).select(F.expr("substring(o, 8)").alias("node"))
    lost = head("provenance_lost")
    same_key = assertions.join(lost.select(F.col("subject").alias("entity_id")), "entity_id", "left_semi")
    about = head("conflict_group").select("subject").distinct()
    of_group = groups.join(school_views.withColumnRenamed("view_id", "member").join(about, "subject").select("member"), "member", "left_semi").select("group_id").distinct()
    members = groups.join(of_group, "group_id", "left_semi").select("member").distinct()
    alike = school_views.join(school_views.join(members.withColumnRenamed("member", "view_id"), "view_id", "left_semi").select("subject", "school").distinct(), ["subject", "school"], "left_semi")
    told = decisions.select("proposal_key", F.explode("targets").alias("target"))
    by_r06 = told.join(proposals.where("rule_id = 'R06'").select("proposal_key"), "proposal_key", "left_semi").select(F.col("target").alias("group_id"))
    viewed = units.select("source_id").unionByName(view_assertions.select("source_id")).distinct()
    withdrawn = base_units.join(viewed, "source_id", "left_semi").join(units.select("source_id", "collation_key").unionByName(view_assertions.select("source_id", "collation_key")).distinct(), ["source_id", "collation_key"], "left_anti")
    replaced = provenance.join(modes.where("mode = 'replacement'").select("source_id"), "source_id", "left_semi")
    now = candidates.select(F.col("candidate_id").alias("object_id"), "source_id", F.col("content_sha256").alias("_now"))
    changed = replaced.join(now, ["object_id", "source_id"], "left").where(~F.col("content_sha256").eqNullSafe(F.col("_now")))
    parts = [
        _seed("target", proposals.select(F.explode("targets").alias("t")), "t"), _seed("target", attached, "node"), _seed("candidate", head("pattern", "concept"), "subject"),
        _seed("candidate", head("pattern", "concept").select("source_id", F.col("subject").alias("candidate_id")).join(candidates, ["source_id", "candidate_id"]), "concept_ref"),
        _seed("collation", keyed(head("collation").select("work", F.col("subject").alias("collation_key"))), "entity_id"), _seed("provenance_lost", lost, "subject"), _seed("provenance_lost", keyed(same_key), "entity_id"),
        _seed("conflict_group", about, "subject"), _seed("conflict_group", members, "member"), _seed("conflict_group", alike, "view_id"),
        _seed("decision", told, "target"), _seed("decision", groups.join(by_r06, "group_id", "left_semi"), "member"),
        _seed("absent_unit", keyed(units.where(~F.coalesce("present", F.lit(False)))), "entity_id"), _seed("view_assertion", keyed(view_assertions), "entity_id"), _seed("withdrawn_unit", keyed(withdrawn), "entity_id"),
        _seed("changed_provenance", changed, "object_id"),
    ]
    return reduce(DataFrame.unionByName, parts).join(entities.select(F.col("entity_id").alias("node")), "node", "left_semi").distinct()


def affected_entities(entities: DataFrame, seeds: DataFrame, relations: DataFrame, groups: DataFrame, kinds: Sequence[str] = CLOSURE_KINDS) -> DataFrame:
    """Every entity with whether the round affects it, and by which rule, at which depth and how: entity_id, affected, rule, depth, via. Relations of other kinds carry nothing on."""
    reached = traced_reach(seeds, relations.where(F.col("kind").isin(*kinds)).select(F.col("from_id").alias("src"), F.col("to_id").alias("dst")), groups)
    joined = entities.select("entity_id").join(reached.withColumnRenamed("node", "entity_id"), "entity_id", "left")
    return joined.withColumn("affected", F.col("rule").isNotNull()).select("entity_id", "affected", "rule", "depth", "via")
