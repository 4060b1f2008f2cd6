"""Queries over the ledger's tables: descriptions, filters, facets, page statistics, stage states, context of neighbours."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.graph import kept


def described_revisions(revisions: DataFrame, artifacts: DataFrame, packages: DataFrame) -> DataFrame:
    """Revisions with their artifact's type, and the stage and id of their package where they have one."""
    return revisions.join(artifacts.select("artifact_id", "artifact_type"), "artifact_id").join(packages.select("artifact_id", "stage_package_id", "stage"), "artifact_id", "left")


def stage_checkpoints(checkpoints: DataFrame, steps: DataFrame, status: str = "succeeded") -> DataFrame:
    """Checkpoints of steps that have a status."""
    return checkpoints.join(steps.where(F.col("status") == status).select("step_run_id", "processing_run_id"), "step_run_id")


def steps_of_part(steps: DataFrame, runs: DataFrame, part: str) -> DataFrame:
    return steps.join(runs.where(F.col("edition_part_id") == part).select("processing_run_id", "edition_part_id"), "processing_run_id")


def package_lineage(packages: DataFrame, revisions: DataFrame, steps: DataFrame) -> DataFrame:
    """Packages with the revision that they hold and the step that made it."""
    made = revisions.select("artifact_id", "artifact_revision_id", "step_run_id")
    return packages.join(made, "artifact_id").join(steps.select("step_run_id", F.col("status").alias("step_status"), F.col("stage").alias("step_stage")), "step_run_id")


def bridged(links: DataFrame, left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows on either side of a bridge table."""
    return links.join(left, left_key).join(right, right_key)


def filtered(rows: DataFrame, equal: Mapping[str, object] | None = None, among: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Optional predicates: those that are None don't apply, and an empty list fits nothing."""
    for column, value in (equal or {}).items():
        rows = rows if value is None else rows.where(F.col(column) == value)
    for column, values in (among or {}).items():
        rows = rows if values is None else rows.where(F.col(column).isin(*values) if values else F.lit(False))
    return rows


def matching(rows: DataFrame, keyword: str, columns: Sequence[str]) -> DataFrame:
    """Rows of which any column holds the keyword, whatever its case; nulls hold nothing, an empty keyword is in all."""
    hit = F.lit(not keyword)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(keyword.lower())), F.lit(False))
    return rows.where(hit)


def faceted(rows: DataFrame, keyword: str = "", keyword_columns: Sequence[str] = (), active: str | None = None, **facets: object) -> DataFrame:
    """Keyword and facets together; with ``active`` only rows of which that flag is true."""
    rows = filtered(matching(rows, keyword, keyword_columns), facets)
    return rows if active is None else rows.where(F.coalesce(F.col(active), F.lit(False)))


def facet_values(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def windows_to_ask(spans: DataFrame, group: str, order: str, text_col: str, least: int = 12) -> DataFrame:
    """Spans of at least so many characters, numbered from 1 within their group."""
    return spans.where(F.length(text_col) >= least).withColumn("window", F.row_number().over(Window.partitionBy(group).orderBy(order)))


def leaf_nodes(nodes: DataFrame, key: str, parent: str) -> DataFrame:
    """Nodes that are no node's parent."""
    return nodes.join(nodes.select(F.col(parent).alias(key)).where(F.col(key).isNotNull()), key, "left_anti")


def text_type(text: Column, kinds: Sequence[tuple[str, str]], default: str) -> Column:
    """The first kind whose pattern a text has."""
    return F.coalesce(*(F.when(text.rlike(pattern), kind) for kind, pattern in kinds), F.lit(default))


def truncation_notes(notes: DataFrame, key: str, notes_col: str, marks: Sequence[str], machine: str = "machine:") -> DataFrame:
    """Notes of people that tell of a truncation: key, place and note. Notes that a machine wrote don't count."""
    each = notes.select(key, F.posexplode(notes_col).alias("place", "note")).where(~F.col("note").startswith(machine))
    hit = F.lit(False)
    for m in marks:
        hit = hit | F.contains(F.lower("note"), F.lit(m.lower()))
    return each.where(hit)


def position_list(rows: DataFrame, key: str, position: str, least: int = 2) -> DataFrame:
    """Keys that come ``least`` times or more, most frequent first, with their positions in order. Counts come first, so that no other key gathers its positions."""
    often = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    places = rows.join(often.select(key), key, "left_semi").groupBy(key).agg(F.array_join(F.sort_array(F.collect_list(position)), ",").alias("positions"))
    return often.join(places, key).orderBy(F.desc("n"), key)


def page_quality(glyphs: DataFrame, page: str = "page") -> DataFrame:
    """Per page, and for all pages together (null page): characters, rare, low in confidence, not common, unrecognized, corrected, mapped and each status."""
    low = F.col("is_rare") & (F.col("rare_reason") == "low_conf")
    counts = {
        "total": F.count(F.lit(1)), "rare": F.count_if("is_rare"), "low_conf": F.count_if(low), "not_common": F.count_if("is_rare") - F.count_if(low),
        "unrecognized": F.count_if((F.col("status") == "unrecognized") | (F.coalesce("char", F.lit("")) == "")), "corrected": F.count_if(F.col("status") == "corrected"),
        "mapped": F.count_if(F.coalesce("mapping", F.lit("")) != ""), "pending": F.count_if(F.col("status") == "pending"), "verified": F.count_if(F.col("status") == "verified"),
    }
    return glyphs.rollup(page).agg(*(c.alias(n) for n, c in counts.items()))


def layout_verdict(lines: DataFrame, page: str = "page", pages: DataFrame | None = None) -> DataFrame:
    """Pages whose layout needs a look: mean confidence, three ratios and the signs that speak against them; at least two must. A page of ``pages`` without lines has the sign ``no_text``.

    Whether a mean is low is told from the exact sum of confidences of twelve decimals, so that it doesn't hang on the order of the lines.
    """
    n, conf = F.count(F.lit(1)), F.coalesce("conf", F.lit(0.0)).cast("double")
    share = lambda c: F.count_if(c) / n
    stats = lines.groupBy(page).agg(
        n.alias("n"), F.avg(conf).alias("mean_conf"), F.sum(conf.try_cast("decimal(38,12)")).alias("_sum"), share(conf < 0.6).alias("low"),
        share(F.length(F.trim(F.coalesce("text", F.lit("")))) <= 1).alias("single"), share(F.col("w") >= F.col("h")).alias("flat"),
    )
    finite = F.abs("mean_conf") < float("inf")  # neither infinite nor NaN
    dim = F.when(finite, F.col("_sum") < F.col("n") * F.lit(Decimal("0.80"))).otherwise(F.col("mean_conf") < 0.80)
    signs = F.array_compact(F.array(
        F.when(F.col("low") > 0.20, "low_conf_lines"), F.when(F.col("single") > 0.15, "many_single_char_boxes"), F.when(F.col("flat") > 0.07, "mixed_orientation"), F.when(dim, "low_mean_conf"),
    ))
    found = stats.withColumn("signals", signs).where(F.size("signals") >= 2).drop("_sum")
    if pages is not None:
        found = found.unionByName(pages.select(page).distinct().join(lines, page, "left_anti").withColumn("signals", F.array(F.lit("no_text"))), allowMissingColumns=True)
    return found


def stage_gaps(planned: DataFrame, done: DataFrame, stage: str, key: str) -> DataFrame:
    """Per stage: planned, done, and the keys that are missing, in order."""
    marked = planned.join(done.select(stage, key).distinct().withColumn("_done", F.lit(True)), [stage, key], "left")
    return marked.groupBy(stage).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce("_done", F.lit(False))).alias("done"), F.sort_array(F.collect_list(F.when(F.col("_done").isNull(), F.col(key)))).alias("missing"))


def lane_counts(a: DataFrame, b: DataFrame, key: str, most: int = 4) -> DataFrame:
    """Rows of two lanes per key, their difference, and a flag: one lane lacks the key, or they differ by ``most`` or more."""
    count = lambda x, name: x.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    both = count(a, "n_a").join(count(b, "n_b"), key, "full").select(key, F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"))
    gap = F.abs(F.col("n_a") - F.col("n_b"))
    return both.withColumns({"difference": gap, "flag": F.when((F.col("n_a") == 0) | (F.col("n_b") == 0), "missing_lane").when(gap >= most, "far_apart")})


def invalidated_ratio(valid: Column, invalid: Column, rework_round: Column) -> Column:
    """Share of invalidated objects (four places, halves to even), and whether it or the number of rounds calls for a warning."""
    ratio = F.when(valid > 0, F.bround(invalid / valid, 4)).otherwise(F.lit(0.0))
    return F.struct(ratio.alias("ratio"), ((ratio >= 0.30) | (rework_round >= 3)).alias("warn"))


def release_level(statuses: DataFrame, key: str, status: str) -> DataFrame:
    """A source's level: refused if anything in it is deprecated, ``release`` if experts reviewed all, else ``dev``."""
    return statuses.groupBy(key).agg(F.when(F.bool_or(F.col(status) == "deprecated"), "refused").when(F.bool_and(F.coalesce(F.col(status) == "expert_reviewed", F.lit(False))), "release").otherwise("dev").alias("level"))


def completeness(gates: DataFrame, edition: str, passed: str, parts: int) -> DataFrame:
    """Whether all ``parts`` gates of an edition are there and have passed."""
    return gates.groupBy(edition).agg(((F.count(F.lit(1)) == parts) & F.bool_and(F.coalesce(passed, F.lit(False)))).alias("complete"))


def maturity(decisions: DataFrame, key: str, kind: str, verdict: str, order: Sequence[str], ranking: Sequence[str], default: str) -> DataFrame:
    """Each key's maturity: of its latest verdict of each kind, the first in ``ranking``; ``default`` where none ranks."""
    last = decisions.groupBy(key, kind).agg(F.max_by(verdict, F.struct(*order)).alias("_v"))
    names = F.array(*(F.lit(r) for r in ranking))
    place = F.nullif(F.array_position(names, F.col("_v")), F.lit(0).cast("long"))
    return last.groupBy(key).agg(F.min(place).alias("_p")).select(key, F.coalesce(F.try_element_at(names, F.col("_p").cast("int")), F.lit(default)).alias("maturity"))


def remaining_seconds(means: DataFrame, stages_left: Column, mean: str = "mean_seconds") -> DataFrame:
    """Mean over all stages' means, times the number of stages that are left."""
    return means.agg(F.avg(mean).alias("mean_seconds")).select("mean_seconds", (F.col("mean_seconds") * stages_left).alias("remaining"))


def reverse_index(pages: DataFrame, spans: DataFrame, page: str, span: str, order: str) -> DataFrame:
    """Every page with its spans in order, an empty list where it has none."""
    listed = spans.groupBy(page).agg(F.transform(F.sort_array(F.collect_list(F.struct(order, span))), lambda s: s[span]).alias("spans"))
    return pages.select(page).distinct().join(listed, page, "left").select(page, F.coalesce("spans", F.array().cast("array<string>")).alias("spans"))


def last_rows(rows: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows, in time order."""
    return rows.orderBy(*(F.col(c).desc() for c in order)).limit(n).orderBy(*order)


def previous_tail(rows: DataFrame, group: str, order: str, text_col: str, n: int = 200) -> DataFrame:
    """Each row with the last n characters of the one before it in its group (``before``; empty for the first)."""
    return rows.withColumn("before", F.coalesce(F.right(F.lag(text_col).over(Window.partitionBy(group).orderBy(order)), F.lit(n)), F.lit("")))


def context(text: Column, start: Column, end: Column, n: int = 15) -> Column:
    """n characters around an interval, with line breaks as spaces."""
    first = F.greatest(start - n, F.lit(0))
    return F.translate(F.substring(text, first + 1, end + n - first), "\n", " ")


def first_failing(stages: DataFrame, run: str, order: str, passed: str) -> DataFrame:
    """Each run's first stage that didn't pass."""
    failing = stages.where(~F.coalesce(F.col(passed), F.lit(False)))
    return failing.groupBy(run).agg(F.min(order).alias(order))


def stage_states(stages: DataFrame, run: str, order: str, started: str, passed: str) -> DataFrame:
    """Adds ``state``: done, running, not_started (all stages before passed) or blocked."""
    before = Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    clear = F.coalesce(F.bool_and(F.coalesce(passed, F.lit(False))).over(before), F.lit(True))
    return stages.withColumn("state", F.when(F.coalesce(passed, F.lit(False)), "done").when(~clear, "blocked").when(F.coalesce(started, F.lit(False)), "running").otherwise("not_started"))


def numbered(rows: DataFrame, categories: Sequence[str], category: str, order: Sequence[str]) -> DataFrame:
    """Adds ``number`` across all rows: categories in the given order, then keys.

    Rows are dealt out by range once and kept with their part, as a second sampling of the ranges may deal them otherwise. The
    sizes of the parts give where each part begins, so no task holds all rows.
    """
    place = F.array_position(F.array(*(F.lit(c) for c in categories)), F.col(category))
    dealt = kept(rows.withColumn("_place", place).repartitionByRange(F.col("_place"), *(F.col(c) for c in order)).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_start")
    within = F.row_number().over(Window.partitionBy("_part").orderBy("_place", *order))
    return dealt.join(F.broadcast(starts), "_part").withColumn("number", F.col("_start") + within).drop("_place", "_part", "_start")


def effective_runs(runs: DataFrame, packages: DataFrame, run: str = "step_run_id", supersedes: str = "supersedes_step_run_id") -> DataFrame:
    """Runs that count: one is out when a run that supersedes it has exactly one package."""
    single = packages.groupBy(run).agg(F.count(F.lit(1)).alias("n")).where("n = 1").select(run)
    replaced = runs.join(single, run, "left_semi").where(F.col(supersedes).isNotNull()).select(F.col(supersedes).alias(run))
    return runs.join(replaced, run, "left_anti")


def stale_checkpoints(checkpoints: DataFrame, events: DataFrame, key: str, at: str) -> DataFrame:
    """Checkpoints that an event came after: key, both times."""
    newest = events.groupBy(key).agg(F.max(at).alias("last_event"))
    return checkpoints.join(newest, key).where(F.col("last_event") > F.col(at)).select(key, at, "last_event")


def same_pages(covered: DataFrame, excluded: DataFrame, manifest: DataFrame, page: str) -> DataFrame:
    """Pages that break "covered and excluded together are the manifest, and none is both": page and problem."""
    c, e, m = (x.select(page).distinct() for x in (covered, excluded, manifest))
    problem = lambda x, name: x.withColumn("problem", F.lit(name))
    return (
        problem(m.join(c, page, "left_anti").join(e, page, "left_anti"), "unaccounted")
        .unionByName(problem(c.unionByName(e).distinct().join(m, page, "left_anti"), "not_in_manifest"))
        .unionByName(problem(c.join(e, page, "left_semi"), "covered_and_excluded"))
    )


def bijection_problems(spans: DataFrame, batches: DataFrame, span: str, batch_items: str) -> DataFrame:
    """Spans in no batch, batch items that are no span, and spans in several batches: key and problem.

    Spans and items are counted together, in one grouping: an item is added up where it is read, and nothing is joined. Null equals nothing, so it is a span in no batch and an item that is no span.
    """
    counted = lambda x, known, items: x.select(span, F.lit(known).alias("_known"), F.lit(items).alias("_items"))
    both = counted(spans, 1, 0).unionByName(counted(batches.select(F.explode(batch_items).alias(span)), 0, 1)).groupBy(span).agg(F.max("_known").alias("_known"), F.sum("_items").alias("_items"))
    null = F.col(span).isNull()
    alone, strange = (F.col("_known") == 1) & ((F.col("_items") == 0) | null), (F.col("_items") > 0) & ((F.col("_known") == 0) | null)
    problems = F.array_compact(F.array(F.when(alone, "in_no_batch"), F.when(strange, "no_span"), F.when(F.col("_items") > 1, "in_several")))
    return both.select(span, F.explode(problems).alias("problem"))
