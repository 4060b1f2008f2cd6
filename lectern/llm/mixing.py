"""Mixing sources to target weights by hierarchical budgets.

Domains, languages and sources form a tree. A total budget of tokens runs down it: each node's budget is dealt to its children by weight,
no child gets more than its usable supply (its leaves' tokens times the most epochs, without leaves that a weight of 0 shuts off), and what a short child
leaves goes to its siblings by weight; only what a whole family can't use goes to the families beside it, one level up. Supplies are
summed from the leaves upwards first, so a parent never gets what its children can't use. That is water-filling at each node,
computed for all nodes of a level at once with window functions over the small table of nodes.

Each leaf then takes a token prefix of its seeded epochs: epoch 0 is all its documents in a pseudo-random order, epoch 1 in
another order, and so on. Cumulative sums are taken in two steps, over hash ranges of a leaf and then within
the ranges, so no task holds a whole leaf, however large.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import checkpoint, read_table

#: Production parameters: the share of all tokens that the mixture has, the most epochs of a leaf, the seed, and the weights.
BUDGET_SHARE, MAX_EPOCHS, SEED = 0.6, 2, "mix-1"
DOMAIN_WEIGHTS: dict[str, float] = {"crawl": 0.4, "books": 0.35, "reference": 0.25}
LANG_WEIGHTS: dict[str, float] = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
#: Weight of a domain or language that isn't listed; every source has weight 1.
OTHER_WEIGHT = 0.05
#: Documents of one hash range of a leaf, about.
RANGE_ROWS = 4096
LEVELS = ("domain", "lang", "source")


def domain_of(source: Column) -> Column:
    """The domain of a source by its number: below 7 crawl, below 14 books, else reference; without a number crawl."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    number = F.when(number == "", 0).otherwise(number.cast("int"))
    return F.when(number < 7, "crawl").when(number < 14, "books").otherwise("reference")


def token_count(text: Column) -> Column:
    """Tokens of a text, as its UTF-8 bytes divided by four, rounded up; null has none."""
    return F.coalesce(F.ceil(F.octet_length(text) / 4), F.lit(0)).cast("long")


def _weight(column: str, weights: Mapping[str, float]) -> Column:
    out = F.lit(float(OTHER_WEIGHT))
    for name, w in weights.items():
        out = F.when(F.col(column) == name, float(w)).otherwise(out)
    return out


def water_fill(nodes: DataFrame, parent: Sequence[str], child: str) -> DataFrame:
    """Deals ``parent_budget`` to the children of each parent: adds ``budget``, at most ``supply`` and otherwise in proportion to ``weight``.

    Children are ordered by supply / weight. A child is full if the level at which it fills, (tokens of those that
    fill before it) + (its ratio) x (weight of the rest), is within the budget; the rest share what is left by weight.
    A child of weight 0 gets nothing. Budgets are rounded down to whole tokens.
    """
    ratio = F.when(F.col("weight") > 0, F.col("supply") / F.col("weight"))
    nodes = nodes.withColumn("ratio", ratio)
    family = Window.partitionBy(*parent)
    before = family.orderBy(F.col("ratio").asc_nulls_last(), child).rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumns({
        "filled_before": F.coalesce(F.sum("supply").over(before), F.lit(0)),
        "weight_left": F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    full = (F.col("ratio").isNotNull()) & (F.col("filled_before") + F.col("ratio") * F.col("weight_left") <= F.col("parent_budget") * (1 + 1e-12))
    nodes = nodes.withColumn("full", full)
    left = F.col("parent_budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("supply"))).over(family), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(family)
    share = F.when(F.col("weight") > 0, F.floor(F.greatest(left, F.lit(0)) * F.col("weight") / open_weight)).otherwise(F.lit(0))
    return nodes.withColumn("budget", F.when(F.col("full"), F.col("supply")).otherwise(F.least(share, F.col("supply"))).cast("long")).drop("ratio", "filled_before", "weight_left", "full")


def leaf_budgets(leaves: DataFrame, budget: Column, domain_weights: Mapping[str, float] = DOMAIN_WEIGHTS, lang_weights: Mapping[str, float] = LANG_WEIGHTS) -> DataFrame:
    """Budgets of the leaves: rows of domain, lang, source and ``supply`` in, the same with ``budget`` out.

    The table has a row for each source, not for each document. Null names are nodes of their own. A shortage is met by siblings
    first and by their parents' siblings next, as only supply below positive weights counts on the way up.
    """
    supply = F.sum("usable").cast("long").alias("supply")
    leaves = leaves.withColumn("usable", F.when(_weight("lang", lang_weights) > 0, F.col("supply")).otherwise(F.lit(0)))
    level = leaves.groupBy("domain").agg(supply).withColumns({"weight": _weight("domain", domain_weights), "root": F.lit(0), "parent_budget": budget})
    level = water_fill(level, ["root"], "domain").select("domain", F.col("budget").alias("parent_budget"))
    for names, weight in ((["domain", "lang"], _weight("lang", lang_weights)), (["domain", "lang", "source"], F.lit(1.0))):
        up = [F.col(f"n.{c}").eqNullSafe(F.col(f"u.{c}")) for c in names[:-1]]
        nodes = leaves.groupBy(*names).agg(supply).withColumn("weight", weight)
        joined = nodes.alias("n").join(level.alias("u"), up).select("n.*", "u.parent_budget")
        level = water_fill(joined, names[:-1], names[-1]).select(*names, F.col("budget").alias("parent_budget"))
    return leaves.alias("n").join(level.alias("u"), [F.col(f"n.{c}").eqNullSafe(F.col(f"u.{c}")) for c in LEVELS]).select("n.*", F.col("u.parent_budget").alias("budget")).drop("usable")


def mixture_report(picked: DataFrame, domain_weights: Mapping[str, float] = DOMAIN_WEIGHTS) -> DataFrame:
    """Achieved against target shares of tokens: domain, tokens, share and target, of the rows of ``mix``. An empty mixture gives no rows."""
    tokens = picked.groupBy("domain").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens")).withColumn("weight", _weight("domain", domain_weights))
    all_of = Window.partitionBy(F.lit(0))  # a row for each domain
    return tokens.select("domain", "tokens", (F.col("tokens") / F.sum("tokens").over(all_of)).alias("share"), (F.col("weight") / F.sum("weight").over(all_of)).alias("target"))


def mix(df: DataFrame, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Which rows the mixture has, once for each epoch: ``key`` (the rows' order key), doc_id, domain, lang, source, n_tokens, epoch and ``copies``.

    Needs doc_id, text, lang and source. The mixture's budget is a share of all tokens. A leaf's epochs hold rows in the order of an MD5 of seed, epoch and doc_id (then text's MD5);
    the longest prefix within the leaf's budget is taken, so a document that would exceed it ends the leaf. Equal rows (same id, text,
    language and source) stand together, are taken or left together, and are given once with their number in ``copies``. Null texts have no tokens. An empty table gives no rows.
    """
    lean = (
        df.select("doc_id", "lang", "source", domain_of(F.coalesce("source", F.lit(""))).alias("domain"), token_count(F.col("text")).alias("n_tokens"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))
        .groupBy("doc_id", "lang", "source", "domain", "n_tokens", "text_md5").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("tokens", F.col("n_tokens") * F.col("copies"))
    )
    lean = checkpoint(lean)
    leaves = lean.groupBy(*LEVELS).agg((F.sum("tokens") * max_epochs).alias("supply"), F.count(F.lit(1)).alias("rows"))
    total = leaves.agg((F.floor(F.sum("supply") / max_epochs * budget_share)).cast("long").alias("b")).first()["b"] or 0
    budgets = leaf_budgets(leaves, F.lit(total))
    same_leaf = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in LEVELS]
    # The key's leading digits name the range; ranges of a leaf are equal shares of the key's values.
    epochs = lean.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_md5"))
    keyed = epochs.withColumn("key", key).alias("d").join(budgets.alias("b"), same_leaf("d", "b")).select("d.*", "b.budget", "b.rows")
    ranges = F.ceil(F.col("rows") / range_rows)
    keyed = keyed.withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)))
    ranged = keyed.groupBy(*LEVELS, "budget", "epoch", "range").agg(F.sum("tokens").alias("range_tokens"))
    earlier = Window.partitionBy(*LEVELS).orderBy("epoch", "range").rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.withColumn("before", F.coalesce(F.sum("range_tokens").over(earlier), F.lit(0))).where(F.col("before") <= F.col("budget"))
    on = [*same_leaf("k", "r"), F.col("k.epoch") == F.col("r.epoch"), F.col("k.range") == F.col("r.range")]
    placed = keyed.alias("k").join(ranged.alias("r"), on).select("k.*", "r.before")
    within = Window.partitionBy(*LEVELS, "epoch", "range").orderBy("key", "lang", "source", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = placed.withColumn("upto", F.col("before") + F.sum("tokens").over(within)).where(F.col("upto") <= F.col("budget"))
    return taken.select("key", "doc_id", "text_md5", "domain", "lang", "source", "n_tokens", "epoch", "copies", F.col("upto").alias("leaf_tokens"))


def mixed_rows(df: DataFrame, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The rows of df that the mixture has, with all their columns, once for each epoch that takes them."""
    taken = mix(df, budget_share, max_epochs, seed).select("doc_id", "text_md5", "lang", "source").groupBy("doc_id", "text_md5", "lang", "source").agg(F.count(F.lit(1)).alias("epochs"))
    keyed = df.withColumn("text_md5", F.md5(F.coalesce("text", F.lit(""))))
    on = [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("doc_id", "text_md5", "lang", "source")]
    joined = keyed.alias("d").join(taken.alias("t"), on).select(*(F.col(f"d.{c}") for c in df.columns), F.col("t.epochs").alias("_epochs"))
    return joined.withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.col("_epochs").cast("int")))).select(*df.columns)


def mixing_sql(documents: str = "documents", budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> str:
    """The same mixture for DuckDB, as common table expressions ending in ``mixed``."""
    weight = lambda col, weights: f"CASE {' '.join(f"WHEN {col} = '{k}' THEN {v!r}" for k, v in weights.items())} ELSE {OTHER_WEIGHT!r} END::DOUBLE"

    def fill(name: str, nodes: str, parent: str, child: str) -> str:
        """One level of water-filling."""
        return f"""
{name}_a AS (
  SELECT *, CASE WHEN weight > 0 THEN supply / weight END AS ratio FROM ({nodes})
), {name}_b AS (
  SELECT *, coalesce(sum(supply) OVER (PARTITION BY {parent} ORDER BY ratio NULLS LAST, {child} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled_before,
         sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER (PARTITION BY {parent} ORDER BY ratio NULLS LAST, {child} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left
  FROM {name}_a
), {name}_c AS (
  SELECT *, ratio IS NOT NULL AND filled_before + ratio * weight_left <= parent_budget * (1 + 1e-12) AS is_full FROM {name}_b
), {name} AS (
  SELECT * EXCLUDE (parent_budget), CAST(CASE WHEN is_full THEN supply
    WHEN weight > 0 THEN least(floor(greatest(parent_budget - coalesce(sum(CASE WHEN is_full THEN supply END) OVER (PARTITION BY {parent}), 0), 0) * weight / sum(CASE WHEN NOT is_full THEN weight END) OVER (PARTITION BY {parent})), supply)
    ELSE 0 END AS BIGINT) AS budget
  FROM {name}_c
)"""

    return f"""
lean AS (
  SELECT doc_id, lang, source,
         CASE WHEN num < 7 THEN 'crawl' WHEN num < 14 THEN 'books' ELSE 'reference' END AS domain,
         n_tokens, text_md5, count(*) AS copies, CAST(n_tokens * count(*) AS BIGINT) AS tokens
  FROM (SELECT doc_id, lang, source, coalesce(TRY_CAST(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS INTEGER), 0) AS num,
               CAST(coalesce(ceil(strlen(text) / 4.0), 0) AS BIGINT) AS n_tokens, md5(coalesce(text, '')) AS text_md5 FROM {documents})
  GROUP BY doc_id, lang, source, num, n_tokens, text_md5
), leaves AS (
  SELECT domain, lang, source, CAST(sum(tokens) * {max_epochs} AS BIGINT) AS supply FROM lean GROUP BY ALL
), usable AS (
  SELECT domain, lang, source, CASE WHEN {weight('lang', LANG_WEIGHTS)} > 0 THEN supply ELSE 0 END AS supply FROM leaves
), total AS (
  SELECT CAST(coalesce(floor(sum(supply) / {max_epochs} * {budget_share!r}), 0) AS BIGINT) AS b FROM leaves
), {fill("d", f"SELECT domain, CAST(sum(supply) AS BIGINT) AS supply, {weight('domain', DOMAIN_WEIGHTS)} AS weight, 0 AS root, (SELECT b FROM total) AS parent_budget FROM usable GROUP BY domain", "root", "domain")},
{fill("l", f"SELECT n.*, d.budget AS parent_budget FROM (SELECT domain, lang, CAST(sum(supply) AS BIGINT) AS supply, {weight('lang', LANG_WEIGHTS)} AS weight FROM usable GROUP BY ALL) n JOIN d USING (domain)", "domain", "lang")},
{fill("s", "SELECT n.*, l.budget AS parent_budget FROM (SELECT domain, lang, source, supply, 1.0::DOUBLE AS weight FROM usable) n JOIN l ON n.domain = l.domain AND n.lang IS NOT DISTINCT FROM l.lang", "domain, lang", "source")},
keyed AS (
  SELECT e.*, s.budget, md5('{seed}|' || CAST(epoch AS VARCHAR) || '|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || text_md5) AS key
  FROM (SELECT *, unnest(range({max_epochs}))::INTEGER AS epoch FROM lean) e
  JOIN s ON e.domain = s.domain AND e.lang IS NOT DISTINCT FROM s.lang AND e.source IS NOT DISTINCT FROM s.source
), mixed AS (
  SELECT * FROM (
    SELECT *, CAST(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY epoch, key, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS leaf_tokens FROM keyed
  ) WHERE leaf_tokens <= budget
)"""


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all documents: one row for each document and epoch."""
    picked = mix(read_table(spark, sf_dir, "documents"))
    return picked.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch", "copies", "leaf_tokens")


SQL = f"WITH {mixing_sql()} SELECT doc_id, domain, lang, source, n_tokens, epoch, copies, leaf_tokens FROM mixed"
