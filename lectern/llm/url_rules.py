"""URL filter: a sort-merge range join of canonical URL keys with nested prefix rules.

A rule is a host and a path prefix. Its canonical key is the host's labels in reverse
order followed by the path, for example ``net.example./en/``. A URL offers one probe key for each of
its host's suffixes, so that "the rule fits the host and its subdomains and the path starts
with the rule's" becomes "the rule's key is a prefix of a probe". The keys that start with a
prefix are an interval in byte order, and such intervals are nested or apart. So one sorted
sweep over rules and probes suffices: at each rule the stack of rules that are open there is
known, the last rule at or before a probe carries that stack, and the entries which no longer
cover the probe are popped. The longest rule that is left wins.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import read_table, shuffle_partitions

#: Host, path, verdict.
DEFAULT_RULES: tuple[tuple[str, str, str], ...] = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
RULE_SCHEMA = "host string, path string, verdict string"
#: The verdict where no rule fits.
DEFAULT_VERDICT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed_key(labels: Column) -> Column:
    """``net.example.`` for example.net; each label ends with a dot, so that ``net.`` isn't a prefix of ``netting.``"""
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("."))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Each distinct rule key with the stack of rules that are open there, shortest first.

    A rule's ancestors are the rules whose keys are prefixes of its own; they are found by an
    equality join on its prefixes. A stack is at most as deep as a key has characters. Of rules with
    the same key, ``block`` wins. Rules with a null host are left out, as they fit no URL;
    a null path counts as empty.
    """
    own = (
        rules.where(F.col("host").isNotNull())
        .select(
            F.translate("host", _UPPER, _LOWER).alias("r_host"),
            F.coalesce("path", F.lit("")).alias("r_path"),
            F.coalesce("verdict", F.lit(DEFAULT_VERDICT)).alias("r_verdict"),
        )
        .withColumn("key", F.concat(_reversed_key(F.split("r_host", r"\.", -1)), "r_path"))
        .groupBy("key")
        .agg(
            F.max("r_verdict").alias("verdict"),
            F.min(F.concat("r_host", "r_path")).alias("rule"),
        )
    )
    prefixes = own.select(F.col("key").alias("child"), F.explode(F.expr("transform(sequence(1, length(key)), n -> substring(key, 1, n))")).alias("key"))
    return (
        prefixes.join(own, "key")
        .groupBy("child")
        .agg(F.sort_array(F.collect_list(F.struct(F.length("key").alias("len"), "key", "rule", "verdict"))).alias("stack"))
        .withColumnRenamed("child", "key")
    )


def apply_url_rules(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default_verdict: str = DEFAULT_VERDICT, buckets: int | None = None) -> DataFrame:
    """Judges each row's URL: id, host, path, the winning rule (null if none) and its verdict.

    The longest host and path wins. A null URL or one without ``://`` has an empty host and path.
    Repeated rows are judged once and given back as often as they came; an empty table gives an empty
    result; an empty rule table gives every row the default verdict; further columns are ignored.

    Distinct URLs are dealt evenly to ``buckets`` sweeps by a hash, so one hot host or one rule that
    covers a third of all URLs fills no single task; each sweep gets every rule. Rules
    therefore cost (rules x buckets) rows, which suits lists of rules that are small against the URLs.
    """
    spark = urls.sparkSession
    buckets = buckets or 2 * shuffle_partitions(spark)
    rows = urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).groupBy("id", "url").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(_reversed_key(F.slice(labels, -n, n)), F.col("path")))
    probes = rows.select(
        F.pmod(F.xxhash64("id", "url"), F.lit(buckets)).cast("int").alias("bucket"),
        F.explode(suffixes).alias("key"),
        F.lit(1).alias("kind"),
        F.lit(None).cast("array<struct<len:int,key:string,rule:string,verdict:string>>").alias("stack"),
        F.struct("id", "url", "copies", "host", "path").alias("row"),
    )
    starts = rule_stacks(rules).select(
        F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"),
        "key",
        F.lit(0).alias("kind"),
        "stack",
        F.lit(None).cast(probes.schema["row"].dataType).alias("row"),
    )
    sweep = Window.partitionBy("bucket").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = probes.unionByName(starts).withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where(F.col("kind") == 1)
    top = F.element_at(F.filter("open", lambda r: F.expr("key").startswith(r["key"])), -1)
    swept = swept.withColumn("top", F.when(F.size(F.coalesce(F.filter("open", lambda r: F.expr("key").startswith(r["key"])), F.array())) > 0, top))
    # A probe's key has one character more than the rule's host and path, so its length orders rules too.
    best = F.max(F.when(F.col("top").isNotNull(), F.struct(F.col("top.len").alias("len"), F.length("key").alias("host_len"), F.col("top.rule").alias("rule"), F.col("top.verdict").alias("verdict"))))
    judged = swept.groupBy("row").agg(best.alias("best"))
    return judged.select(
        F.col("row.id").alias(id_col),
        F.col("row.host").alias("host"),
        F.col("row.path").alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default_verdict)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("row.copies"))).alias("_copy"),
    ).drop("_copy")


def default_rules(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = DEFAULT_RULES) -> DataFrame:
    """A rule table made of literals; an empty list gives an empty table."""
    if not rules:
        return spark.createDataFrame([], RULE_SCHEMA)
    rows = [F.struct(*(F.lit(v).alias(k) for k, v in zip(("host", "path", "verdict"), rule, strict=True))) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_url_rules(read_table(spark, sf_dir, "pages"), default_rules(spark))


SQL = r"""
WITH p AS (
  SELECT page_id,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), h AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), r AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM h
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
