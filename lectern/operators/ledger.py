"""An event-sourced ledger: status machines, run summaries, lineage and latest states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by the order columns; ties by all of them. One aggregation, no window."""
    rest = [c for c in events.columns if c not in keys and c not in order]
    return events.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_last")).select(*keys, "_last.*")


def earliest(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in events.columns if c not in keys and c not in order]
    return events.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first")).select(*keys, "_first.*")


def status_pivot(rows: DataFrame, stage: str, status: str, statuses: Sequence[str]) -> DataFrame:
    """A row for each stage with a count for each of a closed list of statuses, 0 where none."""
    return rows.groupBy(stage).agg(*(F.count_if(F.col(status) == s).alias(s) for s in statuses))


def run_status(steps: DataFrame, run: str, status: str, order: str, done: str, failed: str) -> DataFrame:
    """A run's status: done if all its steps are, failed if any is, else that of its last step."""
    return steps.groupBy(run).agg(
        F.when(F.bool_and(F.col(status) == done), done).when(F.bool_or(F.col(status) == failed), failed).otherwise(F.max_by(status, order)).alias("run_status"),
        F.count(F.lit(1)).alias("n_steps"),
    )


def run_bounds(steps: DataFrame, run: str, status: str, time: str, terminal: Sequence[str]) -> DataFrame:
    """First time of a run, and its last one if all steps have ended."""
    return steps.groupBy(run).agg(F.min(time).alias("started"), F.when(F.bool_and(F.col(status).isin(*terminal)), F.max(time)).alias("finished"))


def throughput(steps: DataFrame, stage: str, run: str, time: str) -> DataFrame:
    """Mean seconds from a stage's event to the run's next one, and how many there are."""
    following = F.lead(time).over(Window.partitionBy(run).orderBy(time, stage))
    seconds = (F.unix_micros(following.cast("timestamp")) - F.unix_micros(F.col(time).cast("timestamp"))) / 1e6
    return steps.withColumn("_s", seconds).groupBy(stage).agg(F.avg("_s").alias("mean_seconds"), F.count("_s").alias("n"))


def illegal_transitions(events: DataFrame, keys: Sequence[str], status: str, order: Sequence[str], legal: Mapping[str, Sequence[str]]) -> DataFrame:
    """Events whose status may not follow the one before; the first one of a key may be any."""
    before = F.lag(status).over(Window.partitionBy(*keys).orderBy(*order))
    allowed = F.lit(False)
    for a, following in legal.items():
        allowed = allowed | ((F.col("from_status") == a) & F.col(status).isin(*following))
    return events.withColumn("from_status", before).where(F.col("from_status").isNotNull() & ~allowed)


def compare_and_set(state: DataFrame, requests: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Splits update requests (key, expected_version, new_status) by whether the version still holds: those to append, and those refused. Of two requests for one key neither wins by chance: the first by request_id does."""
    first = F.row_number().over(Window.partitionBy(key).orderBy("request_id")) == 1
    judged = requests.join(state.select(key, "version"), key, "left").withColumn("ok", F.coalesce(F.col("expected_version") == F.col("version"), F.lit(False)))
    judged = judged.withColumn("ok", F.col("ok") & first)
    return judged.where("ok").drop("ok"), judged.where("NOT ok").drop("ok")


def append_missing(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-or-ignore: the table and those rows whose key it hasn't, one for each key."""
    return table.unionByName(rows.dropDuplicates(list(keys)).join(table, list(keys), "left_anti"))


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table with rows of equal key replaced and new ones added."""
    return table.join(rows, list(keys), "left_anti").unionByName(rows.select(*table.columns))


def keyset_page(rows: DataFrame, order: Sequence[str], after: Sequence[Column], size: int) -> DataFrame:
    """The page of ``size`` rows behind a cursor, in the order of the columns."""
    cursor = F.struct(*(F.col(c) for c in order)) > F.struct(*(a.alias(c) for a, c in zip(after, order, strict=True)))
    return rows.where(cursor).orderBy(*order).limit(size)
