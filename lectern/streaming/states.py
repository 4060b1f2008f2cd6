"""State that ends: reactions whose final state wins, ids that are created once, and runs that leave when they are over.

Each has a form for tables and one for streams. What the stream writes, rebuilt as a table, equals the table form over the same events, in whatever order
and batches they came. States end by event time, so a replay gives the same. (``transformWithState`` failed while it was planned in the one setting that was tried, processing time
with ``foreachBatch`` on Spark 4.1.2; the cause isn't known, and states are those of ``applyInPandasWithState``.)
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

REACTION = "target string, actor string, event_id string, ts timestamp, is_on boolean"
CREATED = "id string, event_id string, ts timestamp, outcome string"
RUN = "run_id string, status string, n_steps long, ended boolean"
DAY = 86_400_000


def derived_id(prefix: str, *parts: str) -> F.Column:
    """An id that any writer derives alike from the parts: a hash of them as a JSON list; null where a part is."""
    whole = F.to_json(F.array(*(F.col(p).cast("string") for p in parts)))
    known = F.lit(True)
    for p in parts:
        known = known & F.col(p).isNotNull()
    return F.when(known, F.concat(F.lit(prefix), F.substring(F.sha2(whole, 256), 1, 32)))


def final_reactions(events: DataFrame) -> DataFrame:
    """The latest state of each actor's reaction to each target (target, actor, event_id, ts, is_on): by time, ties by event id. Events without one of them say nothing."""
    known = events.where("target IS NOT NULL AND actor IS NOT NULL AND event_id IS NOT NULL AND ts IS NOT NULL AND is_on IS NOT NULL")
    return known.groupBy("target", "actor").agg(F.max(F.struct("ts", "event_id", "is_on")).alias("f")).select("target", "actor", "f.event_id", "f.ts", "f.is_on")


def reaction_counts(final: DataFrame) -> DataFrame:
    """(target, n) of reactions that are on: a projection that can be rebuilt from final states at any time, and isn't counted up and down."""
    return final.groupBy("target").agg(F.count_if("is_on").alias("n"))


def _latest(rows: Iterator[pd.DataFrame], columns: list[str]) -> tuple | None:
    """The greatest (ts, event_id, ..) of the batches, one batch at a time."""
    best = None
    for batch in rows:
        batch = batch.dropna(subset=columns)
        if len(batch):
            top = tuple(batch.sort_values(columns[:2]).iloc[-1][columns])
            best = top if best is None or top[:2] > best[:2] else best
    return best


def reaction_changes(events: DataFrame, remember_days: int = 7) -> DataFrame:
    """A stream of the final states that changed. An event older than what is known changes nothing; `final_reactions` over all that was written is the present state.

    State is dropped when the watermark is ``remember_days`` past a key's last event. Events that are further behind the newest one are dropped, as they are from any stream with a watermark.
    """

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best = _latest(batches, ["ts", "event_id", "is_on"])
        if best is None:
            return
        if not state.exists or (best[0].value, best[1]) > tuple(state.get):
            state.update((best[0].value, best[1]))
            yield pd.DataFrame({"target": [key[0]], "actor": [key[1]], "event_id": [best[1]], "ts": [best[0]], "is_on": [bool(best[2])]})
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), best[0].value // 1_000_000) + remember_days * DAY)

    known = events.where("target IS NOT NULL AND actor IS NOT NULL").withWatermark("ts", f"{remember_days} days")
    return known.groupBy("target", "actor").applyInPandasWithState(advance, REACTION, "ts_ns long, event_id string", "update", GroupStateTimeout.EventTimeTimeout)


def created_once(requests: DataFrame) -> DataFrame:
    """Requests (id, event_id, ts) with their outcome: ``created`` for the first of an id by time and event id, ``exists`` for the others. Requests without an id or event are left out; one that is repeated whole counts once."""
    known = requests.where("id IS NOT NULL AND event_id IS NOT NULL AND ts IS NOT NULL").select("id", "event_id", "ts").distinct()
    first = known.groupBy("id").agg(F.min(F.struct("ts", "event_id")).alias("f"))
    # The small side is one row an id; a hot id only repeats on the other side.
    return known.join(first, "id").select("id", "event_id", "ts", F.when((F.col("f.ts") == F.col("ts")) & (F.col("f.event_id") == F.col("event_id")), "created").otherwise("exists").alias("outcome"))


def create_if_absent(requests: DataFrame, remember_days: int = 7) -> DataFrame:
    """A stream of outcomes: exactly one event creates an id, the first that arrives; a retry of that event hears ``created`` again, all others ``exists``. Ids are remembered until the watermark is ``remember_days`` past their last request."""

    def answer(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        by, newest = state.get[0] if state.exists else None, state.getCurrentWatermarkMs()
        for batch in batches:
            batch = batch.dropna(subset=["event_id", "ts"]).sort_values(["ts", "event_id"])
            if not len(batch):
                continue
            if by is None:
                by = batch["event_id"].iloc[0]
                state.update((by,))
            # A request that comes again gets the answer it had.
            yield pd.DataFrame({"id": key[0], "event_id": batch["event_id"], "ts": batch["ts"], "outcome": ["created" if e == by else "exists" for e in batch["event_id"]]})
            newest = max(newest, batch["ts"].iloc[-1].value // 1_000_000)
        if by is not None:
            state.setTimeoutTimestamp(newest + remember_days * DAY)

    return requests.where("id IS NOT NULL").withWatermark("ts", f"{remember_days} days").groupBy("id").applyInPandasWithState(answer, CREATED, "event_id string", "update", GroupStateTimeout.EventTimeTimeout)


def run_results(steps: DataFrame) -> DataFrame:
    """The table form: (run_id, status, n_steps) from each step's latest status (run_id, step_id, status, ts), failed before running before succeeded."""
    latest = steps.where("run_id IS NOT NULL AND step_id IS NOT NULL AND status IS NOT NULL AND ts IS NOT NULL").groupBy("run_id", "step_id").agg(F.max(F.struct("ts", "status")).alias("f"))
    status = F.when(F.bool_or(F.col("f.status") == "failed"), "failed").when(F.bool_and(F.col("f.status") == "succeeded"), "succeeded").otherwise("running")
    return latest.groupBy("run_id").agg(status.alias("status"), F.count(F.lit(1)).alias("n_steps"))


def ending_runs(steps: DataFrame, idle_minutes: int = 60, late: str = "10 minutes") -> DataFrame:
    """A stream of runs' states after each batch (run_id, status, n_steps, ended), from steps (run_id, step_id, status, ts).

    A late event never takes back a later one of its step. When the watermark is ``idle_minutes`` past a run's newest event, its last state comes once more with ``ended`` true, and all that is known of it is dropped. The steps of one run have to fit in a row.
    """

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = {step: (ts, status) for step, ts, status in zip(*state.get, strict=True)} if state.exists else {}
        for batch in batches:
            batch = batch.dropna(subset=["step_id", "status", "ts"])
            for step, status, ts in zip(batch["step_id"], batch["status"], batch["ts"], strict=True):
                known[step] = max(known.get(step, (0, "")), (ts.value // 1_000_000, status))
        if not known:
            return
        said = [status for _, status in known.values()]
        status = "failed" if "failed" in said else "succeeded" if set(said) == {"succeeded"} else "running"
        yield pd.DataFrame({"run_id": [key[0]], "status": [status], "n_steps": [len(known)], "ended": [state.hasTimedOut]})
        if state.hasTimedOut:
            state.remove()
        else:
            state.update((list(known), [ts for ts, _ in known.values()], said))
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), max(ts for ts, _ in known.values())) + idle_minutes * 60_000)

    timed = steps.where("run_id IS NOT NULL").withWatermark("ts", late)
    return timed.groupBy("run_id").applyInPandasWithState(advance, RUN, "steps array<string>, times array<long>, states array<string>", "update", GroupStateTimeout.EventTimeTimeout)


def present(changes: DataFrame) -> DataFrame:
    """Final states out of all changes that a stream wrote, rebuilt."""
    return final_reactions(changes)
