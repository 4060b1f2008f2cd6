"""Event streams: merged notifications, deduplicated deliveries and run states."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def with_event_time(events: DataFrame, time: str = "ts", late: str | None = None) -> DataFrame:
    """``ts`` as a zoned timestamp, which watermarks need; with ``late`` a watermark of that delay."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, late) if late else timed


def merged(events: DataFrame, window: str = "10 minutes", late: str = "10 minutes", key: str = "user_id", time: str = "ts") -> DataFrame:
    """Number of events of each key in each window; the same for streams (rows behind the watermark are dropped) and tables."""
    timed = with_event_time(events, time, late if events.isStreaming else None)
    return timed.groupBy(key, F.window(time, window).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("window_start"), "n")


def delivered_once(events: DataFrame, id_col: str = "event_id", time: str = "ts", days: int = 7) -> DataFrame:
    """The first delivery of each id; a stream remembers ids for ``days``."""
    timed = with_event_time(events, time, f"{days} days" if events.isStreaming else None)
    return timed.dropDuplicatesWithinWatermark([id_col]) if events.isStreaming else timed.dropDuplicates([id_col])


def run_states(steps: DataFrame, done: str = "succeeded", failed: str = "failed") -> DataFrame:
    """Streams each run's state after each batch from step events (run_id, step_id, status): failed as soon as a step is, succeeded when all known steps are, else running."""

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = dict(zip(*state.get, strict=True)) if state.exists else {}
        for batch in batches:
            known.update(zip(batch["step_id"].astype(str), batch["status"].astype(str), strict=True))
        state.update((list(known), list(known.values())))
        status = failed if failed in known.values() else done if all(v == done for v in known.values()) else "running"
        yield pd.DataFrame({"run_id": [key[0]], "status": [status], "n_steps": [len(known)]})

    return steps.groupBy("run_id").applyInPandasWithState(advance, "run_id string, status string, n_steps long", "steps array<string>, states array<string>", "update", GroupStateTimeout.NoTimeout)
