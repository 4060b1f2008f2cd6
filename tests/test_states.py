"""Streams with state that ends: batch equals stream, late final states win, state leaves."""

from __future__ import annotations

import os
import random
import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lectern.streaming import states

T0 = datetime(2024, 1, 1)


def streamed(spark, tmp_path, batches, schema, change):
    """Runs a stream with a file, and so a batch, for each list of rows; what it wrote, with the batch's number."""
    source, name, seen = str(tmp_path / "in"), f"out_{uuid.uuid4().hex}", 0
    os.makedirs(source)
    query = change(spark.readStream.schema(schema).json(source)).writeStream.format("memory").queryName(name).outputMode("update").option("checkpointLocation", str(tmp_path / "check")).start()
    out = []
    try:
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
            query.processAllAvailable()
            found = spark.table(name).collect()  # a memory sink only appends
            out += [(*r, i) for r in found[seen:]]
            seen = len(found)
    finally:
        query.stop()
    return spark.createDataFrame(out, spark.table(name).withColumn("batch", F.lit(0)).schema)


def test_late_final_states_win_and_batch_equals_stream(spark, tmp_path):
    r = random.Random(1)
    events = [("t%d" % r.randrange(3), "a%d" % r.randrange(4), "e%03d" % i, T0 + timedelta(minutes=r.randrange(40)), r.random() < 0.5) for i in range(60)]
    events += [(None, "a", "x", T0, True), ("t0", "a0", None, T0, True), ("t0", "a0", "zz", None, True)]
    r.shuffle(events)  # late ones come in any batch
    table = spark.createDataFrame(events, states.REACTION)
    changes = streamed(spark, tmp_path, [events[:20], events[20:40], events[40:]], states.REACTION, states.reaction_changes)
    want = sorted(map(tuple, states.final_reactions(table).collect()))
    assert sorted(map(tuple, states.present(changes).collect())) == want and len(want) == 12
    assert sorted(map(tuple, states.reaction_counts(states.present(changes)).collect())) == sorted(map(tuple, states.reaction_counts(states.final_reactions(table)).collect()))
    last = changes.groupBy("target", "actor").agg(F.max_by("event_id", "batch").alias("e")).collect()
    assert {tuple(x) for x in last} == {(t, a, e) for t, a, e, _, _ in want}  # an older event never came out after a later one


def test_one_event_creates_an_id(spark, tmp_path):
    schema = "id string, event_id string, ts timestamp"
    first = [("n1", "e2", T0 + timedelta(1)), ("n1", "e1", T0), ("n2", "e3", T0), (None, "e9", T0)]
    second = [("n1", "e0", T0 - timedelta(1)), ("n1", "e1", T0), ("n3", "e4", T0)]
    got = {tuple(x) for x in streamed(spark, tmp_path, [first, second], schema, states.create_if_absent).select("id", "event_id", "outcome", "batch").collect()}
    assert got == {("n1", "e1", "created", 0), ("n1", "e2", "exists", 0), ("n2", "e3", "created", 0), ("n1", "e0", "exists", 1), ("n1", "e1", "created", 1), ("n3", "e4", "created", 1)}
    table = states.created_once(spark.createDataFrame(first + first, schema)).select("id", "event_id", "outcome").collect()
    assert {tuple(x) for x in table} == {("n1", "e1", "created"), ("n1", "e2", "exists"), ("n2", "e3", "created")} and len(table) == 3


def test_runs_end_and_leave(spark, tmp_path):
    schema = "run_id string, step_id string, status string, ts timestamp"
    at = lambda m: T0 + timedelta(minutes=m)
    first = [("r1", "s1", "running", at(0)), ("r1", "s2", "succeeded", at(1)), ("r2", "s1", "failed", at(2)), (None, "s", "failed", at(2)), ("r2", None, "failed", at(2))]
    second = [("r1", "s1", "succeeded", at(5)), ("r2", "s1", "running", at(1))]  # the second is late and changes nothing
    third = [("r3", "s1", "running", at(500))]
    fourth, fifth = [("r3", "s2", "running", at(501))], [("r1", "s9", "failed", at(502))]  # r1 begins anew: its old steps are gone
    rows = streamed(spark, tmp_path, [first, second, third, fourth, fifth], schema, lambda df: states.ending_runs(df, idle_minutes=60, late="5 minutes")).collect()
    got = [(x.batch, x.run_id, x.status, x.n_steps, x.ended) for x in rows]
    assert {(0, "r1", "running", 2, False), (0, "r2", "failed", 1, False), (1, "r1", "succeeded", 2, False), (1, "r2", "failed", 1, False)} <= set(got)
    ended = {g[1:] for g in got if g[4]}
    assert ended == {("r1", "succeeded", 2, True), ("r2", "failed", 1, True)}
    assert (4, "r1", "failed", 1, False) in got
    table = states.run_results(spark.createDataFrame(first + second, schema)).collect()
    assert {tuple(x) for x in table} == {("r1", "succeeded", 2), ("r2", "failed", 1)}


def test_derived_ids(spark):
    df = spark.createDataFrame([("a", "b,c"), ("a,b", "c"), (None, "c"), ("a", "b,c")], "x string, y string")
    ids = [r[0] for r in df.select(states.derived_id("ntf_", "x", "y")).collect()]
    assert ids[0] == ids[3] != ids[1] and ids[2] is None and len(ids[0]) == 36
