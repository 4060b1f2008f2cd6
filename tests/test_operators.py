"""Operators on small fixtures: offsets, patches, gates, graphs, sources and streams."""

from __future__ import annotations

import zipfile

from pyspark.sql import functions as F

from lectern.functions.canonical import canonical_hash, canonical_json
from lectern.functions.text import first_difference, nfc, occurrences, search_key, squeeze
from lectern.operators import cleaning, gates, graph, intervals, ledger, recon, repeats, search, spans
from lectern.sources import files
from lectern.streaming import notifications


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_segments_concatenate_and_cover(spark):
    texts = [(1, "One. Two!?\nThree"), (2, ""), (3, None), (4, "𠀀。甲\n\n乙"), (5, "..."), (6, " \n ")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = spans.segment_spans(df)
    joined = dict(rows(found.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "segment"))), lambda s: s["segment"]), ""))))
    assert joined == {i: t for i, t in texts if t}
    assert all(r.contiguous for r in spans.coverage(df, found).collect())
    assert spans.slices_hold(df, found).count() == 0
    broken = found.where("NOT (doc_id = 1 AND seq = 1)")
    assert [r.doc_id for r in spans.coverage(df, broken).where("NOT contiguous").collect()] == [1]
    assert spans.slices_hold(df, found.withColumn("segment", F.concat("segment", F.lit("x")))).count() == found.count()


def test_patches_round_trip(spark):
    df = spark.createDataFrame([(1, "ab\\-cd https://x.y/z e\u200bf"), (2, None), (3, "")], "doc_id long, text string")
    cleaned = dict(rows(cleaning.clean(df)))
    assert cleaned == {1: "ab-cd  ef", 2: "", 3: ""}
    assert all(r.replayed for r in cleaning.replay_report(df).collect())
    counts = {r.kind: r.n for r in cleaning.report(cleaning.findings(df)).collect()}
    assert counts["watermark"] == counts["control_char"] == counts["escape_residue"] == 1 and counts["private_use_area"] == 0


def test_position_map(spark):
    patches = F.array(F.struct(F.lit(2).alias("raw_start"), F.lit(4).alias("raw_end"), F.lit(2).alias("cleaned_start"), F.lit(3).alias("cleaned_end")))
    got = spark.range(7).select("id", spans.map_position(F.col("id"), patches).alias("p"))
    assert rows(got, "id") == [(0, 0), (1, 1), (2, 2), (3, 2), (4, 3), (5, 4), (6, 5)]


def test_quotes(spark):
    schema = "span_text string, span_start int, quote string, rel_start int, rel_end int"
    data = [("abcabc", 10, "bc", None, None), ("abcabc", 10, "bc", 4, 6), ("abc", 5, "c", None, None), ("abc", 5, None, None, None), ("abc", 5, "x", None, None), (None, 5, "x", None, None), ("abc", 0, "", None, None)]
    got = spans.locate_quotes(spark.createDataFrame(data, schema)).select("start", "stop", "reason")
    assert rows(got) == [(None, None, "ambiguous"), (14, 16, None), (7, 8, None), (5, 8, None), (None, None, "not_found"), (None, None, "no_span"), (None, None, "empty_quote")]


def test_text_functions(spark):
    df = spark.createDataFrame([("aaaa", "aa"), ("abc", "abd"), ("", "a"), (None, "a")], "a string, b string")
    assert rows(df.select(occurrences(F.col("a"), F.col("b")), first_difference(F.col("a"), F.col("b")))) == [(2, 2), (0, 2), (0, 0), (None, None)]
    assert rows(spark.range(1).select(search_key(F.lit("A, b_C!")), squeeze(F.lit(" a \n b ")))) == [("ab_c", "a b")]
    assert rows(spark.createDataFrame([(" e\u0301 ",), (None,)], "t string").select(nfc("t"))) == [("é",), (None,)]
    js = spark.createDataFrame([('{"b": 1, "a": [1, {"x_id": 2}]}',), ("{",), ("NaN",)], "j string")
    assert rows(js.select(canonical_json()("j"))) == [('{"a":[1,{"x_id":2}],"b":1}',), (None,), (None,)]
    assert js.select(canonical_hash(F.col("j"), ("_id",))).first()[0] == spark.range(1).select(F.sha2(F.lit('{"a":[1,{}],"b":1}'), 256)).first()[0]


def test_graph_with_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), (None, "a")], "src string, dst string")
    seeds = spark.createDataFrame([("a",), (None,)], "node string")
    assert rows(graph.reachable(edges, seeds), "node") == [("a", 0), ("b", 1), ("c", 2)]
    assert rows(graph.reachable(edges, seeds, undirected=True), "node") == [("a", 0), ("b", 1), ("c", 1)]
    assert graph.reachable(edges.limit(0), seeds.limit(0)).count() == 0


def test_gates_notice_tampering(spark):
    good = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "g int, seq int")
    assert gates.consecutive(good, "order", "g", "seq").count() == 0
    assert gates.consecutive(good.where("seq = 1"), "order", "g", "seq").count() == 1
    assert rows(gates.verdict(gates.unique(good, "unique", "g"), ["unique", "other"]), "check") == [("other", 0, True), ("unique", 1, False)]


def test_ledger(spark):
    state = spark.createDataFrame([("a", 1), ("b", 2)], "k string, version int")
    asked = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 3, 1), ("c", 4, 0)], "k string, request_id int, expected_version int")
    ok, refused = ledger.compare_and_set(state, asked, "k")
    assert [r.request_id for r in ok.collect()] == [1] and sorted(r.request_id for r in refused.collect()) == [2, 3, 4]
    new = spark.createDataFrame([("b", 9), ("c", 3), ("c", 3)], "k string, version int")
    assert rows(ledger.append_missing(state, new, ["k"]), "k") == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(ledger.upsert(state, new.distinct(), ["k"]), "k") == [("a", 1), ("b", 9), ("c", 3)]


def test_intervals_and_recon(spark):
    points = spark.createDataFrame([(1,), (5,), (None,)], "p long")
    boxes = spark.createDataFrame([("x", 0, 5), ("y", 5, 30), ("z", 7, 7)], "n string, a long, b long")
    assert rows(intervals.points_in_intervals(points, boxes, "p", "a", "b", 4).select("p", "n"), "p") == [(1, "x"), (5, "y")]
    lanes = spark.createDataFrame([("k", "a"), ("k", "b"), ("m", "c")], "k string, body string")
    assert rows(recon.lanes_agree(lanes, lanes.where("k = 'k'"), "k", "body"), "k") == [("k", 2, 2, True), ("m", 1, 0, False)]
    assert repeats.islands(spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "b")], "k int, t int, v string"), ["k"], ["t"], F.col("v"), 2).count() == 1


def test_search_falls_back_to_words(spark):
    df = spark.createDataFrame([(1, "red, green"), (2, "blue")], "id int, text string")
    index = search.search_index(df, "id", "text")
    assert rows(search.locate(index, "RED green", "id", "text").select("id", "how")) == [(1, "substring")]
    assert rows(search.locate(index, "green red", "id", "text").select("id", "how")) == [(1, "words")]
    assert search.locate(index, "nothing", "id", "text").count() == 0


def test_sources(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("é\r\nx".encode())
    (tmp_path / "b.txt").write_bytes("甲乙".encode("gb18030"))
    (tmp_path / "c.txt").write_bytes(b"\xff\xff\xff")
    got = files.read_text_files(spark, str(tmp_path), "*.txt").select("encoding", "text")
    assert rows(got.orderBy("path")) == [("utf-8", "é\nx"), ("gb18030", "甲乙"), (None, None)]
    with zipfile.ZipFile(tmp_path / "k.epub", "w") as z:
        z.writestr("META-INF/container.xml", '<c><rootfiles><rootfile full-path="o/p.opf"/></rootfiles></c>')
        z.writestr("o/p.opf", '<package xmlns="u"><manifest><item id="i" href="a.xhtml"/></manifest><spine><itemref idref="i"/></spine></package>')
        z.writestr("o/a.xhtml", "<p>Hi &amp; you</p>")
    (tmp_path / "l.epub").write_bytes(b"broken")
    got = files.read_epub(spark, str(tmp_path)).orderBy("path").select("place", "file", "text", F.col("error").isNull())
    assert rows(got) == [(0, "o/a.xhtml", "Hi & you", True), (None, None, None, False)]
    pages = spark.createDataFrame([("b", "<!-- p1 -->one<!-- p2 -->\ntwo")], "book string, text string")
    assert rows(files.split_pages(pages)) == [("b", "p1", "one"), ("b", "p2", "two")]


def test_streams(spark, tmp_path):
    events = spark.createDataFrame([(1, 7, "2024-01-01 00:01:00"), (2, 7, "2024-01-01 00:02:00"), (2, 7, "2024-01-01 00:02:00"), (3, 7, "2024-01-02 00:00:00")], "event_id long, user_id long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = notifications.delivered_once(stream).writeStream.format("memory").queryName("once").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.event_id for r in spark.table("once").collect()) == [1, 2, 3]
    q = notifications.merged(stream).writeStream.format("memory").queryName("merged").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.n for r in spark.table("merged").collect()) == [1, 3]
    steps = spark.createDataFrame([("r", "a", "succeeded"), ("r", "b", "running"), ("s", "a", "failed")], "run_id string, step_id string, status string")
    steps.write.parquet(str(tmp_path / "steps"))
    q = notifications.run_states(spark.readStream.schema(steps.schema).parquet(str(tmp_path / "steps"))).writeStream.format("memory").queryName("runs").outputMode("update").option("checkpointLocation", str(tmp_path / "c3")).start()
    q.processAllAvailable()
    q.stop()
    assert {r.run_id: r.status for r in spark.table("runs").collect()} == {"r": "running", "s": "failed"}
