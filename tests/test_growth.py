"""Steps whose cost grew faster than their input, or more than it has to."""

from __future__ import annotations

import random
import time

from lectern.operators import bundles, cleaning, objects
from lectern.sources import declared


def test_long_stretches_take_no_square():
    """a stretch of 20,000 letters without a space took 12 s, 0.05 s since."""
    dice = random.Random(3)
    text = "".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)) + "wxyzwxyzwxyz"
    began = time.process_time()
    assert [(f.kind, f.raw_start, f.raw_end) for f in cleaning.examine(text)] == [("duplicate", 20_000, 20_012)]
    assert time.process_time() - began < 2


def test_rules_find_what_their_patterns_find():
    """phrases and framed blocks are looked for only where they can be; the patterns still say what is found."""
    dice, alphabets = random.Random(4), ("ab \n", "abcdabcd，\n", "┌┐│-|+=\n \tx", "|+-=—\n", "一二。|──│┌┘\n")
    for n in range(2_000):
        text = "".join(dice.choice(alphabets[n % 5]) for _ in range(dice.choice((9, 30, 90))))
        text += text[: dice.randint(1, 12)] * dice.randint(0, 4)
        assert list(cleaning._framed(text)) == [m.span() for m in cleaning._BLOCK.finditer(text)], text
        assert sorted(cleaning._phrases(text)) == [(*m.span(), m[1]) for m in cleaning._RULE["duplicate"].finditer(text)], text


def test_digest_sums_whole_numbers(spark):
    """sums of decimals made from hex digits took most of the time of a digest; it still finds any row that is lost, repeated, moved or changed."""
    rows = spark.range(500).selectExpr("id", "CAST(id % 7 AS STRING) AS a", "IF(id % 5 = 0, NULL, id % 3) AS b")
    plan = bundles.rows_digest(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(38" not in plan and "conv(" not in plan
    told = lambda df: tuple(bundles.rows_digest(df).first())
    whole = told(rows)
    assert whole == told(rows.repartition(7).select("b", "id", "a")) and whole[0] == 500
    others = [rows.where("id <> 3"), rows.unionByName(rows.where("id = 3")), rows.selectExpr("id", "IF(id = 4, 'x', a) AS a", "b"), rows.selectExpr("id", "IF(id = 0, NULL, a) AS a", "IF(id = 0, 0, b) AS b"), rows.where("id <> 3").unionByName(rows.where("id = 4")), rows.limit(0)]
    assert len({whole, *map(told, others)}) == 7


def test_rounds_are_counted_without_writing(spark, monkeypatch):
    """every round's rows were written twice; now only those that are returned or looked at again."""
    frame = lambda *rows: spark.createDataFrame(list(rows), "proposal_key string, resolution string, depends_on array<string>")
    written, keep = [], objects.kept
    monkeypatch.setattr(objects, "kept", lambda df: written.append(df) or keep(df))
    ended = objects.proposal_rounds(lambda r: frame((f"b{r}", "blocked", []), ("a", "auto", None)), frame(("d", "human", None)), 4)
    assert (ended.status, ended.log, len(written)) == ("too_many", [(r, 2, 1, 1) for r in range(1, 5)], 2)
    assert sorted(r[0] for r in ended.proposals.collect()) == ["a", "b4"]
    # Waiting rows, repeated keys, keys and dependencies that are null.
    mixed = frame(("a", "blocked", ["x"]), ("a", "blocked", []), ("b", "blocked", ["d"]), (None, "blocked", ["x"]), ("c", "blocked", [None]), ("e", "auto", ["x"]), ("d", "human", []))
    ended = objects.proposal_rounds(lambda r: mixed, frame(("d", "human", None)))
    assert (ended.status, ended.log) == ("unchanged", [(1, 7, 5, 2), (2, 7, 5, 2)])


def test_only_marked_texts_go_to_python(spark):
    """every text went to Python for its links, and again to be spliced; batches had up to 64 MB."""
    from lectern.operators import spans

    docs = spark.createDataFrame([(1, "see http://a.b now"), (2, "plain"), (3, None), (4, "---\na: 1\n---\nx"), (5, "")], "doc_id long, text string")
    found = cleaning.findings(docs, kinds=["watermark"])
    assert "contains(" in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [(r.doc_id, r.raw_start, r.raw_end) for r in found.collect()] == [(1, 4, 14)]
    assert [r.doc_id for r in cleaning.findings(docs, kinds=["escape_residue"]).collect()] == [4]
    assert cleaning.findings(docs, kinds=[]).count() == 0
    done = spans.apply_patches(docs, spans.patches_from(found.select("doc_id", "raw_start", "raw_end", "replacement")))
    assert {r.doc_id: r.cleaned for r in done.collect()} == {1: "see  now", 2: "plain", 3: "", 4: "---\na: 1\n---\nx", 5: ""}
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20


def test_unit_texts_are_parsed_once(spark):
    """every look at a unit's texts parsed them again."""
    texts = {
        "a/unit.json": '{"unit_id": "ku_a"}', "a/provenance.json": "{}", "a/assertions.json": '[{"span_ids": ["1", 2, null, "1"]}, {"span_ids": "3"}, {}, 4, null, [5], {"span_ids": ["6"]}]',
        "b/unit.json": '{"unit_id": 7}', "b/provenance.json": "{}", "b/assertions.json": '{"span_ids": ["1"]}', "c/unit.json": '{"unit_id": "ku_c"}', "c/provenance.json": "{}", "c/assertions.json": "null",
    }
    units = declared.units(spark.createDataFrame([(f"/ku_{p}", t) for p, t in texts.items()], "path string, text string"))
    assert {r.unit_id: (r.span_ids, r.problem) for r in units.collect()} == {"ku_a": (["1", "6"], None), "ku_b": (None, "identity"), "ku_c": (None, "assertions")}
    assert units.select("span_ids", "problem")._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson") == 2
