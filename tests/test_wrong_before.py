"""Cases that were wrong once: numbers over many partitions, long numbers in ids, parts of words, decimal points, null ends, many intervals."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from lectern.functions.text import padded_id
from lectern.operators import cleaning, products, records, resolution


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_numbers_over_many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        frame = spark.range(60_000).select(F.col("id"), (F.hash("id") % 1000).alias("k"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("c"))
        got = records.numbered(frame, ["b", "a", "c"], "c", ["k", "id"]).select("number", "c", "k", "id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(r.number for r in got) == list(range(1, 60_001))
    assert [r.id for r in sorted(got)] == [r.id for r in sorted(got, key=lambda r: ("bac".index(r.c), r.k, r.id))]


def test_long_numbers_stay_whole(spark):
    df = spark.createDataFrame([(7,), (9999,), (10000,), (10009,)], "n long")
    assert rows(df.select(padded_id("s", F.col("n"))), "n") == [("s0007",), ("s9999",), ("s10000",), ("s10009",)]


def test_first_holder_equals_brute_force(spark):
    r = random.Random(2)
    texts = [(i, "".join(r.choice("abcAB é") for _ in range(r.randrange(40)))) for i in range(80)] + [(90, None), (91, ""), (92, "conCATenate")]
    terms = ["cat", "CAT", "a", "é", "", None, "abc", "abca", "zzzz", "ab ca", "aabbcc", *{"".join(r.choice("abc ") for _ in range(r.randrange(1, 7))) for _ in range(60)}]
    spans = spark.createDataFrame([(100 - i, i, t) for i, t in texts], "place long, doc long, text string")
    got = dict(rows(products.first_holder(spark.createDataFrame([(t,) for t in terms], "term string"), spans, "term", "doc", "place", "text")))
    want = {t: max(i for i, x in texts if x and t.lower() in x.lower()) for t in terms if t and any(x and t.lower() in x.lower() for _, x in texts)}
    assert got == want
    assert products.first_holder(spans.select(F.col("text").alias("term")).limit(0), spans, "term", "doc", "place", "text").count() == 0


def test_sentences_of_answers(spark):
    answers = spark.createDataFrame([(1, "It is 3.5 m long. [s1]"), (2, "See a.b for v1.2.3! [s9] And more"), (3, "One. [s1] 二。三。[s1]"), (4, "Ends.[s1]"), (5, ""), (6, None)], "k int, t string")
    got = products.answer_check(answers, spark.createDataFrame([("s1",)], "span_id string"), "k", "t")
    assert rows(got, "k", "place") == [(2, 0, "not_in_bundle", "s9"), (2, 1, "no_citation", None), (3, 1, "no_citation", None)]


def test_retired_relations(spark):
    items = spark.createDataFrame([("a",), ("b",)], "id string")
    relations = spark.createDataFrame([("a", None), ("b", None), ("b", "a"), ("b", "c"), ("b", "c"), (None, None)], "from_id string, to_id string")
    left, kept, dropped = resolution.without_retired(items, relations, spark.createDataFrame([("a",), (None,)], "id string"), "id")
    assert rows(left) == [("b",)]
    assert sorted(rows(dropped), key=repr) == [("a", None), ("b", "a")]
    assert sorted(rows(kept), key=repr) == [("b", "c"), ("b", "c"), ("b", None), (None, None)]


def test_cover_equals_folds():
    r = random.Random(4)
    for _ in range(300):
        given = [(a, a + r.randrange(6)) for a in (r.randrange(30) for _ in range(r.randrange(8)))]
        cover = cleaning.Cover(given)
        for start in range(32):
            for end in range(start, 34):
                at = start
                for a, b in sorted(given):
                    at = b if a <= at < b else at
                assert cover.holds(start, end) == (at >= end)
                assert cover.within(start, end) == any(a <= start and end <= b for a, b in given)


def test_many_repeats_in_one_text():
    text = "".join(f"same paragraph \\[here\\] {i % 9000}\n" for i in range(18_000))
    began = time.perf_counter()
    found = cleaning.examine(text)
    assert sum(f.kind == "duplicate" for f in found) == 18_000 and time.perf_counter() - began < 10


def test_contents_end_before_the_body():
    entries = cleaning.contents_entries
    assert [t for t, _, _ in entries("目录\n卷一 甲乙\n卷二 丙丁\n\n正文")[0]] == ["卷一 甲乙", "卷二 丙丁"]
    for body in ("卷一 甲乙", "又见卷一 甲乙处", "正文", "一" * 41, "一" * 15 + "。"):
        head = "目录\n卷一 甲乙\n卷二 丙丁\n"
        found, at = entries(head + body + "\n后")
        assert [t for t, _, _ in found] == ["卷一 甲乙", "卷二 丙丁"] and at == len(head)
    assert entries("none") == ([], 4)


def test_kinds_on_demand():
    text = "---\nx: 1\n---\nsame long line\nsame long line\nsame long line\nhttp://a.b \\[x\\] ? 【缺】abcdabcd\n" * 2
    whole = cleaning.examine(text, {"a": "b"}, ["x"])
    for kind in cleaning.KINDS:
        assert cleaning.examine(text, {"a": "b"}, ["x"], [kind]) == [f for f in whole if f.kind == kind]
    assert {"duplicate", "missing", "header_footer", "watermark", "suspected_error", "variant_mixed"} <= {f.kind for f in whole}
    assert cleaning.patched(text, cleaning.examine(text, kinds=cleaning.PATCHED)) == cleaning.patched(text, whole)


def test_drafts_pair_by_evidence_only(spark):
    a = spark.createDataFrame([("a1", ["s1"], "the cat"), ("a2", ["s1"], "a dog"), ("a3", [], "same"), ("a4", None, "same"), ("a5", ["s2", "s3"], "x"), ("a6", ["s9"], "x")], "id string, spans array<string>, body string")
    b = spark.createDataFrame([("b1", ["s1"], "a dogs"), ("b2", ["s1"], "the cats"), ("b3", [], "same"), ("b4", None, "same"), ("b5", ["s3"], "x"), ("b6", ["s2"], "x"), ("b7", ["s8"], "x"), ("b8", ["s8"], "y")], "id string, spans array<string>, body string")
    got = sorted(rows(resolution.compared_drafts(a, b, "id", "spans", "body")), key=repr)
    want = [("a1", "b2", "paired"), ("a2", "b1", "paired"), ("a5", "b5", "partial"), *((x, None, "a_only") for x in ("a3", "a4", "a6")), *((None, x, "b_only") for x in ("b3", "b4", "b6", "b7", "b8"))]
    assert got == sorted(want, key=repr)


def test_concepts_attach_alias_admit(spark):
    base = spark.createDataFrame([("co1", "é", ["b"]), ("co2", "x", None), ("co3", "b", [])], "concept_id string, name string, aliases array<string>")
    mentions = [("s", "co1", "zz", None), ("s", "co1", "x", None), ("s", None, "e\u0301", None), ("s", None, "new", ["b"]), ("s", None, "other", [None, ""]), ("s", "co9", "x", None), ("s", "co9", "q", None), ("s", None, None, None), ("t", "co8", None, None)]
    got = resolution.concept_outcomes(spark.createDataFrame(mentions, "source_id string, concept_ref string, surface string, aliases array<string>"), base)
    assert {(r.source_id, r.subject, r.outcome, r.choice, tuple(r.targets), r.refusal) for r in got.collect()} == {
        ("s", "co1", "attach", "attach:co1", ("co1",), None), ("s", "e\u0301", "alias", None, ("co1",), None), ("s", "new", "alias", None, ("co1", "co3"), None), ("s", "other", "admit_new", "admit_new", (), None),
        ("s", "co9", None, None, (), "mixed"), ("t", "co8", "admit_new", "admit_new", (), None),
    }
