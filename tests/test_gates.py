"""Interval cover, as-of joins by bins, and validator suites."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import cover, intervals, objects, suites
from lectern.plans import catalog, catalog_gates  # noqa: F401


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_cover_equals_brute_force(spark):
    r = random.Random(7)
    some = lambda n, most: [(r.choice(["x", "y", "z"]), a, a + r.randrange(most)) for a in (r.randrange(-40, 60) for _ in range(n))]
    given, asked = some(30, 12), some(200, 20)
    asked += [asked[0], ("x", None, 3), ("x", 3, None), (None, 1, 4), ("none", 5, 9), ("none", 5, 5), ("x", 9, 4)]
    schema = "k string, a int, b int"
    held = {k: {p for c, a, b in given if c == k for p in range(a, b)} for k in ("x", "y", "z")}
    want = [(k, a, b, None if a is None or b is None else a >= b or (k in held and set(range(a, b)) <= held[k])) for k, a, b in asked]
    left, right = spark.createDataFrame(asked, schema), spark.createDataFrame([*given, (None, 1, 9), ("x", None, 2)], schema)
    for width in (1, 7, 1000):
        got = cover.covered_intervals(left, right, ["k"], "a", "b", width)
        assert sorted(rows(got), key=repr) == sorted(want, key=repr)
        merged = rows(cover.merged_intervals(right.where("k IS NOT NULL"), ["k"], "a", "b", width))
        for k, points in held.items():
            mine = sorted((a, b) for c, a, b in merged if c == k)
            assert {p for a, b in mine for p in range(a, b)} == points and all(b < c for (_, b), (c, _) in zip(mine, mine[1:], strict=False))
    assert cover.covered_intervals(left.limit(0), right, ["k"], "a", "b", 4).count() == 0
    assert {c for *_, c in rows(cover.covered_intervals(left, right.limit(0), ["k"], "a", "b", 4))} == {None, True, False}


@pytest.mark.parametrize("width", [None, 1, 5, 10_000])
def test_as_of_by_bins(spark, width):
    r = random.Random(1)
    right = [(r.choice("ab"), t, f"v{t}") for t in r.sample(range(-50, 50), 40)]
    left = [(r.choice("abc"), r.randrange(-60, 60), i) for i in range(200)]
    got = intervals.as_of(spark.createDataFrame(left, "k string, t int, i int"), spark.createDataFrame(right, "k string, s int, v string"), ["k"], "t", "s", "v", width)
    want = [(k, t, i, max(((s, v) for c, s, v in right if c == k and s <= t), default=(0, None))[1]) for k, t, i in left]
    assert sorted(rows(got), key=repr) == sorted(want, key=repr)


def test_open_counts(spark):
    df = spark.createDataFrame([("k", 0, 5), ("k", 3, 8), ("k", 5, 6), ("k", 4, 4), ("k", None, 2)], "k string, a int, b int")
    assert rows(cover.open_counts(df, ["k"], "a", "b"), "at") == [("k", 0, 1), ("k", 3, 2), ("k", 6, 1), ("k", 8, 0)]


def test_forbidden_chars_need_exactly_one_finding(spark):
    parts = spark.createDataFrame([(1, "s", 0, "a?b□"), (1, "t", 4, "?"), (2, "u", None, "?"), (3, "v", 0, None), (4, "w", 0, "?")], "doc_id long, span_id string, start_offset int, text string")
    patches = spark.createDataFrame([(1, 0, 2, 0, 0), (1, 5, 6, 3, 3)], "doc_id long, raw_start int, raw_end int, cleaned_start int, cleaned_end int")
    kept = "known_unresolvable"
    found = [(1, "replacement_char", kept, 3, 4), (1, "replacement_char", kept, 6, 7), (1, "replacement_char", kept, 6, 8), (1, "replacement_char", kept, 7, 8), (1, "replacement_char", "processed", 8, 9), (4, "private_use_area", kept, 0, 1)]
    got = cover.forbidden_chars(parts, patches, spark.createDataFrame(found, "doc_id long, kind string, terminal_state string, raw_start int, raw_end int"), width=2)
    # The private character's only answer is of another kind, the next one's ends otherwise.
    assert rows(got.select("doc_id", "position", "raw_position", "n", "verdict"), "doc_id", "position") == [(1, 1, 3, 1, "disclosed"), (1, 3, 6, 2, "forbidden"), (1, 4, 7, 0, "forbidden"), (1, 5, 8, 0, "forbidden"), (4, 0, 0, 0, "forbidden")]


def test_one_scan_takes_unknown_for_failed(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "k int, bad boolean")
    got = suites.scanned(df, F.col("k"), [suites.Check("bad", F.col("bad")), suites.Check("odd", F.col("k") % 2 == 1, F.col("k"))])
    assert rows(got, "check", "subject") == [("bad", "1", ""), ("bad", "3", ""), ("odd", "1", "1"), ("odd", "3", "3")]
    assert "MapInArrow" not in got._jdf.queryExecution().toString() and got._jdf.queryExecution().toString().count("Generate") >= 1


def test_report_follows_order_and_needs(spark):
    listed = (suites.Validator("a", "G", (("x", "C1"), ("w", None))), suites.Validator("b", "G", (("y", None),), ("a",)), suites.Validator("c", "H", (("z", None),), ("b",)), suites.Validator("d", "H", (("v", None),)))
    found = spark.createDataFrame([("x",), ("x",), ("w",), ("z",), ("what",)], "check string")
    report = lambda df, **k: rows(suites.suite_report(df, listed, warnings=("w",), **k).select("check", "n", "state"), F.col("place"))
    assert report(found) == [("x", 2, "failed"), ("w", 1, "told"), ("y", 0, "blocked"), ("z", 1, "blocked"), ("v", 0, "passed"), ("unregistered", 1, "failed")]
    assert report(found.where("check = 'w'")) == [("x", 0, "passed"), ("w", 1, "told"), ("y", 0, "passed"), ("z", 0, "passed"), ("v", 0, "passed")]
    assert report(found.where("check = 'z'"), gates=["H"]) == [("z", 1, "failed"), ("v", 0, "passed")]


@pytest.mark.parametrize("name", ["suite_sources", "suite_coverage", "suite_evidence"])
def test_every_check_fails_somewhere(spark, name):
    got = catalog.QUERIES[name](spark, "/root/testdata/sf0.01").collect()
    assert all(r.n > 0 for r in got) and {r.state for r in got} <= {"failed", "told"}
    assert len(got) == sum(len(v.checks) for v in suites.VALIDATORS if v.gate == got[0].gate)


# Objects.


def concepts_by_force(base, mentions, technique):
    """Concepts one source after another, as a plain loop."""
    import unicodedata

    known = {c: [n, list(a or []), [p[0] for p in prov or []]] for c, n, a, prov in base}
    refused = set()
    for source in sorted({m[0] for m in mentions}):
        for ref in sorted({m[1] for m in mentions if m[0] == source and m[1]}):
            surfaces = sorted({unicodedata.normalize("NFC", m[2]).strip() for m in mentions if m[0] == source and m[1] == ref and m[2] and m[2].strip()})
            if not surfaces:
                continue
            if not ref.startswith("co_"):
                refused.add((source, ref, "family"))
            elif ref.split("_")[1] != technique:
                refused.add((source, ref, "technique"))
            elif ref not in known:
                known[ref] = [surfaces[0], surfaces[1:], [source]]
            else:
                name, aliases, told = known[ref]
                if source in told and not {name, *aliases} & set(surfaces):
                    refused.add((source, ref, "collision"))
                    continue
                known[ref][1] = sorted(set(aliases) | set(surfaces[1:]) | ({surfaces[0]} - {name}))
                told += [source] if source not in told else []
    return sorted((c, n, a, p) for c, (n, a, p) in known.items()), refused


def test_concepts_equal_a_loop(spark):
    r = random.Random(11)
    base = [("co_x_1", "a", ["b"], [("s1", "h", "machine_extracted")]), ("co_x_2", "é", None, None), ("co_x_9", "z", ["y", "x"], [("s0", "h", "m")])]
    mentions = [(f"s{r.randrange(4)}", r.choice(["co_x_1", "co_x_2", "co_x_3", "co_x_4", "co_y_1", "pat_x_1", None]), r.choice(["a", "b", "c", "é", "é", " d ", "", None])) for _ in range(60)]
    frame = spark.createDataFrame([(*m, None) for m in mentions], "source_id string, concept_ref string, surface string, content_status string")
    got, refused, touched = objects.built_concepts(spark.createDataFrame(base, f"concept_id string, name string, aliases array<string>, provenance {objects.PROVENANCE}"), frame, "x")
    want, no = concepts_by_force(base, mentions, "x")
    assert sorted((c.concept_id, c.name, list(c.aliases or []), [p.source_id for p in c.provenance]) for c in got.collect()) == want
    assert {tuple(x) for x in refused.collect()} == no
    assert {x.object_id for x in touched.collect()} <= {"co_x_1", "co_x_2"}
    assert objects.built_concepts(spark.createDataFrame([], f"concept_id string, name string, aliases array<string>, provenance {objects.PROVENANCE}"), frame.limit(0), "x")[0].count() == 0


def test_patterns_are_attached_numbered_and_refused(spark):
    base = spark.createDataFrame([("pat_x_000001", ["a1"], [("s1", "h", "m")]), ("pat_x_000003", None, None)], f"pattern_id string, assertion_ids array<string>, provenance {objects.PROVENANCE}")
    rows_ = [
        ("s2", None, "pat_x_000001", True, ["a2", "a1"], "t", None, None), ("s1", None, "pat_x_000001", True, ["a3"], "u", None, None), ("s2", None, "pat_x_000003", True, ["a4"], "v", None, "admit_new"),
        ("s2", None, "pat_x_000007", True, ["a5"], "w", None, "admit_new"), ("s2", None, "pat_x_000009", True, ["a6"], "w", None, None), ("s2", "k2", None, True, ["b2"], "w", None, None), ("s1", "k9", None, True, ["b1"], "w", None, None),
        ("s2", "k1", None, True, ["b3"], "w", None, None), ("s2", "k0", None, False, ["b4"], "w", None, None), ("s2", "k3", None, None, ["b5"], "w", None, None), ("s3", "k3", None, True, ["b6"], "w", None, None),
    ]
    candidates = spark.createDataFrame(rows_, "source_id string, candidate_key string, pattern_id string, approved boolean, assertion_ids array<string>, content string, content_status string, choice string")
    got, refused, new, touched = objects.built_patterns(base, candidates, spark.createDataFrame([("pat_x_000009",), ("pat_x_000005",)], "pattern_id string"), "x", 2)
    assert rows(new, "pattern_id") == [("s1", "k9", "pat_x_000004"), ("s2", "k1", "pat_x_000006"), ("s2", "k2", "pat_x_000008"), ("s3", "k3", "pat_x_000010")]
    assert {(p.pattern_id, tuple(p.assertion_ids or ()), tuple(e.source_id for e in p.provenance)) for p in got.collect()} == {
        ("pat_x_000001", ("a1", "a2", "a3"), ("s1", "s2")), ("pat_x_000003", (), ()), ("pat_x_000004", ("b1",), ("s1",)), ("pat_x_000006", ("b3",), ("s2",)), ("pat_x_000007", ("a5",), ("s2",)), ("pat_x_000008", ("b2",), ("s2",)), ("pat_x_000010", ("b6",), ("s3",)),
    }
    assert rows(refused, "pattern_id") == [("s2", "pat_x_000003", "occupied"), ("s2", "pat_x_000009", "retired")] and rows(touched) == [("pat_x_000001",)]


def test_free_numbers_skip_used_ones(spark):
    r = random.Random(3)
    used = [(g, n) for g in "ab" for n in r.sample(range(-3, 40), 20)] + [("c", 1)]
    asked = spark.createDataFrame([(g, i) for g in "abd" for i in range(30)], "g string, i int")
    got = objects.free_numbers(asked, spark.createDataFrame(used, "g string, number long"), "g", ["i"], 2).collect()
    for g in "abd":
        free = [n for n in range(2, 100) if (g, n) not in used]
        assert [x.number for x in sorted((x for x in got if x.g == g), key=lambda x: x.i)] == free[:30]


def test_rounds_wait_for_people_and_dependencies(spark):
    schema = "proposal_key string, resolution string, depends_on array<string>"
    frame = lambda *xs: spark.createDataFrame(list(xs), schema)
    done = spark.createDataFrame([("d",)], "proposal_key string")
    assert objects.proposal_rounds(lambda r: frame(("a", "auto", None), ("d", "human", [])), done).status == "converged"
    assert objects.proposal_rounds(lambda r: frame(("a", "human", []), ("b", "blocked", ["d"])), done).status == "awaiting_human"
    assert objects.proposal_rounds(lambda r: frame(("b", "blocked", ["x", "d"])), done).status == "awaiting_human"
    ended = objects.proposal_rounds(lambda r: frame(("b", "blocked", ["d"])), done)
    assert (ended.status, ended.log) == ("unchanged", [(1, 1, 1, 1), (2, 1, 1, 1)])
    assert objects.proposal_rounds(lambda r: frame((f"b{r}", "blocked", ["d"])), done, 4).log[-1] == (4, 1, 1, 1)
