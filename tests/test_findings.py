"""Cases that queries met at larger sizes: joins that grow faster than their input, rows that travel, SQL that left ties to chance."""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from itertools import combinations, product

from pyspark.sql import functions as F

from lectern.operators import bundles, closure, cover, identity, layout, products, recon, records, resolution, similar, spans
from lectern.operators.graph import kept
from lectern.plans import catalog
from lectern.sources import files


def nodes(plan):
    """The nodes of a plan that has run."""
    yield plan
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        below = [plan.executedPlan()]
    elif name.endswith("QueryStageExec"):
        below = [plan.plan()]
    else:
        children = plan.children()
        below = [children.apply(i) for i in range(children.size())]
    for p in below:
        yield from nodes(p)


def ran(df, kind):
    """The result, and the rows that each node of a kind made."""
    got = [tuple(r) for r in df.collect()]
    return got, [n.metrics().apply("numOutputRows").value() for n in nodes(df._jdf.queryExecution().executedPlan()) if kind in n.nodeName() and n.metrics().contains("numOutputRows")]


def test_sets_that_share_one_item_do_not_meet(spark):
    """before, each two of the sixty sets that share any item met."""
    rng = random.Random(4)
    given = {g: set(rng.sample(range(60), 3)) for g in range(600)} | {1000: set(range(40)), 1001: set(range(20, 60)), 1002: set(range(3))}
    shared = Counter(p for i in range(60) for p in combinations(sorted(g for g, x in given.items() if i in x), 2))
    got, _ = ran(similar.shared_items(spark.createDataFrame([(g, i) for g, x in given.items() for i in x], "g long, i long"), "g", "i", 2), "Join")
    assert sorted(got) == sorted((*p, n) for p, n in shared.items() if n >= 2)
    small = {g: x for g, x in given.items() if g < 1000}
    got, made = ran(similar.shared_items(spark.createDataFrame([(g, i) for g, x in small.items() for i in x], "g long, i long"), "g", "i", 2), "Join")
    assert max(made) < 3 * len(got) + 2 * 1800 < sum(1 for p in shared if p[1] < 1000)


def test_generated_points_are_not_broadcast(spark):
    """points made by an explode look few to a plan."""
    points = spark.range(20).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(11)))).select("id", F.cos("i").alias("x"), F.sin("i").alias("y"))
    circles = layout.circle_fit(points, "id", "x", "y")
    got, made = ran(circles.select("id", F.round("radius", 6)), "Broadcast")
    assert sorted(got) == [(i, 1.0) for i in range(20)] and not made
    assert "Broadcast" not in circles._jdf.queryExecution().executedPlan().toString()


def test_first_spans_settle_the_usual_terms(spark, monkeypatch):
    """before, every span sent its runs of all terms."""
    monkeypatch.setattr(products, "FIRST", 3)
    texts = ["the cat", "a dog sits", "the dog runs", *(f"the cat and dog {i} sit" for i in range(300)), "Ümläut 😀x the rarest"]
    spans = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc long, text string")
    terms = ["cat", "THE", "dog sits", "sits", "rarest", "😀x", "ümläut", "99 s", "nowhere", "t", "", None, "cat and dog"]
    looked = []
    monkeypatch.setattr(products, "_first_held", lambda wanted, known, find=products._first_held: looked.append((sorted(r[0] for r in wanted.collect()), known.count())) or find(wanted, known))
    got = {tuple(r) for r in products.first_holder(spark.createDataFrame([(t,) for t in terms], "term string"), spans, "term", "doc", "doc", "text").collect()}
    assert got == {(t, next(i for i, x in enumerate(texts) if t.lower() in x.lower())) for t in terms if t and t != "nowhere"}
    assert [n for _, n in looked] == [3, len(texts)] and looked[1][0] == sorted(["rarest", "😀x", "ümläut", "99 s", "nowhere", "cat and dog"])


def test_only_pages_with_something_twice_are_dealt_out(spark, monkeypatch):
    """before, every character of every page was shuffled."""
    rng, schema = random.Random(3), "book string, page long, width int, height int, chars array<struct<id:string,char:string,orig_char:string,status:string,is_rare:boolean,rare_reason:string>>"
    some = lambda: [(str(rng.randrange(6)), rng.choice(["a", "b", "", None]), rng.choice(["c", "", None]), "ok", rng.choice([True, False, None]), "x") for _ in range(4)]
    odd = [("b", rng.choice([*range(20), None]), 1, 1, rng.choice([some(), some(), None])) for _ in range(40)]
    plain = [("b", 100 + i, 1, 1, [(str(j), rng.choice("abé"), "z", "ok", j % 10 == 0, "x") for j in range(100)]) for i in range(50)]
    for rows, told in ((plain + odd, 100), (plain + odd, 0), (plain, 100)):
        monkeypatch.setattr(bundles, "TOLD", told)
        best = {}
        key = lambda v: tuple((x is not None, x) for x in v)
        for book, page, _, _, chars in rows:
            for i, char, orig, status, is_rare, why in chars or []:
                best[page, i] = max(best.get((page, i), (book, char, orig, status, is_rare or False, why)), (book, char, orig, status, is_rare or False, why), key=key)
        found = bundles.page_tables(spark.createDataFrame(rows, schema))
        assert sorted(found["characters"].select("page", "char_id", "book", "char", "orig_char", "status", "is_rare", "rare_reason").collect(), key=repr) == sorted(((p, i, *v) for (p, i), v in best.items()), key=repr)
        want = Counter(v[1] or v[2] for v in best.values() if v[4] and (v[1] or v[2]))
        got, _ = ran(found["rare"], "Join")
        assert dict(got) == dict(want)
    assert sum(n.metrics().apply("shuffleRecordsWritten").value() for n in nodes(found["rare"]._jdf.queryExecution().executedPlan()) if n.metrics().contains("shuffleRecordsWritten")) < 500


def test_partners_travel_as_lists(spark):
    """before, each two candidates of a key were a row of a join."""
    rng = random.Random(5)
    given = [(i, ["all", f"m{i % 3}", None]) for i in range(200)] + [(300, ["alone"]), (301, []), (302, None), (None, ["all"]), (5, ["alone", "x"])]
    rng.shuffle(given)
    keys = {}
    for i, ks in given:
        keys.setdefault(i, set()).update(k for k in ks or [] if k)
    want = {i: sorted(j for j in keys if j is not None and j != i and keys[i] & keys[j]) for i in keys if i is not None}
    got, made = ran(resolution.batch_partners(spark.createDataFrame(given, "k long, ks array<string>"), "k", "ks"), "Join")
    assert dict(got) == {i: x for i, x in want.items() if x} and max(made) < 1000


def test_equal_drafts_are_paired_many_at_once(spark):
    """before, each set of spans was a call of Python of its own."""
    a = [(f"a{i}", [f"s{i // 2}"], "red fox" if i % 2 else "blue whale") for i in range(8)] + [("a8", ["t"], "one"), ("a9", [], "none")]
    b = [(f"b{i}", [f"s{i // 2}"], "blue whales" if i % 2 else "red foxes") for i in range(8)] + [("b8", ["t"], None)]
    sides = [spark.createDataFrame(x, "id string, spans array<string>, body string") for x in (a, b)]
    found = resolution.compared_drafts(*sides, "id", "spans", "body")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([*((f"a{i}", f"b{i ^ 1}", "paired") for i in range(8)), ("a8", "b8", "paired"), ("a9", None, "a_only")], key=repr)
    assert [n.nodeName() for n in nodes(found._jdf.queryExecution().executedPlan()) if "FlatMapGroupsInPandas" in n.nodeName() and "component" not in n.toString()] == []


def test_matches_by_any_rule_are_counted_by_class(spark):
    """before, each two rows that agree became a row, forty thousand here."""
    rng = random.Random(6)
    draw = lambda n: [(i, rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice("xyz")) for i in range(n)]
    left, right = draw(200), draw(250)
    sides = [spark.createDataFrame(x, "id long, a string, b long, c string") for x in (left, right)]
    got, made = ran(recon.linked_classes(*sides, "id", "id", [("a", "a"), ("b", "b"), ("c", "c")]), "Join")
    first = lambda x, y: next((k - 1 for k in (1, 2, 3) if x[k] is not None and x[k] == y[k]), None)
    want = []
    for side, rows, others in (("left", left, right), ("right", right, left)):
        for x in rows:
            links = Counter(first(x, y) for y in others)
            want.append((side, x[0], min(y[0] for y in rows if y[1:] == x[1:]), *x[1:], links[0], links[1], links[2]))
    assert sorted(got, key=repr) == sorted(want, key=repr) and max(made) <= 250


def test_equal_boxes_are_paired_once(spark):
    """before, each line and glyph of equal boxes was a pair of its own, thousands here."""
    lines = [(i, i % 2, (10.0 * (i % 3), 0.0, 30.0, 20.0)) for i in range(90)]
    glyphs = [(1000 + i % 399, i % 2, (float(i % 40), 1.0, 8.0, 8.0)) for i in range(400)] + [(5000, 7, (1.0, 1.0, 8.0, 8.0)), (1000, 0, (900.0, 1.0, 8.0, 8.0)), (1002, 0, (9.0, 3.0, 8.0, 8.0)), (1002, 0, (31.0, 3.0, 8.0, 8.0))]
    box = "struct<x:double,y:double,w:double,h:double>"
    found, made = ran(layout.glyphs_in_lines(spark.createDataFrame(lines, f"line_id long, page long, box {box}"), spark.createDataFrame(glyphs, f"glyph_id long, page long, box {box}")), "Join")
    of_line, of_glyph = {}, {}
    for page, part, line, line_no, glyph, glyph_no, member in found:
        if part != "pair":
            (of_line if part == "line" else of_glyph).setdefault((page, line, line_no) if part == "line" else (page, glyph, glyph_no), []).append(member)
    got = {(r[0], x, y) for r in found if r[1] == "pair" for x in of_line[r[0], r[2], r[3]] for y in of_glyph[r[0], r[4], r[5]]}
    want = {(p, i, j) for i, p, a in lines for j, q, b in glyphs if p == q and b[0] >= a[0] - 2 and b[1] >= a[1] - 2 and b[0] + b[2] <= a[0] + a[2] + 2 and b[1] + b[3] <= a[1] + a[3] + 2}
    assert got == want and len(want) > 5000 and len(found) < 700 and max(made) <= 404


def test_trees_meet_once_by_key(spark):
    """before, every leaf was a row that both sides shuffled, sorted and joined."""
    tree = lambda i: '{"a": [%d, {"b": "x"}], "c": {"d": 1, "e": 2}}' % i
    left = [(i, tree(i)) for i in range(300)] + [(None, "{}"), (500, '{"a": 1}'), (500, '{"b": 1}'), (501, None), (502, "{}")]
    right = [(i, tree(i if i % 50 else -1)) for i in range(300)] + [(None, "{}"), (None, "[]"), (500, '{"a": 2}'), (500, '{"b": 1}'), (501, "3")]
    found = identity.substitution_report(spark.createDataFrame(left, "k long, v string"), spark.createDataFrame(right, "k long, v string"), "k", "v")
    got, made = ran(found, "Generate")
    want = [(i, "a[0]", str(i), "-1", "changed") for i in range(0, 300, 50)] + [(None, "$", None, None, "left_only"), (None, "$", None, None, "right_only"), (500, "a", "1", "2", "changed"), (501, "", None, "3", "right_only"), (502, "$", None, None, "left_only")]
    assert sorted(got, key=repr) == sorted(want, key=repr) and sum(made) == len(want)
    assert not [n for n in nodes(found._jdf.queryExecution().executedPlan()) if "Join" in n.nodeName()]


def test_sets_that_are_similar_are_no_rows(spark, monkeypatch):
    """F16: before, each two sets that begin with the same letter were a row of a join."""
    monkeypatch.setattr(similar, "PACK", 7)
    rng = random.Random(8)
    some = lambda n: [(rng.choice([1, 2, None]), rng.choice(["", "abc-", "x"]) + "".join(rng.sample("abcdefghijklm", rng.randrange(5)))) for _ in range(n)]
    a, b = some(200), [*some(200), (1, "zzz"), (1, None), (1, "!"), (3, "abc")]
    key = lambda t: {c for c in t or "" if c.isalpha()}
    want = [x for x in b if not any(s == x[0] is not None and key(t) & key(x[1]) and len(key(t) & key(x[1])) >= 0.6 * len(key(t) | key(x[1])) for s, t in a)]
    assert sorted(map(tuple, similar.unmatched(*(spark.createDataFrame(x, "s long, t string") for x in (a, b)), "s", "t").collect()), key=repr) == sorted(want, key=repr)
    sets = [spark.createDataFrame([(1, sorted("abcd" + c)) for c in letters], "scope long, set array<string>") for letters in ("efghijklmnopqrst", "uvwxyz")]
    got, made = ran(similar._met_sets(*sets, 0.6), "Join")
    assert len(got) == 6 and max(made) <= 16 * 5 < 6 * 16


def test_long_chains_leave_their_edges_behind(spark, monkeypatch):
    """before, each round read all edges and all nodes that were reached."""
    chains = [(f"{c}_{i}", f"{c}_{i + 1}") for c in range(30) for i in range(c % 10)]
    ends = [spark.createDataFrame([(f"{c}_0", "target") for c in range(30)], "node string, rule string"), spark.createDataFrame(chains, "src string, dst string")]
    saved, before = [], closure.kept
    monkeypatch.setattr(closure, "kept", lambda df: saved.append(before(df)) or saved[-1])
    got = {(r["node"], r["depth"]) for r in closure.traced_reach(*ends).collect()}
    assert got == {(f"{c}_{i}", i) for c in range(30) for i in range(c % 10 + 1)}
    left = [df.count() for df in saved if df.columns == ["src", "dst"]]
    assert left[0] == 2 * len(chains) and len(left) > 3 and left[-1] < len(chains) / 4


def test_spans_and_items_are_counted_together(spark):
    """before, all items of batches were joined, made different and counted, each in a shuffle of its own."""
    spans = spark.createDataFrame([(i,) for i in (1, 2, 2, 3, None)], "k long")
    batches = spark.createDataFrame([([1, 3, 3],), ([3, 9, 9, None],), ([None],)], "items array<long>")
    got, made = ran(records.bijection_problems(spans, batches, "k", "items"), "Join")
    assert sorted(got, key=repr) == sorted([(2, "in_no_batch"), (None, "in_no_batch"), (9, "no_span"), (None, "no_span"), (3, "in_several"), (9, "in_several"), (None, "in_several")], key=repr) and not made


def test_only_references_go_to_python(spark):
    """before, whole texts went to Python, ten thousand at once."""
    texts = ["a&amp;b", "&amp;amp;", "&ampx;&notit; &notin; &#65;&#x41;&#0;&#xD800; &nosuch; & &; &&amp;", "", "plain", "&copy", "&#", "😀&😀;&hearts;é", "&" + "a" * 40 + ";", "&#38;#65;$1\\1", "&NotEqualTilde;", None]
    found = files.with_html_text(spark.createDataFrame([(t,) for t in texts], "t string"), "t", "text")
    assert [r["text"] for r in found.collect()] == [t and re.sub(r"\s+", " ", html.unescape(t)).strip(" ") for t in texts]
    udf = next(n for n in nodes(found._jdf.queryExecution().executedPlan()) if "EvalPython" in n.nodeName())
    assert "regexp_extract_all" in udf.toString().split("\n")[0]


def test_only_doubted_spans_meet_whole_texts(spark, monkeypatch):
    """before, every span was joined with its whole text and read it from the start."""
    monkeypatch.setattr(spans, "PIECE", 8)
    texts = {1: "é😀" * 30, 2: "abcdefgh", 3: "", 4: None, 5: "x" * 40}
    rng, given = random.Random(2), []
    for i, t in texts.items():
        for _ in range(60):
            a = rng.randrange(0, 50)
            b = min(a + rng.randrange(0, 14), len(t or ""))
            given.append((i, a, max(a, b), (t or "")[a:b]))
    given += [(1, 3, 4, "z"), (1, 16, 40, "é😀" * 12), (1, 16, 40, "z"), (1, -1, 2, "é"), (1, 5, 3, ""), (2, 7, 9, "h"), (2, 8, 8, ""), (2, 8, 9, ""), (1, 1, 2, None), (1, None, 2, "a"), (9, 0, 1, "a"), (5, 0, 3, "xx"), (5, 0, 2, "xxx")]
    def why(i, a, b, s):
        t = texts.get(i)
        if t is None:
            return "no_text"
        if a is None or s is None:
            return None
        return "out_of_range" if a < 0 or b > len(t) or a > b else "text_differs" if t[a:b] != s else None
    docs, cut = spark.createDataFrame(list(texts.items()), "doc_id long, text string"), spark.createDataFrame(given, "doc_id long, start_offset int, end_offset int, segment string")
    got = [tuple(r) for r in spans.slices_hold(docs, cut).select("doc_id", "start_offset", "end_offset", "segment", "reason").collect()]
    assert sorted(got, key=repr) == sorted([(*g, why(*g)) for g in given if why(*g)], key=repr)
    text = "One sentence. " * 400
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    monkeypatch.setattr(spans, "PIECE", 64)
    found = spans.slices_hold(docs, kept(spans.segment_spans(docs)))
    assert found.collect() == []
    assert not [n for n in nodes(found._jdf.queryExecution().executedPlan()) if "Join" in n.nodeName() and "_at" not in n.toString().split("\n")[0] and n.metrics().contains("numOutputRows") and n.metrics().apply("numOutputRows").value()]


def test_characters_meet_near_findings_only(spark):
    """before, each character met all findings of its kind within four thousand characters, forty thousand pairs here."""
    parts = spark.createDataFrame([(1, 0, 0, "?a" * 200)], "doc_id long, span_id int, start_offset int, text string")
    patches = spark.createDataFrame([], "doc_id long, raw_start int, raw_end int, cleaned_start int, cleaned_end int")
    told = [(1, "replacement_char", "known_unresolvable", i, i + 1) for i in range(0, 400, 4)] + [(1, "replacement_char", "known_unresolvable", 100, 300)]
    count = lambda i: sum(a <= i < b for *_, a, b in told)
    got, made = ran(cover.forbidden_chars(parts, patches, spark.createDataFrame(told, "doc_id long, kind string, terminal_state string, raw_start int, raw_end int")).select("position", "n"), "Join")
    assert sorted(got) == [(i, count(i)) for i in range(0, 400, 2)] and max(made) < 500


def test_texts_meet_terms_where_they_are(spark, monkeypatch):
    """before, the different runs of four characters of every text were stored and shuffled, hundreds for each text."""
    monkeypatch.setattr(products, "FIRST", 5)
    monkeypatch.setattr(products, "STRETCH", 64, raising=False)
    rng = random.Random(11)
    texts = ["".join(rng.choices(["the", "an", "ß", "É", "o", " ", "😀", "\n", "queaux"], k=rng.choice([1, 9, 40, 400]))) for _ in range(150)]
    cuts = [(rng.choice(texts), rng.randrange(60), rng.choice([1, 2, 5, 7, 8, 9, 15, 16, 17, 31, 40, 64, 90, 200])) for _ in range(250)]
    terms = sorted({t[i : i + n] for t, i, n in cuts} | {t[i : i + n] + "x" for t, i, n in cuts} | {texts[-1], max(texts, key=len)})
    saved, before = [], products.kept
    monkeypatch.setattr(products, "kept", lambda df: saved.append(before(df)) or saved[-1])
    spans = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    got = dict(tuple(r) for r in products.first_holder(spark.createDataFrame([(t,) for t in terms], "term string"), spans, "term", "doc", "doc", "text").collect())
    want = {t: next(i for i, x in enumerate(texts) if t.lower() in x.lower()) for t in terms if t and any(t.lower() in x.lower() for x in texts)}
    assert got == want and 100 < len(want) < len(terms)
    assert max(df.count() for df in saved) <= len(terms)


def test_matches_by_any_rule_are_pairs_of_packs(spark, monkeypatch):
    """before, the query counted the links of classes and returned no pair."""
    monkeypatch.setattr(similar, "PACK", 7)
    rng = random.Random(12)
    draw = lambda n, of: [(of(i), rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice("xyz")) for i in range(n)]
    right, rules = draw(120, lambda i: i), [("a", "a"), ("b", "b"), ("c", "c")]
    for left in (draw(90, lambda i: i), [*draw(90, lambda i: i // 2), (None, "a", 1, "x")]):
        sides = [spark.createDataFrame(x, "id long, a string, b long, c string") for x in (left, right)]
        got, made = ran(recon.ranked_matches(*sides, "id", "id", rules), "Join")
        want = {}
        for x, y in product(left, right):
            rule = next((k - 1 for k in (1, 2, 3) if x[k] is not None and x[k] == y[k]), None)
            if rule is not None:
                want[x[0], y[0]] = min(rule, want.get((x[0], y[0]), 3))
        assert sorted(got, key=repr) == sorted(((*p, r) for p, r in want.items()), key=repr) and len(want) > 2500 and max(made) < 150
    pairs = catalog.QUERIES["disjunctive_match"](spark, "/root/testdata/sf0.001")
    assert pairs.columns == ["left_id", "right_id", "rule"] and {r["rule"] for r in pairs.collect()} == {0, 1}


def test_every_glyph_of_every_line_is_a_pair(spark, monkeypatch):
    """before, the query returned pairs of different boxes and who has them, and left the pairs of lines and glyphs to the reader."""
    monkeypatch.setattr(similar, "PACK", 7)
    box = "struct<x:double,y:double,w:double,h:double>"
    lines = [(i, i % 2, (10.0 * (i % 3), 0.0, 30.0, 20.0)) for i in range(60)] + [(70, None, (0.0, 0.0, 90.0, 90.0)), (71, 1, None), (72, 1, (-70.0, -70.0, 300.0, 200.0)), (None, 0, (0.0, 0.0, 30.0, 20.0))]
    glyphs = [(1000 + i, i % 2, (float(i % 40), 1.0, 8.0, 8.0)) for i in range(200)] + [(5000, 7, (1.0, 1.0, 8.0, 8.0)), (None, 1, (1.0, 1.0, 8.0, 8.0)), (6000, None, (1.0, 1.0, 8.0, 8.0)), (6001, 0, None)]
    again = [(5, 1, (0.0, 0.0, 30.0, 20.0)), (5, 1, (0.0, 0.0, 30.0, 20.0))], [(1000, 0, (3.0, 1.0, 8.0, 8.0)), (None, 1, (2.0, 1.0, 8.0, 8.0))]
    for some, others in ((lines, glyphs), (lines + again[0], glyphs + again[1])):
        got, made = ran(layout.boxed_glyphs(spark.createDataFrame(some, f"line_id long, page long, box {box}"), spark.createDataFrame(others, f"glyph_id long, page long, box {box}")), "Join")
        inside = lambda a, b: a and b and b[0] >= a[0] - 2 and b[1] >= a[1] - 2 and b[0] + b[2] <= a[0] + a[2] + 2 and b[1] + b[3] <= a[1] + a[3] + 2
        want = {(p, i, j) for i, p, a in some for j, q, b in others if p is not None and p == q and inside(a, b)}
        assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) > 3000 and max(made) < len(want) / 8
    assert catalog.QUERIES["glyphs_in_lines"](spark, "/root/testdata/sf0.001").columns == ["page", "line_id", "glyph_id"]
