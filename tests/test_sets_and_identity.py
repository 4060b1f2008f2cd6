"""Set joins, closures, pages, identities and trees against plain versions."""

from __future__ import annotations

import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lectern.operators import closure, identity, pages, similar


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.mark.parametrize("least", [1, 2, 4])
def test_shared_items_equal_brute_force(spark, least):
    r = random.Random(least)
    sets = {g: {"hot", *r.sample("abcdefghijkl", r.randrange(0, 6))} for g in range(40)}
    given = [(g, i) for g, s in sets.items() for i in s] * 2 + [(None, "a"), (3, None)]
    got = rows(similar.shared_items(spark.createDataFrame(given, "g long, i string"), "g", "i", least))
    want = [(a, b, n) for a in sets for b in sets if a < b and (n := len(sets[a] & sets[b])) >= least]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("least", [0.3, 0.6, 1.0])
def test_similar_sets_equal_brute_force(spark, least):
    r = random.Random(9)
    side = lambda n: [(r.choice(["x", "y", None]), None if r.random() < 0.1 else [*r.sample("abcdefgh", r.randrange(0, 8)), None, "h"][: r.randrange(0, 10)]) for _ in range(n)]
    a, b = side(60), side(60)
    got = rows(similar.similar_sets(spark.createDataFrame(a, "s string, v array<string>"), spark.createDataFrame(b, "s string, v array<string>"), "s", "v", least))
    plain = lambda v: tuple(sorted({x for x in v or [] if x is not None}))
    want = {(s, plain(u), plain(v)) for s, u in a for t, v in b if s is not None and s == t and plain(u) and plain(v) and len(set(plain(u)) & set(plain(v))) / len(set(plain(u)) | set(plain(v))) >= least}
    assert {(s, tuple(u), tuple(v)) for s, u, v, _ in got} == want and len(got) == len(want)


def test_unmatched_drafts(spark):
    a = spark.createDataFrame([(1, "The cat sat"), (1, "dog"), (2, "..."), (None, "x")], "span long, t string")
    b = spark.createDataFrame([(1, "the CAT, sat!"), (1, "zebra"), (2, "..."), (2, ""), (3, "dog"), (1, "zebra"), (None, "x"), (1, None)], "span long, t string")
    assert sorted(rows(similar.unmatched(a, b, "span", "t")), key=repr) == sorted([(1, "zebra"), (1, "zebra"), (2, "..."), (2, ""), (3, "dog"), (None, "x"), (1, None)], key=repr)


def reach_by_force(seeds, edges, groups):
    order = {r: i for i, r in enumerate(closure.SEED_RULES)}
    near = defaultdict(set)
    for a, b in edges:
        if a and b:
            near[a].add((b, 0)), near[b].add((a, 0))
    of = defaultdict(set)
    for g, m in groups:
        if g and m:
            of[g].add(m)
    for members in of.values():
        for a in members:
            near[a] |= {(b, 1) for b in members if a != b}
    done = {}
    for n, r in seeds:
        if n and (n not in done or order[r] < order[done[n][0]]):
            done[n] = (r, 0, None)
    front, depth = dict(done), 0
    while front:
        depth += 1
        best = {}
        for n, (r, *_) in front.items():
            for m, way in near[n]:
                if m not in done and (m not in best or (order[r], way) < best[m]):
                    best[m] = (order[r], way)
        front = {m: (closure.SEED_RULES[o], depth, ("edge", "group")[way]) for m, (o, way) in best.items()}
        done |= front
    return sorted((n, *v) for n, v in done.items())


def test_traced_reach_equals_brute_force(spark):
    for seed in range(3):
        r = random.Random(seed)
        nodes = [f"n{i}" for i in range(60)]
        edges = [(r.choice(nodes), r.choice(nodes)) for _ in range(25)] + [(None, "n1"), ("n2", None)]
        groups = [(f"g{r.randrange(8)}", r.choice(nodes)) for _ in range(25)] + [(None, "n3"), ("g1", None)]
        seeds = [(r.choice(nodes), r.choice(closure.SEED_RULES)) for _ in range(5)] + [(None, "target")]
        got = closure.traced_reach(spark.createDataFrame(seeds, "node string, rule string"), spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame(groups, "group_id string, member string"))
        assert rows(got, "node") == reach_by_force(seeds, edges, groups)


def test_intervals_that_reach_far_keep_a_band(spark):
    boxes = spark.createDataFrame([("p", 1, 0, 100), ("p", 2, 10, 20), ("p", 3, 90, 110), ("p", 4, 150, 160), ("p", 5, None, 9), ("q", 6, 5, 6)], "page string, id int, a int, b int")
    assert rows(pages.interval_clusters(boxes, ["page"], "a", "b", 40, "id").select("id", "cluster"), "id") == [(1, 0), (2, 0), (3, 0), (4, 1), (5, None), (6, 0)]
    order = pages.banded_order(boxes.withColumn("x", F.col("id") * 100).withColumn("y", F.col("a")), "page", "a", "b", "x", "y", "id")
    assert rows(order.where("page = 'p'").select("id", "band", "column", "place"), "place") == [(3, 0, 0, 1), (2, 0, 1, 2), (1, 0, 2, 3), (4, 1, 0, 4), (5, None, None, 5)]


def test_maps_over_releases(spark):
    maps = [("1", "a", "b"), ("1", "a", "b"), ("1", "c", "d"), ("1", "c", "e"), ("1", "f", None), ("2", "b", "a"), ("2", "g", "h"), ("2", "i", "h"), ("2", "j", None), ("2", "j", "k"), ("3", "x", "y")]
    got = identity.remapped(spark.createDataFrame([(x,) for x in "abcfghijz"], "id string"), spark.createDataFrame(maps, "release string, from_id string, to_id string"), ["1", "2"])
    assert rows(got, "id") == [("a", "a", "moved", None), ("b", "a", "moved", None), ("c", None, "split", "1"), ("f", None, "lost", "1"), ("g", "h", "moved", None), ("h", "h", "kept", None), ("i", "h", "moved", None), ("j", None, "split", "2"), ("z", "z", "kept", None)]


def test_trees_differ_by_path(spark):
    one = {"a": {"b": [1, {"c": "x", "run_id": 1}], "e": {}}, "t_at": 3, "n": None}
    two = json.loads(json.dumps(one).replace('"x"', '"y"').replace('"run_id": 1', '"run_id": 9')) | {"t_at": 4, "z": [0]}
    frame = lambda *xs: spark.createDataFrame([(k, v) for k, v in xs], "k string, v string")
    left = frame(("same", json.dumps(one)), ("diff", json.dumps(one)), ("gone", "{}"), ("bad", "{"), ("null", None))
    right = frame(("same", json.dumps({k: one[k] for k in reversed(one)})), ("diff", json.dumps(two)), ("new", "{}"), ("bad", "{}"), ("null", None))
    got = rows(identity.substitution_report(left, right, "k", "v"), "k", "path")
    assert got == [("bad", "", None, "{}", "right_only"), ("bad", "!", "{", None, "left_only"), ("diff", "a.b[1].c", '"x"', '"y"', "changed"), ("diff", "z[0]", None, "0", "right_only"), ("gone", "$", None, None, "left_only"), ("new", "$", None, None, "right_only")]
