"""Declared sources, units, rules and dictionaries on broken files; bundles that are torn, repeated, contested and migrated; manifests."""

from __future__ import annotations

import glob
import hashlib
import json
import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lectern.operators import bundles
from lectern.sources import declared

GOOD = {
    "source_id": "s1", "work_title": "w", "edition_note": "", "technique_id": "t", "rights_status": "r", "release_policy": "p", "edition_part": {"artifact_id": "a", "label": "l", "pages": ["1"]},
    "source_site": "x", "source_url": "https://x", "file_sha256": "a" * 64, "pages": ["p1", "p-2"],
}


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text if isinstance(text, str) else json.dumps(text, ensure_ascii=False))


def test_declarations_from_files(spark, tmp_path):
    part = GOOD["edition_part"]
    cases = {
        "good": (GOOD, None), "commit": ({**GOOD, "repo_commit": None, "yaml_metadata": {"a": 1}}, None), "list": ([1], "no_object"), "torn": ('{"source_id":', "no_object"), "blank_file": (" ", "no_object"), "twice": ('{"pages":1,"pages":2}', "no_object"),
        "missing": ({k: v for k, v in GOOD.items() if k not in ("pages", "file_sha256")}, "missing:file_sha256,pages"), "extra": ({**GOOD, "zz": 1}, "extra:zz"), "number": ({**GOOD, "source_id": 5}, "source_id"), "blank": ({**GOOD, "work_title": " \t　"}, "work_title"),
        "note": ({**GOOD, "edition_note": None}, "edition_note"), "url": ({**GOOD, "source_url": "ftp://x"}, "source_url"), "hash": ({**GOOD, "file_sha256": "A" * 64}, "file_sha256"), "no_pages": ({**GOOD, "pages": []}, "pages"), "page": ({**GOOD, "pages": ["p 1"]}, "pages"),
        "page_number": ({**GOOD, "pages": [1]}, "pages"), "page_twice": ({**GOOD, "pages": ["p", "p"]}, "pages"), "part": ({**GOOD, "edition_part": {**part, "more": 1}}, "edition_part"), "part_pages": ({**GOOD, "edition_part": {**part, "pages": "1"}}, "edition_part"), "sha": ({**GOOD, "repo_commit": 7}, "repo_commit"),
    }
    put(tmp_path, "d/of_no_bytes.json", "")  # Spark's scans don't see it
    for name, (value, _) in cases.items():
        put(tmp_path, f"d/{name}.json", value)
    found = declared.read_declarations(spark, str(tmp_path))
    got = {os.path.basename(p)[:-5]: (c, x) for p, c, x in rows(found.select("path", "code", "problem"))}
    early = lambda p: p == "no_object" or p.startswith("missing")
    assert got == {name: (None if p is None else "SCH_001" if early(p) else "SCH_002", p) for name, (_, p) in cases.items()}
    one = found.where(F.endswith("path", F.lit("commit.json"))).first()
    assert (one["source_id"], one["pages"], one["edition_part"].asDict(), one["yaml_metadata"]) == ("s1", ["p1", "p-2"], part, '{"a":1}')


def test_units_are_skipped_with_their_reason(spark, tmp_path):
    sound = {"unit.json": {"unit_id": "ku_1"}, "provenance.json": {"a": 1}, "assertions.json": [{"span_ids": ["b", "a"]}, {"span_ids": ["a", "c", 3]}, {}, 5]}
    for unit in ("ku_1", "ku_2", "ku_3", "ku_4", "ku_5", "other"):
        for name, value in sound.items():
            put(tmp_path, f"{unit}/{name}", {"unit_id": unit} if name == "unit.json" and unit != "ku_2" else value)
    put(tmp_path, "ku_3/unit.json", "{")
    put(tmp_path, "ku_4/unit.yaml", "unit_id: ku_4")
    put(tmp_path, "ku_5/assertions.json", {"a": 1})
    put(tmp_path, "ku_6/unit.json", {"unit_id": "ku_6"})
    put(tmp_path, "ku_1/notes.txt", "x")
    got = {u: (s, p) for u, s, p in rows(declared.read_units(spark, str(tmp_path)).select("unit_id", "span_ids", "problem"))}
    assert got == {"ku_1": (["b", "a", "c"], None), "ku_2": (["b", "a", "c"], "identity"), "ku_3": (["b", "a", "c"], "unparsable:unit"), "ku_4": (["b", "a", "c"], "twice:unit"), "ku_5": (None, "assertions"), "ku_6": (None, "missing:provenance,missing:assertions")}


def test_rules_with_errors_by_record(spark, tmp_path):
    put(tmp_path, "a.json", [{"id": "1", "name": "n", "jiXiong": "大吉", "geJuType": "富", "conditions": {"b": [1]}}, 5, {"id": "2"}, {"name": "x"}, {"id": "3", "name": "m", "className": 4}, {"id": "1", "name": "again"}, None])
    put(tmp_path, "b.json", [{"id": "1", "name": "third"}, {"id": "4", "name": "k", "jiXiong": "?", "books": "B", "conditions": None}, {"id": "5", "name": "known"}])
    put(tmp_path, "c.json", "{}")
    put(tmp_path, "d.json", "not JSON")
    put(tmp_path, "e.json", [])
    records = declared.read_rules(spark, str(tmp_path))
    assert Counter(x for (x,) in rows(records.select("problem"))) == {None: 5, "record": 2, "name": 1, "id": 1, "className": 1, "file": 2}
    new = declared.imported_rules(records, spark.createDataFrame([("5",), ("5",)], "pattern_id string"))
    assert rows(new.select("pattern_id", "name", "luck", "kind", "school", "conditions"), "pattern_id") == [("1", "n", "大吉", "富", declared.NO_SCHOOL, '{"b":[1]}'), ("4", "k", "平", "贵", "B", None)]
    assert declared.import_counts(records, new).first().asDict() == {"n_records": 10, "n_imported": 2, "n_skipped": 3, "n_errors": 5, "n_files_broken": 2, "n_category": 1, "n_school": 2}


def test_characters(spark, tmp_path):
    put(tmp_path, "Unihan_Readings.txt", "# x\n\nU+4E00\tkMandarin\tyi\nU+4E01\tkTotalStrokes\t2 3\nbad\tline\nU+D800\ta\tb\nzz\ta\tb\n20000\tkDefinition\tfar\nU+4E00\tkMandarin\tya\n")
    put(tmp_path, "more.json", {"丁": {"kRSUnicode": "1.1"}, "U+4E00": {"kDefinition": "one"}})
    put(tmp_path, "Other.txt", "U+4E00\tkMandarin\tno")
    fields = declared.read_characters(spark, str(tmp_path))
    chars = spark.createDataFrame([("一", "x", "own"), ("丁", "y", None), ("𠀀", None, None), ("q", None, "q!"), (None, None, None)], "char string, note string, reading string")
    got = {r["char"]: tuple(r)[1:] for r in declared.looked_up(chars, fields, own=("reading",)).collect()}
    assert got == {"一": ("x", "U+4E00", None, None, "yi", "one"), "丁": ("y", "U+4E01", "1.1", "2", None, None), "𠀀": (None, "U+20000", None, None, None, "far"), "q": (None, "U+0071", None, None, "q!", None), None: (None,) * 6}


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "bundles")
    bundles.commit_bundle(path, "r1", {"a": spark.range(1000).withColumn("m", F.create_map(F.lit("k"), "id")), "none": spark.createDataFrame([], "x int, y array<double>")})
    return path


def test_bundles_come_back_with_the_manifests_hashes(spark, root):
    packs = bundles.open_bundle(spark, root, "r1")
    assert {k: v.count() for k, v in packs.items()} == {"a": 1000, "none": 0} and packs["none"].dtypes == [("x", "int"), ("y", "array<double>")]
    manifest = bundles.manifests(spark, root).first()
    assert {p["pack"]: (p["n"], p["sha256"]) for p in manifest["packs"]} == {k: tuple(bundles.rows_digest(v).first()) for k, v in packs.items()}
    assert manifest["canonical_hash"] == bundles.canonical_hash(manifest["packs"]) and bundles.unfinished_attempts(spark, root).count() == 0
    # Equal contents in another order change nothing; others are refused, and leave an attempt.
    again = {"none": packs["none"], "a": packs["a"].orderBy(F.desc("id")).repartition(7)}
    assert bundles.commit_bundle(root, "r1", again) == manifest["canonical_hash"]
    with pytest.raises(bundles.BundleRefused, match="other contents"):
        bundles.commit_bundle(root, "r1", {"a": packs["a"].limit(999), "none": packs["none"]})
    assert bundles.manifests(spark, root).count() == 1 and bundles.unfinished_attempts(spark, root).count() == 2
    for name in ("../r9", "", "a/b"):
        with pytest.raises(bundles.BundleRefused):
            bundles.commit_bundle(root, name, again)


def test_torn_bundles_are_refused(spark, root):
    folder = f"{root}/{bundles.manifests(spark, root).first()['packs'][0]['folder']}"
    whole = [tuple(r) for r in spark.read.parquet(folder).collect()]
    write = lambda data: spark.createDataFrame(data, "id long, m map<string,long>").write.mode("overwrite").parquet(folder)
    write(whole[:-1] + [(5, {"k": 6})])
    assert bundles.bundle_problems(spark, root, "r1") == [("a", "digest_differs")]
    with pytest.raises(bundles.BundleRefused, match="torn"):
        bundles.open_bundle(spark, root, "r1")
    write(whole[:-1])
    assert bundles.bundle_problems(spark, root, "r1") == [("a", "rows_differ")]
    spark.createDataFrame([(str(i),) for i in range(1000)], "id string").write.mode("overwrite").parquet(folder)
    assert bundles.bundle_problems(spark, root, "r1") == [("a", "columns_differ")]
    for file in glob.glob(f"{folder}/*.parquet"):
        os.remove(file)
    assert bundles.bundle_problems(spark, root, "r1") == [("a", "missing")]
    write(whole)
    assert bundles.bundle_problems(spark, root, "r1") == []
    with pytest.raises(bundles.BundleRefused, match="no release"):
        bundles.open_bundle(spark, root, "r2")
    # A second writer's manifest with other contents makes the release contested.
    other = bundles.manifests(spark, root).withColumn("canonical_hash", F.lit("0"))
    other.coalesce(1).write.mode("append").json(f"{root}/manifests")
    with pytest.raises(bundles.BundleRefused, match="contested"):
        bundles.open_bundle(spark, root, "r1")


def test_migration_recodes_and_carries_the_rest(spark, root):
    recode = lambda df: bundles.recoded(df, {"id": F.col("id") + 1, "half": (F.col("id") / 2).cast("long")}, drop=["m"])
    bundles.migrate_bundle(spark, root, "r1", "r2", {"a": recode})
    packs = bundles.open_bundle(spark, root, "r2")
    assert sorted(rows(packs["a"])) == [(i + 1, i // 2) for i in range(1000)]
    named = {m["release_id"]: {p["pack"]: p["folder"] for p in m["packs"]} for m in bundles.manifests(spark, root).collect()}
    assert named["r1"]["none"] == named["r2"]["none"] and named["r1"]["a"] != named["r2"]["a"]
    with pytest.raises(bundles.BundleRefused, match="number of rows"):
        bundles.migrate_bundle(spark, root, "r1", "r3", {"a": lambda df: df.where("id > 3")})
    with pytest.raises(bundles.BundleRefused, match="no packs"):
        bundles.migrate_bundle(spark, root, "r1", "r3", {"zz": recode})


def test_tree_digests_ignore_order_and_see_every_item(spark):
    items = [("g", f"k{i}", f"d{i}") for i in range(3000)] + [("h", "k", None), (None, "k", "d")]
    digest = lambda given: {g: (n, h) for g, n, h in rows(bundles.tree_digests(spark.createDataFrame(given, "g string, k string, d string"), "g", "k", "d"))}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def plain(pairs):
        level, width = defaultdict(list), 4
        for k, d in pairs:
            h = sha(f"{k}:{d or ''}")
            level[h[:4]].append(h)
        for width in (2, 0, 0):
            up = defaultdict(list)
            for at, hs in level.items():
                up[at[:width]].append(sha("".join(sorted(hs))))
            level = up
        return level[""][0]

    got = digest(items)
    assert got == digest(items[::-1]) and got["g"] == (3000, plain([(k, d) for g, k, d in items if g == "g"])) and got["h"] == (1, plain([("k", None)]))
    assert digest(items[1:])["g"][1] != got["g"][1] != digest([("g", "k0", "dx"), *items[1:]])["g"][1]
