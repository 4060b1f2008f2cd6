"""Chat formatting, collocations and whitening against plain versions, and at the edges."""

from __future__ import annotations

import hashlib
import os
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.llm import chat, phrases, queries, whitening

SF = "/root/testdata/sf0.001"
TRICKY = ["</s>", "<s>", "<\\s>", "<\\\\/s>", "[INST] x [/INST]", "[\\INST]", "<", "[", "\\", "<</s>", "[[/INST]", "", "a</s", "é𠀀</s>𠀀", "\n", "$1 \\1"]


def turns_frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests_by_force(rows):
    """What each conversation says, without any formatting."""
    talks = defaultdict(list)
    for c, t, role, text in rows:
        talks[c].append((t is not None, t or 0, role or "", text or ""))
    out = {}
    for c, said in talks.items():
        said.sort()
        loss = "".join(x for _, _, r, x in said if r == "assistant")
        out[c] = (len(said), sha("".join(f"{r}\n{x}\n" for _, _, r, x in said)), len(loss), sha(loss))
    return out


def test_chat_round_trip(spark):
    r = random.Random(5)
    rows = [(c, t, r.choice(["user", "assistant", "system", None, "a[/INST]b"]), r.choice([None, "plain", *TRICKY]) and "".join(r.choice(TRICKY) for _ in range(3))) for c in range(40) for t in range(r.randrange(1, 9))]
    rows += [(50, 0, "user", None), (51, 0, "assistant", "</s>"), (51, 0, "assistant", "</s>"), (52, None, "assistant", "x"), (52, 1, None, ""), (None, 3, "user", "q"), (None, 4, "assistant", "a")]
    frame = turns_frame(spark, rows).withColumn("full", F.lit("clash")).withColumn("place", F.lit(7)).withColumn("end", F.lit("clash"))
    examples = chat.training_examples(frame)
    got = {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in chat.conversation_digests(examples).collect()}
    assert got == digests_by_force(rows)
    # Every reply is one example, behind all turns before it; its span is the escaped reply, and the mark behind it closes the text.
    kept = examples.collect()
    assert sum(e.loss_end > e.loss_start for e in kept) == sum(role == "assistant" and bool(text) for _, _, role, text in rows)
    for e in kept:
        assert e.text[e.loss_end :] == chat.CLOSE and e.text.count(chat.CLOSE) == e.n_turns
    by_talk = defaultdict(list)
    for e in sorted(kept, key=lambda e: e.example):
        by_talk[e.conv_id].append(e)
    for several in by_talk.values():
        assert [e.example for e in several] == list(range(len(several))) and [e.last for e in several] == [False] * (len(several) - 1) + [True]
        assert all(b.text.startswith(a.text) for a, b in zip(several, several[1:], strict=False))
    assert chat.conversation_digests(chat.training_examples(frame.limit(0))).count() == 0


def test_chat_escapes_are_reversible(spark):
    r = random.Random(8)
    texts = TRICKY + ["".join(r.choice(["<", "[", "\\", "/", "s>", "INST]", "x"]) for _ in range(12)) for _ in range(400)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e")).select("t", "e", chat.unescaped(F.col("e")).alias("back")).collect()
    for row in rows:
        assert row.back == row.t
        assert not re.search(r"</?s>|\[/?INST\]", row.e)


@pytest.mark.parametrize("name", ["op11_chat", "op12_phrases"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "documents"):
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    if name not in queries.SQL:
        pytest.skip("no SQL")
    cursor = con.execute(queries.SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(map(tuple, queries.QUERIES[name](spark, SF).select(*columns).collect())) == sorted(cursor.fetchall())


def phrases_by_force(rows, least=10, share=50, top=2000):
    total, found = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    found[lang][words[i : i + k]] += 1
    out = []
    for lang, f in found.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in cand.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= share * f[q]}
        rows_ = []
        for p, a in cand.items():
            if len(p) == 2 and p in gone:
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(rows_)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def prose_rows(seed, n):
    r = random.Random(seed)
    words = ["Alpha", "beta", "É", "éTé", "x y", "𠀀", "the", "THE", "of", "Of", "\x0b", "q\x00z", *[f"w{i}" for i in range(30)]]
    rows = []
    for i in range(n):
        parts = [r.choice(words) + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for _ in range(r.randrange(60))]
        rows.append((r.choice(["", " ", "."]) + "".join(parts), r.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), ("   ", "en"), ("of the " * 5000, "en"), ("of the " * 20, None), ("rare", "xx")]


@pytest.mark.parametrize("chunk", [300, 4 << 20])
def test_phrases_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(phrases, "RANGE_KEYS", 2000)
    rows = prose_rows(4, 400)
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(5).withColumn("word", F.lit("clash")).withColumn("chunk", F.lit(1))
    for least, share, top in ((10, 50, 2000), (3, 90, 40)):
        got = phrases.collocations(frame, least, share, top)
        assert sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == phrases_by_force(rows, least, share, top)
    assert phrases.collocations(frame.limit(0)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, "en"), ("one two", "en")], "text string, lang string")).count() == 0


def test_radix_order_and_runs():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 5, (3000, 3)).astype(">u4") * np.uint32(70_000)
    order = phrases.radix_order(keys)
    assert [tuple(k) for k in keys[order].tolist()] == sorted(map(tuple, keys.tolist()))
    different, counts = phrases.run_counts(keys, np.ones(len(keys), np.int64))
    assert dict(zip(map(tuple, different.tolist()), counts.tolist(), strict=True)) == Counter(map(tuple, keys.tolist()))


def test_scores_pass_64_bits(spark):
    r = random.Random(6)
    cases = [(a, r.randrange(a, 10**15), r.randrange(a, 10**15)) for a in [1, 10, 10**9, 3 * 10**12, 10**15 - 1]]
    rows = spark.createDataFrame(cases, "a long, l long, r long").select("*", phrases.floor_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(x.s == 10**6 * x.a * x.a // (x.l * x.r) for x in rows)


def vectors(rng, n, d):
    spread = rng.standard_normal((d, d)) * (1 / (1 + np.arange(d)))
    return np.round((rng.standard_normal((n, d)) @ spread).astype(np.float32), 5)


def check_whitened(got, data, components=16):
    """Rows against numpy on the whole covariance."""
    kept = [(k, v) for k, v in data if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([np.floor(64 * np.array(v, np.float64)).astype(np.int64) + 1_000_000 for _, v in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.astype(object).sum(axis=0)
    mean = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums]) / n
    c = (fit - mean) - rest
    values, vecs = np.linalg.eigh(c.T @ c / n)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    trace = np.trace(c.T @ c / n)
    expected = ((x - mean) - rest) @ vecs / np.sqrt(values)
    rows = defaultdict(list)
    for r in got:
        rows[r.vec_id].append(r)
    assert sum(map(len, rows.values())) == len(kept) * len(values)
    signs = np.zeros(len(values))
    for i, (k, _) in enumerate(kept):
        mine = sorted(rows[k], key=lambda r: r.component)
        if len(mine) != len(values):
            continue  # a repeated id
        dev = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums, strict=True))
        for j, r in enumerate(mine):
            assert (r.component, r.n, int(r.deviation)) == (j + 1, n, dev)
            if not signs[j]:
                signs[j] = np.sign(r.whitened * expected[i, j])
            assert abs(r.whitened * signs[j] - expected[i, j]) < 1e-7
            assert abs(r.explained / (values[j] / trace) - 1) < 1e-9 and 0 <= r.identity_error < 1e-9


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(9)
    data = [(i, v.tolist()) for i, v in enumerate(vectors(rng, 400, 24))]
    data += [(400, data[0][1]), (400, data[1][1]), (None, data[2][1]), (401, None), (402, [float("nan")] * 24), (403, [None] * 24), (404, [float("inf")] + [0.0] * 23), (405, []), (406, [1.0] * 3)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("x", F.lit("clash")).withColumn("key", F.lit(1))
    check_whitened(whitening.whitened(frame).collect(), [d for d in data if d[0] != 406])
    few = [(i, v[:3]) for i, v in data[:50]]
    check_whitened(whitening.whitened(spark.createDataFrame(few, "vec_id long, embedding array<double>")).collect(), few)


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whitened(spark.createDataFrame(rows, schema)).count() == 0
    # Without variance in one dimension there is one component less.
    flat = whitening.whitened(spark.createDataFrame([(i, [float(i * i), float(i), 5.0]) for i in range(20)], schema)).collect()
    assert {r.component for r in flat} == {1, 2} and abs(sum(r.explained for r in flat if r.vec_id == 3) - 1) < 1e-12
    wide = whitening.whitened(spark.createDataFrame([(i, [i * 3.1e7, float(i % 3)]) for i in range(60)], "vec_id long, embedding array<double>"))
    assert wide.schema["deviation"].dataType.simpleString() == "decimal(38,0)" and wide.agg(F.max("deviation")).first()[0] > Decimal(1 << 63)


@pytest.mark.parametrize("case", ["flat", "equal", "restart", "small"])
def test_lanczos_finds_eigenpairs(case):
    rng = np.random.default_rng(2)
    d, wanted, block, limit = {"flat": (60, 16, 16, 512), "equal": (80, 8, 4, 512), "restart": (300, 5, 5, 40), "small": (6, 16, None, 512)}[case]
    values = {"flat": 60 + np.sort(rng.random(d))[::-1] * 5, "equal": np.append(np.full(6, 9.0), np.ones(d - 6)), "restart": 1000 * 0.9 ** np.arange(d), "small": np.arange(d, 0, -1.0)}[case]
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    matrix = (q * values) @ q.T
    got, vecs, took = whitening.block_lanczos(lambda b: matrix @ b, d, wanted, block, limit)
    k = min(wanted, d)
    assert np.allclose(got, values[:k], rtol=1e-12) and np.allclose(vecs.T @ vecs, np.eye(k), atol=1e-12)
    assert np.linalg.norm(matrix @ vecs - vecs * got, axis=0).max() < 1e-11 * values[0]
    assert case != "restart" or took["basis"] <= limit


def test_lanczos_says_when_it_does_not_settle():
    rng = np.random.default_rng(2)
    noise = rng.standard_normal((200, 200))
    with pytest.raises(ArithmeticError, match="after 2 passes"):
        whitening.block_lanczos(lambda b: noise @ (noise.T @ b), 200, 4, passes=2)


def test_matrix_columns_are_whole(spark):
    batch = pa.array([[1, 2], [3, 4]], pa.list_(pa.int64()))
    assert whitening._matrix(batch.slice(1)).tolist() == [[3, 4]]
