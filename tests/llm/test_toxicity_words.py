"""Words are learnt and looked up alike: sharp s, combining marks, digits."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from lectern.llm import toxicity


def test_folding_of_given_terms(spark):
    docs = spark.createDataFrame([(1, "du scheiße"), (2, "DU SCHEISSE"), (3, "größenwahn"), (4, "nichts"), (5, None)], "doc_id long, text string")
    got = {r.doc_id: r.features[0] for r in toxicity.with_features(docs, ["scheiße", "Größenwahn"], []).collect()}
    assert got[1] > 0 and got[2] > 0 and got[3] > 0 and got[4] == got[5] == 0


def test_learnt_terms_hit_their_texts(spark):
    r = random.Random(4)
    plain = [f"w{i}x" for i in range(60)]
    odd = ["straßenköter", "évilé", "b4dword"]
    text = lambda extra: " ".join(r.sample(plain, 12) + extra)
    rows = []
    for i in range(120):
        words = r.sample(plain, 12)
        if i % 3 == 0:
            for w in odd:
                words.insert(r.randrange(1, 12), w)
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    train = spark.createDataFrame([(t, y) for _, t, y in rows], "text string, label int")
    words, stems = toxicity.learn_lexicon(train)
    assert {w.casefold() for w in odd} <= set(words) or stems
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(odd)], "doc_id long, text string")
    assert all(r_.features[0] + r_.features[3] > 0 for r_ in toxicity.with_features(docs, words, stems).collect())
    assert toxicity.folded_words("Straße ét 4x!") == ["strasse", "ét", "4x"]
    assert train.select(toxicity._learnt_words("text").alias("w")).select(F.size("w")).first()[0] == len(rows[0][1].split())
