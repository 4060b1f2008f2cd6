"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each document. Expectation-maximisation over the counts of all vote patterns
estimates how accurate each labeller is for either class, and the share of good documents, without any true label.
The posterior of each pattern is the soft label on which a linear scorer over hashed features is trained,
so that the scorer also judges what the labellers abstain on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StringType, StructField, StructType

from lectern.llm.bpe import slices
from lectern.llm.common import TOKEN_BYTES, bound_batches, read_table, tidy
from lectern.llm.tokens import TokenBatch, classes, code_points, run_hash

#: Hashed features, and the most documents that the scorer is fitted on (those with the least MD5 of their text).
DIMENSIONS, TRAIN_ROWS = 1024, 6_000
LABELLERS = ("symbols", "capitals", "repeats", "alternation", "wordless", "dominant", "doubled_marks", "lengths", "variety", "sentences")
#: Documents of fewer tokens get no votes, as a share of few tokens says little; features of short texts shrink by n / (n + SHRINK).
MIN_TOKENS, SHRINK = 8, 8


def describe(names: list[str]) -> np.ndarray:
    """For each distinct token: letters, capitals, marks (neither letters nor numbers), length, whether it ends like a sentence or clause,
    whether it ends in two marks, its shape's bucket and its word's bucket.

    A shape has one sign for small letters, one for capitals and one for numbers, marks as they are, and runs shortened to two.
    """
    if not names:
        return np.zeros((0, 8), np.int64)
    points, starts = code_points(names)
    kind = classes()[points]
    owner = np.repeat(np.arange(len(names)), np.diff(starts))
    count = lambda which: np.bincount(owner, weights=which, minlength=len(names)).astype(np.int64)
    last, length = starts[1:] - 1, np.diff(starts)
    ends = np.isin(points[last], [ord(c) for c in ".,;:?!"])
    doubled = (length >= 2) & (kind[last] == 0) & (kind[np.maximum(last - 1, 0)] == 0)
    signs = np.where(kind == 0, points + 4, kind)
    # A sign goes where the two before it in its token are the same.
    again = np.append([False, False], (signs[2:] == signs[1:-1]) & (signs[2:] == signs[:-2]) & (owner[2:] == owner[:-2]))[: len(signs)]
    kept = ~again
    shape_starts = np.append(0, np.cumsum(kept))[starts]
    half = DIMENSIONS // 2
    return np.column_stack([
        count((kind == 1) | (kind == 2)), count(kind == 2), count(kind == 0), length, ends, doubled,
        run_hash(signs[kept], shape_starts) % half, half + run_hash(points, starts) % (half // 2),
    ])


class Reader:
    """Votes and features of batches of texts."""

    def read(self, texts: pa.Array) -> tuple[TokenBatch, np.ndarray, np.ndarray]:
        """The tokens, each document's shares (one column for each labeller), and each token's buckets."""
        batch = TokenBatch(texts)
        rows = describe(batch.names)[batch.code]
        n = np.maximum(batch.counts, 1)
        letters, capitals, marks, length, ends, extra = (batch.sums(rows[:, i]) for i in range(6))
        same = np.append(False, (batch.code[1:] == batch.code[:-1]) & (batch.doc[1:] == batch.doc[:-1])) if len(batch.code) else np.zeros(0, bool)
        every_other = np.append([False, False], (batch.code[2:] == batch.code[:-2]) & (batch.doc[2:] == batch.doc[:-2]))[: len(batch.code)]
        pairs, often = np.unique(batch.doc * (len(batch.names) + 1) + batch.code, return_counts=True)
        owner = pairs // (len(batch.names) + 1)
        distinct = np.bincount(owner, minlength=len(batch))
        most = np.zeros(len(batch))
        np.maximum.at(most, owner, often)
        shares = np.column_stack([
            marks / np.maximum(length, 1), capitals / np.maximum(letters, 1), batch.sums(same) / n, batch.sums(every_other) / n,
            batch.sums(rows[:, 0] == 0) / n, most / n, extra / n, length / n, distinct / np.minimum(n, 400), ends / n,
        ])
        return batch, shares, rows[:, 6:8]


def vote(shares: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 good, -1 bad, 0 nothing: (documents, labellers)."""
    symbols, capitals, repeats, alternation, wordless, dominant, doubled, lengths, variety, sentences = shares.T
    bad = lambda wrong: np.where(wrong, -1, 0)
    out = np.column_stack([
        bad(symbols >= 0.15), bad(capitals >= 0.5), bad(repeats >= 0.12), bad(alternation >= 0.12), bad(wordless >= 0.15), bad(dominant >= 0.2), bad(doubled >= 0.25), bad((lengths < 2) | (lengths > 14)),
        np.where(variety < 0.2, -1, np.where(variety > 0.35, 1, 0)), np.where((sentences > 0.02) & (sentences < 0.45), 1, np.where(sentences > 0.8, -1, 0)),
    ])
    out[counts < MIN_TOKENS] = 0
    return out


@dataclass
class LabelModel:
    """What expectation-maximisation found: the share of good documents, and for each class the chance of each vote of each labeller."""

    prior: float
    chances: np.ndarray  # (class bad/good, labeller, vote -1/0/1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance that each row of votes belongs to a good document."""
        log = np.log(np.array([1 - self.prior, self.prior]))[:, None] + sum(np.log(self.chances[:, i, votes[:, i] + 1]) for i in range(votes.shape[1]))
        found = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        return np.where((votes != 0).any(axis=1), found, self.prior)  # no vote says nothing

    def accuracies(self) -> dict[str, float]:
        """Of the votes that each labeller casts, the expected share that is right."""
        cast = (1 - self.prior) * self.chances[0][:, [0, 2]].sum(axis=1) + self.prior * self.chances[1][:, [0, 2]].sum(axis=1)
        right = (1 - self.prior) * self.chances[0][:, 0] + self.prior * self.chances[1][:, 2]
        return dict(zip(LABELLERS, (right / np.maximum(cast, 1e-12)).tolist(), strict=True))


#: What is believed of a labeller before it is seen: chances of a bad, no and good vote, for bad and good documents; and how much that counts against the documents seen.
BELIEF = {"bad only": ((0.3, 0.7, 1e-3), (0.02, 0.98, 1e-3)), "both": ((0.3, 0.3, 0.4), (0.02, 0.18, 0.8))}
BELIEF_SHARE = 0.15
#: The first so many labellers only vote bad or nothing.
ONLY_BAD = 8


def fit_label_model(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """EM over vote patterns and how often each occurs, from a weak belief in each labeller. Patterns without votes take no part."""
    belief = np.array([BELIEF["bad only" if i < ONLY_BAD else "both"] for i in range(len(LABELLERS))]).transpose(1, 0, 2)
    seen = (votes != 0).any(axis=1) if len(votes) else np.zeros(0, bool)
    votes, counts = votes[seen], counts[seen]
    model = LabelModel(0.85, belief / belief.sum(axis=2, keepdims=True))
    strength = BELIEF_SHARE * counts.sum() + 1
    for _ in range(rounds if len(votes) else 0):
        good = model.posterior(votes)
        weight = np.stack([(1 - good) * counts, good * counts])
        tallies = np.stack([[[(w * (votes[:, i] == v)).sum() for v in (-1, 0, 1)] for i in range(len(LABELLERS))] for w in weight])
        chances = tallies + strength * belief
        chances /= chances.sum(axis=2, keepdims=True)
        before, model = model, LabelModel(float((weight[1].sum() + 0.85) / (counts.sum() + 1)), chances)
        if np.abs(before.chances - chances).max() < 1e-7:
            break
    return model


def _features(batch: TokenBatch, shares: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Hashed features: shares of token shapes and words, and the labellers' shares in steps."""
    out = np.zeros((len(batch), DIMENSIONS), np.float32)
    for i in range(2):
        np.add.at(out, (batch.doc, buckets[:, i]), 1.0)
    out /= np.maximum(batch.counts, 1)[:, None]
    out[:, : DIMENSIONS // 4 * 3] = np.sqrt(out[:, : DIMENSIONS // 4 * 3])
    for i in range(shares.shape[1]):
        step = np.clip((np.log2(np.maximum(shares[:, i], 1e-3)) + 10).astype(int), 0, 15)
        out[np.arange(len(batch)), DIMENSIONS // 4 * 3 + (i * 16 + step) % (DIMENSIONS // 4)] = 1.0
    return out * (batch.counts / (batch.counts + SHRINK)).astype(np.float32)[:, None]


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float


def fit_scorer(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 300, rate: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Adam."""
    w, m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    for t in range(1, rounds + 1 if len(x) else 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1].astype(np.float32) + w[-1], -40, 40)))
        g = np.append(x.T @ (p - y).astype(np.float32) / len(y) + ridge * w[:-1], (p - y).mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1].astype(np.float32), float(w[-1])


def weak_votes(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The votes on each whole text, as a string of ``-``, ``0`` and ``+``. One column."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for whole in batches:
            for batch in slices(whole, text_col, TOKEN_BYTES):
                tokens, shares, _ = reader.read(batch.column(text_col))
                letters = np.array(["-", "0", "+"])[vote(shares, tokens.counts) + 1]
                yield pa.RecordBatch.from_arrays([pa.array(["".join(r) for r in letters], pa.string())], names=["votes"])

    return df.select(text_col).mapInArrow(tidy(run), "votes string")


def fit_quality(df: DataFrame, text_col: str = "text", rows: int = TRAIN_ROWS) -> QualityModel:
    """Votes of all documents give the label model; the scorer is fitted on the posterior labels of at most ``rows`` distinct texts, those with the least MD5."""
    patterns = weak_votes(df, text_col).groupBy("votes").count().collect()  # at most 3 to the number of labellers
    to_votes = lambda texts: np.array([["-0+".index(c) - 1 for c in t] for t in texts], np.int64).reshape(len(texts), len(LABELLERS))
    labels = fit_label_model(to_votes([r["votes"] for r in patterns]), np.array([r["count"] for r in patterns], float))
    order = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    chosen = df.select(order.alias("order")).distinct().orderBy("order").limit(rows).agg(F.max("order")).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for whole in batches:
            for batch in slices(whole, text_col, TOKEN_BYTES):
                tokens, shares, buckets = reader.read(batch.column(text_col))
                x = _features(tokens, shares, buckets).astype(np.float16)
                y = labels.posterior(vote(shares, tokens.counts))
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), pa.array(y)], names=["x", "y"])

    # Copies count once, both for the limit and in the sample.
    sample = df.select(text_col).where(order <= F.lit(chosen)).distinct().limit(rows) if chosen is not None else df.select(text_col).limit(0)
    got = sample.mapInArrow(tidy(run), StructType([StructField("x", BinaryType()), StructField("y", DoubleType())])).collect()
    x = np.frombuffer(b"".join(r["x"] for r in got), np.float16).reshape(-1, DIMENSIONS).astype(np.float32)
    return QualityModel(labels, *fit_scorer(x, np.array([r["y"] for r in got], float)))


def score_quality(df: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """Adds ``quality`` (0 to 1), ``keep`` (1 from 0.5) and ``votes``. Other columns are kept, those with the new names replaced.

    A null text counts as empty; texts without tokens get no vote and the score of the features that they have.
    """
    bound_batches(df.sparkSession)
    df = df.drop("quality", "keep", "votes")
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*df.schema.fields, StructField("quality", DoubleType()), StructField("keep", IntegerType()), StructField("votes", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, fitted = Reader(), shared.value
        for whole in batches:
            for batch in slices(whole, text_col, TOKEN_BYTES):
                tokens, shares, buckets = reader.read(batch.column(text_col))
                logit = _features(tokens, shares, buckets) @ fitted.weights + fitted.bias
                score = 1 / (1 + np.exp(-np.clip(logit, -40, 40).astype(np.float64)))
                letters = np.array(["-", "0", "+"])[vote(shares, tokens.counts) + 1]
                new = [pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(["".join(r) for r in letters], pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return df.mapInArrow(tidy(run), schema)


def good_rows(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of df that a classifier fitted on df itself keeps, with their columns."""
    return score_quality(df, fit_quality(df, text_col), text_col).where("keep = 1").select(*df.columns)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(documents, fit_quality(documents)).select("doc_id", "quality", "keep", "votes")
