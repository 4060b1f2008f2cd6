"""Toxicity: a lexicon trie met by Levenshtein automata, and scores of each hit's context window.

The lexicon (words, and stems that many words share) is learnt from labelled rows, or given. Its trie is intersected
with the Levenshtein automata of all words at once: a state of the product is a set of (trie node, edits so far),
made deterministic when a word first reaches it, so that one table look-up per letter tells whether a word is a term, a misspelt term,
or begins with a stem. The table is run over all distinct words of a batch in parallel.

Each hit is weighed by the window of tokens around it: inside quotation marks or near a reporting word it counts as
quotation, near a second-person pronoun it counts as address. The sums are a logistic model's features.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from lectern.llm.bpe import slices
from lectern.llm.common import TOKEN_BYTES, bound_batches, checkpoint, read_table, tidy
from lectern.llm.minhash import sketches
from lectern.llm.tokens import TokenBatch

#: At most so many labelled rows are fitted on, those with the least MD5 of their id.
TRAIN_ROWS = 10_000
#: Lengths of stems, and the number of distinct words that a stem must begin.
STEM_LENGTHS, STEM_WORDS = (4, 5, 6, 7, 8, 9), 3
#: At least this share of the rows with a term must be toxic.
PRECISION = 0.8
#: Words and stems that chance could make look toxic; terms must be more surprising than that.
CANDIDATES = 100_000
#: So many different words must stand before a word in toxic rows.
CONTEXTS = 3
#: States of an automaton's table beyond which it is made anew.
MOST_STATES = 50_000
#: Tokens on either side of a hit that are its context.
WINDOW = 6
#: What counts as address, as reporting and as a quotation mark, in the corpus's languages.
ADDRESS = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
REPORTING = frozenset("said says say wrote writes quoted quote quotes word words term terms called calls reported sagte schrieb zitat wort begriff dit écrit cité mot terme dijo escribió cita palabra término".split())
QUOTES = "\"“”„«»‹›"
#: Weight of a hit that is quoted or reported, and of one that is an address.
QUOTED_WEIGHT, ADDRESS_WEIGHT = 0.25, 1.5
FEATURES = ("exact", "one_edit", "two_edits", "stem", "abuse", "density", "quoted", "terms")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


def folded_words(text: str) -> list[str]:
    """A text's words without regard to case: the one way in which words are learnt, looked up and compared."""
    return _WORD.findall(text.casefold())


def allowed_edits(term: str) -> int:
    """0 for terms below 5 letters, 1 below 9, else 2."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """The trie of a lexicon intersected with its Levenshtein automata, as a table whose states are made when a word first reaches them.

    ``table[state, letter]`` is the next state, or -1 while it isn't known; state 0 is dead, 1 is the start, 2 has completed a stem; letter 0 stands for every letter
    that no term has. ``edits[state]`` is the least number of edits with which a word that ends there is a term (9: it isn't one),
    ``stem[state]`` whether a stem was completed on the way. A set of ``words`` adds at most as many states as it has letters, and the
    table is emptied before a set if it has more than ``most`` states, so its size is bounded whatever the lexicon is.
    """

    def __init__(self, words: Iterable[str], stems: Iterable[str] = (), most: int = MOST_STATES):
        self.most = most
        self.children: list[dict[str, int]] = [{}]
        self.term_edits: dict[int, int] = {}
        self.stem_nodes: set[int] = set()
        self.reach = [0]  # most edits that any word below a node allows
        for text, is_stem in [*((w, False) for w in words), *((s, True) for s in stems)]:
            if not text:
                continue
            node, k = 0, 0 if is_stem else allowed_edits(text)
            self.reach[0] = max(self.reach[0], k)
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], k)
            if is_stem:
                self.stem_nodes.add(node)
            else:
                self.term_edits[node] = k
        self.letters = [None, *sorted({c for kids in self.children for c in kids})]
        self.of_point = np.zeros(max([ord(c) for c in self.letters[1:]], default=0) + 2, np.int32)
        for i, c in enumerate(self.letters[1:], 1):
            self.of_point[ord(c)] = i
        self._empty()

    def _empty(self) -> None:
        self.sets: list[frozenset[tuple[int, int]] | None] = []
        self.number: dict[frozenset[tuple[int, int]], int] = {}
        self.table = np.full((64, len(self.letters)), -1, np.int32)
        self.edits, self.stem = np.full(64, 9, np.int8), np.zeros(64, bool)
        self._state(frozenset())
        self._state(self._closed({0: 0}))
        self.sets.append(None)
        self.table[0], self.table[2], self.stem[2] = 0, 2, True

    def _closed(self, found: dict[int, int]) -> frozenset[tuple[int, int]]:
        """With the letters that a word may leave out."""
        stack = list(found.items())
        while stack:
            node, e = stack.pop()
            if found.get(node, 9) < e:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.reach[child] and e + 1 < found.get(child, 9):
                    found[child] = e + 1
                    stack.append((child, e + 1))
        return frozenset(found.items())

    def _state(self, state: frozenset[tuple[int, int]]) -> int:
        """The number of a set of (node, edits so far)."""
        if state not in self.number:
            i = self.number[state] = len(self.sets)
            self.sets.append(state)
            if i == len(self.table):
                grown = lambda x, fill: np.concatenate([x, np.full_like(x, fill)])
                self.table, self.edits, self.stem = grown(self.table, -1), grown(self.edits, 9), grown(self.stem, False)
            self.edits[i] = min([e for node, e in state if node in self.term_edits and e <= self.term_edits[node]], default=9)
        return self.number[state]

    def _step(self, state: int, letter: int) -> int:
        c = self.letters[letter]
        found: dict[int, int] = {}
        for node, e in self.sets[state]:
            for label, child in self.children[node].items():
                cost = e + (label != c)
                if cost <= self.reach[child] or cost == 0:
                    found[child] = min(cost, found.get(child, 9))
            if e + 1 <= self.reach[node]:
                found[node] = min(e + 1, found.get(node, 9))
        after = self._closed(found)
        # Nothing that follows a stem matters.
        return 2 if any(e == 0 and node in self.stem_nodes for node, e in after) else self._state(after)

    def run(self, words: list[str]) -> np.ndarray:
        """Final state of each word, valid until the next run; all words advance together, one letter a step."""
        if len(self.sets) > self.most:
            self._empty()
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        letters = self.of_point[np.minimum(points, len(self.of_point) - 1)]
        starts = np.cumsum(lengths) - lengths
        state = np.ones(len(words), np.int32)
        live, at = np.flatnonzero(lengths > 0), 0
        width = len(self.letters)
        while len(live):
            now, letter = state[live], letters[starts[live] + at]
            after = self.table[now, letter]
            if (after < 0).any():
                for pair in np.unique(now[after < 0].astype(np.int64) * width + letter[after < 0]).tolist():
                    target = self._step(*divmod(pair, width))  # may replace the table
                    self.table[divmod(pair, width)] = target
                after = self.table[now, letter]
            state[live] = after
            at += 1
            live = live[(lengths[live] > at) & (state[live] > 0)]
        return state


def term_kinds(automaton: LexiconAutomaton, words: list[str]) -> np.ndarray:
    """0: no term, 1: a term, 2 and 3: one and two edits off, 4: begins with a stem."""
    state = automaton.run(words)
    kinds = np.select([automaton.edits[state] == 0, automaton.stem[state], automaton.edits[state] == 1, automaton.edits[state] == 2], [1, 4, 2, 3], 0)
    return kinds.astype(np.int8)


class Scorer:
    """Features of batches of texts."""

    def __init__(self, automaton: LexiconAutomaton):
        self.automaton = automaton

    def describe(self, tokens: list[str]) -> np.ndarray:
        """For each distinct token: kind, quotation marks, whether it begins with one, addresses, reports, and the term's hash."""
        lowered = [t.casefold() for t in tokens]
        plain = [t.isalpha() for t in lowered]
        parts = [[t] if p else _WORD.findall(t) for t, p in zip(lowered, plain, strict=True)]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = [w for p in parts for w in p]
        kinds = term_kinds(self.automaton, flat).astype(np.int64)
        out = np.zeros((len(tokens), 6), np.int64)
        owner = np.repeat(np.arange(len(tokens)), sizes)
        hits = np.flatnonzero(kinds)
        for i in hits:
            row = out[owner[i]]
            if not row[0] or kinds[i] < row[0]:
                row[0], row[5] = kinds[i], hash_term(flat[i])
        for i in np.flatnonzero(~np.array(plain, bool)) if plain else ():
            t = tokens[i]
            out[i, 1] = sum(map(t.count, QUOTES))
            out[i, 2] = t[0] in QUOTES
        out[:, 3] = [not ADDRESS.isdisjoint(p) for p in parts]
        out[:, 4] = [not REPORTING.isdisjoint(p) for p in parts]
        return out

    def features(self, texts: pa.Array) -> np.ndarray:
        batch = TokenBatch(texts)
        rows = self.describe(batch.names) if batch.names else np.zeros((0, 6), np.int64)
        out = np.zeros((len(batch), len(FEATURES)))
        kind = rows[:, 0][batch.code]
        hits = np.flatnonzero(kind)
        if not len(hits):
            return out
        flags = rows[batch.code]
        totals = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(flags[:, :5], axis=0)])
        doc = batch.doc[hits]
        first, last = batch.offsets[doc], batch.offsets[doc + 1]
        low, high = np.maximum(hits - WINDOW, first), np.minimum(hits + WINDOW + 1, last)
        near = totals[high] - totals[low]
        marks_before = totals[hits, 1] - totals[first, 1]
        marks_in_all = totals[last, 1] - totals[first, 1]
        inside = flags[hits, 2].astype(bool) | ((marks_before % 2 == 1) & (marks_in_all > marks_before))
        quoted = inside | (near[:, 4] > 0)
        weight = np.where(quoted, QUOTED_WEIGHT, np.where(near[:, 3] > 0, ADDRESS_WEIGHT, 1.0))
        kind = kind[hits]
        total = lambda x: np.bincount(doc, weights=x, minlength=len(batch))
        for i, k in enumerate((1, 2, 3, 4)):
            out[:, i] = np.log1p(total(weight * (kind == k)))
        sure = (kind == 1) | (kind == 4)
        out[:, 4] = np.log1p(total(weight * sure))
        out[:, 5] = np.log1p(100 * total(weight * sure) / np.maximum(batch.counts, 1))
        out[:, 6] = np.log1p(total(quoted * 1.0))
        pairs = np.unique(np.stack([doc[sure], flags[hits, 5][sure]]), axis=1)
        out[:, 7] = np.log1p(np.bincount(pairs[0], minlength=len(batch)))
        return out


def hash_term(word: str) -> int:
    h = 0
    for c in word:
        h = (h * 31 + ord(c)) % (1 << 40)
    return h


@dataclass
class ToxicityModel:
    words: list[str]
    stems: list[str]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((features - self.mean) / self.scale @ self.weights + self.bias, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Mean, scale, weights and bias by Newton's method. With one class only, the bias is the smoothed share."""
    mean, scale = (x.mean(axis=0), x.std(axis=0)) if len(x) else (np.zeros(x.shape[1]), np.zeros(x.shape[1]))
    scale = np.where(scale > 0, scale, 1.0)
    share = (y.sum() + 0.5) / (len(y) + 2)
    w = np.zeros(x.shape[1] + 1)
    w[-1] = math.log(share / (1 - share))
    if 0 < y.sum() < len(y):
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        penalty = np.diag([ridge] * x.shape[1] + [1e-9])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
    return mean, scale, w[:-1], float(w[-1])


def is_held_out(doc_id: Column) -> Column:
    """Whether crc32(doc_id as text) mod 5 is 0; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def training_rows(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, label_col: str = "toxic") -> DataFrame:
    """Different texts and labels (0 or 1) of at most ``rows`` labelled rows that aren't held out. The sample's size bounds the broadcast.

    Labels above 0 are toxic, null ones take no part; a text with both labels is toxic. Copies and near copies (texts that agree in an entry of their
    sketches) are one example, else all words of a toxic text with copies would look toxic; the one with the least MD5 stands for them.
    """
    sample = (
        labels.where(~is_held_out(F.col("doc_id")) & F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg((F.max(label_col) > 0).cast("int").alias("label"))
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(rows)
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("text").agg(F.max("label").alias("label"))
    texts = checkpoint(texts)
    nodes = sketches(texts, "label", "text")
    entries = nodes.select("text_key", F.explode("sketch").alias("entry")).where("entry <> 0")
    later = entries.withColumn("first", F.min("text_key").over(Window.partitionBy("entry"))).where("first <> text_key").select("text_key").distinct()
    return texts.withColumn("text_key", F.unhex(F.md5(F.coalesce("text", F.lit(""))))).join(later, "text_key", "left_anti").select("text", "label")


@F.pandas_udf(ArrayType(StringType()))
def _learnt_words(text: pd.Series) -> pd.Series:
    """The words of training texts, cut and folded as those that are looked up."""
    return text.map(lambda t: folded_words(t or ""))


def learn_lexicon(train: DataFrame) -> tuple[list[str], list[str]]:
    """Words and stems that occur in toxic rows far more often than chance and rarely in others.

    A word must also follow ``CONTEXTS`` different words in toxic texts, which words of a repeated passage don't.
    A candidate's surprise is its number of rows times the divergence of its toxic share from the overall one; it must exceed the log of
    ``CANDIDATES``, so that chance finds are unlikely. What reaches the driver is the lexicon itself.
    """
    rows = train.select("label", _learnt_words("text").alias("words"))
    total = train.agg(F.count(F.lit(1)), F.sum("label")).first()
    n, toxic = total[0], total[1] or 0
    if not 0 < toxic < n:
        return [], []
    prior = toxic / n
    # Words and stems are made distinct within their row, so groupings only shuffle one count a task.
    per_row = F.array_distinct(F.filter("words", lambda w: F.length(w) >= 3))
    beginnings = lambda w: F.array_compact(F.array(*(F.when(F.length(w) >= k, F.substring(w, 1, k)) for k in STEM_LENGTHS)))
    counted = lambda of: rows.select("label", F.explode(of).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("t"))
    share = F.col("t") / F.col("n")
    surprise = F.col("n") * (share * F.log(share / prior) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - prior))).otherwise(0.0))
    telling = (F.col("t") >= 3) & (share >= PRECISION) & (surprise > math.log(CANDIDATES))
    words = checkpoint(counted(per_row))
    candidates = checkpoint(words.where(telling).select("word"))
    placed = rows.where("label = 1").select(F.explode(F.expr("transform(words, (w, i) -> struct(w AS word, CASE WHEN i > 0 THEN words[i - 1] ELSE '' END AS before))")).alias("w")).select("w.*")
    varied = placed.join(F.broadcast(candidates), "word").groupBy("word").agg(F.count_distinct("before").alias("variety")).where(F.col("variety") >= CONTEXTS)
    family = words.where("t > 0").select(F.explode(beginnings(F.col("word"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") >= STEM_WORDS)
    likely = counted(F.array_distinct(F.flatten(F.transform(per_row, beginnings)))).where(telling).join(family, "word")
    found = varied.select("word", F.lit(False).alias("is_stem")).unionByName(likely.select("word", F.lit(True).alias("is_stem"))).collect()
    stems: list[str] = []
    for s in sorted((r["word"] for r in found if r["is_stem"]), key=lambda w: (len(w), w)):
        if not any(s.startswith(x) for x in stems):
            stems.append(s)
    # Words that begin with a stem stay, as their misspellings may miss it.
    return sorted(r["word"] for r in found if not r["is_stem"]), sorted(stems)


def with_features(df: DataFrame, words: Iterable[str], stems: Iterable[str], text_col: str = "text", features_col: str = "features") -> DataFrame:
    """Adds the features of each whole text as an array of doubles; null counts as empty."""
    bound_batches(df.sparkSession)
    df = df.drop(features_col)
    shared = df.sparkSession.sparkContext.broadcast(([w.casefold() for w in words], [s.casefold() for s in stems]))
    schema = StructType([*df.schema.fields, StructField(features_col, ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(LexiconAutomaton(*shared.value))
        for whole in batches:
            for batch in slices(whole, text_col, TOKEN_BYTES):
                x = scorer.features(batch.column(text_col))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(x), pa.list_(pa.float64()))], names=schema.names)

    return df.mapInArrow(tidy(run), schema)


def fit_toxicity(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Learns lexicon and weights from labelled rows that aren't held out; without both classes every text gets the smoothed share."""
    train = checkpoint(training_rows(documents, labels, rows))
    words, stems = learn_lexicon(train)
    got = with_features(train, words, stems).select("features", "label").collect()
    x = np.array([r["features"] for r in got], float).reshape(len(got), len(FEATURES))
    return ToxicityModel(words, stems, *fit_logistic(x, np.array([r["label"] for r in got], float)))


def score_toxicity(df: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows with ``score`` (0 to 1) and ``predicted`` (1 from 0.5) instead of their text. Only the text is read; null counts as empty. Columns with these names are replaced."""
    bound_batches(df.sparkSession)
    df = df.drop("score", "predicted")
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*(f for f in df.schema.fields if f.name != text_col), StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        scorer = Scorer(LexiconAutomaton(fitted.words, fitted.stems))
        for whole in batches:
            for batch in slices(whole, text_col, TOKEN_BYTES):
                score = fitted.score(scorer.features(batch.column(text_col)))
                columns = [batch.column(n) for n in batch.schema.names if n != text_col]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=schema.names)

    return df.mapInArrow(tidy(run), schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(documents, read_table(spark, sf_dir, "labels"))
    return score_toxicity(documents, model).select("doc_id", F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")
