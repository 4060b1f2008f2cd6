"""Search and release products: concepts and assertions with their evidence, evidence chains and bundles, answer checks, entry ids, manifests."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from lectern.functions.batches import bound_batches
from lectern.operators.graph import kept


def concept_hits(mentions: DataFrame, spans: DataFrame, concept: str | None = None) -> DataFrame:
    """Mentions (of one concept, or all) with the quote and location of their span; mentions of unknown spans stay, without."""
    wanted = mentions if concept is None else mentions.where(F.col("concept_id") == concept)
    return wanted.join(spans.select("span_id", "quote", "location"), "span_id", "left").select("concept_id", "surface", "unit_id", "span_id", "quote", "location")


def assertion_evidence(assertions: DataFrame, evidence: DataFrame, spans: DataFrame) -> DataFrame:
    """Assertions with their evidence as a list ordered by span; evidence of unknown spans is left out, assertions without any have an empty list."""
    known = evidence.join(spans.select("span_id", "quote", "location"), "span_id")
    listed = known.groupBy("assertion_id").agg(F.sort_array(F.collect_list(F.struct("span_id", "support_type", "quote", "location"))).alias("evidence"))
    empty = F.array().cast(listed.schema["evidence"].dataType)
    return assertions.join(listed, "assertion_id", "left").withColumn("evidence", F.coalesce("evidence", empty))


def owning_span(assertions: DataFrame, spans: DataFrame, evidence_col: str = "span_ids") -> DataFrame:
    """Each assertion's home: its first evidence's span. Assertions without evidence have none."""
    first = assertions.select("assertion_id", F.get(evidence_col, F.lit(0)).alias("span_id"))
    return first.join(spans.select("span_id", "unit_id"), "span_id", "left").select("assertion_id", "span_id", "unit_id")


def glossary_spans(glossary: DataFrame, spans: DataFrame) -> DataFrame:
    """Glossary terms (source_id, term, seg_ids, status) with the spans that their segments name by source and number at the end of the id; rejected terms and ids without a number are left out."""
    named = glossary.where("status <> 'rejected'").select("source_id", "term", F.explode("seg_ids").alias("seg_id"))
    numbered = named.withColumn("seq", F.nullif(F.regexp_extract("seg_id", r"([0-9]+)$", 1), F.lit("")).cast("int")).where("seq IS NOT NULL")
    return numbered.join(spans.select("source_id", "seq", "span_id"), ["source_id", "seq"]).select("term", "source_id", "seg_id", "span_id")


def first_holder(terms: DataFrame, spans: DataFrame, term: str, span: str, order: str, text_col: str) -> DataFrame:
    """Each term's first span that holds it anywhere, also within a word, by order and span; case doesn't count. Empty and null terms have none.

    The first ``FIRST`` spans are searched for all terms, and what they hold is settled; all spans are then searched for the other terms only, which
    are rare or nowhere.
    """
    wanted = terms.select(F.col(term).alias("_term"), F.lower(term).alias("_low")).where("_low <> ''").distinct()
    known = spans.where(F.length(text_col) > 0).select(F.col(span).alias("_span"), F.col(order).alias("_order"), F.lower(text_col).alias("_text"))
    nearest = known.select(F.col("_order").alias("_o"), F.col("_span").alias("_s")).orderBy("_o", "_s").limit(FIRST)
    near = kept(known.join(F.broadcast(nearest), F.col("_order").eqNullSafe(F.col("_o")) & F.col("_span").eqNullSafe(F.col("_s")), "left_semi"))
    early = kept(_first_held(wanted, near))
    late = kept(wanted.join(early.select("_term"), "_term", "left_anti"))
    held = early if late.isEmpty() else early.unionByName(_first_held(late, known))
    return held.select(F.col("_term").alias(term), F.col("_f._span").alias(span))


def _first_held(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """The least order and span that holds a term: _term, _f.

    A span gives its different parts that are terms by a table of ``MARKS`` bits, which seldom errs and only by taking too many. Each task sends a part once, with the
    least order and span; one that equals a term is held for sure. So texts, and pairs of spans and terms, neither travel nor are stored.
    """
    bound_batches(known.sparkSession)
    given = known.select(F.struct("_order", "_span").alias("_at"), F.explode(_parts(*_marked(wanted))("_text")).alias("_low"))
    return wanted.join(given.groupBy("_low").agg(F.min("_at").alias("_f")), "_low").select("_term", "_f")


#: Bits that tell parts of texts apart; characters that are looked at together; spans that are searched for all terms; characters by which longer terms are looked for first.
MARKS, STRETCH, FIRST, BEGIN = 1 << 24, 1 << 14, 1_000, 8
_STEP, _MIX, _SPREADS = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_AWAY = np.uint64(64 - (MARKS - 1).bit_length())


def _powers(step: int, n: int) -> np.ndarray:
    """The first n powers, modulo 2 ** 64."""
    steps = np.full(n, step, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _sums(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the characters of a text, and a factor for each place: they give the number of any part without another look at it."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _powers(_STEP, len(codes)), out=sums[1:])
    return sums, _powers(pow(_STEP, -1, 1 << 64), len(codes))


def _mixed(numbers: np.ndarray, length: int, begins: bool) -> np.ndarray:
    """Parts that terms begin with are told from whole terms, and lengths from each other."""
    mixed = numbers + np.uint64((2 * length + begins) * _MIX % (1 << 64))
    return mixed ^ (mixed >> np.uint64(32))


def _held(sums: np.ndarray, back: np.ndarray, at: np.ndarray | None, length: int, begins: bool, table: np.ndarray) -> np.ndarray:
    """The places, of some or of all, whose part of a length has its bits in the table."""
    last = len(back) - length
    if last < 0:
        return np.zeros(0, np.int64)
    if at is None:
        at, numbers = np.arange(last + 1), (sums[length:] - sums[: last + 1]) * back[: last + 1]
    else:
        at = at[at <= last]
        numbers = (sums[at + length] - sums[at]) * back[at]
    mixed = _mixed(numbers, length, begins)
    for spread in _SPREADS:
        bit = (mixed * spread) >> _AWAY
        yes = np.flatnonzero((table[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1))
        at, mixed = at[yes], mixed[yes]
    return at


def _met(text: str, lengths: list[int], table: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Where a text may hold terms of each length. Terms of ``BEGIN`` characters and more are looked for where such a beginning is, those of twice as many where a beginning of twice as many is, and so on."""
    sums, back = _sums(text)
    at, begin = None, BEGIN
    for length in lengths:
        while length >= begin:
            at, begin = _held(sums, back, at, begin, True, table), 2 * begin
        if at is not None and not len(at):
            return
        yield _held(sums, back, at, length, False, table), length


@F.pandas_udf(ArrayType(IntegerType()))
def _marks(low: pd.Series) -> pd.Series:
    """The bits of terms and of their beginnings."""

    def bits(term: str) -> list[int]:
        sums, n = _sums(term)[0], len(term)
        looks = [(n, False), *((BEGIN << k, True) for k in range((n // BEGIN).bit_length()))]
        return [int((_mixed(sums[length : length + 1], length, begins) * spread >> _AWAY)[0]) for length, begins in looks for spread in _SPREADS]

    return low.map(bits)


def _marked(wanted: DataFrame) -> tuple[list[int], np.ndarray]:
    """The lengths of terms, and the table of their bits; it has the same size however many terms there are."""
    lengths = sorted(r[0] for r in wanted.select(F.length("_low")).distinct().collect())
    bits = wanted.select(F.explode(_marks("_low")).alias("bit")).groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("bits")).toArrow()
    table = np.zeros(MARKS // 64, np.uint64)
    table[bits["word"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    return lengths, table


def _stretches(texts: pd.Series, longest: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, str]]:
    """Texts many at once, long ones in windows that overlap by the longest term: the row of each piece, the ends of the pieces, and all of them in one."""
    rows, pieces, n = [], [], 0
    for row, text in enumerate(texts):
        for start in range(0, len(text), width):
            rows.append(row)
            pieces.append(text[start : start + width + longest])
            n += len(pieces[-1])
            if n >= width:
                yield np.array(rows), np.cumsum([len(p) for p in pieces]), "".join(pieces)
                rows, pieces, n = [], [], 0
    if rows:
        yield np.array(rows), np.cumsum([len(p) for p in pieces]), "".join(pieces)


def _parts(lengths: list[int], table: np.ndarray) -> Callable[[Column], Column]:
    """The different parts of a text that may be terms."""
    longest = max(lengths, default=0)
    width = max(STRETCH, longest)

    @F.pandas_udf(ArrayType(StringType()))
    def parts(texts: pd.Series) -> pd.Series:
        found = [set() for _ in range(len(texts))]
        for rows, ends, text in _stretches(texts, longest, width):
            for at, length in _met(text, lengths, table):
                piece = np.searchsorted(ends, at, "right")
                whole = at + length <= ends[piece]
                for i, row in zip(at[whole].tolist(), rows[piece[whole]].tolist(), strict=True):
                    found[row].add(text[i : i + length])
        return pd.Series([list(x) for x in found], dtype=object)

    return parts


def evidence_chain(assertions: DataFrame, spans: DataFrame, documents: DataFrame, assets: DataFrame, policy: Column) -> DataFrame:
    """One row for each piece of evidence from assertion to asset; where ``policy`` (of the asset) forbids it, quotes are withheld and only their hashes stay."""
    each = assertions.select("assertion_id", F.posexplode("span_ids").alias("place", "span_id"))
    joined = each.join(spans.select("span_id", "doc_key", "quote"), "span_id", "left").join(documents.select("doc_key", "asset_id"), "doc_key", "left").join(assets, "asset_id", "left")
    broken = F.when(F.col("doc_key").isNull(), "no_span").when(F.col("asset_id").isNull(), "no_document").when(policy.isNull(), "no_asset")
    return joined.select("assertion_id", "place", "span_id", "doc_key", "asset_id", F.sha2("quote", 256).alias("quote_sha256"), F.when(policy, F.col("quote")).alias("quote"), (~F.coalesce(policy, F.lit(False))).alias("redacted"), broken.alias("broken"))


def orphans(items: DataFrame, referring: DataFrame, key: str, refs_col: str) -> DataFrame:
    """Items that nothing refers to."""
    return items.join(referring.select(F.explode(refs_col).alias(key)), key, "left_anti").select(key)


def subjects_both_ways(assertions: DataFrame, key: str, subject: str, refs_col: str) -> DataFrame:
    """Assertions under their declared subject and under each concept that they refer to, never inferred: subject, its track and the sorted assertions."""
    declared = assertions.select(F.col(subject).alias("subject"), key, F.lit("subject").alias("track"))
    referred = assertions.select(F.explode(refs_col).alias("subject"), key, F.lit("concept").alias("track"))
    return declared.unionByName(referred).where("subject IS NOT NULL").groupBy("subject", "track").agg(F.sort_array(F.collect_set(key)).alias("items"))


def evidence_bundle(hits: DataFrame, rank: Sequence[str], per_concept: int) -> DataFrame:
    """At most ``per_concept`` pieces of evidence of each concept (concept_id, span_id, status, score): by status rank, score and span, each span once."""
    place = F.nullif(F.array_position(F.array(*(F.lit(r) for r in rank)), F.col("status")), F.lit(0).cast("long"))
    best = Window.partitionBy("concept_id", "span_id").orderBy(F.coalesce(place, F.lit(len(rank) + 1)), F.desc("score"))
    once = hits.withColumn("_p", F.coalesce(place, F.lit(len(rank) + 1))).withColumn("_one", F.row_number().over(best)).where("_one = 1")
    order = Window.partitionBy("concept_id").orderBy("_p", F.desc("score"), "span_id")
    return once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_concept).drop("_p", "_one")


#: A sentence with the citations behind it. A Latin mark only ends one before white space, a citation or the text's end: not in a number or a name.
SENTENCE = r"(?s).+?(?:[.!?]+(?=\s|\[|$)|[。！？]+)(?:\s*\[[^\]]+\])*|.+$"


def answer_check(answers: DataFrame, bundle: DataFrame, key: str, text_col: str) -> DataFrame:
    """Sentences of answers that don't hold: no citation like ``[span]``, or one that isn't in the bundle. Rows of key, place, problem and citation."""
    sentences = answers.select(key, F.posexplode(F.filter(F.regexp_extract_all(text_col, F.lit(SENTENCE), F.lit(0)), lambda s: F.trim(s) != "")).alias("place", "sentence"))
    cited = sentences.withColumn("cites", F.regexp_extract_all("sentence", F.lit(r"\[([^\]]+)\]"), F.lit(1)))
    none = cited.where(F.size("cites") == 0).select(key, "place", F.lit("no_citation").alias("problem"), F.lit(None).cast("string").alias("citation"))
    each = cited.select(key, "place", F.explode("cites").alias("citation"))
    wrong = each.join(bundle.select(F.col("span_id").cast("string").alias("citation")).distinct(), "citation", "left_anti")
    return none.unionByName(wrong.select(key, "place", F.lit("not_in_bundle").alias("problem"), "citation"))


def carried_entry_ids(entries: DataFrame, previous: DataFrame, key: str, prefix: str = "ent_") -> DataFrame:
    """Entries with the id that the last release gave them, or a new one by content hash, so that a rerun gives the same."""
    fresh = F.concat(F.lit(prefix), F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 32))
    return entries.join(previous.select(key, F.col("entry_id").alias("_old")), key, "left").withColumn("entry_id", F.coalesce("_old", fresh)).withColumn("carried", F.col("_old").isNotNull()).drop("_old")


def pack_manifest(packs: DataFrame, name: str, content: str) -> DataFrame:
    """Each pack's files, bytes and order-free hash."""
    one = F.struct(F.sha2(F.col(content), 256).alias("h"))
    return packs.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(content)).cast("long").alias("n_bytes"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["h"]), "\n"), 256).alias("sha256"))


def unreconciled_inputs(declared: DataFrame, used: DataFrame, key: str, digest: str) -> DataFrame:
    """Inputs that a manifest declares and that weren't used, the other way round, or with another digest."""
    both = declared.select(key, F.col(digest).alias("_d")).join(used.select(key, F.col(digest).alias("_u")), key, "full")
    problem = F.when(F.col("_d").isNull(), "undeclared").when(F.col("_u").isNull(), "unused").when(F.col("_d") != F.col("_u"), "digest_differs")
    return both.select(key, problem.alias("problem")).where("problem IS NOT NULL")


def defects(counts: dict[str, Column]) -> Column:
    """The sorted names of defects of which there is at least one."""
    return F.array_sort(F.array_compact(F.array(*(F.when(F.coalesce(n, F.lit(0)) > 0, name) for name, n in counts.items()))))
