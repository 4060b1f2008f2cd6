"""Collocations of a corpus: which words stand together more often than alone, for each language.

1. Texts are cut into pieces and words, a few megabytes together (a chunk). A chunk keeps its words once, with counts, and its
   text as positions in that list.
2. Words that come often enough for any phrase are numbered in the order of language and word. A phrase can only be frequent
   where all its words are, so every other word breaks a piece.
3. Each chunk learns the numbers of its own words by a join (the dictionary is never broadcast), packs pairs and triples
   into keys of twelve bytes, sorts them by radix, counts equal ones by runs, and sends them on by ranges of keys.
4. Each range is sorted and counted again in the same way. Counts are exact: nothing is hashed or dropped before its sum is known.
5. Scores are made by joins of frequent phrases with the counts of their parts, in whole numbers of up to 38 digits.

The ranges come from a bounded sample of phrases (``SAMPLE``), which decides how work is dealt and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import bound_batches, read_table, tidy, written

#: A phrase's least count, and the share of a phrase (percent) that a longer one must reach to replace it.
LEAST, SHARE = 10, 50
TOP = 2_000
UNKNOWN_LANG = "und"
#: Bytes of text in a chunk; phrases in a range; phrases in the sample, and of one chunk.
CHUNK_BYTES, RANGE_KEYS, SAMPLE, CHUNK_SAMPLE = 4 << 20, 2_000_000, 100_000, 96
#: Parts in which each language's phrases are ranked before they meet.
RANK_PARTS = 32
#: A key is three big-endian numbers of 32 bits; a pair's third one is 0.
KEY_WORDS = 3

# What a byte is: 0 part of a word, 1 between words, 2 between pieces.
_BYTES = np.zeros(256, np.uint8)
_BYTES[[0x20, 0x09]] = 1
_BYTES[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of a batch of texts, with A-Z lowered: the words, the text of each, and whether a piece begins with it."""
    texts = pc.fill_null(pc.ascii_lower(texts.cast(pa.large_string())), "")
    if not len(texts):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, bool)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = _BYTES[data]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]  # where texts begin that aren't empty
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    letters = np.append(0, np.cumsum(inside))
    text = np.searchsorted(offsets, starts, "right") - 1
    # A piece begins with the first word of a text, and after any break.
    breaks = np.append(0, np.cumsum(kind == 2))[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (breaks[1:] != breaks[:-1]) | (text[1:] != text[:-1])
    bounds = np.append(letters[starts], letters[-1]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[inside])))
    return words, text, fresh


def _chunk(key: int, texts: list[pa.Array], langs: list[pa.Array], seed: int) -> list:
    """A chunk's columns: its different (language, word) with counts, its texts as places in them (0 breaks a piece), and sampled phrases."""
    words, text, fresh = words_of(pa.concat_arrays([t.cast(pa.large_string()) for t in texts]))
    lang_codes = pc.fill_null(pa.concat_arrays(langs), UNKNOWN_LANG).dictionary_encode()
    word_codes = words.dictionary_encode()
    code = np.asarray(word_codes.indices).astype(np.int64)
    names = len(word_codes.dictionary)
    both = np.asarray(lang_codes.indices).astype(np.int64)[text] * max(1, names) + code
    distinct, local, counts = np.unique(both, return_inverse=True, return_counts=True)
    # A break comes before each piece but the first.
    place = np.arange(len(local)) + np.cumsum(fresh)
    stream = np.zeros(len(local) + int(fresh.sum()), np.uint32)
    stream[place] = local + 1
    lang_of, word_of = pa.array(distinct // max(1, names)), pa.array(distinct % max(1, names))
    langs_out, words_out = lang_codes.dictionary.take(lang_of), word_codes.dictionary.take(word_of).cast(pa.string())
    at = np.random.default_rng(seed).integers(0, max(1, len(stream)), CHUNK_SAMPLE)
    sampled = [stream[a : a + 3].tolist() for a in at]
    # Half of the keys are pairs, half are triples.
    sampled = [s[: 2 + i % 2] for i, s in enumerate(sampled) if len(s) == 3 and all(s[: 2 + i % 2])]
    spoken = lambda p: None if p is None else words_out[p - 1].as_py()
    sample = [{"lang": langs_out[s[0] - 1].as_py(), "w1": spoken(s[0]), "w2": spoken(s[1]), "w3": spoken(s[2] if len(s) == 3 else None)} for s in sampled]
    packed = pa.compress(stream.tobytes(), "zstd", asbytes=True)
    return [key, langs_out.to_pylist(), words_out.to_pylist(), counts.tolist(), len(stream) * 4, packed, sample]


_CHUNK_SCHEMA = pa.schema([
    ("chunk", pa.int64()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("n_bytes", pa.int64()), ("stream", pa.binary()),
    ("sample", pa.list_(pa.struct([("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string())]))),
])


def chunks_of(docs: DataFrame) -> DataFrame:
    """Texts in chunks, see ``_chunk``."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, made = TaskContext.get().partitionId() << 32, 0
        texts, langs, held = [], [], 0
        for batch in batches:
            sizes = np.append(0, np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0)) + 1))
            begin = 0
            while begin < len(batch):
                upto = max(begin + 1, int(np.searchsorted(sizes, sizes[begin] + CHUNK_BYTES - held, "right")) - 1)
                texts.append(batch.column("text").slice(begin, upto - begin))
                langs.append(batch.column("lang").slice(begin, upto - begin))
                held += int(sizes[upto] - sizes[begin])
                begin = upto
                if held >= CHUNK_BYTES or begin < len(batch):
                    yield _row(_chunk(first + made, texts, langs, made))
                    texts, langs, held, made = [], [], 0, made + 1
        if texts:
            yield _row(_chunk(first + made, texts, langs, made))

    return docs.select("text", "lang").mapInArrow(run, "chunk long, langs array<string>, words array<string>, counts array<long>, n_bytes long, stream binary, sample array<struct<lang:string,w1:string,w2:string,w3:string>>")


def _row(values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _CHUNK_SCHEMA, strict=True)], schema=_CHUNK_SCHEMA)


def dictionary_of(counts: DataFrame) -> DataFrame:
    """Words (lang, word, f) numbered from 1 in the order of language and word.

    Rows are dealt by range once and written with their part; numbers are a part's first number and a place in the part.
    Only the parts' sizes reach the driver.
    """
    spark = counts.sparkSession
    dealt = written(counts.repartitionByRange("lang", "word").withColumn("part", F.spark_partition_id()), "dictionary")
    sizes = sorted((r.part, r["count"]) for r in dealt.groupBy("part").count().collect())
    if not sizes:
        return dealt.select("lang", "word", "f", F.lit(0).cast("long").alias("id"))
    first = np.append(0, np.cumsum([n for _, n in sizes]))[:-1].tolist()
    starts = spark.createDataFrame(list(zip([p for p, _ in sizes], first, strict=True)), "part int, first long")
    place = F.row_number().over(Window.partitionBy("part").orderBy("lang", "word"))
    return written(dealt.join(F.broadcast(starts), "part").select("lang", "word", "f", (F.col("first") + place).alias("id")), "numbered")


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The order of fixed-width binary keys: stable counting sorts by digits of 16 bits, the last digit first; digits that are all equal are skipped."""
    digits = np.ascontiguousarray(keys, ">u4").view(">u2").reshape(len(keys), -1)
    order = np.arange(len(keys))
    for d in range(digits.shape[1] - 1, -1, -1):
        digit = digits[:, d].astype(np.uint16)
        if len(digit) and (digit != digit[0]).any():
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = radix_order(keys)
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
    return keys[heads], np.add.reduceat(counts, heads)


def phrase_keys(ids: np.ndarray) -> np.ndarray:
    """The keys of all pairs and triples of a stream of word numbers, in which 0 ends a run."""
    big = ids.astype(">u4")
    pair = (ids[:-1] > 0) & (ids[1:] > 0)
    triple = pair[:-1] & (ids[2:] > 0)
    first, then = np.flatnonzero(pair), np.flatnonzero(triple)
    keys = np.zeros((len(first) + len(then), KEY_WORDS), ">u4")
    keys[: len(first), 0], keys[: len(first), 1] = big[first], big[first + 1]
    keys[len(first) :, 0], keys[len(first) :, 1], keys[len(first) :, 2] = big[then], big[then + 1], big[then + 2]
    return keys


def _comparable(keys: np.ndarray) -> np.ndarray:
    """Keys as byte strings, which numpy compares in order."""
    return np.ascontiguousarray(keys, ">u4").view(f"S{4 * KEY_WORDS}").ravel()


def counted_phrases(encoded: DataFrame, splits: np.ndarray, buckets: int, least: int) -> DataFrame:
    """Phrases with at least so many occurrences: w1, w2, w3 (0 for pairs), f.

    ``encoded`` has a chunk's stream and the numbers of its words. Keys go to the range between two splits, and within it to
    one of some buckets, so that a range never holds more than a task can sort, however large the table.
    """
    edges = _comparable(splits) if len(splits) else np.zeros(0, f"S{4 * KEY_WORDS}")

    @tidy
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                stream = np.frombuffer(pa.decompress(batch.column("stream")[i].as_buffer(), batch.column("n_bytes")[i].as_py(), "zstd"), np.uint32)
                places, ids = (np.asarray(batch.column(c)[i].values) for c in ("places", "ids"))
                number = np.zeros(max(int(stream.max(initial=0)), int(places.max(initial=0))) + 1, np.uint32)
                number[places] = ids
                keys = phrase_keys(number[stream])
                keys, counts = run_counts(keys, np.ones(len(keys), np.int64))
                mixed = (keys.astype(np.uint64) * np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)).sum(axis=1) >> np.uint64(7)
                where = np.searchsorted(edges, _comparable(keys), "right") * buckets + (mixed % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(where, kind="stable")
                cuts = np.flatnonzero(np.diff(where[order], prepend=-1))
                for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
                    part = order[a:b]
                    # By columns: sorted first words and counts of one take next to no room in a shuffle.
                    yield pa.RecordBatch.from_arrays([pa.array([where[part[0]]]), pa.array([keys[part].T.astype(">u4").tobytes()], pa.binary()), pa.array([counts[part].astype(np.uint32).tobytes()], pa.binary())], ["range", "keys", "counts"])

    def finished(number: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        kept = counts >= least
        columns = [keys[kept, w].astype(np.int64) for w in range(KEY_WORDS)]
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(counts[kept])], ["w1", "w2", "w3", "f"])

    @tidy
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = None, [], 0

        def folded() -> tuple[np.ndarray, np.ndarray]:
            return run_counts(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))

        for batch in batches:
            for r, k, c in zip(batch.column("range").to_pylist(), batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                if r != number and held:
                    yield finished(number, *folded())
                    held, size = [], 0
                number = r
                counts = np.frombuffer(c, np.uint32).astype(np.int64)
                held.append((np.ascontiguousarray(np.frombuffer(k, ">u4").reshape(KEY_WORDS, -1).T), counts))
                size += len(counts)
                if size > RANGE_KEYS:  # a key that many chunks have is kept once
                    held = [folded()]
                    size = len(held[0][1]) // 2
        if held:
            yield finished(number, *folded())

    blobs = encoded.mapInArrow(spread, "range long, keys binary, counts binary")
    return blobs.repartition(F.col("range")).sortWithinPartitions("range").mapInArrow(merge, "w1 long, w2 long, w3 long, f long")


def floor_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact for counts below 10^15."""
    wide = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(left) * wide(right)).cast("long")


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts that are null or hold no word add nothing; a null ``lang`` is ``und``, together with rows that say so. Repeated
    rows count as often as they come. Columns besides ``text`` and ``lang`` aren't looked at. An empty table has no phrases.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    chunks = written(chunks_of(docs), "chunks")
    known = chunks.select("chunk", F.explode(F.arrays_zip("langs", "words", "counts", F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1))).alias("places"))).alias("w"))
    known = known.select("chunk", F.col("w.langs").alias("lang"), F.col("w.words").alias("word"), F.col("w.counts").alias("c"), F.col("w.places").alias("place")).where("word IS NOT NULL")
    totals = known.groupBy("lang").agg(F.sum("c").alias("n"))
    numbers = dictionary_of(known.groupBy("lang", "word").agg(F.sum("c").alias("f")).where(F.col("f") >= least))

    own = known.join(numbers.select("lang", "word", "id"), ["lang", "word"]).groupBy("chunk").agg(F.collect_list(F.struct("place", "id")).alias("own"))
    encoded = chunks.select("chunk", "n_bytes", "stream").join(own, "chunk").select("n_bytes", "stream", F.col("own.place").alias("places"), F.col("own.id").alias("ids"))

    sampled = chunks.select(F.explode("sample").alias("s")).select("s.*").withColumn("r", F.xxhash64("w1", "w2", "w3", F.monotonically_increasing_id())).orderBy("r").limit(SAMPLE)
    for w in ("w1", "w2", "w3"):
        sampled = sampled.join(numbers.select("lang", F.col("word").alias(w), F.col("id").alias(f"id_{w}")), ["lang", w], "left")
    found = sampled.where("id_w1 IS NOT NULL AND id_w2 IS NOT NULL AND (w3 IS NULL OR id_w3 IS NOT NULL)").select("id_w1", "id_w2", F.coalesce("id_w3", F.lit(0))).collect()
    ordered = sorted(tuple(r) for r in found)
    occurrences = 2 * int(numbers.agg(F.sum("f")).first()[0] or 0)
    ranges = min(max(1, -(-occurrences // RANGE_KEYS)), max(1, len(ordered) // 4))
    picked = sorted({ordered[len(ordered) * i // ranges] for i in range(1, ranges)}) if ordered else []
    splits = np.array(picked, ">u4").reshape(-1, KEY_WORDS)
    buckets = max(1, -(-occurrences // (RANGE_KEYS * ranges)))
    phrases = written(counted_phrases(encoded, splits, buckets, least), "phrases")
    return ranked(scored(phrases, numbers, share), totals, top)


def scored(phrases: DataFrame, numbers: DataFrame, share: int) -> DataFrame:
    """Phrases that no longer one replaces, as lang, phrase, a, l, r, score of their weakest cut."""
    pairs, triples = phrases.where("w3 = 0"), phrases.where("w3 > 0")
    single = lambda w, *names: numbers.select(F.col("id").alias(w), *(F.col(a).alias(b) for a, b in names))

    # A pair goes if a frequent triple that begins or ends with it has the given share of its count.
    longer = triples.select("w1", "w2", "f").unionAll(triples.select("w2", "w3", "f")).groupBy("w1", "w2").agg(F.max("f").alias("longer"))
    kept = pairs.join(longer, ["w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("f")))
    two = kept.join(single("w1", ("lang", "lang"), ("word", "t1"), ("f", "l")), "w1").join(single("w2", ("word", "t2"), ("f", "r")), "w2")
    two = two.select("lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), F.col("f").alias("a"), "l", "r").withColumn("score", floor_score(F.col("a"), F.col("l"), F.col("r")))

    joined = (
        triples.join(pairs.select("w1", "w2", F.col("f").alias("f12")), ["w1", "w2"]).join(pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23")), ["w2", "w3"])
        .join(single("w1", ("lang", "lang"), ("word", "t1"), ("f", "f1")), "w1").join(single("w2", ("word", "t2")), "w2").join(single("w3", ("word", "t3"), ("f", "f3")), "w3")
    )
    cuts = [F.struct(floor_score(F.col("f"), F.col(a), F.col(b)).alias("score"), F.lit(k).alias("k"), F.col(a).alias("l"), F.col(b).alias("r")) for k, a, b in ((1, "f1", "f23"), (2, "f12", "f3"))]
    three = joined.withColumn("cut", F.least(*cuts)).select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
    return two.unionByName(three)


def ranked(found: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """Each language's first phrases. A language's parts are ranked first, so that few of its rows meet in one task."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    best = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), spoken AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
), placed AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM spoken WHERE len(ws) > 0
), grams AS (
  SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3 FROM placed
), n AS (
  SELECT lang, count(*) AS n FROM grams GROUP BY lang
), f1 AS (
  SELECT lang, w1, count(*) AS f FROM grams GROUP BY lang, w1
), f2 AS (
  SELECT lang, w1, w2, count(*) AS f FROM grams WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 10
), f3 AS (
  SELECT lang, w1, w2, w3, count(*) AS f FROM grams WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10
), longer AS (
  SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY lang, w1, w2
), two AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * p.f * p.f) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f1 y ON y.lang = p.lang AND y.w1 = p.w2
  LEFT JOIN longer g ON g.lang = p.lang AND g.w1 = p.w1 AND g.w2 = p.w2
  WHERE g.f IS NULL OR 100 * g.f < 50 * p.f
), cuts AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3 AS phrase, p.f AS a, x.f AS x, yz.f AS yz, xy.f AS xy, z.f AS z,
         CAST((1000000::HUGEINT * p.f * p.f) // (x.f::HUGEINT * yz.f) AS BIGINT) AS s1, CAST((1000000::HUGEINT * p.f * p.f) // (xy.f::HUGEINT * z.f) AS BIGINT) AS s2
  FROM f3 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f2 yz ON yz.lang = p.lang AND yz.w1 = p.w2 AND yz.w2 = p.w3
  JOIN f2 xy ON xy.lang = p.lang AND xy.w1 = p.w1 AND xy.w2 = p.w2 JOIN f1 z ON z.lang = p.lang AND z.w1 = p.w3
), every AS (
  SELECT lang, phrase, a, l, r, score FROM two
  UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN x ELSE xy END, CASE WHEN s1 <= s2 THEN yz ELSE z END, least(s1, s2) FROM cuts
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM every
)
SELECT o.lang, o.rank, o.phrase, o.a, o.l, o.r, n.n, o.score FROM ordered o JOIN n ON n.lang = o.lang WHERE o.rank <= 2000
"""
