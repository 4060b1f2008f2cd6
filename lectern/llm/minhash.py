"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A text is a sequence of five-word shingles, each labelled with its occurrence number, so that a repeated shingle counts as
often as it comes. For each of several hash functions, Order MinHash takes the few shingles with the least
values and keeps them in text order; a hash of that little sequence is one entry of the sketch. Texts of small edit
distance agree in many entries, reordered ones don't.

Texts that share an entry are candidates. Buckets are read in sorted order in bounded chunks; in a chunk each text is paired with the few that
agree with it in most entries and with the chunk's most central text, so that a bucket gives a number of pairs
in proportion to its size. A pair is verified by an alignment of the two shingle sequences within the band of diagonals
that the threshold leaves. Verified pairs are contracted to classes, and texts of one bucket that are
still in different classes are paired and verified again.

An exact pass then finds every link between classes that the sketches missed. Aligned similarity is at most the Jaccard similarity of the labelled
shingles, so similar texts share one of the first shingles of each in an order that all texts have in common, rare ones first.
Few texts with such a shingle are joined and verified; where many have it, their groups are compared in salted blocks, each by counts
of common shingles and then by alignment, and a block gives at most one link for each text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.bpe import slices
from lectern.llm.common import TOKEN_BYTES, bound_batches, checkpoint, narrow, read_table, tasks_for, tidy
from lectern.llm.components import connected_components
from lectern.llm.tokens import TokenBatch

#: Words of a shingle and the least similarity of near duplicates: aligned shingles / all different shingles of the two.
WORDS, SIMILARITY = 5, 0.8
#: Entries of a sketch and shingles of an entry.
ENTRIES, PER_ENTRY = 10, 3
#: Texts of a bucket that are compared by sketch at once, and partners that each text gets among them.
CHUNK, PARTNERS = 512, 3
#: Rounds of pairing and verifying.
ROUNDS = 2
#: One of so many texts brings the frequencies by which shingles are ordered, and most shingles that are known as frequent (16 bytes each). They change the cost of the exact pass, not what it finds.
ORDER_SHARE, FREQUENT = 8, 1 << 20
#: A shingle that begins more texts than this has them compared in blocks, of about so many texts and shingles.
LIGHT, BLOCK_TEXTS, BLOCK_SHINGLES = 64, 1024, 1 << 18
#: Blocks whose parity maps are compared in one task.
MAP_BLOCKS = 16
#: Keys of at most so many texts are broadcast to where the texts are read, so that texts aren't shuffled.
FEW_KEYS = 100_000
#: Least number of 64-bit words of a text's parity map; a long text's has as many bits as it has shingles, or up to twice as many.
MAP_WORDS = 8
#: Keeps thresholds that floats miss by a hair.
HAIR = 1e-9
SEED = 11
#: Stands for a null id in joins.
NO_ID = -(1 << 63)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15))
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX[0]
    x = (x ^ (x >> np.uint64(33))) * _MIX[1]
    return x ^ (x >> np.uint64(33))


def labelled_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' labelled shingles, one text after another, and where each text begins (one entry more than texts).

    A text of one to four words is one shingle; null and empty texts have none.
    """
    batch = TokenBatch(texts)
    names = np.fromiter((xxhash.xxh3_64_intdigest(n) for n in batch.names), np.uint64, len(batch.names))
    h = names[batch.code] if len(batch.code) else np.zeros(0, np.uint64)
    counts = np.where(batch.counts == 0, 0, np.maximum(batch.counts - WORDS + 1, 1))
    starts = np.append(0, np.cumsum(counts))
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.repeat(batch.offsets[:-1], counts) + np.arange(len(doc)) - np.repeat(starts[:-1], counts)
    last = np.repeat(batch.offsets[1:], counts)
    out = np.zeros(len(doc), np.uint64)
    padded = np.append(h, np.zeros(WORDS, np.uint64))
    for i in range(WORDS):
        word = np.where(first + i < last, padded[np.minimum(first + i, len(h))], np.uint64(1))
        out = (out ^ (out >> np.uint64(29))) * _MIX[2] + word
    # Number the occurrences of equal shingles of a text from the left.
    keyed = mix(out ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keyed, kind="stable")
    ordered = keyed[order]
    new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    label = np.empty(len(order), np.uint64)
    label[order] = (np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))).astype(np.uint64)
    return mix(out + label * _MIX[1]), starts


def order_min_hash(shingles: np.ndarray, starts: np.ndarray, entries: int = ENTRIES, per_entry: int = PER_ENTRY, seed: int = SEED) -> np.ndarray:
    """The sketch of each text as int64 (texts, entries). Texts without shingles have zeros."""
    out = np.zeros((len(starts) - 1, entries), np.int64)
    counts = np.diff(starts)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n, begin = counts[full], starts[:-1][full]
    odd = np.random.default_rng(seed).integers(1, 1 << 63, entries, dtype=np.uint64) | np.uint64(1)
    last = np.uint64(len(shingles))
    for j in range(entries):
        x = shingles * odd[j]
        x ^= x >> np.uint64(32)
        x *= _MIX[0]
        found = np.full((per_entry, len(full)), len(shingles), np.int64)
        for i in range(per_entry):
            least = np.minimum.reduceat(x, begin)
            at = np.flatnonzero((x == np.repeat(least, n)) & (x != _TOP))
            owner = np.searchsorted(begin, at, side="right") - 1
            owner, one = np.unique(owner, return_index=True)
            found[i, owner] = at[one]
            x[at[one]] = _TOP
        found.sort(axis=0)  # text order
        key = np.full(len(full), np.uint64(j + 1))
        for row in found:
            key = mix(key * _MIX[2] + np.where(row < last, shingles[np.minimum(row, len(shingles) - 1)], np.uint64(0)))
        out[full, j] = key.view(np.int64)
    return out


def parity_maps(shingles: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    """For each text, which hash values an odd number of its shingles have, as bits of a list of int64 whose length is a power of two.

    Two maps of one length differ in at most as many bits as there are shingles that only one of the texts has;
    a map of half the length is the exclusive or of the two halves.
    """
    n = np.diff(starts)
    words = MAP_WORDS << np.maximum(np.ceil(np.log2(np.maximum(n, 1) / (64 * MAP_WORDS))), 0).astype(np.int64)
    begin = np.append(0, np.cumsum(words))
    out = np.zeros(begin[-1], np.uint64)
    hashed = mix(shingles)
    word = (hashed >> np.uint64(6)).astype(np.uint64) % np.repeat(words, n).astype(np.uint64)
    np.bitwise_xor.at(out, np.repeat(begin[:-1], n) + word.astype(np.int64), np.uint64(1) << (hashed & np.uint64(63)))
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(out.view(np.int64)))


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def keyed_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, text) of each row; null ids are ``NO_ID``, null texts empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.unhex(F.md5(text)).alias("text_key"), text.alias("text"))


def one_copy(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str, tasks: int | None = None) -> DataFrame:
    """(text_key, text, ...) once for each row of ``wanted`` (id, text_key, ...), which names a distinct text by its least id, so that copies stay where they are read."""
    wanted = narrow(checkpoint(narrow(wanted.withColumn("id", F.coalesce("id", F.lit(NO_ID))), tasks)), tasks)
    few = wanted.count() <= FEW_KEYS
    found = keyed_texts(df, id_col, text_col).join(F.broadcast(wanted) if few else wanted, ["id", "text_key"]).drop("id")
    return narrow(narrow(found, tasks).dropDuplicates(["text_key"]), tasks)


def sketches(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each distinct text: text_key (its MD5), the least id that has it, its number of shingles ``n``, sketch and parity map. Nulls count as empty, null ids come last."""
    bound_batches(df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.unhex(F.md5(text)).alias("text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", TOKEN_BYTES):
                shingles, starts = labelled_shingles(batch.column("text"))
                columns = [pa.array(np.diff(starts).astype(np.int32)), _lists(order_min_hash(shingles, starts)), parity_maps(shingles, starts)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_key"), *columns], names=["id", "text_key", "n", "sketch", "parity"])

    found = rows.mapInArrow(tidy(run), "id long, text_key binary, n int, sketch array<long>, parity array<long>")
    return found.groupBy("text_key").agg(F.min("id").alias("id"), *(F.min(c).alias(c) for c in ("n", "sketch", "parity")))


def may_be_similar(pairs: DataFrame, nodes: DataFrame, similarity: float, tasks: int | None = None) -> DataFrame:
    """The pairs (a, b) of ``num`` whose parity maps don't rule out that they are similar enough, as text keys (a, b)."""
    side = lambda c: nodes.select(F.col("num").alias(c), F.col("text_key").alias(f"key_{c}"), F.col("n").alias(f"n_{c}"), F.col("parity").alias(f"parity_{c}"))
    half = lambda c: (F.size(c) / 2).cast("int")
    folded = lambda c, other: F.when(F.size(c) > F.size(other), F.zip_with(F.slice(c, 1, half(c)), F.slice(c, half(c) + 1, half(c)), lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(c))
    # Texts of like lengths have maps of one length, or one of half the other's.
    differ = F.aggregate(F.zip_with(folded("parity_a", "parity_b"), folded("parity_b", "parity_a"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)
    most = (F.col("n_a") + F.col("n_b")) * ((1 - similarity) / (1 + similarity)) + HAIR
    return narrow(narrow(pairs.join(side("a"), "a"), tasks).join(side("b"), "b"), tasks).where((F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b") - HAIR) & (differ <= most)).select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))


def bucket_rows(nodes: DataFrame, tasks: int | None = None) -> DataFrame:
    """(key, text_key, sketch) for each sketch entry that several texts have."""
    keyed = nodes.where(F.exists("sketch", lambda x: x != 0)).select("text_key", F.explode("sketch").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return narrow(narrow(keyed.join(shared, "key"), tasks).join(nodes.select("text_key", "sketch"), "text_key"), tasks).select("key", "text_key", "sketch")


def chunk_pairs(sketch: np.ndarray, classes: np.ndarray | None, partners: int = PARTNERS) -> tuple[set[tuple[int, int]], int]:
    """Pairs of rows of a chunk, and its most central row: each row with the rows that agree with it in most entries, and with the most central row. With classes, only pairs across them."""
    agree = np.zeros((len(sketch), len(sketch)), np.int16)
    for j in range(sketch.shape[1]):
        agree += sketch[:, j, None] == sketch[None, :, j]
    np.fill_diagonal(agree, -1)
    central = agree.sum(axis=1)
    if classes is not None:
        agree[classes[:, None] == classes[None, :]] = -1
    rank = agree.astype(np.float64) + central / (abs(central).max() + 1.0)
    rank[agree < 0] = -1
    top = min(partners, len(sketch) - 1)
    best = np.argpartition(-rank, top - 1, axis=1)[:, :top]
    out = {(min(i, j), max(i, j)) for i, row in enumerate(best.tolist()) for j in row if agree[i, j] >= 0}
    centre = int(np.argmax(central))
    return out | {(min(i, centre), max(i, centre)) for i in range(len(sketch)) if i != centre and agree[i, centre] >= 0}, centre


def candidate_pairs(buckets: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Distinct pairs (a, b) of text keys, a < b. ``buckets`` may have a ``class`` column; then only pairs across classes come.

    Rows are dealt by ranges of (key, following entries, text), so that a bucket of any size is spread over tasks and texts that agree further
    stand together; each task reads its rows in chunks of one bucket, and a chunk's central text is also compared in the task's next chunk of that bucket.
    Partners in chunks further apart or in other tasks don't meet here; ``missed_links`` finds them.
    """
    with_class = "class" in buckets.columns
    following = [F.element_at("sketch", F.pmod(F.array_position("sketch", F.col("key")) + i, F.lit(ENTRIES)).cast("int") + 1).alias(f"o{i}") for i in (0, 1)]
    columns = ["key", "o0", "o1", "text_key"]
    rows = buckets.select("key", *following, "text_key", "sketch", *(["class"] if with_class else []))
    dealt = rows.repartitionByRange(*columns).sortWithinPartitions(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None

        def take(batch: pa.RecordBatch, final: bool) -> tuple[pa.RecordBatch, pa.RecordBatch | None]:
            """Pairs of the batch's chunks, and the rows of its last bucket, of which more may come."""
            key = batch.column("key").to_numpy()
            sketch = batch.column("sketch").flatten().to_numpy().reshape(len(key), -1)
            names = batch.column("text_key").to_pylist()
            classes = np.unique(np.array(batch.column("class").to_pylist(), dtype=object), return_inverse=True)[1] if with_class else None
            cuts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
            found: set[tuple[bytes, bytes]] = set()
            left = None
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                centre = None
                for at in range(a, b, chunk):
                    # The central row of the chunk before stands in for its texts.
                    some = ([centre] if centre is not None else []) + list(range(at, min(at + chunk, b)))
                    if b == len(key) and not final and b - at < chunk:
                        left = batch.take(pa.array(some))
                        centre = None
                        break
                    if len(some) > 1:
                        pairs, middle = chunk_pairs(sketch[some], classes[some] if classes is not None else None)
                        found.update((min(names[some[i]], names[some[j]]), max(names[some[i]], names[some[j]])) for i, j in pairs)
                        centre = some[middle]
                if b == len(key) and not final and centre is not None:
                    left = batch.slice(centre, 1)
            a, b = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"]), left

        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            out, rest = take(batch, False)
            yield out
        if rest is not None:
            yield take(rest, True)[0]

    return dealt.mapInArrow(tidy(run), "a binary, b binary").distinct()


def aligned(x: np.ndarray, y: np.ndarray, similarity: float) -> float:
    """Similarity of two sequences of labelled shingles by their longest banded alignment; 0 as soon as it can't reach ``similarity``.

    Labels make matches one to one, so the alignment is the longest rising run of matched positions.
    """
    n = len(x) + len(y)
    if not n:
        return 1.0
    if min(len(x), len(y)) < similarity * max(len(x), len(y)) - HAIR:
        return 0.0
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    band = int(n * (1 - similarity) / (1 + similarity) + HAIR)
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if len(i) < similarity * (n - len(i)) - HAIR:
        return 0.0
    j = j[np.argsort(i)]
    length = len(j)
    if (np.diff(j) < 0).any():
        tails: list[int] = []
        for at in j.tolist():
            k = bisect_left(tails, at)
            if k == len(tails):
                tails.append(at)
            else:
                tails[k] = at
        length = len(tails)
    return length / (n - length)


def verify(pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v, similarity) of the pairs (a, b, text_a, text_b) that are similar enough."""
    bound_batches(pairs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text_a", TOKEN_BYTES):
                if not batch.num_rows:
                    continue
                both = pc.fill_null(pa.concat_arrays([batch.column("text_a"), batch.column("text_b")]), "")
                coded = both.dictionary_encode()
                shingles, starts = labelled_shingles(coded.dictionary)
                code = coded.indices.to_numpy()
                of = lambda i: shingles[starts[code[i]] : starts[code[i] + 1]]  # noqa: E731, B023
                score = np.array([aligned(of(i), of(i + batch.num_rows), similarity) for i in range(batch.num_rows)])
                good = pa.array(score >= similarity)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good), pa.array(score).filter(good)], names=["u", "v", "similarity"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(tidy(run), "u binary, v binary, similarity double")


def shingle_order(df: DataFrame, text_col: str, share: int = ORDER_SHARE, tasks: int | None = None) -> np.ndarray:
    """Frequent shingles, sorted by hash, as rows of (hash, count) in one of ``share`` texts. Any such table gives a right order; a good one makes prefixes rare.

    The share is of all texts, so that a shingle of a given frequency is known or not alike at every size. A task counts a text's copies once.
    """
    bound_batches(df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    some = df.select(text.alias("text")).withColumn("code", F.xxhash64("text", F.lit(SEED))).where(F.pmod("code", F.lit(share)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for batch in slices(whole, "text", TOKEN_BYTES):
                code = batch.column("code").to_pylist()
                new = [i for i, c in enumerate(code) if c not in seen and not seen.add(c)]
                texts = batch.column("text").take(pa.array(new, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(labelled_shingles(texts)[0].view(np.int64))], names=["token"])

    found = narrow(some.mapInArrow(tidy(run), "token long"), tasks).groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    counts = narrow(checkpoint(narrow(found, tasks)), tasks)
    # The least power of two whose shingles are few enough; there are at most 64 of them.
    sizes = {r["power"]: r["shingles"] for r in counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count(F.lit(1)).alias("shingles")).collect()}
    least = next(k for k in range(65) if sum(v for p, v in sizes.items() if p >= k) <= FREQUENT)
    top = counts.where(F.col("n") >= 1 << min(least, 62)).toArrow()  # at most FREQUENT rows
    table = np.column_stack([top.column("token").to_numpy(), top.column("n").to_numpy()]).astype(np.int64)
    return table[np.argsort(table[:, 0].view(np.uint64))]


def prefix_sizes(n: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Of texts with ``n`` shingles: how many first ones meet those of any similar text, and how many do if the other text is at least as long."""
    return tuple(np.minimum(n, n - np.ceil(share * n - HAIR).astype(np.int64) + 1) for share in (similarity, 2 * similarity / (1 + similarity)))


def prefix_rows(df: DataFrame, order: np.ndarray, text_col: str, similarity: float, tasks: int | None = None) -> DataFrame:
    """For each distinct text with shingles: text_key, n (its shingles), n_index and ``tokens``, its first shingles in the common order."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(order)
    text = F.coalesce(F.col(text_col), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = np.append(shared.value[:, 0].view(np.uint64), _TOP), np.append(shared.value[:, 1], 0)
        for whole in batches:
            for batch in slices(whole, "text", TOKEN_BYTES):
                shingles, starts = labelled_shingles(batch.column("text"))
                n = np.diff(starts)
                at = np.searchsorted(known, shingles)
                rank = np.where(known[np.minimum(at, len(known) - 1)] == shingles, counts[np.minimum(at, len(known) - 1)], 0)
                doc = np.repeat(np.arange(len(n)), n)
                ordered = shingles[np.lexsort((shingles, rank, doc))]
                probe, index = prefix_sizes(n, similarity)
                first = np.arange(len(doc)) - np.repeat(starts[:-1], n) < np.repeat(probe, n)
                tokens = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(probe)).astype(np.int32)), pa.array(ordered[first].view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("text_key"), pa.array(n.astype(np.int32)), pa.array(index.astype(np.int32)), tokens], names=["text_key", "n", "n_index", "tokens"])

    rows = df.select(text.alias("text"), F.unhex(F.md5(text)).alias("text_key"))
    return narrow(rows.mapInArrow(tidy(run), "text_key binary, n int, n_index int, tokens array<long>").where("n > 0"), tasks).dropDuplicates(["text_key"])


def block_links(num: np.ndarray, side: np.ndarray, classes: np.ndarray, shingles: np.ndarray, starts: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links across classes between the texts of two blocks (sides 0 and 1), or within one block if all have side 0; classes that a link joins count as one from then on."""
    n = np.diff(starts)
    _, code, times = np.unique(shingles, return_inverse=True, return_counts=True)
    dense = np.cumsum(times > 1) - 1
    held = times[code] > 1
    owner, code = np.repeat(np.arange(len(n)), n)[held], dense[code[held]]
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    common = np.zeros((len(left), len(right)), np.float32)
    by_code = np.argsort(code, kind="stable")
    owner, code = owner[by_code], code[by_code]
    width = 1024
    cuts = np.searchsorted(code, np.arange(0, (code[-1] if len(code) else -1) + 1 + width, width))
    for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        has = np.zeros((len(n), width), np.float32)
        has[owner[a:b], code[a:b] - k * width] = 1
        common += has[left] @ has[right].T
    near = common * (1 + similarity) >= similarity * (n[left][:, None] + n[right][None, :]) - 1e-3
    near &= classes[left][:, None] != classes[right][None, :]
    if not side.any():
        near &= np.arange(len(left))[:, None] < np.arange(len(left))[None, :]
    above = {int(c): int(c) for c in np.unique(classes)}

    def root(c: int) -> int:
        while above[c] != c:
            above[c] = above[above[c]]
            c = above[c]
        return c

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
        a, b = left[i], right[j]
        u, v = root(int(classes[a])), root(int(classes[b]))
        if u != v and aligned(shingles[starts[a] : starts[a + 1]], shingles[starts[b] : starts[b + 1]], similarity) >= similarity:
            above[u] = v
            out.append((int(num[a]), int(num[b])))
    return out


def map_partners(side: np.ndarray, classes: np.ndarray, n: np.ndarray, block: np.ndarray, maps: pa.ListArray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Texts of two groups of blocks (sides 0 and 1), or of one (all 0), and the blocks where each has a text of another class and the other side that parity maps don't rule out."""
    starts, words = maps.offsets.to_numpy() - maps.offsets[0].as_py(), maps.flatten().to_numpy().view(np.uint64)
    length = np.diff(starts)
    names, block = np.unique(block, return_inverse=True)
    reach = np.zeros((len(n), len(names)), bool)
    both = side.any()
    rows_of = lambda at: words[starts[at][:, None] + np.arange(length[at[0]])]
    for w in np.unique(length).tolist():
        same, twice = np.flatnonzero(length == w), np.flatnonzero(length == 2 * w)
        folded = rows_of(same)
        others = [(same, folded)]
        if len(twice):
            double = rows_of(twice)
            others.append((twice, double[:, :w] ^ double[:, w:]))
        for other, of_other in others:
            for at in range(0, len(same), 256):
                a = same[at : at + 256]
                differ = np.zeros((len(a), len(other)), np.int32)
                for k in range(w):
                    differ += np.bitwise_count(folded[at : at + 256, k, None] ^ of_other[None, :, k])
                near = differ <= (n[a][:, None] + n[other][None, :]) * ((1 - similarity) / (1 + similarity)) + HAIR
                near &= classes[a][:, None] != classes[other][None, :]
                if both:
                    near &= side[a][:, None] != side[other][None, :]
                i, j = np.nonzero(near)
                reach[a[i], block[other[j]]] = True
                reach[other[j], block[a[i]]] = True
    text, partner = np.nonzero(reach)
    return text, names[partner]


def crowded_links(df: DataFrame, rows: DataFrame, nodes: DataFrame, id_col: str, text_col: str, similarity: float, tasks: int | None = None) -> DataFrame:
    """Links (u, v) by number among texts of crowded shingles: ``rows`` has token, num, class and n, ``nodes`` num, id and text_key.

    Texts that crowded shingles connect are one group; its texts are dealt to blocks by hash, and each two blocks are compared in a task of their own:
    first by parity maps, which leave the texts that may have a partner there, and then those texts by their shingles.
    """
    bound_batches(df.sparkSession)
    # A shingle's least text stands for it, so that only texts are nodes.
    least = F.min("num").over(Window.partitionBy("token"))
    groups = connected_components(rows.select(F.col("num").alias("u"), least.alias("v")), tasks)
    members = rows.select("num", "class", "n").distinct().join(groups.select(F.col("node").alias("num"), F.col("component").alias("cluster")), "num").join(nodes.select("num", "id", "text_key", "parity"), "num")
    members = narrow(checkpoint(narrow(members, tasks)), tasks)
    sizes = members.groupBy("cluster").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_TEXTS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    members = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("num"), F.col("blocks")).cast("int"))
    members = narrow(checkpoint(narrow(members, tasks)), tasks)
    # Maps are small, so many blocks' maps meet in one task.
    mine, groups_of = F.floor(F.col("block") / MAP_BLOCKS), F.floor((F.col("blocks") - 1) / MAP_BLOCKS)
    dealt = members.select("num", "class", "n", "parity", "cluster", "block", mine.alias("mine"), F.explode(F.sequence(F.lit(0).cast("long"), groups_of)).alias("other")).select(
        "num", "class", "n", "parity", "cluster", "block", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).cast("int").alias("side"),
    )

    def alone(table: pa.Table) -> bool:
        side = table.column("side").to_numpy()
        return table.column("i")[0].as_py() < table.column("j")[0].as_py() and bool((side == side[0]).all())

    def flag(table: pa.Table) -> pa.Table:
        column = lambda c: table.column(c).combine_chunks()
        block = column("block").to_numpy()
        none = np.zeros(0, np.int64)
        text, partner = (none, none.astype(np.int32)) if alone(table) else map_partners(column("side").to_numpy(), column("class").to_numpy(), column("n").to_numpy(), block, column("parity"), similarity)
        rows = table.select(["cluster", "num"]).take(pa.array(text))
        own = block[text]
        return rows.append_column("i", pa.array(np.minimum(own, partner))).append_column("j", pa.array(np.maximum(own, partner))).append_column("side", pa.array((own > partner).astype(np.int32)))

    flagged = narrow(checkpoint(dealt.groupBy("cluster", "i", "j").applyInArrow(flag, "cluster long, num long, i int, j int, side int")), tasks)
    source = one_copy(df, members.join(flagged.select("num").distinct(), "num", "left_semi").select("id", "text_key", "num", "class"), id_col, text_col, tasks)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", TOKEN_BYTES):
                shingles, starts = labelled_shingles(batch.column("text"))
                column = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(shingles.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("num"), batch.column("class"), column], names=["num", "class", "shingles"])

    pairs = source.mapInArrow(tidy(read), "num long, class long, shingles array<long>").join(flagged, "num").select("num", "class", "shingles", "cluster", "i", "j", "side")
    pairs = narrow(pairs, tasks)

    def compare(table: pa.Table) -> pa.Table:
        column = lambda c: table.column(c).combine_chunks()
        lists = column("shingles")
        starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        side = column("side").to_numpy()
        found = [] if alone(table) else block_links(column("num").to_numpy(), side, column("class").to_numpy(), lists.flatten().to_numpy().view(np.uint64), starts, similarity)
        u, v = zip(*found, strict=True) if found else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return pairs.groupBy("cluster", "i", "j").applyInArrow(compare, "u long, v long")


def missed_links(df: DataFrame, nodes: DataFrame, classes: DataFrame, id_col: str, text_col: str, similarity: float, tasks: int | None = None) -> DataFrame:
    """Links (u, v) by text key that join all classes between which any pair of texts is similar enough.

    ``nodes`` has the columns of ``sketches`` and num, ``classes`` node and component by text key; texts without a row there are classes of their own.
    """
    order = shingle_order(df, text_col, tasks=tasks)
    numbers = nodes.select("text_key", "num")
    of_class = narrow(classes.select(F.col("node").alias("text_key"), "component").join(numbers.select(F.col("text_key").alias("component"), F.col("num").alias("class")), "component"), tasks).select("text_key", "class")
    known = numbers.join(of_class, "text_key", "left").select("text_key", "num", F.coalesce("class", "num").alias("class"))
    texts = narrow(prefix_rows(df, order, text_col, similarity, tasks).join(known, "text_key"), tasks)
    rows = texts.select("num", "class", "n", "n_index", F.posexplode("tokens").alias("at", "token")).select("token", "num", "class", "n", (F.col("at") < F.col("n_index")).alias("index"))
    # A window needs one shuffle of the rows, a grouping and a join two.
    alike = Window.partitionBy("token")
    rows = rows.withColumns({"texts": F.count(F.lit(1)).over(alike), "lo": F.min("class").over(alike), "hi": F.max("class").over(alike)})
    rows = narrow(checkpoint(narrow(rows.where("texts > 1 AND lo <> hi").drop("lo", "hi"), tasks)), tasks)
    light, crowded = rows.where(F.col("texts") <= LIGHT), rows.where(F.col("texts") > LIGHT)
    longer = (F.col("y.n") > F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.num") > F.col("x.num")))
    pairs = (
        light.where("index").alias("x").join(light.alias("y"), "token")
        .where((F.col("x.class") != F.col("y.class")) & longer & (F.col("x.n") >= similarity * F.col("y.n") - HAIR))
        .select(F.col("x.num").alias("a"), F.col("y.num").alias("b")).distinct()
    )
    keyed = lambda p, x, y: p.join(numbers.select(F.col("num").alias(x), F.col("text_key").alias("u")), x).join(numbers.select(F.col("num").alias(y), F.col("text_key").alias("v")), y).select("u", "v")
    pairs = narrow(checkpoint(may_be_similar(narrow(pairs, tasks), nodes, similarity, tasks)), tasks)
    ends = pairs.select(F.col("a").alias("text_key")).unionByName(pairs.select(F.col("b").alias("text_key"))).distinct()
    texts_of = narrow(checkpoint(one_copy(df, ends.join(nodes.select("id", "text_key"), "text_key"), id_col, text_col, tasks)), tasks)
    found = verify(with_texts(pairs, texts_of, tasks), similarity).select("u", "v")
    if not crowded.isEmpty():
        found = found.unionByName(narrow(keyed(narrow(crowded_links(df, crowded, nodes, id_col, text_col, similarity, tasks), tasks).toDF("a", "b"), "a", "b"), tasks))
    return narrow(checkpoint(found), tasks)


def with_texts(pairs: DataFrame, texts: DataFrame, tasks: int | None = None) -> DataFrame:
    """The pairs (a, b) with text_a and text_b."""
    first = narrow(pairs.join(texts.select(F.col("text_key").alias("a"), F.col("text").alias("text_a")), "a"), tasks)
    return narrow(first.join(texts.select(F.col("text_key").alias("b"), F.col("text").alias("text_b")), "b"), tasks)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, rounds: int = ROUNDS) -> DataFrame:
    """One row for each input row: id, text_key (MD5 of its text), class_id and keep.

    Equal texts are one class, as are texts joined by a chain of pairs whose alignment reaches ``similarity``; none is missed, however many rounds of sketches come first (one at least). ``class_id`` is the
    class's least id, ``keep`` whether the row has that id and the first text (by MD5) with it; repeated rows all keep it.
    Null texts count as empty and are copies of each other; texts of fewer than five words are one shingle.
    A null id counts as larger than all others. Empty tables give no rows; other columns are ignored.
    """
    nodes = checkpoint(sketches(df, id_col, text_col).withColumn("num", F.monotonically_increasing_id()))
    tasks = tasks_for(df.sparkSession, nodes.count())
    nodes = narrow(nodes, tasks)
    buckets = narrow(checkpoint(bucket_rows(nodes, tasks)), tasks)
    texts = narrow(checkpoint(one_copy(df, buckets.select("text_key").distinct().join(nodes.select("text_key", "id"), "text_key"), id_col, text_col, tasks)), tasks)
    links: DataFrame | None = None
    classes: DataFrame | None = None
    tried: DataFrame | None = None
    for _ in range(rounds):
        rows = buckets
        if classes is not None:
            rows = narrow(buckets.join(classes.select(F.col("node").alias("text_key"), "component"), "text_key", "left"), tasks).select("key", "text_key", "sketch", F.coalesce("component", "text_key").alias("class"))
            mixed = rows.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("key")
            rows = narrow(rows.join(mixed, "key"), tasks)
        pairs = narrow(candidate_pairs(rows), tasks)
        pairs = narrow(checkpoint(pairs if tried is None else narrow(pairs.join(tried, ["a", "b"], "left_anti"), tasks)), tasks)
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = narrow(checkpoint(verify(with_texts(pairs, texts, tasks), similarity).select("u", "v")), tasks)
        links = found if links is None else narrow(links.unionByName(found), tasks)
        classes = narrow(checkpoint(narrow(connected_components(links, tasks), tasks)), tasks)
    found = missed_links(df, nodes, classes, id_col, text_col, similarity, tasks)
    if not found.isEmpty():
        classes = narrow(checkpoint(narrow(connected_components(links.unionByName(found), tasks), tasks)), tasks)
    named = nodes.join(classes.withColumnRenamed("node", "text_key"), "text_key", "left").select("text_key", "id", F.coalesce("component", "text_key").alias("component"))
    named = narrow(checkpoint(narrow(named, tasks)), tasks)
    # A null id stands behind all others.
    first = named.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("first"))
    of_text = named.join(first, "component").select("text_key", F.col("first.id").alias("class_id"), F.col("first.text_key").alias("first_key"))
    members = df.select(F.col(id_col).alias("id"), F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("text_key"))
    return members.join(of_text, "text_key").select(F.col("id").alias(id_col), "text_key", "class_id", (F.col("id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("first_key"))).alias("keep"))


def one_of_each_class(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of df that stay: of each class the one with the least id (then the first text by MD5); of repeated rows one. Columns stay."""
    kept = near_duplicates(df, id_col, text_col, similarity).where("keep").select(F.col(id_col).alias("_kept_id"), F.col("text_key").alias("_kept_key")).distinct()
    keyed = df.withColumns({"_id": F.col(id_col), "_key": F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))})
    stay = keyed.join(kept, F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_key") == F.col("_kept_key")), "left_semi")
    return stay.dropDuplicates(["_id", "_key"]).select(*df.columns)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", F.col("keep").cast("int").alias("keep"))
