"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

Encoding cuts a batch of texts into words with Arrow kernels and encodes each distinct word
once. The symbols of all distinct words lie in one flat array. Each round looks up the rank of
every adjacent pair by binary search over the sorted pair keys, finds each word's
lowest rank, merges that pair wherever it occurs in the word, and closes the gaps; words without
a known pair leave the array. Decoding is one Arrow ``take`` over the vocabulary's bytes.

The vocabulary is a parameter; the driver reads it and broadcasts its arrays (a few MB, fixed by
the vocabulary).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from lectern.llm.common import bound_batches, read_table, tidy

#: How byte-level BPE cuts text into words (fixed by the vocabulary's format).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text that are encoded at once.
SLICE_BYTES = 2 << 20
#: Pieces whose ids a task remembers; beyond that it starts afresh. This bounds memory only, results don't depend on it.
CACHE_PIECES = 250_000
_NO_RANK = np.int64(1 << 40)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


@dataclass
class BpeModel:
    """Arrays of a vocabulary: what the merge rounds and the decoder need."""

    byte_ids: np.ndarray  # id of each single byte
    pair_keys: np.ndarray  # sorted (left << 32 | right)
    pair_ranks: np.ndarray
    pair_ids: np.ndarray  # id of what the pair becomes
    token_bytes: list[bytes]  # by id
    specials: dict[str, int]

    @classmethod
    def load(cls, path: str) -> BpeModel:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        symbols = byte_symbols()
        of_symbol = {s: b for b, s in enumerate(symbols)}
        specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        table = [b""] * (max([*vocab.values(), *specials.values()]) + 1)
        for token, i in vocab.items():
            table[i] = bytes(of_symbol[c] for c in token)
        for token, i in specials.items():
            table[i] = token.encode()
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        return cls(
            np.array([vocab[s] for s in symbols], np.int64),
            keys[order],
            order.astype(np.int64),
            np.array([vocab[a + b] for a, b in merges], np.int64)[order],
            table,
            specials,
        )


def merge_rounds(model: BpeModel, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of many words: data holds their bytes, one after another. Gives the flat ids and their number for each word."""
    ids = model.byte_ids[data]
    word = np.repeat(np.arange(len(lengths)), lengths)
    done_ids, done_words = [], []
    while len(ids):
        same = word[1:] == word[:-1]
        keys = ids[:-1] << 32 | ids[1:]
        at = np.minimum(np.searchsorted(model.pair_keys, keys), len(model.pair_keys) - 1)
        ranks = np.where(same & (model.pair_keys[at] == keys), model.pair_ranks[at], _NO_RANK)
        ranks = np.append(ranks, _NO_RANK)  # the last symbol starts no pair
        starts = np.flatnonzero(np.append(True, ~same))
        lowest = np.minimum.reduceat(ranks, starts)
        sizes = np.diff(np.append(starts, len(ids)))
        best = np.repeat(lowest, sizes)
        ended = best == _NO_RANK
        if ended.any():
            done_ids.append(ids[ended])
            done_words.append(word[ended])
            going = ~ended
            ids, word, ranks, best, at = ids[going], word[going], ranks[going], best[going], np.append(at, 0)[going]
            if not len(ids):
                break
        hit = np.flatnonzero(ranks == best)
        # Of overlapping pairs (a run of one symbol) every second one merges, from the left.
        first = np.append(True, np.diff(hit) > 1)
        run = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        ids = ids.copy()
        ids[hit] = model.pair_ids[at[hit]]
        keep = np.ones(len(ids), bool)
        keep[hit + 1] = False
        ids, word = ids[keep], word[keep]
    ids = np.concatenate(done_ids) if done_ids else np.empty(0, np.int64)
    word = np.concatenate(done_words) if done_words else np.empty(0, np.int64)
    order = np.argsort(word, kind="stable")
    return ids[order].astype(np.uint32), np.bincount(word, minlength=len(lengths))


class Encoder:
    """Encodes batches of texts."""

    def __init__(self, model: BpeModel):
        self.model = model
        self.words = regex.compile(WORD_PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, sorted(model.specials, key=len, reverse=True)))) if model.specials else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64)

    def remembered(self, pieces: list[str]) -> np.ndarray:
        """Codes of distinct pieces in ids and sizes; only pieces not seen before are encoded."""
        if len(self.known) > CACHE_PIECES:
            self.forget()
        known = self.known
        fresh = [p for p in pieces if p not in known]
        if fresh:
            for p in fresh:
                known[p] = len(known)
            ids, sizes = self.encode_pieces(fresh)
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces begin and end at word limits. Flat ids and their number for each piece."""
        words: dict[str, int] = {}
        flat: list[int] = []
        counts = np.empty(len(pieces), np.int64)
        for i, piece in enumerate(pieces):
            found = [piece] if piece[1:].isalpha() and piece[0] == " " else self.words.findall(piece)
            counts[i] = len(found)
            flat += [words.setdefault(w, len(words)) for w in found]
        raw = [w.encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        ids, sizes = merge_rounds(self.model, np.frombuffer(b"".join(raw), np.uint8), lengths)
        of_piece = gather(ids, sizes, np.array(flat, np.int64))
        per_word = sizes[np.array(flat, np.int64)] if flat else np.empty(0, np.int64)
        ends = np.append(0, np.cumsum(per_word))
        cuts = np.append(0, np.cumsum(counts))
        return of_piece, ends[cuts[1:]] - ends[cuts[:-1]]

    def cut(self, text: str) -> list[str]:
        """Pieces of any text: a cut before each single space that stands before a character, where a word always begins."""
        return regex.split(r"(?V1)(?= \S)", text)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        if not len(texts):
            return []
        parts = pc.split_pattern(texts, " ")
        pieces, offsets = parts.flatten(), np.asarray(parts.offsets)
        offsets = offsets - offsets[0]
        # Where a space is followed by white space or the end, or a special token occurs, the text is cut in Python.
        odd = np.zeros(len(pieces), bool)
        odd[:] = pc.match_substring_regex(pieces, r"^$|^[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]").to_numpy(zero_copy_only=False)
        heads = offsets[:-1]
        nonempty = np.diff(offsets) > 0
        odd[heads[nonempty]] = False
        slow = np.add.reduceat(np.append(odd, False), np.minimum(heads, len(odd))) > 0 if len(odd) else np.zeros(len(texts), bool)
        slow &= nonempty
        for token in self.model.specials:
            slow |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        coded = pieces.dictionary_encode()
        code, names = np.asarray(coded.indices).astype(np.int64), coded.dictionary.to_pylist()
        # A piece that heads its text has no space before it; it gets a code of its own.
        is_head = np.zeros(len(code), bool)
        is_head[heads[nonempty]] = True
        code = code * 2 + is_head
        used, code = np.unique(code, return_inverse=True)
        heads_of = (used & 1).tolist()
        table = [names[c] if h else " " + names[c] for c, h in zip((used >> 1).tolist(), heads_of, strict=True)]
        code = self.remembered(table)[code]
        out: list[np.ndarray] = []
        flat = gather(self.ids, self.sizes, code)
        ends = np.append(0, np.cumsum(self.sizes[code]))[offsets].astype(np.int64)
        slow_at = np.flatnonzero(slow)
        fixed = dict(zip(slow_at.tolist(), self.encode_slow([texts[int(i)].as_py() for i in slow_at]), strict=True))
        for i in range(len(texts)):
            out.append(fixed[i] if i in fixed else flat[ends[i] : ends[i + 1]])
        return out

    def encode_slow(self, texts: list[str]) -> list[np.ndarray]:
        """Texts with runs of white space or special tokens, cut in Python."""
        pieces: list[str] = []
        plan: list[list[tuple[int, int] | int]] = []
        for text in texts:
            steps: list[tuple[int, int] | int] = []
            at = 0
            for m in self.special.finditer(text) if self.special else ():
                begin = len(pieces)
                pieces += [p for p in self.cut(text[at : m.start()]) if p]
                steps += [(begin, len(pieces)), self.model.specials[m[0]]]
                at = m.end()
            begin = len(pieces)
            pieces += [p for p in self.cut(text[at:]) if p]
            steps.append((begin, len(pieces)))
            plan.append(steps)
        names = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
        code = self.remembered(list(names))[np.fromiter((names[p] for p in pieces), np.int64, len(pieces))]
        ids, sizes = self.ids, self.sizes
        out = []
        for steps in plan:
            chunks = [np.array([s], np.uint32) if isinstance(s, int) else gather(ids, sizes, code[s[0] : s[1]]) for s in steps]
            out.append(np.concatenate(chunks).astype(np.uint32))
        return out


def gather(flat: np.ndarray, sizes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The runs of flat that code names, one after another."""
    if not len(code):
        return flat[:0]
    starts = np.append(0, np.cumsum(sizes))[:-1]
    n = sizes[code]
    ends = np.cumsum(n)
    at = np.arange(ends[-1]) + np.repeat(starts[code] - (ends - n), n)
    return flat[at]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about limit bytes together."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bpe_encode(df: DataFrame, vocab_path: str, text_col: str = "text", ids_col: str = "token_ids", count_col: str = "n_tokens") -> DataFrame:
    """Adds the token ids of each whole text, packed as little-endian unsigned 32-bit integers, and their number.

    A null text counts as empty and has no tokens. Special tokens in a text get their ids, as in the
    tokenizers library's default. Every other column is kept; columns named like the two
    new ones are replaced. ``unpack_ids`` gives an array column.
    """
    spark = df.sparkSession
    bound_batches(spark)
    df = df.drop(ids_col, count_col)
    model = spark.sparkContext.broadcast(BpeModel.load(vocab_path))
    schema = StructType([*df.schema.fields, StructField(ids_col, BinaryType()), StructField(count_col, IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for whole in batches:
            for batch in slices(whole, text_col):
                ids = encoder.encode(pc.fill_null(batch.column(text_col), ""))
                columns = [*batch.columns, pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(tidy(run), schema)


def bpe_decode(df: DataFrame, vocab_path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """Adds the text of packed token ids; bytes that aren't UTF-8 become U+FFFD. Null ids give an empty text."""
    spark = df.sparkSession
    df = df.drop(text_col)
    tokens = spark.sparkContext.broadcast(BpeModel.load(vocab_path).token_bytes)
    schema = StructType([*df.schema.fields, StructField(text_col, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(tokens.value, pa.binary())
        for whole in batches:
            for batch in slices(whole, ids_col):
                texts = []
                for packed in batch.column(ids_col):
                    ids = np.frombuffer(packed.as_py() or b"", "<u4")
                    taken = vocabulary.take(pa.array(ids))
                    edges = np.frombuffer(taken.buffers()[1], np.int32)
                    data = taken.buffers()[2]
                    texts.append(bytes(memoryview(data)[edges[0] : edges[len(ids)]]).decode("utf-8", "replace") if len(ids) else "")
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return df.mapInArrow(tidy(run), schema)


def unpack_ids(packed: F.Column) -> F.Column:
    """Packed ids as an array of integers."""
    word = lambda i: F.conv(F.concat(*(F.substring(F.hex(packed), i * 8 + 7 - 2 * k, 2) for k in range(4))), 16, 10).cast("int")
    n = (F.octet_length(packed) / 4).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), word)).when(n == 0, F.array().cast("array<int>"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = default_vocabulary()
    coded = bpe_encode(read_table(spark, sf_dir, "documents").select("doc_id", "text"), vocab).drop("text")
    decoded = bpe_decode(coded, vocab)
    return decoded.select(
        "doc_id",
        F.col("n_tokens").cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
