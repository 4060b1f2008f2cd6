"""White-space tokens of a batch of texts as arrays: each distinct token is looked at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class TokenBatch:
    """Tokens of all texts in one flat array.

    ``names`` are the distinct tokens, ``code`` the flat tokens as positions in names, ``offsets`` where each text's tokens
    begin (one entry more than texts), ``doc`` each token's text. Null texts have no tokens.
    """

    def __init__(self, texts: pa.Array):
        parts = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
        flat, offsets = parts.flatten(), np.asarray(parts.offsets).astype(np.int64)
        offsets = offsets - offsets[0]
        full = np.asarray(pc.not_equal(flat, "").to_numpy(zero_copy_only=False))
        if not full.all():  # white space at the ends gives empty parts
            flat = flat.filter(pa.array(full))
            offsets = np.append(0, np.cumsum(full))[offsets]
        coded = flat.dictionary_encode()
        self.names: list[str] = coded.dictionary.to_pylist()
        self.code = np.asarray(coded.indices).astype(np.int64)
        self.offsets = offsets
        self.counts = np.diff(offsets)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def __len__(self) -> int:
        return len(self.counts)

    def sums(self, per_token: np.ndarray) -> np.ndarray:
        """Sum of a value of each token over each text."""
        return np.bincount(self.doc, weights=per_token, minlength=len(self))


#: What a code point is: 0 a mark, 1 a letter without case or a small one, 2 a capital, 3 another number.
_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every code point; made once in each process."""
    if not _CLASSES:
        table = np.zeros(0x110000, np.uint8)
        for i in range(0x110000):
            c = chr(i)
            if c.isalnum():
                table[i] = 3 if not c.isalpha() else 2 if c.isupper() else 1
        _CLASSES.append(table)
    return _CLASSES[0]


def code_points(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all names, one after another, and where each name begins (one entry more than names)."""
    lengths = np.fromiter(map(len, names), np.int64, len(names))
    return np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64), np.append(0, np.cumsum(lengths))


def run_hash(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 32-bit polynomial hash of each run of values."""
    n = np.diff(starts)
    place = np.arange(len(values)) - np.repeat(starts[:-1], n)
    powers = np.empty(int(n.max(initial=0)) + 1, np.uint64)
    powers[0] = 1
    for i in range(1, len(powers)):
        powers[i] = int(powers[i - 1]) * 1_000_003 % (1 << 32)
    mixed = (values.astype(np.uint64) + np.uint64(1)) * powers[place] & np.uint64(0xFFFFFFFF)
    totals = np.append(np.uint64(0), np.cumsum(mixed, dtype=np.uint64))
    h = (totals[starts[1:]] - totals[starts[:-1]]) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(32)).astype(np.int64)
