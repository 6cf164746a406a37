"""Array kernels over whole Arrow batches: bytes, words, shingles.

Everything works on the concatenated UTF-8 bytes of a batch of texts, so the
cost is a few array passes a byte and no Python object is made for each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text that one pass of the kernels works on; a longer text is a pass of its own. A pass takes some fifty bytes beside each.
PASS_BYTES = 1 << 19

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: A random 64-bit value for each byte.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=U) * _ODD)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def bit_masks(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, mask) of a bitmap's words of 64 bits in which a bit is set for the leading bits of each hash."""
    slots = np.unique(hashes >> U(64 - bits))
    at, first = np.unique(slots >> U(6), return_index=True)
    return at, np.bitwise_or.reduceat(U(1) << (slots & U(63)), first) if len(slots) else slots


def bits_set(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    slots = hashes >> U(64 - bits)
    return (bitmap[slots >> U(6)] >> (slots & U(63)) & U(1)).astype(bool)


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Bytes of words: anything but ASCII white space.
NOT_SPACE = ~_table((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words: digits, letters (after lower-casing A-Z) and everything beyond ASCII.
ALNUM = _table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, U(base), dtype=U), np.full(n, U(inverse), dtype=U)
    up[0] = down[0] = U(1)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, n of each at least."""
    return _powers(1 << max(12, (n - 1).bit_length()))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary()
    column = column.cast(kind) if column.type != kind else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def passes(offsets: np.ndarray, most: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each, or of one longer row."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def word_spans(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the maximal runs of kept bytes; no run crosses rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = keep[data]
    here, before, after = inside[1:-1], inside[:-2].copy(), inside[2:].copy()
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts, ends = np.flatnonzero(here & ~before), np.flatnonzero(here & ~after) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, row


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word with A-Z lowered; equal for equal words anywhere."""
    if not len(starts):
        return np.zeros(0, U)
    up, down = powers(len(data))
    total = np.empty(len(data) + 1, U)
    total[0] = U(0)
    np.cumsum(BYTE_VALUES[LOWER[data]] * up[: len(data)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] ^ (ends - starts).astype(U) * _ODD)


def one_word_hash(word: bytes) -> int:
    data = np.frombuffer(word, np.uint8)
    return int(word_hashes(data, np.zeros(1, np.int64), np.full(1, len(data)))[0])


def shingles(words: np.ndarray, row: np.ndarray, rows: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each row's distinct k-word shingles, sorted within the row.

    A row of fewer words, but not none, has its whole sequence as one shingle.
    """
    n = len(words)
    counts = np.bincount(row, minlength=rows) if n else np.zeros(rows, np.int64)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    h, owner = np.zeros(0, U), np.zeros(0, np.int64)
    if n >= k:
        m = n - k + 1
        h = words[:m].copy()
        for i in range(1, k):
            h = mix64(h * _ODD + words[i : i + m])
        same = row[:m] == row[k - 1 :]
        h, owner = h[same], row[:m][same]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        lone = words[first[short]].copy()
        for i in range(1, k - 1):
            more = counts[short] > i
            lone[more] = mix64(lone[more] * _ODD + words[first[short][more] + i])
        lone = mix64(lone + counts[short].astype(U))
        h, owner = np.concatenate((h, lone)), np.concatenate((owner, short))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[new], owner[new]
    return h, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=rows)))).astype(np.int64)


def minima(values: np.ndarray, offsets: np.ndarray, empty: int) -> np.ndarray:
    """The least value of each row; ``empty`` for rows without any."""
    out = np.full(len(offsets) - 1, empty, values.dtype)
    some = offsets[1:] > offsets[:-1]
    if some.any():
        out[some] = np.minimum.reduceat(values, offsets[:-1][some])
    return out


def signatures(h: np.ndarray, offsets: np.ndarray, count: int, seed: int = 1) -> np.ndarray:
    """rows x count minwise hashes (uint32) of each row's set."""
    out = np.empty((len(offsets) - 1, count), np.uint32)
    keys = mix64(np.arange(1, count + 1, dtype=U) * _ODD + U(seed))
    for i in range(count):
        x = (h ^ keys[i]) * U(0xBF58476D1CE4E5B9)
        x ^= x >> U(29)
        x *= _ODD
        out[:, i] = minima((x >> U(32)).astype(np.uint32), offsets, 0xFFFFFFFF)
    return out


def set_sums(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's set."""
    out = []
    for salt in (U(0x1234567), U(0x7654321)):
        total = np.concatenate((np.zeros(1, U), np.cumsum(mix64(h ^ salt))))
        out.append(total[offsets[1:]] - total[offsets[:-1]])
    return out[0], out[1]
