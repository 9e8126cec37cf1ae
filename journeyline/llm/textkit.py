"""Vectorised word, line and shingle primitives over batches of UTF-8 texts.

Words are maximal runs of bytes other than space and ``\\x09``-``\\x0d``; these bytes never occur inside a
multi-byte UTF-8 sequence, so whole batches are segmented with numpy on the raw Arrow buffers.
Hashes are polynomial in 64-bit arithmetic (odd bases, from prefix sums) followed by a finaliser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BYTE_BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xD6E8FEB86659FD93 | 1
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**k and base**-k modulo 2**64 for k < n (grown by doubling)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, U64)
            step, k = b & _MASK, 1
            while k < size:
                p[k:2 * k] = p[:k] * U64(step)
                step, k = step * step & _MASK, 2 * k
            out.append(p)
        have = _POWERS[base] = (out[0], out[1])
    return have


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser (two xor-multiply rounds); ``seed`` selects an independent-looking function."""
    x = x ^ U64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _MASK)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def span_hash(codes: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``codes[start:end]`` for every span, from one prefix sum."""
    up, down = _powers(base, len(codes) + 1)
    prefix = np.zeros(len(codes) + 1, U64)
    np.cumsum(codes * up[:len(codes)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U64))


def pieces(column: pa.Array, max_bytes: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a string column in row ranges of about ``max_bytes``: (first row, rows, bytes, offsets).

    A null has no bytes. A single longer text is its own range, whole.
    """
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
        j = min(j, n)
        yield i, j - i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the row each belongs to."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = _SPACE[data]
    inner = offsets[1:-1]
    start = ~gap[1:-1] & gap[:-2]
    at = inner[inner < len(data)]
    start[at] |= ~gap[1:-1][at]  # a text's first byte starts a word even if its predecessor ends with one
    s = np.flatnonzero(start)
    end = ~gap[1:-1] & gap[2:]
    at = inner[inner > 0] - 1
    end[at] |= ~gap[1:-1][at]
    e = np.flatnonzero(end) + 1
    row = np.searchsorted(offsets, s, "right") - 1
    return s, e, row


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hash(data.astype(U64) + U64(1), start, end, BYTE_BASE)


def shingles(hashes: np.ndarray, row: np.ndarray, rows: int, size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles: (row, 64-bit hash) sorted by row and hash, and the set size of each row.

    A row with fewer words has its whole sequence as one shingle; a row without words has none.
    """
    count = np.bincount(row, minlength=rows)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    per = np.where(count == 0, 0, np.maximum(count - size + 1, 1))
    owner = np.repeat(np.arange(rows), per)
    begin = np.concatenate(([0], np.cumsum(per)[:-1]))
    s = first[owner] + np.arange(len(owner)) - begin[owner]
    e = np.minimum(s + size, (first + count)[owner])
    h = span_hash(hashes, s, e, WORD_BASE)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    owner, h = owner[new], h[new]
    return owner, h, np.bincount(owner, minlength=rows)


def text_shingles(data: np.ndarray, offsets: np.ndarray, size: int = 5):
    """Shingles of lower-cased (A-Z) texts, see ``shingles``; also each text's word-sequence hash (128 bits)."""
    low = lowered(data)
    s, e, row = words(low, offsets)
    wh = word_hashes(low, s, e)
    rows = len(offsets) - 1
    count = np.bincount(row, minlength=rows)
    last = np.cumsum(count)
    key = [span_hash(mix(wh, k), last - count, last, WORD_BASE) for k in (1, 2)]
    return (*shingles(wh, row, rows, size), key)
