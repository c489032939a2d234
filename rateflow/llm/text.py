"""Vectorised text primitives on Arrow string batches: words, hashes, winnowing.

All functions work on the UTF-8 bytes of a few rows at a time (``row_chunks``), so the
memory of a task is set by CHUNK_BYTES and by its longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

_U = np.uint64
# Odd multipliers, so that their powers are invertible modulo 2**64.
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (finaliser of splitmix64)."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BYTE_BASE))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = -(-n // (1 << 18)) * (1 << 18)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, np.uint64)
            p[1:] = _U(b)
            both.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (both[0], both[1])
    return have


def _prefix_sums(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    p, inverse = _powers(base, len(values) + 1)
    c = np.empty(len(values) + 1, np.uint64)
    c[0] = 0
    np.multiply(values, p[: len(values)], out=c[1:])
    np.cumsum(c, out=c)
    return c, inverse


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[s:e] for each (s, e): equal sequences have equal hashes."""
    c, inverse = _prefix_sums(values, base)
    h = c[ends]
    h -= c[starts]
    h *= inverse[starts]
    h += (ends - starts).astype(np.uint64)
    return mix(h)


def byte_span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(_BYTE_VALUES[data], starts, ends, _BYTE_BASE)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + upper.astype(np.uint8) * np.uint8(32)


def byte_class(keep) -> np.ndarray:
    return np.array([bool(keep(b)) for b in range(256)])


#: Bytes of [^\x20\x09-\x0D]+ and of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after A-Z is lowered).
#: Bytes of 0x80 and above only occur inside multi-byte characters, which both accept.
NOT_BLANK = byte_class(lambda b: not (b == 32 or 9 <= b <= 13))
ALNUM = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary array; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    big = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    buffers = column.buffers()
    if n == 0 or buffers[1] is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(buffers[1], np.int64 if big else np.int32)[column.offset: column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]: offsets[-1]]


def row_chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batch with about ``size`` bytes of the column each (one row at least),
    each with that column's offsets and bytes."""
    offsets, data = string_parts(batch.column(batch.schema.get_field_index(column)))
    n, i = batch.num_rows, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        j = min(j, n)
        yield batch.slice(i, j - i), offsets[i: j + 1] - offsets[i], data[offsets[i]: offsets[j]]
        i = j


@dataclass
class Words:
    """Words of a few texts: byte spans, and for each text where its words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # first[d]: index of the first word of text d; one more at the end
    text: np.ndarray  # text[i]: the text that word i is in

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return byte_span_hashes(self.data, self.starts, self.ends)

    def joined(self, i: int, j: int) -> str:
        """Words i to j-1, joined by spaces."""
        b = self.data
        return b" ".join(b[s:e].tobytes() for s, e in zip(self.starts[i:j].tolist(), self.ends[i:j].tolist())).decode("utf-8", "replace")


def words(offsets: np.ndarray, data: np.ndarray, keep: np.ndarray) -> Words:
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(data, z, z, np.zeros(len(offsets), np.int64), z)
    inside = keep[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends_at = offsets[1:][offsets[1:] > 0] - 1
    after[ends_at] = False
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets, "left")
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, starts, ends, first, text)


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of values[i:i+k] for every i; shorter by k - 1 (texts are not kept apart)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    c, inverse = _prefix_sums(values, _WORD_BASE)
    h = c[k:] - c[:n]
    h *= inverse[:n]
    h += _U(k)
    return mix(h)


def gram_positions(first: np.ndarray, k: int) -> np.ndarray:
    """Positions i where values[i:i+k] lies inside one text; first as in Words."""
    n = int(first[-1])
    if n < k:
        return np.zeros(0, np.int64)
    room = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return np.flatnonzero(room >= k)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i+w]) for every i; shorter by w - 1."""
    if len(x) < w:
        return x[:0]
    p, m = 1, x
    while 2 * p <= w:
        m = np.minimum(m[:-p], m[p:])
        p *= 2
    rest = w - p
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def winnow(hashes: np.ndarray, first: np.ndarray, k: int, w: int) -> np.ndarray:
    """Positions of the minimum k-gram hash (the last of equal ones) in every window of w
    consecutive k-grams of a text. ``hashes`` are those of gram_hashes. Two texts that
    share w + k - 1 consecutive values choose the same k-gram of that passage."""
    n = len(hashes)
    low = _U((1 << 24) - 1)
    # Below its upper 40 bits each hash carries its place, so that the last of equals is least.
    keys = np.arange(n, 0, -1, dtype=np.uint64)
    keys &= low
    keys |= hashes & ~low
    best = sliding_min(keys, w)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a < w + k - 1:
            continue
        places = best[a: b - w - k + 2] & low
        # A minimum stays for many windows: look only where it changes.
        places = places[np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))].astype(np.int64)
        at = n - places
        if n > 1 << 24:  # places are known modulo 2**24; a text's windows are nearer than that
            at = a + (at - a) % (1 << 24) if b - a <= 1 << 24 else _unwrapped(at, a)
        out.append(at)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _unwrapped(at: np.ndarray, a: int) -> np.ndarray:
    """Ascending places of which only the value modulo 2**24 is known, from a on."""
    at = a + (at - a) % (1 << 24)
    return at + (1 << 24) * np.concatenate([[0], np.cumsum(at[1:] < at[:-1])])
