"""Vectorised word kernels over the UTF-8 bytes of Arrow string columns.

Separators are ASCII bytes, so a word of code points is a run of bytes and no text is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers: within a word, and from word to word.
BYTE_BASE, WORD_BASE = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

SPACED_MASK = np.ones(256, dtype=bool)
SPACED_MASK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z.
ALNUM_MASK = np.zeros(256, dtype=bool)
ALNUM_MASK[0x30:0x3A] = ALNUM_MASK[0x61:0x7B] = ALNUM_MASK[0x80:] = True

_powers = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 256), base, dtype=U64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 1 << 20:
            _powers[int(base)] = have
    return have[:n]


def free(name: str, taken: list[str]) -> str:
    """The name, with underscores behind it while a column has it: names are the same to Spark whatever their case."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name += "_"
    return name


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over all 64."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


class Words(NamedTuple):
    data: np.ndarray  # bytes of the slice, lower-cased if asked for
    docs: np.ndarray  # byte offset of each document, and the end
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    of: np.ndarray  # index of each document's first word, and the end
    hash: np.ndarray | None  # 64 bits of each word


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    n = len(column)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64, count=n + 1 + column.offset)[column.offset :] if n else np.zeros(1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows of about `most` bytes; a longer text is a run of its own."""
    data, offsets = buffers(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def find(data: np.ndarray, docs: np.ndarray, mask: np.ndarray, lower: bool = False, hashed: bool = True) -> Words:
    """The words of a slice. mask: which bytes are word bytes, after lower-casing."""
    if lower:
        data = LOWER[data]
    inside = mask[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[docs] = True
    before = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    of = np.searchsorted(starts, docs)
    h = None
    if hashed:
        h = np.zeros(len(starts), dtype=U64)
        if len(starts):
            lens = ends - starts
            first = np.cumsum(lens) - lens
            body = data[inside]
            rel = np.arange(len(body), dtype=np.int64) - np.repeat(first, lens)
            value = powers(BYTE_BASE, int(lens.max()))[rel]
            value *= body.astype(U64) + U64(1)
            h = mix(np.add.reduceat(value, first) + lens.astype(U64))
    return Words(data, docs, starts, ends, of, h)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive values; those that cross documents are for the caller to leave out."""
    if len(h) < n:
        return np.zeros(0, dtype=U64)
    out, have, power, span = None, 0, h, 1
    bits = n
    while bits:
        if bits & 1:
            if out is None:
                out, have = power, span
            else:
                m = len(h) - have - span + 1
                out = out[:m] + powers(WORD_BASE, have + 1)[have] * power[have : have + m]
                have += span
        bits >>= 1
        if bits:
            m = len(power) - span
            power = power[:m] + powers(WORD_BASE, span + 1)[span] * power[span : span + m]
            span *= 2
    return mix(out)


def whole(starts_of: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of the `total` runs of n words lie within one document."""
    ok = np.zeros(max(total, 0), dtype=bool)
    counts = np.maximum(np.diff(starts_of) - n + 1, 0)
    if counts.sum():
        first = np.repeat(starts_of[:-1], counts)
        ok[first + np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)] = True
    return ok


def cover(flags: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words inside any flagged run of n words."""
    delta = np.zeros(total + 1, dtype=np.int32)
    at = np.flatnonzero(flags)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + n, -1)
    return np.cumsum(delta[:-1]) > 0
