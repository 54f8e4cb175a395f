"""Vectorised word hashing over Arrow string buffers.

A word is `[^\\x20\\x09-\\x0D]+`, with A-Z lower-cased. Nothing here loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes, so that every bit depends on all others."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def seeds(n: int, start: int = 0) -> np.ndarray:
    """n fixed 64-bit numbers."""
    return mix((np.arange(start + 1, start + n + 1, dtype=_U)) * _U(0x9E3779B97F4A7C15))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CASED = seeds(256)
_BYTE = _CASED.copy()
_BYTE[65:91] = _BYTE[97:123]
_BASE = int(seeds(1, 1000)[0]) | 1
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        n = max(n, CHUNK + 1)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(n, base, _U)
            p[0] = 1
            _powers[key] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the documents' offsets of a string array; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of all documents in order, and the documents' offsets in it."""
    h, _, _, at = word_spans(*buffers(column))
    return h, at


def word_spans(data: np.ndarray, offsets: np.ndarray, fold: bool = True, cut: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each word's hash, first byte and end, and the documents' offsets in the words.

    fold: hash A-Z as a-z. cut: two tables of bytes; words are also cut between a byte of the first and one of the second.

    Works in pieces of about CHUNK bytes, cut at white space or document ends, so that one very long document
    takes no more memory than many short ones.
    """
    found, starts, ends, lo, n = [], [], [], 0, len(data)
    while lo < n:
        hi = min(n, lo + CHUNK)
        while hi < n and not _SPACE[data[hi]]:  # to the next white space or document end
            stop = offsets[np.searchsorted(offsets, hi)]
            spaces = np.flatnonzero(_SPACE[data[hi : min(stop, hi + CHUNK)]])
            hi = hi + spaces[0] if len(spaces) else min(stop, hi + CHUNK)
            if hi == stop:
                break
        piece = data[lo:hi]
        inner = offsets[np.searchsorted(offsets, lo, "right") : np.searchsorted(offsets, hi)] - lo
        word = ~_SPACE[piece]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        if cut is not None:
            inside = cut[0][piece[:-1]] & cut[1][piece[1:]]
            first[1:] |= inside
            last[:-1] |= inside
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = _power(len(piece) + 1)
        total = np.zeros(len(piece) + 1, _U)
        np.cumsum((_BYTE if fold else _CASED)[piece] * up[: len(piece)], out=total[1:])
        found.append(mix((total[e] - total[s]) * down[s] + _U(1)))
        starts.append(s + lo)
        ends.append(e + lo)
        lo = hi
    h = np.concatenate(found) if found else np.zeros(0, _U)
    first, last = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends))
    return h, first, last, np.searchsorted(first, offsets)


def pieces(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, offsets) of some documents of a string array at a time, about `size` bytes or one document."""
    data, offsets = buffers(column)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def shingles(h: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words and the documents' offsets in them; a shorter text is one run."""
    factors = seeds(width, 2000) | _U(1)
    sizes = np.diff(offsets)
    n = len(h)
    runs = np.zeros(max(0, n - width + 1), _U)
    for j in range(width):
        runs += h[j : n - width + 1 + j] * factors[j] if len(runs) else _U(0)
    room = np.where(sizes >= width, sizes - width + 1, (sizes > 0).astype(np.int64))
    out = np.zeros(len(room) + 1, np.int64)
    np.cumsum(room, out=out[1:])
    result = np.zeros(out[-1], _U)
    full = np.flatnonzero(sizes >= width)
    if len(full):
        keep = np.zeros(len(runs) + 1, np.int64)
        np.add.at(keep, offsets[full], 1)
        np.add.at(keep, offsets[full] + room[full], -1)
        long = np.repeat(sizes >= width, room)
        result[long] = runs[np.cumsum(keep[:-1]) > 0]
    for d in np.flatnonzero((sizes > 0) & (sizes < width)):
        part = h[offsets[d] : offsets[d + 1]]
        result[out[d]] = (part * factors[: len(part)]).sum(dtype=_U) + _U(len(part))
    return mix(result), out
