"""Words and word hashes of Arrow string columns as numpy arrays.

All functions work on a slab: the UTF-8 bytes of some whole texts back to back,
with the offsets of each text. Slabs keep the memory of a task bounded by
``SLAB_BYTES`` (or by the longest single text, at a few bytes per byte of text).
Hashes are 64 bits wide; two different words or word sequences get the same
hash with a probability of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLAB_BYTES = 4 << 20
_PIECE_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def byte_class(excluded: str) -> np.ndarray:
    """Table of 256 booleans: False for the ASCII characters listed, else True."""
    table = np.ones(256, dtype=bool)
    table[[ord(c) for c in excluded]] = False
    return table


#: Words as runs of bytes other than space, tab, line feed, vertical tab, form feed, carriage return.
NOT_SPACE = byte_class(" \t\n\x0b\x0c\r")
#: Words as runs of digits, lower-case letters and any non-ASCII bytes.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bijection on 64-bit words (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slabs(texts: pa.Array, max_bytes: int = SLAB_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) of consecutive rows; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return
    wide = pa.types.is_large_string(texts.type)
    _, offs, data = texts.buffers()
    off = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_spans(data: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the words of a slab: starts, ends, and each text's range in them (length n + 1)."""
    n = len(data)
    w = table[data]
    first, last = w.copy(), w.copy()
    if n:
        first[1:] &= ~w[:-1]
        last[:-1] &= ~w[1:]
        edge = off[off < n]
        first[edge] = w[edge]
        edge = off[off > 0] - 1
        last[edge] = w[edge]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, in pieces of bounded size."""
    out = np.empty(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    lens = ends - starts
    total = np.cumsum(lens)
    powers = np.cumprod(np.full(int(lens.max()), _BASE, dtype=np.uint64))
    a = 0
    while a < len(starts):
        base = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, base + _PIECE_BYTES, "right")))
        n = lens[a:b]
        begin = total[a:b] - n - base
        at = np.arange(int(total[b - 1] - base)) - np.repeat(begin, n)
        codes = _BYTE_CODE[data[np.repeat(starts[a:b], n) + at]] * powers[at]
        out[a:b] = np.add.reduceat(codes, begin)
        a = b
    return mix(out)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; entry i starts at word i (runs may cross texts)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        out *= _STEP
        out += words[j:j + n]
    return mix(out + np.uint64(size))


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles of each text (lower-cased A-Z, words between white space).

    A text with fewer words has its whole sequence as the one shingle; without words, none.
    Returns the sorted hashes of all texts back to back and each text's range (length n + 1).
    """
    starts, ends, words = word_spans(data, off, NOT_SPACE)
    h = word_hashes(ASCII_LOWER[data], starts, ends)
    windows = window_hashes(h, size)
    sets = []
    for a, b in zip(words[:-1].tolist(), words[1:].tolist()):
        if b - a >= size:
            s = np.sort(windows[a:b - size + 1])
            sets.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            sets.append(window_hashes(h[a:b], b - a))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), bounds
