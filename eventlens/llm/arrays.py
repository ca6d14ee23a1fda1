"""Numpy helpers that treat a batch of texts as one byte buffer.

A batch is cut into pieces of about ``PIECE_BYTES`` (one long text may make a
larger piece), so working memory does not depend on the Arrow batch size.
Hashes are 64-bit polynomial (Rabin-Karp) hashes modulo 2**64 over a random
byte table, finished with an avalanche step.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 19
U = np.uint64

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64
WORD_BASE = 0xD1342543DE82EF95


def separators(*spans) -> np.ndarray:
    """A 256-entry table that is True for word bytes; ``spans`` are the
    (first, last) byte ranges that separate words."""
    table = np.ones(256, bool)
    for a, b in spans:
        table[a:b + 1] = False
    return table


#: words ``[^\x20\x09-\x0D]+``
SPACED = separators((0x20, 0x20), (0x09, 0x0D))
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
ALNUM = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@functools.lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (grown in powers of two)."""
    return _powers(base, 1 << max(10, int(n - 1).bit_length()))[:n]


@functools.lru_cache(maxsize=8)
def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche step (splitmix64 finaliser)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their n + 1 offsets; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(texts: pa.Array, target: int = PIECE_BYTES):
    """Yield (first row, last row + 1, bytes, offsets) for runs of texts."""
    buf, off = text_buffer(texts)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + target, "right")) - 1)
        yield i, j, buf[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def find_words(buf: np.ndarray, off: np.ndarray, table: np.ndarray):
    """(starts, ends, first word of each text [n + 1])."""
    is_word = table[buf]
    before = np.empty_like(is_word)
    after = np.empty_like(is_word)
    if len(buf):
        before[0], before[1:] = False, is_word[:-1]
        after[-1], after[:-1] = False, is_word[1:]
        inner = off[1:-1]
        inner = inner[(inner > 0) & (inner < len(buf))]
        before[inner] = False
        after[inner - 1] = False
    starts = np.flatnonzero(is_word & ~before)
    ends = np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def prefix_hash(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of values[i] * base**i modulo 2**64, with a leading 0."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, max(1, len(values))), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of the spans [a, b), independent of where they lie."""
    shift = powers(inverse(base), max(1, len(prefix)))
    return (prefix[b] - prefix[a]) * shift[a]


def word_hashes(buf, starts, ends) -> np.ndarray:
    return mix(span_hash(prefix_hash(BYTE_VALUE[buf], BASE), starts, ends, BASE))


def window_hashes(words: np.ndarray, first: np.ndarray, n: int):
    """Hashes of every n-word window that lies in one text, and the index of
    each window's first word.  ``first``: first word of each text [texts + 1]."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    at = ranges(first[:-1], counts)
    prefix = prefix_hash(words, WORD_BASE)
    return mix(span_hash(prefix, at, at + n, WORD_BASE) + U(n)), at, counts


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated arange(start, start + count)."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - (ends - counts), counts)


def planes(a: np.ndarray) -> bytes:
    """Integers as byte planes: Spark's shuffle compression folds the planes
    that hardly change."""
    a = np.ascontiguousarray(a)
    return a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def unplanes(raw: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    if not raw:
        return np.zeros(0, dtype)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, -1).T).view(dtype).ravel()


def deltas(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def covered(starts: np.ndarray, ends: np.ndarray):
    """Union of intervals as disjoint, sorted (starts, ends); touching
    intervals merge."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.r_[True, s[1:] > e[:-1]])
    return s[new], e[np.r_[new[1:] - 1, len(s) - 1]]


def batch_of(schema: pa.Schema, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
