"""Vectorised text primitives shared by the Arrow-batched operators of this subpackage.

Everything works on one chunk of documents laid out as a flat ``uint8`` array plus offsets
(the layout of an Arrow string column), so per-word and per-byte work is numpy, not Python.
Chunks are cut to about ``CHUNK_BYTES`` so a task's memory does not depend on the batch
size; a longer single text forms a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1              # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        a = np.full(max(n, CHUNK_BYTES + 1), base, dtype=U64)
        a[0] = 1
        have = _POW[base] = np.cumprod(a, dtype=U64)
    return have[:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalising mixer: spreads every input bit over the word."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Chunk(NamedTuple):
    """Consecutive rows of a batch: their bytes and byte offsets (len = rows + 1, first 0)."""
    data: np.ndarray
    offsets: np.ndarray
    first: int                              # index of the first row in its batch


def chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into chunks of about ``limit`` bytes; null texts are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_string())
    n = len(col)
    if not n:
        return
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64, count=n + 1 + col.offset)[col.offset:]
    raw = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield Chunk(raw[off[i]:off[j]], off[i:j + 1] - off[i], i)
        i = j


class Words(NamedTuple):
    """Words of a chunk: byte spans, hashes, and ``first`` (word index where each row starts)."""
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


_WS = np.ones(256, dtype=bool)              # the word class [^\x20\x09-\x0D]+
_WS[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
# ASCII letters and digits and every byte of a multi-byte character.
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def lower_ascii(c: Chunk) -> Chunk:
    return c._replace(data=_LOWER[c.data])


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` turns two of them into a span's hash."""
    s = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * _powers(_BASE, len(data)), dtype=U64, out=s[1:])
    return s


def span_hash(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix64((s[end] - s[start]) * _powers(_BASE_INV, len(s))[start])


def words(c: Chunk, alnum: bool = False, sums: np.ndarray | None = None) -> Words:
    """White-space words of each row (or runs of letters and digits with ``alnum``)."""
    is_word = (_ALNUM if alnum else _WS)[c.data]
    n = len(c.data)
    before = np.zeros(n, dtype=bool)
    before[1:] = is_word[:-1]
    inner = c.offsets[:-1][(c.offsets[:-1] < n)]
    before[inner] = False
    start = np.flatnonzero(is_word & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = is_word[1:]
    ends = c.offsets[1:][c.offsets[1:] > 0] - 1
    after[ends] = False
    end = np.flatnonzero(is_word & ~after) + 1
    if sums is None:
        sums = prefix_hash(c.data)
    h = span_hash(sums, start, end)
    return Words(start, end, h, np.searchsorted(start, c.offsets))


def window_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive entries (fewer entries than ``n``: none)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    acc = np.zeros(m, dtype=U64)
    for j in range(n):
        acc = (acc + h[j:j + m]) * U64(0xD6E8FEB86659FD93)
    return mix64(acc)


def shingle_set(h: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct ``n``-word shingle hashes of one text; a text with 1 to n-1 words
    has its whole sequence as the only shingle, one without words has none."""
    if len(h) == 0:
        return np.zeros(0, U64)
    if len(h) < n:
        # the length keeps a short sequence apart from the same words inside a window
        return window_hash(h, len(h)) ^ U64(len(h))
    return np.unique(window_hash(h, n))


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive entries, by block-wise running minima."""
    m = len(h) - w + 1
    if m <= 0:
        return h[:0]
    pad = np.full(-len(h) % w, np.iinfo(h.dtype).max, h.dtype)
    x = np.concatenate([h, pad]).reshape(-1, w)
    fwd = np.minimum.accumulate(x, axis=1).ravel()
    bwd = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(bwd[:m], fwd[w - 1:w - 1 + m])
