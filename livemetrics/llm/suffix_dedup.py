"""Operator 3, suffix-array dedup: remove every byte covered by a repeated ``length``-byte string.

A byte goes if some ``length``-byte string over it also starts earlier: in a document with a
smaller id, or further up in the same one.  Strings are judged on the input and never cross
documents.

1. Anchors.  Every ``length``-byte string has one anchor, the leftmost smallest hash of its
   ``gram``-byte substrings, which depends on its content only; a text needs about two
   anchors per ``length - gram`` bytes.  An anchor occurrence stands for the strings it is
   the anchor of: a *piece* of text, packed with its content hash and dealt by the gram's
   hash.  A gram seen once can hold no repeat.  Pieces equal to an earlier piece are
   repeated whole; what remains are the first occurrences of pieces that share a gram but
   not all their content.
2. Suffix arrays.  Those pieces are fetched from their texts and dealt by gram to shards.
   Each shard sorts the suffixes of its pieces by Larsson-Sadakane refinement (prefix
   doubling over the groups not yet sorted) and finds the common prefixes of neighbours by
   Kasai's rule; neighbours sharing ``length`` bytes are repeats of the earliest.
3. Merge.  A gram with very many different pieces is split over several shards; their sorted
   distinct strings are then merged pairwise by binary search, by hash range.
4. Runs of repeated strings per document meet their text, which is cut and hashed.

Scale: texts are shuffled compressed and only if they may have a repeat (a bounded bitmap
tells); copies of a passage cost a few packed bytes per ``length`` bytes and are never
compared pairwise; a shard holds at most ``shard_bytes`` plus one gram's pieces.

Defined edge results: null text: empty (digest of nothing); texts shorter than ``length``:
unchanged; rows with the same id and the same text are one document, all with its result;
rows with the same id and different texts are ordered by a hash of their text; a null id
counts as the smallest and stays null; an empty table gives an empty result; other columns
are ignored.  Pieces are compared by 64-bit content hash, strings in shards by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemetrics.llm import textvec as tv
from livemetrics.llm.common import (
    id_bitmap, in_bitmap, map_arrow, shuffle_partitions, whole_keys, with_bitmap_bit, written,
)

U64 = np.uint64
NULL_ID = -(1 << 63)


@dataclass(frozen=True)
class SuffixDedup:
    length: int = 100                        # bytes of a repeated string
    gram: int = 24                           # bytes of an anchor
    split_at: int = 4096                     # different pieces of one gram per shard
    shard_bytes: int = 1 << 19               # text sorted at a time


def _cuts(key: np.ndarray) -> np.ndarray:
    """Run borders of a sorted array, with both ends."""
    if not len(key):
        return np.zeros(1, np.int64)
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))


# -- packed arrays ----------------------------------------------------------------------------

def _pack(*arrays: np.ndarray) -> bytes:
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    size = np.frombuffer(blob, np.int64, len(types))
    at, out = 8 * len(types), []
    for t, n in zip(types, size):
        out.append(np.frombuffer(blob, t, int(n), at))
        at += int(n) * np.dtype(t).itemsize
    return out


def _batch(names: str, types, rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names.split())


# -- 1. anchors -------------------------------------------------------------------------------

def anchors(c: tv.Chunk, p: SuffixDedup):
    """Pieces of a chunk: (row, anchor position, first and last string start, gram hash, piece
    hash), positions relative to the row; and the text hash of every row."""
    n = len(c.data)
    sums = tv.prefix_hash(c.data)
    text = tv.span_hash(sums, c.offsets[:-1], c.offsets[1:]).astype(np.int64)
    m = n - p.length + 1
    last = c.offsets[1:] - p.length          # last string start of each row
    if m <= 0 or not (last >= c.offsets[:-1]).any():
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.astype(U64), z.astype(U64), text
    gram = (sums[p.gram:] - sums[:-p.gram]) * tv._powers(tv._BASE_INV, n + 1)[:n - p.gram + 1]
    h = tv.mix64(gram)
    marked = (h & U64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=U64)
    low = tv.sliding_min(marked, p.length - p.gram + 1)
    at = (low & U64(0xFFFFFFFF)).astype(np.int64)
    edge = np.zeros(n + 1, np.int32)
    long = last >= c.offsets[:-1]
    np.add.at(edge, c.offsets[:-1][long], 1)
    np.add.at(edge, last[long] + 1, -1)
    start = np.flatnonzero(np.cumsum(edge[:m]) > 0)
    at = at[start]
    cut = _cuts(at)
    first, end = start[cut[:-1]], start[cut[1:] - 1]
    pos = at[cut[:-1]]
    row = np.searchsorted(c.offsets, pos, "right") - 1
    piece = tv.mix64(tv.span_hash(sums, first, end + p.length) + (pos - first).astype(U64) * U64(0xC2B2AE3D27D4EB4F))
    base = c.offsets[row]
    return row, pos - base, first - base, end - base, h[pos], piece, text


def _anchor_blobs(p: SuffixDedup, parts: int):
    """(id, text) batches to (part, blob) rows; entries are gathered over a task's texts, so blobs
    stay large however many parts there are.  Texts are hashed 256 kB at a time (some 15 eight-byte arrays each)."""
    names = "ids text docs gram piece pos left more".split()

    def packed(held) -> pa.RecordBatch:
        x = {k: np.concatenate(v) for k, v in held.items()}
        part = (x["gram"] >> U64(48)).astype(np.int64) % parts
        order = np.argsort(part, kind="stable")                # documents stay in order within a part
        cut = _cuts(part[order])
        rows = []
        for i, j in zip(cut[:-1], cut[1:]):
            o = order[i:j]
            docs, count = np.unique(x["docs"][o], return_counts=True)
            g = x["gram"][o]
            rows.append((int(part[o[0]]), _pack(
                x["ids"][docs], x["text"][docs], count.astype(np.uint32), g.astype(np.uint32),
                (g >> U64(32)).astype(np.uint16), x["piece"][o], x["pos"][o], x["left"][o], x["more"][o])))
        return _batch("part blob", [pa.int32(), pa.binary()], rows)

    def run(batches):
        held, docs, size = {k: [] for k in names}, 0, 0
        for b in batches:
            ids = b.column(0).to_numpy()
            for c in tv.chunks(b.column(1), tv.CHUNK_BYTES // 8):
                row, pos, first, end, gram, piece, text = anchors(c, p)
                for k, v in zip(names, (ids[c.first:c.first + len(text)], text, docs + row, gram, piece, pos.astype(np.uint32),
                                        (pos - first).astype(np.uint8), (end - first).astype(np.uint8))):
                    held[k].append(v)
                docs, size = docs + len(text), size + len(row)
                if size > 400_000:
                    yield packed(held)
                    held, docs, size = {k: [] for k in names}, 0, 0
        if size:
            yield packed(held)
    return run


_ANCHOR = (np.int64, np.int64, np.uint32, np.uint32, np.uint16, np.uint64, np.uint32, np.uint8, np.uint8)


def match_anchors(blobs: list[bytes], part: int, p: SuffixDedup):
    """Rows (id, text hash, intervals, requests) of one hash range: repeated pieces as packed
    (start, end), and pieces to be sorted as packed (group, start, strings - 1, split)."""
    got = [_unpack(x, *_ANCHOR) for x in blobs]
    doc_id = np.concatenate([np.repeat(g[0], g[2]) for g in got])
    doc_th = np.concatenate([np.repeat(g[1], g[2]) for g in got])
    gram, piece, pos, left, more = (
        np.concatenate([g[3].astype(U64) | (g[4].astype(U64) << U64(32)) for g in got]),
        *(np.concatenate([g[k] for g in got]) for k in (5, 6, 7, 8)))
    order = np.argsort(gram)
    cut = _cuts(gram[order])
    size = np.diff(cut)
    keep = order[np.repeat(size > 1, size)]
    order = keep[np.lexsort((pos[keep], doc_th[keep], doc_id[keep], piece[keep], gram[keep]))]
    if not len(order):
        return []
    gram, piece, doc_id, doc_th = gram[order], piece[order], doc_id[order], doc_th[order]
    start = pos[order].astype(np.int64) - left[order]
    more = more[order].astype(np.int64)
    same_piece = np.concatenate([[False], (gram[1:] == gram[:-1]) & (piece[1:] == piece[:-1])])
    # the same place twice: a repeated row, not a repeat
    same_place = same_piece.copy()
    same_place[1:] &= (doc_id[1:] == doc_id[:-1]) & (doc_th[1:] == doc_th[:-1]) & (start[1:] == start[:-1])
    # a piece is repeated unless it is at the first place of its run
    run = np.flatnonzero(~same_piece)
    head = np.repeat(run, np.diff(np.append(run, len(order))))
    at_first = (doc_id == doc_id[head]) & (doc_th == doc_th[head]) & (start == start[head])
    repeated = ~at_first & ~same_place
    # first places of pieces whose gram has several different pieces
    g = _cuts(gram[run])
    kinds = np.diff(g)
    several = np.repeat(kinds > 1, kinds)
    want = run[several]
    shards = np.repeat(-(-kinds // p.split_at), kinds)[several]
    salt = piece[want] % shards.astype(U64)
    group = tv.mix64(gram[want] + (U64(part + 1) << U64(48)) + salt * U64(0x9E3779B97F4A7C15))
    out_doc = np.concatenate([np.flatnonzero(repeated), want])
    kind = np.concatenate([np.zeros(int(repeated.sum()), np.int8), np.ones(len(want), np.int8)])
    where = np.concatenate([np.full(int(repeated.sum()), -1), np.arange(len(want))])
    o = np.lexsort((start[out_doc], kind, doc_th[out_doc], doc_id[out_doc]))
    if not len(o):                            # only repeated rows met here
        return []
    out_doc, kind, where = out_doc[o], kind[o], where[o]
    new = np.concatenate([[True], (doc_id[out_doc][1:] != doc_id[out_doc][:-1]) | (doc_th[out_doc][1:] != doc_th[out_doc][:-1])])
    cut = np.append(np.flatnonzero(new), len(out_doc))
    rows = []
    for i, j in zip(cut[:-1], cut[1:]):
        k = i + int(np.searchsorted(kind[i:j], 1))
        d, w = out_doc[i:k], where[k:j]
        iv = _merge_intervals(start[d], start[d] + more[d] + p.length)
        x = out_doc[k:j]
        rq = _pack(group[w], start[x].astype(np.uint32), more[x].astype(np.uint8), (shards[w] > 1).astype(np.uint8)) if j > k else None
        rows.append((int(doc_id[out_doc[i]]), int(doc_th[out_doc[i]]), iv, rq))
    return rows


def _merge_intervals(a: np.ndarray, b: np.ndarray) -> bytes | None:
    """Sorted, disjoint union of intervals [a, b), packed; None if there are none."""
    if not len(a):
        return None
    o = np.argsort(a, kind="stable")
    a, b = a[o], np.maximum.accumulate(b[o])
    new = np.concatenate([[True], a[1:] > b[:-1]])
    return _pack(a[new].astype(np.uint32), b[np.append(np.flatnonzero(new)[1:] - 1, len(b) - 1)].astype(np.uint32))


def _per_part(fn, names: str, types):
    """Batches (part, blob) sorted by part: ``fn(blobs, part)`` once per part."""
    def run(batches):
        for t in whole_keys(batches):
            part = t.column(0).to_numpy()
            cut = _cuts(part)
            for i, j in zip(cut[:-1], cut[1:]):
                blobs = [x.as_py() for x in t.column(1).slice(i, j - i)]
                rows = fn(blobs, int(part[i]))
                if rows:
                    yield _batch(names, types, rows)
    return run


# -- 2. suffix arrays -------------------------------------------------------------------------

def suffix_order(data: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts with at least ``length`` bytes left in their piece, sorted by those bytes (ties by
    start), and the packed 8-byte words of the text.

    Larsson-Sadakane: ranks by the first 8 bytes, then by 16, 32, ... by sorting pairs of
    ranks within the groups that are not yet sorted; sorted members keep their rank.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n].copy().view(">u8").ravel().astype(U64)
    rank = np.zeros(n, np.int64)
    active = np.flatnonzero(left >= min(8, length))
    order = active[np.argsort(word[active])]
    cut = _cuts(word[order])
    size = np.diff(cut)
    rank[order] = np.repeat(cut[:-1], size)
    open_ = order[np.repeat(size > 1, size)]
    h = 8
    while h < length and len(open_):
        step = min(h, length - h)                              # the next depth is h + step
        open_ = open_[left[open_] >= h + step]
        second = rank[open_ + step]
        key = (rank[open_] << 32) | second
        o = np.argsort(key)
        open_, key = open_[o], key[o]
        first = rank[open_]
        sub = _cuts(key)
        size = np.diff(sub)
        group = _cuts(first)
        base = np.repeat(group[:-1], np.diff(group))
        fresh = first + np.repeat(sub[:-1], size) - base       # group rank + offset of the subgroup
        rank[open_] = fresh
        open_ = open_[np.repeat(size > 1, size)]
        h += step
    starts = np.flatnonzero(left >= length)
    return starts[np.argsort(rank[starts], kind="stable")], word


def neighbour_prefix(order: np.ndarray, data: np.ndarray, word: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Common prefix of every sorted start with the one before it (within their pieces).

    Kasai's rule: where the predecessor of start i is one past the predecessor of i - 1, the
    prefix is one shorter than at i - 1; only the other starts are compared, 8 bytes a time.
    """
    n = len(data)
    before = np.full(n + 1, -1, np.int64)
    before[order[1:]] = order[:-1]
    text = np.sort(order)
    phi = before[text]
    chained = np.zeros(len(text), bool)
    chained[1:] = (text[1:] == text[:-1] + 1) & (phi[1:] == phi[:-1] + 1) & (phi[:-1] >= 0)
    own = np.flatnonzero(~chained & (phi >= 0))
    a, b = text[own], phi[own]
    most = np.minimum(left[a], left[b])
    got = np.zeros(len(own), np.int64)
    live = np.arange(len(own))
    while len(live):
        x, y = a[live] + got[live], b[live] + got[live]
        inside = got[live] + 8 <= most[live]
        same = inside.copy()
        same[inside] = word[x[inside]] == word[y[inside]]
        got[live[same]] += 8
        done = live[~same]
        if len(done):                                          # fewer than 8 more bytes are equal
            for _ in range(8):
                x, y = a[done] + got[done], b[done] + got[done]
                ok = got[done] < most[done]
                ok[ok] = data[x[ok]] == data[y[ok]]
                done = done[ok]
                got[done] += 1
                if not len(done):
                    break
        live = live[same]
    plcp = np.zeros(len(text), np.int64)
    plcp[own] = got
    head = np.maximum.accumulate(np.where(chained, 0, np.arange(len(text))))
    plcp = np.maximum(plcp[head] - (np.arange(len(text)) - head), 0)
    out = np.zeros(n, np.int64)
    out[text] = plcp
    return out[order]


def repeats_in_shard(data: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts of strings that start earlier in the shard too, starts of first occurrences)."""
    order, word = suffix_order(data, left, length)
    same = neighbour_prefix(order, data, word, left) >= length
    return order[same], order[~same]


def _cut_pieces(p: SuffixDedup, parts: int):
    """Rows (id, th, packed text, requests) to packed pieces per shard range."""
    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            ids, ths = b.column(0).to_pylist(), b.column(1).to_pylist()
            doc, group, start, more, split, text = [], [], [], [], [], []
            size = 0

            def flush():
                g, s, m, x = (np.concatenate(v) for v in (group, start, more, split))
                d = np.concatenate(doc)
                t = np.concatenate([_slices(t_, s_, m_.astype(np.int64) + p.length) for t_, s_, m_ in zip(text, start, more)])
                n = m.astype(np.int64) + p.length
                at = np.concatenate([[0], np.cumsum(n)])
                part = (g >> U64(40)).astype(np.int64) % parts
                o = np.argsort(part, kind="stable")
                cut = _cuts(part[o])
                rows = []
                for i, j in zip(cut[:-1], cut[1:]):
                    k = o[i:j]
                    dd, count = np.unique(d[k], return_counts=True)
                    raw = _slices(t, at[k], n[k])
                    rows.append((int(part[k[0]]), _pack(
                        np.array([ids[r] for r in dd], np.int64), np.array([ths[r] for r in dd], np.int64),
                        count.astype(np.uint32), g[k], s[k], m[k], x[k],
                        np.frombuffer(zstandard.ZstdCompressor(level=1).compress(raw.tobytes()), np.uint8))))
                return _batch("part blob", [pa.int32(), pa.binary()], rows)

            for r in range(b.num_rows):
                raw = np.frombuffer(unzip.decompress(b.column(2)[r].as_py()), np.uint8)
                for blob in b.column(3)[r].as_py():
                    g, s, m, x = _unpack(blob, np.uint64, np.uint32, np.uint8, np.uint8)
                    doc.append(np.full(len(g), r))
                    group.append(g)
                    start.append(s)
                    more.append(m)
                    split.append(x)
                    text.append(raw)
                    size += len(g)
                if size > 20_000:             # about 3 MB of pieces
                    yield flush()
                    doc, group, start, more, split, text = [], [], [], [], [], []
                    size = 0
            if size:
                yield flush()
    return run


def _slices(data: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Concatenation of data[start : start + n]."""
    n = n.astype(np.int64)
    at = np.concatenate([[0], np.cumsum(n)])
    kind = np.int32 if len(data) < 1 << 31 and at[-1] < 1 << 31 else np.int64
    index = np.repeat((start.astype(np.int64) - at[:-1]).astype(kind), n)
    index += np.arange(at[-1], dtype=kind)
    return data[index]


_PIECE = (np.int64, np.int64, np.uint32, np.uint64, np.uint32, np.uint8, np.uint8, np.uint8)


def sort_shards(blobs: list[bytes], p: SuffixDedup, parts: int) -> list[tuple]:
    """Rows (kind, id, th, part, blob) of one shard range: kind 0 repeated intervals of a document,
    kind 1 sorted distinct strings of a split gram, for the merge."""
    unzip = zstandard.ZstdDecompressor()
    got = [_unpack(x, *_PIECE) for x in blobs]
    did = np.concatenate([np.repeat(g[0], g[2]) for g in got])
    dth = np.concatenate([np.repeat(g[1], g[2]) for g in got])
    group, start, more, split = (np.concatenate([g[k] for g in got]) for k in (3, 4, 5, 6))
    text = np.concatenate([np.frombuffer(unzip.decompress(g[7].tobytes()), np.uint8) for g in got])
    n = more.astype(np.int64) + p.length
    at = np.concatenate([[0], np.cumsum(n)[:-1]])
    order = np.argsort(group, kind="stable")
    cut = _cuts(group[order])
    rows, i = [], 0
    total = np.concatenate([[0], np.cumsum(n[order])])
    while i < len(cut) - 1:                                    # whole groups up to shard_bytes
        j = i + 1
        while j < len(cut) - 1 and total[cut[j + 1]] - total[cut[i]] <= p.shard_bytes:
            j += 1
        k = order[cut[i]:cut[j]]
        k = k[np.lexsort((start[k], dth[k], did[k]))]          # text order is the order of places
        rows += _sort_one(_slices(text, at[k], n[k]), n[k], did[k], dth[k], start[k].astype(np.int64), split[k], p, parts)
        i = j
    return rows


def _sort_one(data, n, did, dth, start, split, p: SuffixDedup, parts: int) -> list[tuple]:
    at = np.concatenate([[0], np.cumsum(n)])
    piece = np.repeat(np.arange(len(n)), n)
    left = at[1:][piece] - np.arange(len(data))
    again, first = repeats_in_shard(data, left, p.length)
    rows = []
    if len(again):
        pc = piece[again]
        rows += _interval_rows(did[pc], dth[pc], start[pc] + again - at[pc], p.length)
    pc = piece[first]
    wide = first[split[pc] > 0]
    if len(wide):
        pc = piece[wide]
        h = tv.span_hash(tv.prefix_hash(data), wide, wide + p.length)
        part = (h >> U64(48)).astype(np.int64) % parts
        o = np.lexsort((h, part))
        cut = _cuts(part[o])
        pos = (start[pc] + wide - at[pc]).astype(np.uint32)
        rows += [(1, None, None, int(part[o[i]]), _pack(h[o[i:j]], did[pc[o[i:j]]], dth[pc[o[i:j]]], pos[o[i:j]]))
                 for i, j in zip(cut[:-1], cut[1:])]
    return rows


def _interval_rows(did, dth, pos, length: int) -> list[tuple]:
    o = np.lexsort((pos, dth, did))
    did, dth, pos = did[o], dth[o], pos[o]
    new = np.concatenate([[True], (did[1:] != did[:-1]) | (dth[1:] != dth[:-1])])
    cut = np.append(np.flatnonzero(new), len(did))
    return [(0, int(did[i]), int(dth[i]), None, _merge_intervals(pos[i:j], pos[i:j] + length))
            for i, j in zip(cut[:-1], cut[1:])]


# -- 3. merge of split grams ------------------------------------------------------------------

_RUN = (np.uint64, np.int64, np.int64, np.uint32)


def merge_two(a: list[np.ndarray], b: list[np.ndarray]):
    """Merge two runs sorted by string hash, by binary search of one in the other.  Returns the
    merged run, keeping the earlier place of an equal string, and the later places."""
    at = np.searchsorted(a[0], b[0])
    hit = np.flatnonzero((at < len(a[0])) & (a[0][np.minimum(at, len(a[0]) - 1)] == b[0])) if len(a[0]) else np.zeros(0, int)
    i = at[hit]
    later_a = np.zeros(len(hit), bool)        # the place in a comes after the one in b
    for x, y in reversed(list(zip(a[1:], b[1:]))):
        x, y = x[i], y[hit]
        later_a = np.where(x == y, later_a, x > y)
    late = [np.where(later_a, x[i], y[hit]) for x, y in zip(a[1:], b[1:])]
    kept = [x.copy() for x in a]
    for x, y in zip(kept, b):
        x[i[later_a]] = y[hit[later_a]]
    rest = np.ones(len(b[0]), bool)
    rest[hit] = False
    return [np.insert(x, at[rest], y[rest]) for x, y in zip(kept, b)], late


def merge_runs(blobs: list[bytes], p: SuffixDedup) -> list[tuple]:
    runs = [[x.copy() for x in _unpack(b, *_RUN)] for b in blobs]
    late = []
    while len(runs) > 1:
        nxt = []
        for i in range(0, len(runs) - 1, 2):
            m, l = merge_two(runs[i], runs[i + 1])
            nxt.append(m)
            late.append(l)
        runs = nxt + ([runs[-1]] if len(runs) % 2 else [])
    late = [np.concatenate(x) for x in zip(*late)] if late else [np.zeros(0, np.int64)] * 3
    if not len(late[0]):
        return []
    return [(i, t, v) for _, i, t, _, v in _interval_rows(late[0], late[1], late[2].astype(np.int64), p.length)]


# -- the operator -----------------------------------------------------------------------------

def _text_hash(c: tv.Chunk) -> np.ndarray:
    return tv.span_hash(tv.prefix_hash(c.data), c.offsets[:-1], c.offsets[1:]).astype(np.int64)


def _packed_texts(bitmap):
    """(id, text, bit) rows that may be wanted to (id, th, compressed text)."""
    def run(batches):
        for b in batches:
            b = b.filter(pa.array(in_bitmap(bitmap.value, b.column(2))))
            zipper = zstandard.ZstdCompressor(level=1)
            for c in tv.chunks(b.column(1)):
                th = _text_hash(c)
                z = [zipper.compress(c.data[x:y].tobytes()) for x, y in zip(c.offsets[:-1], c.offsets[1:])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(c.first, len(th)), pa.array(th), pa.array(z, pa.binary())],
                                                 names=["id", "th", "z"])
    return run


RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
_RESULT_TYPES = [pa.int64()] * 4 + [pa.string(), pa.binary()]


def _untouched(bitmap, keep_text: bool):
    def run(batches):
        for b in batches:
            b = b.filter(pa.array(~in_bitmap(bitmap.value, b.column(2))))
            ids, rows = b.column(0).to_pylist(), []
            for c in tv.chunks(b.column(1)):
                for r in range(len(c.offsets) - 1):
                    raw = c.data[c.offsets[r]:c.offsets[r + 1]].tobytes()
                    rows.append((ids[c.first + r], len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw if keep_text else None))
            yield _batch("id n_bytes n_removed n_spans kept_sha256 kept", _RESULT_TYPES, rows)
    return run


def _cut_texts(keep_text: bool):
    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            ids, rows = b.column(0).to_pylist(), []
            for r in range(b.num_rows):
                raw = unzip.decompress(b.column(1)[r].as_py())
                spans = [_unpack(x, np.uint32, np.uint32) for x in (b.column(2)[r].as_py() or []) if x]
                kept, removed, n = raw, 0, 0
                if spans:
                    a, e = _unpack(_merge_intervals(np.concatenate([s[0] for s in spans]).astype(np.int64),
                                                    np.concatenate([s[1] for s in spans]).astype(np.int64)), np.uint32, np.uint32)
                    removed, n = int((e.astype(np.int64) - a).sum()), len(a)
                    kept = b"".join(raw[x:y] for x, y in zip([0, *e.tolist()], [*a.tolist(), len(raw)]))
                rows.append((ids[r], len(raw), removed, n, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            yield _batch("id n_bytes n_removed n_spans kept_sha256 kept", _RESULT_TYPES, rows)
    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     p: SuffixDedup = SuffixDedup(), keep_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with
    ``keep_text``, the remaining bytes as ``kept``."""
    spark = docs.sparkSession
    width = shuffle_partitions(spark)
    parts = 2 * width
    src = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)).alias("id"),
                      F.coalesce(docs[text_col], F.lit("")).alias("text"))

    def dealt(df):
        return df.repartition(width, "part").sortWithinPartitions("part")

    blobs = map_arrow(src, _anchor_blobs(p, parts), "part int, blob binary")
    matched = written(map_arrow(
        dealt(blobs), _per_part(lambda x, k: match_anchors(x, k, p), "id th iv rq", [pa.int64(), pa.int64(), pa.binary(), pa.binary()]),
        "id long, th long, iv binary, rq binary"), "suffix-match")

    wanted = matched.where("rq is not null")
    requests = wanted.groupBy("id", "th").agg(F.collect_list("rq").alias("rq"))
    texts = map_arrow(with_bitmap_bit(src, "id"), _packed_texts(id_bitmap(wanted, "id")), "id long, th long, z binary")
    # repeated rows are one document: its pieces are cut once
    held = texts.join(requests, ["id", "th"]).dropDuplicates(["id", "th"]).select("id", "th", "z", "rq")
    pieces = map_arrow(held, _cut_pieces(p, parts), "part int, blob binary")
    sorted_ = written(map_arrow(
        dealt(pieces), _per_part(lambda x, k: sort_shards(x, p, parts), "kind id th part blob",
                                 [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]),
        "kind int, id long, th long, part int, blob binary"), "suffix-sort")

    merged = map_arrow(dealt(sorted_.where("kind = 1").select("part", "blob")),
                       _per_part(lambda x, k: merge_runs(x, p), "id th iv", [pa.int64(), pa.int64(), pa.binary()]),
                       "id long, th long, iv binary")
    intervals = (matched.where("iv is not null").select("id", "th", "iv")
                 .unionByName(sorted_.where("kind = 0").select("id", "th", F.col("blob").alias("iv")))
                 .unionByName(merged))
    spans = written(intervals.groupBy("id", "th").agg(F.collect_list("iv").alias("iv")), "suffix-spans")
    bitmap = id_bitmap(spans, "id")
    marked = with_bitmap_bit(src, "id")
    touched = map_arrow(marked, _packed_texts(bitmap), "id long, th long, z binary")
    cut = map_arrow(touched.join(spans, ["id", "th"], "left").select("id", "z", "iv"), _cut_texts(keep_text), RESULT)
    out = map_arrow(marked, _untouched(bitmap, keep_text), RESULT).unionByName(cut)
    cols = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_text
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), *cols)
