"""Operator 8, n-gram Jaccard join: count vectors under an R-tree, within signature buckets.

Two documents link when 100 * |A & B| >= percent * |A | B| for their sets of distinct word
shingles.  The result is each document's set size and connected component.

1. Equal sets are one class, found by grouping on a hash of the set; only class
   representatives (smallest id) go on, so copies never form pairs.
2. Buckets.  A linked pair differs in at most D shingles (D from the size class of the
   smaller set), so if shingles are hashed into P > D groups, at least P - D groups have
   equal content.  Every class emits one signature per non-empty group; classes that share
   a signature share a bucket.  P leaves room for empty groups; a class with too many empty
   ones also emits under the next seed, and after the last seed its empty groups too, so
   no pair is lost.  Signatures travel packed (6 bytes each) by hash range and are matched
   in numpy, one range at a time.
3. Star round: each bucket proposes the pairs of its most central member with the others.
   Proposals are bounded by the summed coordinate minima of the count vectors (shingles
   hashed into ``dims`` groups, counted) and the survivors verified on the exact sets.
4. Search rounds: within each bucket that still holds several components, an R-tree over
   the count vectors (coordinate maxima per node; a node is left out when the sum of
   coordinate minima with the query stays below the overlap a link needs) finds the pairs
   of different components that may link; they are verified too.  Members share many
   buckets, so each carries the ``low_buckets`` smallest of its buckets: if the lists of two
   members have a value in common, only the bucket of the smallest such value proposes the
   pair (both are in it), else every shared bucket does.  The first round takes the best few
   per bucket and component pair, the last takes all: no link is lost, and members of one
   component are never paired.  A bucket of more than ``block_members`` members is searched
   in blocks, one per pair of its parts, so no task holds a whole large bucket.

Count vectors of large sets have more coordinates (they fold to ``dims`` for the tree), so the
bound tells unrelated texts apart at every length.  An R-tree over all points alone would not do: in ``dims`` dimensions the boxes of unrelated
documents overlap, and every query would visit most of the tree.  The buckets are its shards.

Defined edge results: null text or no words: empty set, own component; fewer words than
``words``: the whole sequence is one shingle; repeated rows: same class; rows of one id are
one node; a null id has a null component unless its set equals another document's; an
empty table gives an empty result; other columns are ignored (or kept, in ``keep_first``).
Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemetrics.llm import textvec as tv
from livemetrics.llm.common import (
    drop_ids, id_bitmap, in_bitmap, map_arrow, shuffle_partitions, whole_keys, with_bitmap_bit, written,
)
from livemetrics.llm.components import components


@dataclass(frozen=True)
class JaccardJoin:
    words: int = 3
    percent: int = 90
    dims: int = 128                          # coordinates of a count vector
    seeds: int = 5                           # partitions tried for sets with empty groups
    ratio: float = 1.5                       # width of a size class
    first_pairs: int = 32                    # pairs per block and component pair in early rounds
    low_buckets: int = 16                    # smallest buckets a member carries, to propose a pair once
    block_members: int = 4096                # members of a bucket that are searched as one part


#: pads a member's list of smallest buckets
NO_BUCKET = np.iinfo(np.int64).max


def _sets(col: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text; words are A-Z lower-cased."""
    for c in tv.chunks(col):
        w = tv.words(tv.lower_ascii(c))
        for r in range(len(c.offsets) - 1):
            yield c.first + r, tv.shingle_set(w.hash[w.first[r]:w.first[r + 1]], words)


def set_key(s: np.ndarray) -> int:
    """Signed 64-bit hash of a whole set."""
    a = int(tv.mix64(s).sum(dtype=np.uint64))
    return int(tv.mix64(np.array([a ^ (len(s) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)], np.uint64))[0].astype(np.int64))


def count_vector(s: np.ndarray, dims: int) -> np.ndarray:
    """Counts of hashed shingles; large sets get a power of two times ``dims`` coordinates (about
    one per eight shingles), so the bound tells unrelated texts apart at every length."""
    while dims * 8 < len(s):
        dims *= 2
    return np.bincount((s >> tv.U64(32)).astype(np.int64) % dims, minlength=dims).astype(np.int32)


def fold(vec: np.ndarray, dims: int) -> np.ndarray:
    """The count vector of the same set in ``dims`` coordinates."""
    return vec if len(vec) == dims else vec.reshape(-1, dims).sum(axis=0, dtype=np.int32)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> int:
    dims = min(len(a), len(b))
    return int(np.minimum(fold(a, dims), fold(b, dims)).sum())


def size_class(n: int, ratio: float) -> tuple[int, int]:
    """(class number, largest size of the class); classes are geometric."""
    c, top = 0, 1
    while n > top:
        c, top = c + 1, max(top + 1, int(top * ratio))
    return c, top


def emitted_classes(n: int, p: JaccardJoin) -> list[tuple[int, int, int]]:
    """(class, D, P) under which a set of size n emits: its own class, and every lower class
    whose sizes a linked smaller set could have."""
    out = []
    c, top = 0, 1
    while True:
        if 100 * top >= p.percent * n:       # sizes up to top include one that may link
            # |A & B| >= t |A | B| and |A & B| <= top bound the union, hence the difference
            union = 100 * top // p.percent
            d = union * (100 - p.percent) // 100
            out.append((c, d, d + d // 4 + 2 if d else 1))
        if n <= top:
            return out
        c, top = c + 1, max(top + 1, int(top * p.ratio))


def signatures(s: np.ndarray, p: JaccardJoin) -> np.ndarray:
    """Group signatures of a set under all its size classes."""
    if not len(s):
        return np.zeros(0, np.uint64)
    out = []
    mixed = tv.mix64(s + tv.U64(0x632BE59BD9B4E019))
    for c, d, groups in emitted_classes(len(s), p):
        for seed in range(p.seeds):
            salt = tv.U64((c * 64 + seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            if groups == 1:
                out.append(tv.mix64(np.array([mixed.sum(dtype=np.uint64) ^ salt], np.uint64)))
                break
            g = (tv.mix64(s ^ salt) >> tv.U64(32)).astype(np.int64) % groups
            order = np.argsort(g, kind="stable")
            gs = g[order]
            at = np.flatnonzero(np.concatenate([[True], gs[1:] != gs[:-1]]))
            total = np.add.reduceat(mixed[order], at)
            out.append(tv.mix64((total + gs[at].astype(np.uint64) * tv.U64(0xC2B2AE3D27D4EB4F)) ^ salt))
            empty = groups - len(at)
            if empty <= groups - d - 1:
                break                        # some equal group is not empty: nothing more to emit
            if seed == p.seeds - 1:
                lack = np.setdiff1d(np.arange(groups), gs[at]).astype(np.uint64)
                out.append(tv.mix64((lack + tv.U64(1)) * tv.U64(0xD6E8FEB86659FD93) ^ ~salt))
    return np.concatenate(out)


# -- packed signature exchange --------------------------------------------------------------

def _pack(keys: np.ndarray, owner: np.ndarray, sig: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """(part, blob) rows: per part the class keys, their entry counts, and 48 bits per entry."""
    part = (sig >> tv.U64(48)).astype(np.int64) % parts
    order = np.lexsort((owner, part))
    part, owner, sig = part[order], owner[order], sig[order]
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
    for a, b in zip(cut[:-1], cut[1:]):
        o, n = np.unique(owner[a:b], return_counts=True)
        s = sig[a:b]
        yield int(part[a]), b"".join([
            np.array([len(o), b - a], np.int64).tobytes(), keys[o].tobytes(), n.astype(np.uint32).tobytes(),
            s.astype(np.uint32).tobytes(), (s >> tv.U64(32)).astype(np.uint16).tobytes()])


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(class key, 48-bit signature) of every entry."""
    k, m = (int(x) for x in np.frombuffer(blob, np.int64, 2))
    at = 16
    keys = np.frombuffer(blob, np.int64, k, at)
    at += 8 * k
    n = np.frombuffer(blob, np.uint32, k, at)
    at += 4 * k
    low = np.frombuffer(blob, np.uint32, m, at)
    at += 4 * m
    high = np.frombuffer(blob, np.uint16, m, at)
    return np.repeat(keys, n), low.astype(np.uint64) | (high.astype(np.uint64) << tv.U64(32))


def _signature_blobs(p: JaccardJoin, parts: int):
    def run(batches):
        # gathered over a task's texts, so blobs stay large however many parts there are
        held: dict[int, np.ndarray] = {}
        size = 0

        def flush():
            owner = np.repeat(np.arange(len(held)), [len(g) for g in held.values()])
            return _rows(_pack(np.array(list(held), np.int64), owner, np.concatenate(list(held.values())), parts))

        for b in batches:
            for _, s in _sets(b.column(0), p.words):
                k = set_key(s)
                if not len(s) or k in held:
                    continue
                held[k] = signatures(s, p)
                size += len(held[k])
                if size > 1_000_000:
                    yield from flush()
                    held.clear()
                    size = 0
        if held:
            yield from flush()
    return run


def _rows(pairs) -> Iterator[pa.RecordBatch]:
    part, blob = [], []
    for a, x in pairs:
        part.append(a)
        blob.append(x)
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(blob, pa.binary())], names=["part", "blob"])


def match_part(key: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of one hash range: star pairs (centre, other) and, for buckets of three or more,
    (bucket, member) rows, each distinct list of members once."""
    none = np.zeros(0, np.int64)
    order = np.argsort(sig)
    s = sig[order]
    run = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else none
    size = np.diff(np.append(run, len(s)))
    many = np.repeat(size > 1, size)
    key, s = key[order[many]], s[many]
    if not len(s):
        return none, none, none, none
    names, idx = np.unique(key, return_inverse=True)
    order = np.lexsort((idx, s))
    s, idx = s[order], idx[order]
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (idx[1:] != idx[:-1])])      # copies of one class
    s, idx = s[new], idx[new]
    run = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    size = np.diff(np.append(run, len(s)))
    many = np.repeat(size > 1, size)
    idx, bucket = idx[many], np.repeat(np.arange(len(run)), size)[many]
    if not len(idx):
        return none, none, none, none
    share = np.bincount(idx, minlength=len(names))             # central: in many buckets of this range
    run = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    size = np.diff(np.append(run, len(idx)))
    # among the nearly most central the smallest key: ranges mostly agree on a group's centre
    edge = share[idx] < 0.8 * np.repeat(np.maximum.reduceat(share[idx], run), size)
    order = np.lexsort((idx, edge, bucket))
    idx = idx[order]
    centre = np.repeat(idx[run], size)
    other = np.ones(len(idx), bool)
    other[run] = False
    pair = np.unique(centre[other].astype(np.int64) * len(names) + idx[other])
    token = np.add.reduceat(tv.mix64(names[idx].astype(np.uint64)), run)
    wide = np.flatnonzero(size > 2)
    _, once = np.unique(token[wide], return_index=True)
    take = np.zeros(len(run), bool)
    take[wide[once]] = True
    rows = np.repeat(take, size)
    return (names[pair // len(names)], names[pair % len(names)],
            np.repeat(token, size)[rows].astype(np.int64), names[idx[rows]])


def _match(batches):
    """Packed blobs, sorted by part, to (kind, a, b) rows: 0 pair, 1 bucket member."""
    def out(blobs):
        entries = [_unpack(x) for x in blobs]
        ca, cb, bucket, member = match_part(np.concatenate([e[0] for e in entries]), np.concatenate([e[1] for e in entries]))
        kind = np.concatenate([np.zeros(len(ca), np.int32), np.ones(len(bucket), np.int32)])
        return pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(np.concatenate([ca, bucket])), pa.array(np.concatenate([cb, member]))],
            names=["kind", "a", "b"])

    now, held = None, []
    for b in batches:
        for part, blob in zip(b.column(0).to_pylist(), b.column(1)):
            if part != now and held:
                yield out(held)
                held = []
            now = part
            held.append(blob.as_py())
    if held:
        yield out(held)


# -- count-vector R-tree --------------------------------------------------------------------

class CountRTree:
    """Packed R-tree over count vectors: points sorted by size then by position, ``fanout`` per
    node; a node keeps the coordinate maxima and the smallest size below it."""

    def __init__(self, vec: np.ndarray, size: np.ndarray, fanout: int = 16):
        self.order = np.lexsort((vec[:, 0], vec.argmax(axis=1), size))
        self.fanout = fanout
        self.levels = [(vec[self.order], size[self.order])]
        while len(self.levels[-1][1]) > fanout:
            v, n = self.levels[-1]
            cut = np.arange(0, len(n), fanout)
            self.levels.append((np.maximum.reduceat(v, cut, axis=0), np.minimum.reduceat(n, cut)))

    def search(self, q: np.ndarray, size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, overlap bound) of every pair whose summed coordinate minima reach the
        overlap a link needs: percent / (100 + percent) of the two sizes together."""
        top = len(self.levels) - 1
        qi = np.repeat(np.arange(len(q)), len(self.levels[top][1]))
        ni = np.tile(np.arange(len(self.levels[top][1])), len(q))
        for level in range(top, -1, -1):
            v, n = self.levels[level]
            bound = np.concatenate([np.minimum(q[qi[i:i + 65536]], v[ni[i:i + 65536]]).sum(axis=1)
                                    for i in range(0, len(qi), 65536)]) if len(qi) else np.zeros(0, np.int64)
            ok = (100 + percent) * bound >= percent * (size[qi] + n[ni])
            qi, ni, bound = qi[ok], ni[ok], bound[ok]
            if level:
                below = len(self.levels[level - 1][1])
                child = ni[:, None] * self.fanout + np.arange(self.fanout)
                qi = np.repeat(qi, self.fanout)
                ni = child.ravel()
                inside = ni < below
                qi, ni = qi[inside], ni[inside]
        return qi, self.order[ni], bound


def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row the smallest value that both of two ascending lists (rows of two matrices, padded
    with ``NO_BUCKET``) hold; ``NO_BUCKET`` if they share none."""
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 8192):
        x, y = a[i:i + 8192], b[i:i + 8192]
        out[i:i + 8192] = np.where((x[:, :, None] == y[:, None, :]).any(axis=2), x, NO_BUCKET).min(axis=1)
    return out


def _search_block(name: int, block: tuple[int, int], ids, comp, size, vec, part, low, percent: int, limit: int | None):
    """Pairs of different components of one block of a bucket that may link and that no other
    block proposes."""
    tree = CountRTree(vec, size)
    qa, qb, qo = [], [], []
    for i in range(0, len(ids), 256):
        a, b, o = tree.search(vec[i:i + 256], size[i:i + 256], percent)
        a = a + i
        ok = ((comp[a] < comp[b]) & (np.minimum(part[a], part[b]) == block[0]) & (np.maximum(part[a], part[b]) == block[1]))
        a, b, o = a[ok], b[ok], o[ok]
        home = first_shared(low[a], low[b])
        ok = (home == name) | (home == NO_BUCKET)
        qa.append(a[ok])
        qb.append(b[ok])
        qo.append(o[ok])
    a, b, o = np.concatenate(qa), np.concatenate(qb), np.concatenate(qo)
    if limit is not None and len(a) > limit:
        gap = size[a] + size[b] - 2 * o
        order = np.lexsort((gap, comp[b], comp[a]))
        a, b = a[order], b[order]
        new = np.concatenate([[True], (comp[a][1:] != comp[a][:-1]) | (comp[b][1:] != comp[b][:-1])])
        rank = np.arange(len(a)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        a, b = a[rank < limit], b[rank < limit]
    return ids[a], ids[b]


def _search_blocks(p: JaccardJoin, limit: int | None):
    """Rows (block, bucket, x, y, id, comp, n, part, low, vec) sorted by block, bucket, x and y to
    candidate pairs (a, b)."""
    def run(batches):
        for t in whole_keys(batches):
            where = np.stack([t.column(i).to_numpy() for i in range(4)])
            ids, comp, size, part = (t.column(i).to_numpy() for i in range(4, 8))
            low = np.full((len(ids), p.low_buckets), NO_BUCKET, np.int64)
            for i, x in enumerate(t.column(8).to_pylist()):
                low[i, :len(x)] = x
            vec = np.stack([fold(np.frombuffer(v.as_buffer(), np.int32), p.dims) for v in t.column(9)])
            cut = np.flatnonzero(np.concatenate([[True], (where[:, 1:] != where[:, :-1]).any(axis=0), [True]]))
            for i, j in zip(cut[:-1], cut[1:]):
                if j - i > 1:
                    _, name, x, y = (int(v) for v in where[:, i])
                    a, b = _search_block(name, (x, y), ids[i:j], comp[i:j], size[i:j], vec[i:j], part[i:j], low[i:j],
                                         p.percent, limit)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    return run


def _blocks(named: DataFrame, nodes: DataFrame, low: DataFrame, p: JaccardJoin) -> DataFrame:
    """Members (bucket, id, comp) of the buckets that hold several components, as rows of
    ``_search_blocks``: a bucket of more than ``block_members`` is dealt into parts, and each pair
    of parts (x <= y) is a block, so no task holds more than two parts of a bucket."""
    mixed = (named.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"))
             .where("lo < hi").select("bucket", F.ceil(F.col("m") / p.block_members).cast("int").alias("parts")))
    rows = (named.join(mixed, "bucket").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("x", F.least("part", "other")).withColumn("y", F.greatest("part", "other")))
    return (rows.join(nodes.select("id", "n", "vec"), "id").join(low, "id")
            .select(F.xxhash64("bucket", "x", "y").alias("block"), "bucket", "x", "y", "id", "comp", "n", "part", "low", "vec"))


# -- the join -------------------------------------------------------------------------------

def _points(docs: DataFrame, p: JaccardJoin) -> DataFrame:
    """Per row: doc_id, n, key, vec."""
    def run(batches):
        for b in batches:
            n, key, vec = [], [], []
            for _, s in _sets(b.column(1), p.words):
                n.append(len(s))
                key.append(set_key(s))
                vec.append(count_vector(s, p.dims).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(key, pa.int64()),
                                              pa.array(vec, pa.binary())], names=["doc_id", "n", "key", "vec"])

    return map_arrow(docs, run, "doc_id long, n long, key long, vec binary")


def _bounded(pairs: DataFrame, nodes: DataFrame, p: JaccardJoin) -> DataFrame:
    """Pairs of ids (a, b) with the sizes, after the count-vector bound."""
    a = nodes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("vec").alias("va"))
    b = nodes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("vec").alias("vb"))

    def run(batches):
        for x in batches:
            if not x.num_rows:
                continue
            na, nb = (x.column(i).to_numpy() for i in (2, 3))
            over = np.array([overlap_bound(np.frombuffer(va.as_buffer(), np.int32), np.frombuffer(vb.as_buffer(), np.int32))
                             for va, vb in zip(x.column(4), x.column(5))])
            ok = (100 + p.percent) * over >= p.percent * (na + nb)
            y = x.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays(y.columns[:4], names=["a", "b", "na", "nb"])

    both = pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "va", "vb")
    return map_arrow(both, run, "a long, b long, na long, nb long")


def _verified(docs: DataFrame, pairs: DataFrame, p: JaccardJoin) -> DataFrame:
    """The pairs (a, b, na, nb) whose exact sets link, as edges (u, v).  Sets are recomputed from
    the texts of the candidates only (bounded bitmap before the shuffle)."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    bitmap = id_bitmap(ids, "id")
    marked = with_bitmap_bit(docs, "doc_id")

    def run(batches):
        for b in batches:
            b = b.filter(pa.array(in_bitmap(bitmap.value, b.column(2))))
            if b.num_rows:
                sets = [s.astype(np.int64) for _, s in _sets(b.column(1), p.words)]
                off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = pa.array(np.concatenate(sets))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(off), flat)], names=["id", "s"])

    sets = map_arrow(marked, run, "id long, s array<long>")
    x = (pairs.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
         .join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (x.where(100 * both >= p.percent * (F.size("sa") + F.size("sb") - both))
            .select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       p: JaccardJoin = JaccardJoin()) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    points = written(_points(src, p), "jaccard-points")
    classes = (points.where("n > 0").groupBy("key", "n")
               .agg(F.min("doc_id").alias("id"), F.min("vec").alias("vec")))
    classes = written(classes, "jaccard-classes")
    nodes = classes.where("id is not null")
    width = shuffle_partitions(spark)
    parts = 2 * width
    blobs = map_arrow(src.select("text"), _signature_blobs(p, parts), "part int, blob binary")
    matched = written(map_arrow(blobs.repartition(width, "part").sortWithinPartitions("part"), _match,
                                "kind int, a long, b long"), "jaccard-match")
    of = nodes.select(F.col("key").alias("_k"), "id")
    pairs = (matched.where("kind = 0")
             .join(of.select(F.col("_k").alias("a"), F.col("id").alias("ia")), "a")
             .join(of.select(F.col("_k").alias("b"), F.col("id").alias("ib")), "b")
             .select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b")).where("a <> b").distinct())
    members = written(matched.where("kind = 1").select(F.col("a").alias("bucket"), F.col("b").alias("_k")).distinct()
                      .join(of, "_k").select("bucket", "id"), "jaccard-members")
    low = written(members.groupBy("id").agg(F.slice(F.sort_array(F.collect_list("bucket")), 1, p.low_buckets).alias("low")),
                  "jaccard-low")
    edges = written(_verified(src, written(_bounded(pairs, nodes, p), "jaccard-pairs"), p), "jaccard-edges")
    label = components(edges)
    for limit in (p.first_pairs, None):
        named = (members.join(label, "id", "left")
                 .select("bucket", "id", F.coalesce("component", "id").alias("comp")))
        rows = _blocks(named, nodes, low, p)
        found = map_arrow(rows.repartition(width, "block").sortWithinPartitions("block", "bucket", "x", "y"),
                          _search_blocks(p, limit), "a long, b long")
        found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        found = written(_bounded(found, nodes, p), "jaccard-found")
        if found.isEmpty():
            continue                          # a limited round may have cut what would have passed: the exact one still runs
        more = written(_verified(src, found, p), "jaccard-more")
        if not more.isEmpty():                # the components so far, as stars, and the new links
            label = components(label.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(more))
    comp = (classes.join(label, "id", "left").select("key", F.col("n").alias("_n"), F.coalesce("component", "id").alias("comp")))
    out = points.join(comp, (points["key"] == comp["key"]) & (points["n"] == comp["_n"]) & (points["n"] > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               p: JaccardJoin = JaccardJoin(words=5, percent=80)) -> DataFrame:
    """One document of each component (the smallest id), with exactly the input's columns."""
    comp = written(jaccard_components(docs, id_col, text_col, p).where("component_id <> doc_id")
                   .select(F.col("doc_id").alias("_gone_id")), "jaccard-gone")
    return drop_ids(docs, id_col, comp, "_gone_id")


def oracle_sql(p: JaccardJoin = JaccardJoin()) -> str:
    """DuckDB SQL of doc_id, n_shingles and component_id: all links between distinct sets by a join
    on shingle strings, then reachability."""
    up = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{up}', '{up.lower()}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {p.words - 1}), ' ') AS s
       FROM w, unnest(range(1, greatest(len(w) - {p.words - 2}, 2))) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS k FROM sh GROUP BY doc_id),
c AS (SELECT *, min(doc_id) OVER (PARTITION BY k) AS rep FROM n),
one AS (SELECT sh.doc_id, s, n FROM sh JOIN c USING (doc_id) WHERE doc_id = rep),
link AS (SELECT a.doc_id AS x, b.doc_id AS y FROM one a JOIN one b ON a.s = b.s AND a.doc_id < b.doc_id
         GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {p.percent} * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM link UNION SELECT y, x FROM link UNION SELECT doc_id, rep FROM c UNION SELECT rep, doc_id FROM c),
r(doc_id, node) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(node) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)"""
