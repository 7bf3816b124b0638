"""Operators 3 (suffix-array dedup), 7 (decontamination) and 8 (n-gram Jaccard join)."""

import hashlib
import random
import re

import numpy as np
import pytest

from livemetrics.llm.components import components
from livemetrics.llm.decontaminate import Containment, find_contaminated, remove_contaminated
from livemetrics.llm.jaccard_join import (
    NO_BUCKET, CountRTree, JaccardJoin, first_shared, jaccard_components, keep_first,
)
from livemetrics.llm.suffix_dedup import SuffixDedup, dedup_substrings, repeats_in_shard
from tests.llm.helpers import DOC_SCHEMA, LOWER, docs_frame, edge_rows, prose, words


# -- suffix arrays --------------------------------------------------------------------------

def brute_substrings(rows, length):
    """Distinct (id, text) documents in order of id; result by document."""
    docs = sorted(set((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for i, t in docs:
        b = t.encode()
        cover = bytearray(len(b))
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            if s in seen:
                cover[k:k + length] = b"\1" * length
            seen.add(s)
        kept = bytes(c for c, v in zip(b, cover) if not v)
        spans = len(re.findall(rb"\x01+", bytes(cover)))
        out[i, t] = (len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return out


def substring_rows():
    shared = prose(50, 40)
    rnd = random.Random(4)
    rows = [(i, prose(100 + i, 20) + shared[rnd.randint(0, 60):rnd.randint(150, 260)] + prose(200 + i, 15)) for i in range(40)]
    rows += [(60, "ab" * 200), (61, "x" * 350), (62, "ab" * 60), (63, prose(1, 30) + " " + prose(1, 30)),
             (64, "é" * 120), (65, shared[:99]), (66, shared[:100]), (None, shared[20:140])]
    return rows


@pytest.mark.parametrize("p", [SuffixDedup(), SuffixDedup(split_at=2, shard_bytes=1000)])
def test_substrings_match_brute_force(spark, p):
    rows = substring_rows() + [(70, None), (71, ""), (72, prose(9, 25_000)), (5, substring_rows()[5][1])]
    out = dedup_substrings(docs_frame(spark, rows).repartition(5), p=p).collect()
    want = brute_substrings(rows, 100)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=repr) == \
        sorted([(i, *want[i, t or ""]) for i, t in rows], key=repr)
    for r in out:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


def test_same_id_different_texts_and_empty_table(spark):
    rows = [(1, prose(3, 40)), (1, prose(3, 40) + " tail"), (2, prose(3, 40))]
    out = sorted((r.doc_id, r.n_removed > 0) for r in dedup_substrings(docs_frame(spark, rows)).collect())
    assert sorted(x for i, x in out if i == 1) == [False, True] and (2, True) in out
    assert dedup_substrings(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def test_suffix_array_of_one_shard():
    rnd = random.Random(1)
    for length in (8, 20, 37, 100):
        pieces = ["".join(rnd.choice("ab") for _ in range(rnd.randint(5, 200))) for _ in range(30)] + ["a" * 150] * 2
        data = np.frombuffer("".join(pieces).encode(), np.uint8)
        left = np.concatenate([np.arange(len(x), 0, -1) for x in pieces])
        again, first = repeats_in_shard(data, left, length)
        seen, want, at = set(), set(), 0
        for x in pieces:
            for k in range(len(x) - length + 1):
                s = x[k:k + length]
                if s in seen:
                    want.add(at + k)
                seen.add(s)
            at += len(x)
        assert set(again.tolist()) == want and len(first) == len(seen)


# -- Jaccard join ---------------------------------------------------------------------------

def shingles(t, n):
    w = words((t or "").translate(LOWER))
    return frozenset([tuple(w)]) if 0 < len(w) < n else frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def brute_components(rows, n, percent):
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i in ids}


def near_rows(n_copies=25):
    rnd = random.Random(7)
    rows, k = [], 0
    for base, n in ((1, 12), (2, 40), (3, 150), (4, 400)):
        w = prose(base, n).split()
        for c in range(n_copies):
            v = list(w)
            for _ in range(rnd.randint(0, max(1, n // 40))):
                v[rnd.randrange(n)] = f"new{rnd.randint(0, 5)}"
            rows.append((k, " ".join(v).upper() if c % 4 == 0 else " ".join(v)))
            k += 1
    passage = prose(77, 60)                   # shared by unrelated texts
    rows += [(1000 + i, prose(500 + i, 60) + " " + passage) for i in range(30)]
    return rows


@pytest.mark.parametrize("n,percent,members,low", [(3, 90, 4096, 16), (5, 80, 4096, 16), (5, 80, 6, 1)])
def test_components_match_brute_force(spark, n, percent, members, low):
    rows = near_rows() + [(2000, None), (2001, ""), (2002, "Two words"), (2003, "two WORDS"), (2003, "two WORDS"),
                          (2004, "one"), (2005, prose(8, 20_000)), (2006, prose(8, 20_000) + " x")]
    p = JaccardJoin(words=n, percent=percent, first_pairs=1, block_members=members, low_buckets=low)
    out = jaccard_components(docs_frame(spark, rows + [(None, "alone here now then")]), p=p).collect()
    comp = brute_components(rows, n, percent)
    assert len(out) == len(rows) + 1
    by_text = {}
    for r in out:
        by_text.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    for i, t in rows:
        assert by_text[i] == {(len(shingles(t, n)), comp[i])}, i
    assert by_text[None] == {(len(shingles("alone here now then", n)), None)}


def test_keep_first_keeps_one_per_group(spark):
    rows = near_rows(8) + [(2000, None), (2001, ""), (2002, "a b"), (2003, "A B")]
    df = docs_frame(spark, rows)
    out = keep_first(df)
    assert out.columns == df.columns
    comp = brute_components(rows, 5, 80)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(i for i in comp if comp[i] == i)


def test_rtree_loses_no_pair():
    rng = np.random.default_rng(0)
    vec = rng.integers(0, 6, (300, 8)).astype(np.int32)
    size = vec.sum(axis=1).astype(np.int64)
    a, b, bound = CountRTree(vec, size).search(vec, size, 80)
    over = np.minimum(vec[:, None], vec[None]).sum(axis=2)
    want = 180 * over >= 80 * (size[:, None] + size[None])
    assert set(zip(a.tolist(), b.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(want))))
    assert (over[a, b] == bound).all()


def test_first_shared_value_of_two_lists():
    a = np.array([[1, 4, 9], [2, 5, NO_BUCKET], [3, NO_BUCKET, NO_BUCKET]])
    b = np.array([[0, 4, 9], [1, 6, NO_BUCKET], [1, 3, 7]])
    assert first_shared(a, b).tolist() == [4, NO_BUCKET, 3]


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, k) for k in range(2, 30)] + [(30, 29), (7, 7), (500, 400)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 1 for i in range(1, 31)}, 500: 400, 400: 400}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty_jaccard(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert jaccard_components(empty).count() == 0
    assert keep_first(empty).columns == empty.columns


# -- decontamination ------------------------------------------------------------------------

def grams(t, n=5):
    w = re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").translate(LOWER))
    return [tuple(w)] if 0 < len(w) < n else [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]


def brute_contaminated(docs, items):
    out = []
    for d, t in docs:
        w = re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").translate(LOWER))
        for i, x in items:
            s = set(grams(x))
            if s:
                n = len(next(iter(s)))
                have = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
                if 100 * len(s & have) >= 80 * len(s):
                    out.append((d, i, len(s), len(s & have)))
    return sorted(out, key=repr)


def leak_tables():
    items = [(i, prose(300 + i, 8 + 3 * i)) for i in range(20)] + [(20, None), (21, ""), (22, "three Word item"), (23, prose(303, 17))]
    docs = [r[:2] for r in edge_rows()]
    for i in range(20):
        w = items[i][1].split()
        docs += [(100 + i, prose(i, 200) + ". " + items[i][1].upper() + "! " + prose(i + 50, 100)),
                 (200 + i, prose(i, 30) + " " + " ".join(w[:len(w) * 9 // 10]) + " " + prose(i + 60, 30)),
                 (300 + i, prose(i, 30) + " " + " ".join(w[::2]))]
    docs += [(400, "So: THREE word, item."), (401, prose(8, 12_000) + " " + items[3][1] + " " + prose(9, 12_000))]
    return docs, items


@pytest.mark.parametrize("block", [2_000_000, 100])
def test_contaminated_match_brute_force(spark, block):
    docs, items = leak_tables()
    df = docs_frame(spark, docs)
    it = spark.createDataFrame(items, "item_id long, text string")
    p = Containment(block_words=block)
    got = sorted(((r.doc_id, r.item_id, r.n_item, r.n_found) for r in find_contaminated(df, it, p).collect()), key=repr)
    want = brute_contaminated(docs, items)
    assert got == want and len(want) > 40
    bad = {d for d, *_ in want}
    kept = remove_contaminated(df, it, p)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.select("doc_id").collect()), key=repr) == sorted((d for d, _ in docs if d not in bad), key=repr)


def test_empty_benchmark_or_documents(spark):
    docs, items = leak_tables()
    none = spark.createDataFrame([], "item_id long, text string")
    df = docs_frame(spark, docs[:5])
    assert find_contaminated(df, none).count() == 0 and remove_contaminated(df, none).count() == 5
    assert find_contaminated(spark.createDataFrame([], DOC_SCHEMA), spark.createDataFrame(items, "item_id long, text string")).count() == 0
