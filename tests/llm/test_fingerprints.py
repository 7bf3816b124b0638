"""Fingerprints against a plain one-permutation MinHash, likeness against exact Jaccard."""

import hashlib
import struct

import xxhash
from pyspark.sql import functions as F

from livemetrics.llm.fingerprints import BINS, edited_prints, fingerprint, likeness, probes
from tests.llm.helpers import docs_frame, edge_rows, prose, words


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(*vals):
    h = 42
    for v in vals:
        h = xxhash.xxh64(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed=h).intdigest()
    return signed(h)


def shingles(text):
    w = [xx(x) for x in words((text or "").lower())]
    if len(w) >= 5:
        return {xx(*w[i:i + 5]) for i in range(len(w) - 4)}
    return {xx(*w)} if w else set()          # an array is hashed element by element


def plain(text):
    bins = {}
    for h in shingles(text):
        bins[h >> 56] = min(h, bins.get(h >> 56, h))
    if not bins:
        return ""
    out = []
    for b in range(-BINS // 2, BINS // 2):
        looks = [b] + [x - BINS // 2 for x in probes(b + BINS // 2)]
        found = [f for f in looks if f in bins]
        if found:
            out.append(bins[found[0]] & 15)
        else:                                # the filled bin that comes first in this bin's own order
            out.append(min((xx(b, f) & ~15) | (bins[f] & 15) for f in bins) & 15)
    return "".join(f"{v:x}" for v in out)


def like(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    same = sum(x == y for x, y in zip(a, b)) / BINS
    return max(0.0, (same - 1 / 16) / (1 - 1 / 16))


def brute(rows):
    key = lambda r: (r[0] is None, -(r[0] or 0), xx(r[1] or ""), signed(0) or xx_one(r[1] or ""))
    order = sorted(rows, key=key)
    out = []
    for i, r in enumerate(order):
        text, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        need = len(text) // 3
        edited = text[:len(text) - need] + nxt[:need]
        a, b, c = plain(text), plain(edited), plain(nxt)
        out.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(like(a, b), 9), round(like(a, c), 9)))
    return sorted(out, key=repr)


def xx_one(text):
    h = xxhash.xxh64(struct.pack("<i", 1), seed=42).intdigest()      # F.lit(1) is an int
    return signed(xxhash.xxh64(text.encode(), seed=h).intdigest())


def got(df):
    return sorted(((r[0], r[1], r[2], r[3], r[4], round(r[5], 9), round(r[6], 9)) for r in edited_prints(df).collect()), key=repr)


def test_rows_equal_a_plain_implementation(spark):
    rows = [(i, prose(i, 1 + (i * 37) % 900)) for i in range(40)] + [(50, prose(3, 200)), (51, prose(3, 200)), (52, "AB cd"), (53, "ab CD")]
    assert got(docs_frame(spark, rows)) == brute(rows)


def test_edges_nulls_ties_repeats_and_long_texts(spark):
    rows = edge_rows() + [(8, "the same id, another text"), (None, None), (None, "two null ids")]
    rows = [(r[0], r[1]) for r in rows]
    assert got(docs_frame(spark, rows)) == brute(rows)
    assert edited_prints(docs_frame(spark, rows).where("1 = 0")).count() == 0
    one = [(1, "a single document is its own successor, whatever its length may be")]
    assert got(docs_frame(spark, one)) == brute(one)


def test_likeness_is_close_to_exact_jaccard(spark):
    texts, exact = [], []
    for i in range(60):
        base = prose(i, 700).split()
        cut = (i % 10) * 70
        a, b = " ".join(base), " ".join(base[:700 - cut] + prose(1000 + i, 700).split()[:cut])
        x, y = shingles(a), shingles(b)
        texts.append((a, b))
        exact.append(len(x & y) / len(x | y))
    df = spark.createDataFrame(texts, "a string, b string")
    est = [r[0] for r in df.select(likeness(fingerprint(F.col("a")), fingerprint(F.col("b")))).collect()]
    errors = [e - x for e, x in zip(est, exact)]
    assert abs(sum(errors) / len(errors)) < 0.015                # no bias left
    assert max(map(abs, errors)) < 0.14                          # four standard deviations of 256 bins


def test_no_python_in_the_plan(spark):
    plan = edited_prints(docs_frame(spark, [(1, "a"), (2, "b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
