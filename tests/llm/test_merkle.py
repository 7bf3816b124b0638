"""Merkle manifest against a plain Python tree."""

import hashlib
import zlib

import pytest

from livemetrics.llm import merkle
from livemetrics.llm.merkle import merkle_digest
from tests.llm.helpers import LOWER, docs_frame, edge_rows, prose


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text):
    vals = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))


def tree(nodes):
    """Levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([H("".join(at[i:i + 16])) for i in range(0, len(at), 16)])
    return levels


def path(levels, i):
    out = []
    for at in levels[:-1]:
        lo = i // 16 * 16
        out.append(("".join(at[lo:i]), "".join(at[i + 1:lo + 16])))
        i //= 16
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, lf, r) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            steps = path(trees[s], i) + path(top, k)
            h = lf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                h = leaf(r, r["text"].translate(LOWER))
            for lo, hi in steps:
                h = H(lo + h + hi)
            root = top[-1][0]
            out.append((r["doc_id"], lf, trees[s][-1][0], root, H("".join(lo + hi for lo, hi in steps)), h, h == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [1, 3])
def test_proofs_equal_a_plain_tree(spark, monkeypatch, levels):
    """Blocks of 16 make several rounds of the small table; sources of 1, 2, 16, 17, 300 and 1500 rows."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16 ** levels)
    rows, i = [], 0
    for source, n in (("one", 1), ("two", 2), (None, 16), ("Zé", 17), ("a", 300), ("hot", 1500), ("", 1)):
        for _ in range(n):
            i += 7
            rows.append((i * 31 % 100_003, f"Text {i} ABC" if i % 3 else f"text {i}", "en", source))
    rows += [(10_000_000 + k, "X", "de", f"s{k:02d}") for k in range(20)]        # more than 16 sources
    df = docs_frame(spark, rows)
    got = sorted((tuple(r) for r in merkle_digest(df).collect()), key=repr)
    assert got == brute(df.collect())
    assert 0 < sum(not r[-1] for r in got) < len(got) / 4


def test_edges_repeated_rows_nulls_and_long_texts(spark):
    rows = edge_rows() + [(None, None, None, None), (8, prose(7, 120)), (77, "é" * 50_000, None, "x" * 3000)]
    df = docs_frame(spark, rows)
    assert sorted((tuple(r) for r in merkle_digest(df).collect()), key=repr) == brute(df.collect())
    assert merkle_digest(df.where("1 = 0")).count() == 0
    one = df.where("doc_id = 4")
    (r,) = merkle_digest(one).collect()
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == H("")


def test_changed_blocks_name_the_block_of_a_changed_row(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    a = docs_frame(spark, [(i, f"t{i}", "en", f"s{i % 2}") for i in range(200)])
    b = docs_frame(spark, [(i, "other" if i == 101 else f"t{i}", "en", f"s{i % 2}") for i in range(200)])
    old, _ = merkle.manifest(merkle.leaves(a))
    new, _ = merkle.manifest(merkle.leaves(b))
    assert [tuple(r) for r in merkle.changed_blocks(old, new).collect()] == [("=s1", 101 // 2 // 16)]
    assert merkle.changed_blocks(old, old).count() == 0
