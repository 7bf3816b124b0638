"""Prefix trie against a walked trie, list ranking against a loop."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from livemetrics.llm import conversation_trie, list_ranking
from livemetrics.llm.conversation_trie import prefix_trie
from livemetrics.llm.list_ranking import rank_list

SCHEMA = "conv_id long, turn long, role string, text string"


def walked(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, role, sha, text))
    convs = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in convs.items()}
    members = {}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c - (abs(c) % 100) * (1 if c >= 0 else -1))
        built[c] = tuple(convs.get(base, [])[:h] + own[h:])
        for d in range(len(built[c]) + 1):
            members.setdefault(built[c][:d], []).append(c)
    out = []
    for node, who in members.items():
        kids = {m[:len(node) + 1] for m in members if len(m) > len(node) and m[:len(node)] == node}
        below = [m for m in members if m[:len(node)] == node]
        leaves = [m for m in below if not any(len(x) == len(m) + 1 and x[:len(m)] == m for x in members)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1]) for m in below if m)
        ends = ",".join(str(c) for c in sorted(who) if built[c] == node)
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids), len(leaves),
                    saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(seed, n=60):
    rnd = random.Random(seed)
    out = []
    for c in rnd.sample(range(-120, 900), n) + [0, 100, 200]:
        for t in range(rnd.choice([0, 1, 2, 3, 6, 9])):
            out.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "bb", "é€"])))
    return out


def check(spark, rows, clash=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        for name in ("c", "at", "nid", "_part", "depth", "sha"):
            df = df.withColumn(name, F.lit("x"))
    got = sorted((tuple(r) for r in prefix_trie(df).collect()), key=repr)
    assert got == walked(rows)
    return got


def test_trie_equals_a_walked_one_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK", 2)
    monkeypatch.setattr(conversation_trie, "TOUR_BLOCK", 16)
    monkeypatch.setattr(conversation_trie, "rank_list", lambda links: rank_list(links, block=32))
    check(spark, random_rows(1))


def test_edges_nulls_ties_repeats_copies_and_a_long_conversation(spark):
    rows = [(1, None, None, None), (1, None, "user", "x"), (1, 0, "user", "x"), (1, 0, "user", "x"),
            (2, 5, "b", "tie"), (2, 5, "a", "tie"), (2, 5, "a", "other"), (None, 0, "user", "lost"),
            (100, 0, "user", "z" * 100_000), (1234567890123, 0, "user", "y")]
    rows += [(c, t, "user", f"copy {t}") for c in range(300, 340) for t in range(4)]
    rows += [(500, t, "assistant", str(t)) for t in range(700)]
    check(spark, rows, clash=True)
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("kind", ["in order", "shuffled", "strided"])
def test_list_ranking_does_not_depend_on_the_numbers(spark, kind):
    """Shuffled numbers leave no chains inside blocks: pointer jumping takes over."""
    n, rnd = 3000, random.Random(3)
    order = list(range(n))
    if kind == "shuffled":
        rnd.shuffle(order)
    if kind == "strided":
        order = [i for s in range(7) for i in range(s, n, 7)]
    links = [(a, b) for a, b in zip(order, order[1:] + [list_ranking.END])]
    rnd.shuffle(links)
    got = {r["item"]: r["pos"] for r in rank_list(spark.createDataFrame(links, "item long, next long"), block=128).collect()}
    assert got == {x: i for i, x in enumerate(order)}
