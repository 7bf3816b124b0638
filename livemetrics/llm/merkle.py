"""Operator 13, Merkle dataset manifest: one digest over a table, per-source roots, and for every
row the sibling digests that prove it belongs.

Method, concatenated-level strings: a source's leaves in id order are cut into aligned blocks of
``BLOCK`` = 16**3.  A block keeps each of its levels as one hex string; fixed-width substrings of a
level (a run of 16 digests is 1024 characters) hash to the next, and the substrings that flank a
node in its run are its sibling segments.  The digests on top of the blocks are the leaves of the
next round, until a source has one block; the sources' roots, ordered by source, go through the
same rounds.

Plan: texts are read once and become digests where they are scanned.  Only digests and ids are
dealt out: by range of (source, id), numbered with a carried count (``operators/ordered.py``, so
a source of any size is spread over all tasks), and gathered by block.  A row's siblings are cut
out of its block's strings and hashed in place; what is above a block is one short list per block.

Defined edge results: a null source is a source of its own and comes first; null ids come first in
their source and are never tampered with; rows with equal ids are ordered by leaf, so repeated rows
stand side by side and each gets a proof; a source of one row has that leaf as its root and no
siblings; null and empty values differ (``-`` and ``0:``); texts of any length are hashed whole; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livemetrics.llm.common import lower_ascii, written
from livemetrics.operators.ordered import PART, ordered_parts, running

FANOUT = 16
LEVELS = 3                                   # levels a block holds above its nodes
BLOCK = FANOUT ** LEVELS
HEX = 64                                     # characters of a digest


def row_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each as byte count, colon and value, ``-`` if null."""
    def enc(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[enc(c) for c in fields]), 256)


def _group_key(c: Column) -> Column:
    """Null first, then bytewise, without nulls."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def _cut(level: Column, start: Column, n: Column) -> Column:
    """``n`` digests of a level from digest ``start`` on (a binary substring, so no scan from the
    string's beginning); what is beyond the end is left out."""
    return F.substring(level, start * HEX + 1, n * HEX)


def _parents(level: Column) -> Column:
    """The next level: the digest of every run of ``FANOUT`` digests."""
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) / HEX - 1) / FANOUT).cast("int"))
    return F.encode(F.array_join(F.transform(runs, lambda i: F.sha2(
        _cut(level, i * FANOUT, F.lit(FANOUT)), 256)), ""), "utf-8")


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """Nodes (g, n, pos, hash, data) to blocks (g, blk, n, data array, l0..l3, depth, top)."""
    gathered = nodes.groupBy("g", F.expr(f"pos div {BLOCK}").alias("blk")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "hash", "data"))).alias("nodes"))
    n = F.col("n")
    depth = F.when(n <= 1, 0)
    for k in range(1, LEVELS):
        depth = depth.when(n <= FANOUT ** k, k)
    out = gathered.select(
        "g", "blk", "n", F.transform("nodes", lambda x: x["data"]).alias("data"), depth.otherwise(LEVELS).alias("depth"),
        F.encode(F.array_join(F.transform("nodes", lambda x: x["hash"]), ""), "utf-8").alias("l0"))
    for k in range(1, LEVELS + 1):
        out = out.withColumn(f"l{k}", F.when(F.col("depth") >= k, _parents(F.col(f"l{k - 1}"))))
    top = F.coalesce(*[F.col(f"l{k}") for k in range(LEVELS, -1, -1)])
    return written(out.withColumn("top", F.decode(top, "utf-8")), name)


def build_rounds(nodes: DataFrame, name: str) -> list[DataFrame]:
    """All rounds of blocks over nodes (g, n, pos, hash, data); in the last, a group is one block."""
    rounds = []
    while True:
        blocks = _blocks(nodes, name)
        rounds.append(blocks)
        most = blocks.agg(F.max("n")).first()[0]
        if most is None or most <= BLOCK:
            return rounds
        nodes = blocks.select("g", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("blk").alias("pos"),
                              F.col("top").alias("hash"), F.lit(None).cast("string").alias("data"))


def _segments(i: Column) -> list[tuple[Column, Column]]:
    """(left, right) siblings of node ``i`` of a block, level by level; empty above its depth."""
    out, empty = [], F.encode(F.lit(""), "utf-8")
    for k in range(LEVELS):
        at = F.floor(i / FANOUT ** k).cast("int")
        first = F.floor(at / FANOUT).cast("int") * FANOUT
        level, inside = F.col(f"l{k}"), F.col("depth") > k
        out.append((F.when(inside, _cut(level, first, at - first)).otherwise(empty),
                    F.when(inside, _cut(level, at + 1, first + (FANOUT - 1) - at)).otherwise(empty)))
    return out


def _own_path(i: Column) -> Column:
    """array<struct<l, r>> of a node's levels inside its block."""
    return F.slice(F.array(*[F.struct(lo.alias("l"), hi.alias("r")) for lo, hi in _segments(i)]),
                   F.lit(1), F.col("depth"))


def with_paths(rounds: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """The first round's blocks with ``path``, the siblings above the block's top up to the very
    root, and ``up``: what ``above`` (g, path, up) carries per group, else the root."""
    last = rounds[-1]
    if above is None:
        none = F.array().cast("array<struct<l:binary,r:binary>>")
        at = last.select("*", none.alias("path"), F.struct(F.col("top").alias("root")).alias("up"))
    else:
        at = last.join(above, "g")
    for blocks in reversed(rounds[:-1]):
        nodes = at.select("g", "up", F.inline(F.transform("data", lambda _, i: F.struct(
            (F.col("blk") * BLOCK + i).alias("blk"), F.concat(_own_path(i), F.col("path")).alias("path")))))
        at = blocks.join(nodes, ["g", "blk"])
    return at


def _fold(start: Column, i: Column) -> Column:
    """The root recomputed from a node's digest, its siblings in the block and the path above."""
    h = F.encode(start, "utf-8")
    for k, (lo, hi) in enumerate(_segments(i)):
        h = F.when(F.col("depth") > k, F.encode(F.sha2(F.concat(lo, h, hi), 256), "utf-8")).otherwise(h)
    return F.decode(F.aggregate("path", h, lambda acc, s: F.encode(
        F.sha2(F.concat(s["l"], acc, s["r"]), 256), "utf-8")), "utf-8")


def leaves(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
           id_col: str = "doc_id", group_col: str = "source", changed: dict[str, Column] | None = None,
           when: Column | None = None) -> DataFrame:
    """(g, id, leaf, other, tie), stored: ``other`` is the leaf with the columns of ``changed``
    replaced in the rows where ``when`` holds, null elsewhere."""
    changed = changed or {}
    other = row_digest([changed.get(c, docs[c]) for c in fields])
    return written(docs.select(
        _group_key(docs[group_col]).alias("g"), docs[id_col].alias("id"),
        row_digest([docs[c] for c in fields]).alias("leaf"),
        F.when(F.coalesce(when, F.lit(False)) if when is not None else F.lit(False), other).alias("other"),
        F.monotonically_increasing_id().alias("tie")), "merkle-leaves")


def manifest(leaf_rows: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """The rounds of the sources' trees and of the tree over the sources' roots."""
    order = [F.col("id").asc_nulls_first(), F.col("leaf"), F.col("tie")]
    parts = ordered_parts(leaf_rows, [F.col("g"), *order], "merkle-order")
    numbered = running(parts, ["g"], order, {"at": ("count", F.lit(1))}, totals={"n": ("count", F.lit(1))})
    per_source = build_rounds(numbered.select(
        "g", "n", (F.col("at") - 1).alias("pos"), F.col("leaf").alias("hash"),
        F.struct("id", "other").alias("data")), "merkle-blocks")
    roots = per_source[-1].select(F.lit("").alias("all"), "g", "top")
    numbered = running(ordered_parts(roots, ["g"], "merkle-roots"), ["all"], ["g"], {"at": ("count", F.lit(1))},
                       totals={"n": ("count", F.lit(1))})
    over_sources = build_rounds(numbered.select(
        F.col("all").alias("g"), "n", (F.col("at") - 1).alias("pos"), F.col("top").alias("hash"),
        F.col("g").alias("data")), "merkle-tops")
    return per_source, over_sources


def proofs(per_source: list[DataFrame], over_sources: list[DataFrame]) -> DataFrame:
    """Per row: id, leaf, subroot, root, proof (all sibling digests, leaf to root, left to right, as
    one digest of their text) and folded, the root recomputed from the changed leaf if there is one."""
    top = with_paths(over_sources, None).select(F.inline(F.transform("data", lambda g, i: F.struct(
        g.alias("g"), F.concat(_own_path(i), F.col("path")).alias("path"),
        F.struct(F.decode(_cut(F.col("l0"), i, F.lit(1)), "utf-8").alias("subroot"), F.col("up.root").alias("root")).alias("up")))))
    beyond = F.aggregate("path", F.encode(F.lit(""), "utf-8"), lambda acc, s: F.concat(acc, s["l"], s["r"]))
    at = with_paths(per_source, top).withColumn("beyond", beyond)

    def row(x: Column, i: Column) -> Column:
        leaf = F.decode(_cut(F.col("l0"), i, F.lit(1)), "utf-8")
        inside = [c for pair in _segments(i) for c in pair]
        return F.struct(x["id"].alias("id"), leaf.alias("leaf"),
                        F.sha2(F.concat(*inside, F.col("beyond")), 256).alias("proof_sha256"),
                        _fold(F.coalesce(x["other"], leaf), i).alias("folded_root"))

    return at.select("up", F.inline(F.transform("data", row))).select(
        "id", "leaf", "up.subroot", "up.root", "proof_sha256", "folded_root")


def changed_blocks(old: list[DataFrame], new: list[DataFrame]) -> DataFrame:
    """(g, blk) of the blocks of two manifests whose digests differ or that only one of them has:
    the rows that must be read again to bring one copy of a table up to date."""
    a = old[0].select("g", "blk", F.col("top").alias("a"))
    b = new[0].select("g", "blk", F.col("top").alias("b"))
    return a.join(b, ["g", "blk"], "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("g", "blk")


def merkle_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: every fifth document (by CRC-32 of its id) is checked against a
    tampered copy whose text has A-Z lower-cased."""
    tampered = F.crc32(docs["doc_id"].cast("string")) % 5 == 0
    rows = leaves(docs, changed={"text": lower_ascii(docs["text"])}, when=tampered)
    out = proofs(*manifest(rows))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle_sql() -> str:
    """The same in DuckDB: every level as a table, siblings by run number, folds level by level."""
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)), "
           "lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), "
           "lambda v, k: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)")

    def enc(c: str) -> str:
        return f"coalesce(strlen({c})::VARCHAR || ':' || {c}, '-')"

    def leaf(text: str) -> str:
        cols = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(enc(c) for c in cols) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(lowered)} AS low,
         coalesce(CASE WHEN doc_id IS NOT NULL THEN {crc} END % 5 = 0, false) AS tampered FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY source) AS n FROM d),
t AS (SELECT source, 0 AS level, pos, leaf AS h, n FROM l
      UNION ALL
      SELECT source, any_value(level) + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
      FROM t WHERE n > 1 GROUP BY source, pos // 16),
sub AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
               count(*) OVER () AS n, level AS height FROM t WHERE n = 1),
r AS (SELECT 0 AS level, pos, subroot AS h, n FROM sub
      UNION ALL
      SELECT any_value(level) + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
      FROM r WHERE n > 1 GROUP BY pos // 16),
sib AS (                                     -- per node that has siblings: what is left and right of it in its run
  SELECT a.source, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lo,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS hi
  FROM t a JOIN t b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.pos // 16 = b.pos // 16
  WHERE a.n > 1 GROUP BY ALL),
rsib AS (
  SELECT a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lo,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS hi
  FROM r a JOIN r b ON a.level = b.level AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY ALL),
steps AS (                                   -- level by level, the source's tree and then the tree of the sources
  SELECT l.source, l.pos AS leaf_pos, s.level, s.lo, s.hi FROM l JOIN sib s
         ON l.source IS NOT DISTINCT FROM s.source AND s.pos = l.pos // (16 ** s.level)::BIGINT
  UNION ALL
  SELECT l.source, l.pos, sub.height + s.level, s.lo, s.hi
  FROM l JOIN sub ON l.source IS NOT DISTINCT FROM sub.source JOIN rsib s ON s.pos = sub.pos // (16 ** s.level)::BIGINT),
proof AS (SELECT source, leaf_pos, string_agg(lo || hi, '' ORDER BY level) AS segs FROM steps GROUP BY ALL),
fold AS (
  SELECT source, pos AS leaf_pos, 0 AS level, CASE WHEN tampered THEN low ELSE leaf END AS h FROM l
  UNION ALL
  SELECT f.source, f.leaf_pos, f.level + 1, sha256(s.lo || f.h || s.hi)
  FROM fold f JOIN steps s ON f.source IS NOT DISTINCT FROM s.source AND f.leaf_pos = s.leaf_pos AND f.level = s.level),
folded AS (SELECT source, leaf_pos, arg_max(h, level) AS folded_root FROM fold GROUP BY ALL)
SELECT l.doc_id, l.leaf, sub.subroot, root.h AS root, sha256(coalesce(p.segs, '')) AS proof_sha256, f.folded_root,
       f.folded_root = root.h AS verified
FROM l JOIN sub ON l.source IS NOT DISTINCT FROM sub.source JOIN (SELECT h FROM r WHERE n = 1) root ON true
JOIN folded f ON l.source IS NOT DISTINCT FROM f.source AND l.pos = f.leaf_pos
LEFT JOIN proof p ON l.source IS NOT DISTINCT FROM p.source AND l.pos = p.leaf_pos"""
