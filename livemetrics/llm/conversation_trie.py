"""Operator 11, conversation prefix trie by the Euler-tour technique.

Conversations that begin with the same turns share the nodes of a trie; what a subtree saves is
what its shared turns would have cost again.  The trie is never walked: every node gets an arc
into it and one out of it, the arcs' successors form one list (the Euler tour, children in order of
their smallest member), the list is ranked distributedly (``list_ranking.py``), and a subtree's
leaves and savings are differences of prefix sums at its two arcs.

Plan: texts are read once and become a digest and a length where they are scanned.  A prefix is
known by its depth and two 64-bit XORs over hashes of (position, turn), running values that are
carried over range partitions (``operators/ordered.py``), so neither a conversation nor a parent with a
third of all rows ends in one task; nodes are a partially aggregated grouping by that key, numbered by
(smallest member, depth), which keeps most of the tour inside blocks of consecutive numbers.
Conversations that end at one node are joined to chunks of ids in order; SHA-256 then reads a
node's chunks one after the other and holds one of them.

Defined edge results: a null role or text is empty; a null turn sorts first; turns that tie are ordered
by role, then by the digest of role and text; repeated rows are repeated turns; rows without a
conversation id belong to no conversation and are left out; texts of any length are hashed whole; an
empty table has no root; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livemetrics.llm.common import map_arrow, written
from livemetrics.llm.list_ranking import END, rank_list
from livemetrics.operators.ordered import PART, ordered_parts, running

FAMILY = 100                                 # conversations of one hundred share their first turns
HEADS = 6                                    # the number of shared turns is below this
CHUNK = 4096                                 # ids joined to one string
TOUR_BLOCK = 1 << 16
KEY = ["depth", "k1", "k2"]


def ordered_turns(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(c, at, n, sha, chars, _part), stored: turns numbered from 0 in their conversation of n."""
    role, text = (F.coalesce(convs[x].cast("string"), F.lit("")) for x in (role_col, text_col))
    turns = convs.where(convs[conv_col].isNotNull()).select(
        convs[conv_col].cast("long").alias("c"), convs[turn_col].alias("turn"), role.alias("role"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("sha"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("tie"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha"), F.col("tie")]
    parts = ordered_parts(written(turns, "trie-turns"), [F.col("c"), *order], "trie-order")
    numbered = running(parts, ["c"], order, {"at": ("count", F.lit(1))}, totals={"n": ("count", F.lit(1))})
    return written(numbered.select(PART, "c", (F.col("at") - 1).alias("at"), "n", "sha", "chars"), "trie-numbered")


def _lanes(depth: Column, sha: Column) -> tuple[Column, Column]:
    """Two hashes of a turn at its depth; their XORs along a prefix are its key."""
    return F.xxhash64(depth, sha), F.xxhash64(sha, depth)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (c, depth, k1, k2, h1, h2, chars, last) of the rebuilt conversations, and all conversations
    (c, size).  The first turns of the family's first conversation go before a conversation's own."""
    shared = F.crc32(F.col("c").cast("string")) % HEADS
    first = turns.where(F.col("at") < HEADS - 1).groupBy("c").agg(
        F.sort_array(F.collect_list(F.struct("at", "sha", "chars"))).alias("first"))
    convs = turns.where("at = 0").select("c", "n", (F.col("c") - F.col("c") % FAMILY).alias("b"), shared.alias("h"))
    joined = convs.join(first.select(F.col("c").alias("b"), "first"), "b", "left")
    none = F.array().cast("array<struct<at:bigint,sha:string,chars:bigint>>")
    lead = F.slice(F.coalesce("first", none), F.lit(1), F.col("h").cast("int"))

    def step(acc, x):
        depth = F.size(acc).cast("long") + 1
        before = F.try_element_at(acc, F.lit(-1))
        h1, h2 = _lanes(depth, x["sha"])
        zero = F.lit(0).cast("long")
        return F.concat(acc, F.array(F.struct(
            depth.alias("depth"), F.coalesce(before["k1"], zero).bitwiseXOR(h1).alias("k1"),
            F.coalesce(before["k2"], zero).bitwiseXOR(h2).alias("k2"), h1.alias("h1"), h2.alias("h2"),
            x["chars"].alias("chars"))))

    empty = F.array().cast("array<struct<depth:bigint,k1:bigint,k2:bigint,h1:bigint,h2:bigint,chars:bigint>>")
    info = joined.select("c", "n", "h", F.aggregate(lead, empty, step).alias("lead"))
    info = written(info.withColumn("m", F.size("lead").cast("long")).withColumn(
        "size", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-convs")

    end = F.try_element_at("lead", F.lit(-1))
    spans = turns.select(PART, "c").distinct().join(info.select(
        "c", "m", "size", F.coalesce(end["k1"], F.lit(0)).alias("b1"), F.coalesce(end["k2"], F.lit(0)).alias("b2")), "c")
    depth = F.col("m") + F.col("at") - shared + 1
    own = turns.where(F.col("at") >= shared).join(spans, [PART, "c"]).withColumn("depth", depth)
    h1, h2 = _lanes(F.col("depth"), F.col("sha"))
    own = own.select(PART, "c", "at", "depth", "chars", "size", "b1", "b2", h1.alias("h1"), h2.alias("h2"))
    own = running(own, ["c"], ["at"], {"x1": ("bit_xor", F.col("h1")), "x2": ("bit_xor", F.col("h2"))})
    own = own.select("c", "depth", F.col("x1").bitwiseXOR(F.col("b1")).alias("k1"),
                     F.col("x2").bitwiseXOR(F.col("b2")).alias("k2"), "h1", "h2", "chars",
                     (F.col("depth") == F.col("size")).alias("last"))
    lead_rows = info.select("c", "size", F.inline("lead")).select(
        "c", "depth", "k1", "k2", "h1", "h2", "chars", (F.col("depth") == F.col("size")).alias("last"))
    return written(lead_rows.unionByName(own), "trie-rows"), info.select("c", "size")


def numbered_nodes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes (nid, conv_id, depth, k1, k2, parent_conv, n_convs, chars), stored; the root is in."""
    zero = [F.lit(0).cast("long").alias(x) for x in ("depth", "k1", "k2", "h1", "h2")]
    found = rows.groupBy(*KEY).agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                   F.min("chars").alias("chars"), F.min("h1").alias("h1"), F.min("h2").alias("h2"))
    root = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        *zero, "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"))
    nodes = written(found.unionByName(root), "trie-keys")
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("u1"), F.col("k2").alias("u2"),
                      F.col("conv_id").alias("parent_conv"))
    child = nodes.select("*", F.col("k1").bitwiseXOR(F.col("h1")).alias("u1"),
                         F.col("k2").bitwiseXOR(F.col("h2")).alias("u2"))
    # a parent of very many children is a hot key of this join only, which nothing follows: AQE splits it
    linked = written(child.join(up, ["depth", "u1", "u2"], "left").select(
        "conv_id", *KEY, "parent_conv", "n_convs", "chars"), "trie-linked")
    parts = ordered_parts(linked, ["conv_id", "depth"], "trie-nodes")
    out = running(parts, [], ["conv_id", "depth"], {"nid": ("count", F.lit(1))})
    return written(out.withColumn("nid", F.col("nid") - 1).drop(PART), "trie-numbers")


def euler_tour(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes with their children's count, and the tour's links (item, next): 2 * nid is the arc
    into a node, 2 * nid + 1 the arc out of it."""
    kids = nodes.where(F.col("parent_conv").isNotNull())
    span = kids.groupBy(F.col("parent_conv").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("nid").alias("first"), F.max("nid").alias("final"))
    tree = written(nodes.join(span, ["conv_id", "depth"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))), "trie-tree")
    family = ["parent_conv", "depth"]
    beside = running(ordered_parts(kids.select(*family, "nid"), [*family, "nid"], "trie-siblings"), family, ["nid"],
                     {"before": ("max", F.col("nid"))}, inclusive=False)
    into, out = F.col("nid") * 2, F.col("nid") * 2 + 1
    links = (tree.select(into.alias("item"), F.coalesce(F.col("first") * 2, out).alias("next"))
             .unionByName(beside.where("before is not null").select((F.col("before") * 2 + 1).alias("item"), into.alias("next")))
             .unionByName(tree.where("final is not null").select((F.col("final") * 2 + 1).alias("item"), out.alias("next")))
             .unionByName(tree.where("parent_conv is null").select(out.alias("item"), F.lit(END).cast("long").alias("next"))))
    return tree, written(links, "trie-links")


def subtree_sums(tree: DataFrame, positions: DataFrame) -> DataFrame:
    """(nid, n_leaves, saved_tokens) from prefix sums over the ranked tour."""
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    own = tree.select("nid", leaf.alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    into = F.col("out") == 0
    tour = positions.select(F.expr("item div 2").alias("nid"), (F.col("item") % 2).alias("out"), "pos").join(own, "nid")
    tour = tour.select("nid", "out", "pos", F.expr(f"pos div {TOUR_BLOCK}").alias("block"),
                       F.when(into, F.col("leaf")).otherwise(0).alias("leaf"),
                       F.when(into, F.col("saved")).otherwise(0).alias("saved"))
    sums = running(tour, [], ["pos"], {"leaves": ("sum", F.col("leaf")), "saving": ("sum", F.col("saved"))}, part="block")

    def inside(total: str, own: str) -> Column:
        return F.max(F.when(~into, F.col(total))) - F.max(F.when(into, F.col(total) - F.col(own)))

    return sums.groupBy("nid").agg(inside("leaves", "leaf").alias("n_leaves"), inside("saving", "saved").alias("saved_tokens"))


def _digests(batches):
    """Chunks of ids, sorted by node and chunk, to one SHA-256 per node."""
    key, sha = None, None
    for b in batches:
        done = {x: [] for x in (*KEY, "ends_sha256")}
        for *node, part in zip(*[b.column(x).to_pylist() for x in (*KEY, "ids")]):
            if node != key:
                if key is not None:
                    _put(done, key, sha)
                key, sha = node, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(part.encode())
        yield pa.RecordBatch.from_pydict(done, schema=_DIGEST)
    if key is not None:
        done = {x: [] for x in (*KEY, "ends_sha256")}
        _put(done, key, sha)
        yield pa.RecordBatch.from_pydict(done, schema=_DIGEST)


def _put(done: dict, key: list, sha) -> None:
    for name, v in zip((*KEY, "ends_sha256"), (*key, sha.hexdigest())):
        done[name].append(v)


_DIGEST = pa.schema([*[(x, pa.int64()) for x in KEY], ("ends_sha256", pa.string())])


def end_digests(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): the ids of the conversations that end at a node, in order."""
    zero = [F.lit(0).cast("long").alias(x) for x in KEY]
    ends = rows.where("last").select(*KEY, "c").unionByName(convs.where("size = 0").select(*zero, "c"))
    at = running(ordered_parts(ends, [*KEY, "c"], "trie-ends"), KEY, ["c"], {"at": ("count", F.lit(1))})
    chunks = at.groupBy(*KEY, F.expr(f"(at - 1) div {CHUNK}").alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda x: x.cast("string")), ",").alias("ids"))
    dealt = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk")
    return map_arrow(dealt, _digests, ", ".join(f"{x} long" for x in KEY) + ", ends_sha256 string")


def prefix_trie(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node, see the contract: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    rows, all_convs = rebuilt(ordered_turns(convs, conv_col, turn_col, role_col, text_col))
    tree, links = euler_tour(numbered_nodes(rows, all_convs))
    sums = subtree_sums(tree, rank_list(links))
    ends = end_digests(rows, all_convs)
    out = tree.join(sums, "nid").join(ends, KEY, "left")
    return out.select("conv_id", "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
                      "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def oracle_sql() -> str:
    """The same in DuckDB: prefixes as text, subtrees as the nodes that a member meets further on."""
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)), "
           "lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), "
           "lambda v, k: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)")
    return f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations
           WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role,
                                   sha256(strlen(role)::VARCHAR || ':' || role || text)) - 1 AS i FROM t),
f AS (SELECT c, c - c % {FAMILY} AS b, {crc} % {HEADS} AS h FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT f.c, 0 AS own, o.i, o.role, o.text FROM f JOIN o ON o.c = f.b AND o.i < f.h
      UNION ALL SELECT f.c, 1, o.i, o.role, o.text FROM f JOIN o ON o.c = f.c AND o.i >= f.h),
n AS (SELECT c, row_number() OVER w AS depth, length(text) AS chars,
             md5(string_agg(strlen(role)::VARCHAR || ':' || role || strlen(text)::VARCHAR || ':' || text, '') OVER w) AS k
      FROM r WINDOW w AS (PARTITION BY c ORDER BY own, i ROWS UNBOUNDED PRECEDING)),
p AS (SELECT c, depth, k, chars FROM n UNION ALL SELECT c, 0, '', 0 FROM f),
node AS (SELECT depth, k, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM p GROUP BY ALL),
link AS (SELECT DISTINCT a.depth, a.k, b.k AS up FROM p a JOIN p b ON a.c = b.c AND b.depth = a.depth - 1),
kids AS (SELECT depth - 1 AS depth, up AS k, count(*) AS n_children FROM link GROUP BY ALL),
under AS (SELECT DISTINCT a.depth, a.k, b.depth AS d2, b.k AS k2 FROM p a JOIN p b ON a.c = b.c AND b.depth >= a.depth),
sums AS (SELECT u.depth, u.k, count(*) FILTER (kids.k IS NULL) AS n_leaves,
                sum((node.n_convs - 1) * node.chars)::BIGINT AS saved_tokens
         FROM under u JOIN node ON node.depth = u.d2 AND node.k = u.k2
         LEFT JOIN kids ON kids.depth = u.d2 AND kids.k = u.k2 GROUP BY ALL),
ends AS (SELECT depth, k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
         FROM (SELECT c, max(depth) AS depth, arg_max(k, depth) AS k FROM p GROUP BY c) GROUP BY ALL)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n_children, 0) AS n_children,
       sums.n_leaves, sums.saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM node JOIN sums USING (depth, k) LEFT JOIN kids USING (depth, k) LEFT JOIN ends USING (depth, k)
LEFT JOIN link USING (depth, k) LEFT JOIN node parent ON parent.depth = node.depth - 1 AND parent.k = link.up"""
