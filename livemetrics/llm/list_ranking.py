"""Distributed list ranking: the position of every element of one linked list.

The elements are cut into blocks of consecutive numbers.  Inside a block every maximal chain is
contracted to its head (numpy pointer doubling over at most ``block`` elements); the heads, weighted
by their chains' lengths, form a shorter list over wider blocks, until one block holds it all, and the
positions are handed down again.  A list without locality would hardly shrink: its heads are then
ranked by pointer jumping, a join on unique keys per round, so a result never depends on the order
of the numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemetrics.llm.common import ship, written

BLOCK = 1 << 17
END = -1
_CHAINS = "item long, head long, ahead long, next long, length long"


def contract(t: pa.Table) -> pa.Table:
    """One block (item, next, w) to each item's chain head and the weight ahead of it in the chain;
    a head's row also holds the chain's successor and length."""
    t = t.sort_by("item")
    item, nxt, w = (t[c].to_numpy() for c in ("item", "next", "w"))
    n = len(item)
    at = np.minimum(np.searchsorted(item, nxt), n - 1)
    inside = item[at] == nxt
    jump = np.where(inside, at, np.arange(n))
    rest = np.where(inside, w, 0)            # weight from an item up to, without, its chain's last one
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            break
        rest = rest + rest[jump]
        jump = further
    is_head = np.ones(n, bool)
    is_head[at[inside]] = False
    heads = np.flatnonzero(is_head)
    head_of = np.empty(n, np.int64)
    head_of[jump[heads]] = heads
    head = head_of[jump]
    return pa.table({
        "item": item, "head": item[head], "ahead": rest[head] - rest,
        "next": pa.array(nxt[jump], mask=~is_head), "length": pa.array(rest + w[jump], mask=~is_head)})


def _jumped(heads: DataFrame) -> DataFrame:
    """Positions (item, pos) by pointer jumping; ``s`` is the weight from an item up to ``next``."""
    rows = written(heads.select("item", "next", F.col("w").alias("s")), "list-jump")
    while rows.where(F.col("next") != END).limit(1).count():
        to = rows.select(F.col("item").alias("next"), F.col("next").alias("further"), F.col("s").alias("more"))
        live = rows.where(F.col("next") != END).join(to, "next")
        rows = written(live.select("item", F.col("further").alias("next"), (F.col("s") + F.col("more")).alias("s"))
                       .unionByName(rows.where(F.col("next") == END)), "list-jump")
    total = rows.agg(F.max("s")).first()[0]
    return rows.select("item", (F.lit(total) - F.col("s")).alias("pos"))


def rank_list(links: DataFrame, block: int = BLOCK) -> DataFrame:
    """(item, next) of one list, ``next`` = -1 at its end, to (item, pos), the first at 0."""
    ship(links.sparkSession)
    items = links.select("item", "next", F.lit(1).cast("long").alias("w"))
    width, chains = block, []
    while True:
        dealt = items.withColumn("_block", F.expr(f"item div {width}L"))
        local = written(dealt.groupBy("_block").applyInArrow(lambda t: contract(t), _CHAINS), "list-chains")
        chains.append(local)
        heads = local.where("item = head").select("item", "next", F.col("length").alias("w"))
        sizes = heads.groupBy(F.expr(f"item div {width}L")).count().agg(F.sum("count"), F.max("count")).first()
        if sizes[0] is None or sizes[0] <= 1:
            pos = heads.select("item", F.lit(0).cast("long").alias("pos"))
            break
        if sizes[1] * 2 > block:
            pos = _jumped(heads)
            break
        width *= block // sizes[1]
        items = heads
    for local in reversed(chains):
        at = pos.select(F.col("item").alias("head"), "pos")
        pos = local.join(at, "head").select("item", (F.col("pos") + F.col("ahead")).alias("pos"))
    return pos
