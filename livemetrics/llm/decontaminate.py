"""Operator 7, benchmark decontamination: size-partitioned MinHash containment search.

An item is found in a document if at least ``threshold`` of the item's distinct five-word
shingles occur anywhere in the document (containment, not Jaccard: documents may be
thousands of times longer).  Words are runs of letters and digits, A-Z lower-cased, so
punctuation and line breaks around a passage do not hide it.

Items are partitioned by shingle count into classes [2**j, 2**(j+1)).  An item's MinHash
sketch is its ``k`` smallest shingle hashes, ``k`` fixed per class as one more than the most
shingles a match may lack there.  A document that contains the item therefore contains at
least one of the ``k`` (no match can be lost); a document whose shingle hashes meet no
sketch is left alone.  Every (document, item) that meets is verified by counting all the
item's shingles among the document's, by 64-bit hash.

Scale: documents are scanned once per block of items, without a shuffle; a block holds
about ``block_words`` item words, so what is broadcast is bounded whatever the benchmark's
size, and a larger benchmark is worked off in more blocks (a stated query set against all
rows).  Whole texts are hashed, in chunks of bounded size.

Defined edge results: an item with fewer than five words is one shingle of all its words,
looked for among the document's windows of that length; an item without words or with null
text matches nothing, a null or empty document contains nothing; repeated items and
repeated documents each give their own pairs; empty tables give empty results;
``remove_contaminated`` keeps exactly the input's columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemetrics.llm import textvec as tv
from livemetrics.llm.common import map_arrow, n_words

PAIRS = "doc_id long, item_id long, n_item long, n_found long, containment double"


@dataclass(frozen=True)
class Containment:
    words: int = 5
    percent: int = 80                        # 100 * found >= percent * item's shingles
    block_words: int = 2_000_000             # item words searched per scan of the documents


@dataclass(frozen=True)
class ItemBlock:
    """One block of items, ready for the search (bounded by ``block_words``)."""
    item_id: list
    sets: list[np.ndarray]                   # sorted shingle hashes of each item
    length: np.ndarray                       # shingle length in words of each item
    sketch: dict[int, tuple[np.ndarray, np.ndarray]]  # length -> (sorted sketch hashes, item index)
    filter: dict[int, np.ndarray]            # length -> bitmap over the low hash bits


_BITS = 22


def item_block(ids: list, texts: list, p: Containment) -> ItemBlock:
    ids_out, sets, length, parts = [], [], [], {}
    for c in tv.chunks(pa.array(texts, pa.large_string())):
        c = tv.lower_ascii(c)
        w = tv.words(c, alnum=True)
        for r in range(len(c.offsets) - 1):
            h = w.hash[w.first[r]:w.first[r + 1]]
            if not len(h):
                continue
            n = min(len(h), p.words)
            s = np.unique(tv.window_hash(h, n))
            upper = (1 << int(len(s)).bit_length()) - 1          # largest size of the item's class
            k = upper * (100 - p.percent) // 100 + 1
            keys, at = parts.setdefault(n, ([], []))
            keys.append(s[:k])                                   # hashes are sorted: the k smallest
            at.append(np.full(len(s[:k]), len(sets)))
            ids_out.append(ids[c.first + r])
            sets.append(s)
            length.append(n)
    sketch, bitmap = {}, {}
    for n, (keys, at) in parts.items():
        keys, at = np.concatenate(keys), np.concatenate(at)
        order = np.argsort(keys, kind="stable")
        sketch[n] = keys[order], at[order]
        bitmap[n] = np.zeros(1 << _BITS, dtype=bool)
        bitmap[n][keys & tv.U64((1 << _BITS) - 1)] = True
    return ItemBlock(ids_out, sets, np.array(length, int), sketch, bitmap)


def _row_windows(w: tv.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every ``n``-word window that lies in one row."""
    h = tv.window_hash(w.hash, n)
    row = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    inside = row[:len(h)] == row[n - 1:n - 1 + len(h)]
    return h[inside], row[:len(h)][inside]


def search(texts: pa.Array, block: ItemBlock, p: Containment) -> Iterator[tuple[int, int, int]]:
    """(row, item index, shingles found) of every match in a text column."""
    for c in tv.chunks(texts):
        w = tv.words(tv.lower_ascii(c), alnum=True)
        for n, (keys, items) in block.sketch.items():
            h, row = _row_windows(w, n)
            may = np.flatnonzero(block.filter[n][h & tv.U64((1 << _BITS) - 1)])
            if not len(may):
                continue
            lo, hi = np.searchsorted(keys, h[may], "left"), np.searchsorted(keys, h[may], "right")
            hit = np.flatnonzero(hi > lo)
            found = {(int(row[may[i]]), int(k)) for i in hit for k in items[lo[i]:hi[i]]}
            last, mine = -1, None
            for r, k in sorted(found):
                if r != last:
                    a, b = np.searchsorted(row, [r, r + 1])
                    last, mine = r, np.unique(h[a:b])
                s = block.sets[k]
                at = np.searchsorted(mine, s)
                n_found = int((mine[np.minimum(at, len(mine) - 1)] == s).sum())
                if 100 * n_found >= p.percent * len(s):
                    yield c.first + r, k, n_found


def blocks(items: DataFrame, p: Containment, id_col: str, text_col: str) -> Iterator[ItemBlock]:
    """The items in blocks of about ``block_words`` words each, dealt by hash."""
    src = items.select(items[id_col].cast("long").alias("id"), items[text_col].alias("text")).where("text is not null")
    total = src.agg(F.sum(n_words(F.col("text"))).alias("n")).first()["n"] or 0
    parts = max(1, -(-total // p.block_words))
    for i in range(parts):
        rows = src.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == i).collect() if total else []
        yield item_block([r["id"] for r in rows], [r["text"] for r in rows], p)


def find_contaminated(docs: DataFrame, items: DataFrame, p: Containment = Containment(), id_col: str = "doc_id",
                      text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs (doc_id, item_id, n_item, n_found, containment) at or above the threshold."""
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    out = None
    for block in blocks(items, p, item_col, item_text):
        shared = src.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            block = shared.value
            for b in batches:
                got = [(b.column(0)[r].as_py(), block.item_id[k], len(block.sets[k]), n, n / len(block.sets[k]))
                       for r, k, n in search(b.column(1), block, p)]
                cols = list(zip(*got)) if got else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(cols, [pa.int64()] * 4 + [pa.float64()])],
                    names=["doc_id", "item_id", "n_item", "n_found", "containment"])

        pairs = map_arrow(src, run, PAIRS)
        out = pairs if out is None else out.unionByName(pairs)
    return out


def remove_contaminated(docs: DataFrame, items: DataFrame, p: Containment = Containment(), text_col: str = "text",
                        item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that contain no item, with exactly the input's columns."""
    at = docs.columns.index(text_col)
    for block in blocks(items, p, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            block = shared.value
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for r, _, _ in search(b.column(at), block, p):
                    keep[r] = False
                yield b.filter(pa.array(keep))

        docs = map_arrow(docs, run, docs.schema)
    return docs


def oracle_sql(p: Containment = Containment()) -> str:
    """DuckDB SQL of the pairs, from shingle strings (items of at least five words)."""
    def words(table: str, key: str) -> str:
        return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                f"'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM {table}")

    def shingles(src: str, key: str) -> str:
        return (f"SELECT DISTINCT {key}, array_to_string(list_slice(w, u.i, u.i + {p.words - 1}), ' ') AS s "
                f"FROM {src}, unnest(range(1, len(w) - {p.words - 2})) AS u(i)")

    return f"""
WITH iw AS ({words("benchmark", "item_id")}), dw AS ({words("documents", "doc_id")}),
i AS ({shingles("iw", "item_id")}), d AS ({shingles("dw", "doc_id")}),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
f AS (SELECT doc_id, item_id, count(*) AS n_found FROM d JOIN i USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment
FROM f JOIN n USING (item_id) WHERE 100 * n_found >= {p.percent} * n_item"""
