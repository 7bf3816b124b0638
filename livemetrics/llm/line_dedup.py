"""Operator 9, line dedup (native): hashes of line runs.

A text is its ``\\n``-split lines.  A run of lines that also occurs earlier, in a document with a
smaller id or further up in the same one, is repeated; every line inside a repeated run is
deleted and the first occurrence stays.  Runs are judged on the input, not on what is left.
A run counts if it is ``window`` lines long, at least two of them with a word; with
``min_words`` also, at any length from one line on, if it begins and ends with a line with a
word and holds that many words.  The pipeline's stage uses ``MIN_WORDS``; op9_line_dedup keeps
the rule of its SQL (``window`` alone).

1. Run hashes, in place of winnowing (none is left out, as a run may be one line): lines are
   hashed (xxhash64); every run of ``window`` lines has its hash and its smallest line hash.  With ``min_words`` each line with a word adds the shortest run
   of that many words down from it and the shortest one up to it: any longer repeated run is
   a union of these, so they are few (two per line at most) and leave nothing out.  Runs of
   ``window`` lines that two shorter word runs make up are not needed then.
2. Join positions: the key (smallest line hash, hash of the run's lines) is equal exactly for equal
   runs, so the earliest position per key is a partially aggregated minimum; positions are
   joined with it instead of with each other, which is linear in the occurrences however
   often a run repeats.  AQE splits a key that many documents share.
3. Delete: the numbers of a document's lines inside repeated runs are gathered and the
   stretches between them stay.  Longer repeats are unions of their runs.

Only hashes are shuffled before the last step, where each text moves once to meet its line
numbers.

Defined edge results: a null text has no lines and stays null; a text with fewer lines than
``window`` is changed only with ``min_words``; rows with the same id and the same text count
as one document (all get its result); with the same id and different texts, the text hash breaks the tie; a
null id sorts first; an empty table gives an empty result.  ``dedup_lines`` keeps every
other column of its input under its own name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3
MIN_WORDS = 8
HAS_WORD = r"[^\x20\x09-\x0D]"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _word_runs(solid: Column, min_words: int) -> Column:
    """array<struct<at, to>>: from each line with a word the shortest run of ``min_words`` words
    down, and the shortest one up.  ``solid`` holds (at, w) of the lines with a word."""
    def reach(lines):
        return F.aggregate(lines, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end")),
                           lambda a, x: F.when(a["sum"] >= min_words, a).otherwise(
                               F.struct((a["sum"] + x["w"]).alias("sum"), x["at"].alias("end"))))

    def span(at, to):
        return F.struct(at.cast("int").alias("at"), to.cast("int").alias("to"))

    def both(x, i):
        down = reach(F.slice(solid, i + 1, F.lit(min_words)))
        up = reach(F.reverse(F.slice(solid, F.greatest(i + 2 - min_words, F.lit(1)), F.least(i + 1, F.lit(min_words)))))
        wide = F.concat(_let(down, lambda r: F.when(r["sum"] >= min_words, F.array(span(x["at"], r["end"]))).otherwise(F.array())),
                        _let(up, lambda r: F.when(r["sum"] >= min_words, F.array(span(r["end"], x["at"]))).otherwise(F.array())))
        return F.when(x["w"] >= min_words, F.array(span(x["at"], x["at"]))).otherwise(wide)

    return F.flatten(F.transform(solid, both))


def _line_runs(words: Column, window: int, min_words: int | None) -> Column:
    """array<struct<at, to>> of the runs of ``window`` lines with two or more with a word, without
    those that two word runs one line shorter make up."""
    def sum_of(part):
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def fits(s):
        w = F.slice(words, s, F.lit(window))
        ok = F.size(F.filter(w, lambda x: x > 0)) >= 2
        if min_words is None:
            return ok
        made = (F.forall(w, lambda x: x > 0) & (sum_of(F.slice(w, 1, window - 1)) >= min_words)
                & (sum_of(F.slice(w, 2, window - 1)) >= min_words))
        return ok & ~made

    n = F.size(words) - (window - 1)
    starts = F.when(n >= 1, F.filter(F.sequence(F.lit(1), n), fits)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.struct(s.alias("at"), (s + (window - 1)).alias("to")))


def _runs(lines: Column, window: int, min_words: int | None) -> Column:
    """array<struct<at, to, fp, run>> of a text's runs that count."""
    def spans(words):
        by_lines = _line_runs(words, window, min_words)
        if min_words is None:
            return by_lines
        solid = F.filter(F.transform(words, lambda w, i: F.struct((i + 1).alias("at"), w.alias("w"))), lambda x: x["w"] > 0)
        return F.array_union(_let(solid, lambda s: _word_runs(s, min_words)), by_lines)

    def hashed(h, r):
        part = F.slice(h, r["at"], r["to"] - r["at"] + 1)
        return F.struct(r["at"].alias("at"), r["to"].alias("to"), F.array_min(part).alias("fp"), F.xxhash64(part).alias("run"))

    words = F.transform(lines, lambda x: F.regexp_count(x, F.lit(HAS_WORD + "+")))
    hashes = F.transform(lines, lambda x: F.xxhash64(x))
    return _let(hashes, lambda h: F.transform(_let(words, spans), lambda r: hashed(h, r)))


def repeated_lines(docs: DataFrame, window: int = WINDOW, min_words: int | None = None) -> DataFrame:
    """(_id, _th, _text) documents to one row per document that has repeated runs: ``gone``, the
    sorted numbers of the lines inside them."""
    src = docs.select("_id", "_th", "_text").where(F.col("_text").isNotNull())
    if min_words is None:
        src = src.where(F.contains("_text", F.lit("\n")))
    rows = (src.select("_id", "_th", F.explode(_let(F.split("_text", "\n"), lambda x: _runs(x, window, min_words))).alias("w"))
            .select("_id", "_th", "w.at", "w.to", "w.fp", "w.run"))
    key = ["fp", "run"]
    first = (rows.groupBy(*key)
             .agg(F.min(F.struct("_id", "_th", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(*key, "first"))
    span = lambda x: F.sequence(x["at"], x["to"])
    return (rows.join(first, key).where(F.struct("_id", "_th", "at") != F.col("first"))
            .groupBy("_id", "_th").agg(F.collect_set(F.struct("at", "to")).alias("_w"))
            .select("_id", "_th", F.array_sort(F.array_distinct(F.flatten(F.transform("_w", span)))).alias("gone")))


def _without(lines: Column, gone: Column) -> Column:
    """The stretches of lines between the (sorted) gone ones."""
    def stretches(x, cuts):
        def one(k):
            after = F.element_at(cuts, k)
            return F.slice(x, after + 1, F.element_at(cuts, k + 1) - after - 1)
        return F.flatten(F.transform(F.sequence(F.lit(1), F.size(cuts) - 1), one))

    return _let(lines, lambda x: _let(F.concat(F.array(F.lit(0)), gone, F.array(F.size(x) + 1)), lambda c: stretches(x, c)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                window: int = WINDOW, min_words: int | None = None) -> DataFrame:
    """All input columns with the text rewritten, plus ``n_lines`` and ``n_removed``."""
    names = docs.columns
    src = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), docs[id_col].alias("_id"),
                      docs[text_col].alias("_text"), F.xxhash64(docs[text_col]).alias("_th"))
    gone = repeated_lines(src, window, min_words).withColumnsRenamed({"_id": "_fid", "_th": "_fth"})
    joined = src.join(gone, src["_id"].eqNullSafe(gone["_fid"]) & (src["_th"] == gone["_fth"]), "left")
    out = joined.withColumn("_left", F.when(F.col("gone").isNotNull(), _without(F.split("_text", "\n"), F.col("gone"))))
    text = F.when(F.col("_left").isNull(), F.col("_text")).otherwise(F.array_join("_left", "\n"))
    n = F.when(F.col("_text").isNull(), F.lit(0)).otherwise(
        F.length("_text") - F.length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1).cast("long")
    removed = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long")
    return out.select(*[(text if c == text_col else F.col("_row")[c]).alias(c) for c in names],
                      n.alias("n_lines"), removed.alias("n_removed"))


def oracle_sql(window: int = WINDOW) -> str:
    """DuckDB SQL of the digest: runs compared as text, without fingerprints."""
    return f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
win AS (SELECT doc_id, u.i AS st, list_slice(l, u.i, u.i + {window - 1}) AS run
        FROM d, unnest(range(1, len(l) - {window - 2})) AS u(i)),
ok AS (SELECT * FROM win
       WHERE len(list_filter(run, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) >= 2),
pos AS (SELECT doc_id, st, row_number() OVER (PARTITION BY run ORDER BY doc_id, st) AS k FROM ok),
gone AS (SELECT DISTINCT doc_id, st + o.i AS line FROM pos, unnest(range(0, {window})) AS o(i) WHERE k > 1),
lines AS (SELECT d.doc_id, u.i AS line, d.l[u.i] AS x FROM d, unnest(range(1, len(l) + 1)) AS u(i)),
kept AS (SELECT a.doc_id, string_agg(a.x, chr(10) ORDER BY a.line) AS text
         FROM lines a ANTI JOIN gone g ON a.doc_id = g.doc_id AND a.line = g.line GROUP BY a.doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.l), 0)::BIGINT AS n_lines, coalesce(cut.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)"""


def line_dedup_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_lines, n_removed and the digest of the kept text (null: empty)."""
    out = dedup_lines(docs.select("doc_id", "text"), window=window)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
