"""Operator 1, quality rules: repetition coverage.

Rolling hashes of several n-gram lengths, all in numpy over Arrow batches, measure which
characters of a text lie inside duplicated n-grams and duplicated lines.  A document is one
row and never meets another, so the plan is a single scan without a shuffle and any row can
be recomputed after a lost executor.

Measures (shares of the code points inside words):

* ``top_{n}gram`` for short ``n``: characters of all occurrences of the n-gram that covers
  the most characters, if it occurs at least twice;
* ``dup_{n}gram`` for longer ``n``: characters covered by n-grams that occurred earlier in
  the text (each character counted once);
* ``dup_line``: characters in lines equal to an earlier line.

Windows of ``n`` words can only repeat where their first ``n-1`` words repeat, so each
length looks at the survivors of the shorter one only.

Defined edge results: a null or empty text, or one without words, has zero counts and
``base_failed``; repeated rows give repeated results; a null ``doc_id`` is kept; other
input columns are ignored, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from livemetrics.llm import textvec as tv
from livemetrics.llm.common import map_arrow


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the shares above; a text over any limit is not kept."""
    top: dict[int, float] = field(default_factory=lambda: {2: 0.25, 3: 0.22, 4: 0.20})
    dup: dict[int, float] = field(default_factory=lambda: {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15})
    dup_line: float = 0.25
    min_words: int = 50
    max_repeat_percent: int = 50


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, dup_line_share double, top_share double, dup_share double, "
          "failed_rule string")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(x) for x in "#*$%&|<>"]] = True


def _groups(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``h`` with equal values together and the starts of their runs."""
    order = np.argsort(h)
    s = h[order]
    new = np.ones(len(s), dtype=bool)
    np.not_equal(s[1:], s[:-1], out=new[1:])
    return order, np.flatnonzero(new)


def _later(order: np.ndarray, run: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Members of ``order`` that are not the first of their run in input order."""
    first = np.minimum.reduceat(order, run)
    return order[order != np.repeat(first, size)]


def _covered(starts: np.ndarray, n: int, m: int) -> np.ndarray:
    """Mask over ``m`` words covered by windows of ``n`` words at ``starts``."""
    d = np.zeros(m + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + n, m), -1)
    return np.cumsum(d[:-1]) > 0


def _measure(h: np.ndarray, chars: np.ndarray, rules: RepetitionRules) -> tuple[int, float, float, str | None]:
    """(words in repeated 3-word windows, largest top share, largest dup share, first rule broken)."""
    m = len(h)
    total = int(chars.sum())
    repeat_words, top, dup, failed = 0, 0.0, 0.0, None
    if m < 2 or total == 0:
        return repeat_words, top, dup, failed
    cum = np.concatenate([[0], np.cumsum(chars)])
    at = np.arange(m)                                  # window starts whose shorter window repeats
    acc = h.copy()                                     # hash of the current window at each start
    for n in range(2, max([3, *rules.top, *rules.dup]) + 1):
        fits = at + n <= m
        at, acc = at[fits], acc[fits]
        if not len(at):
            break
        acc = tv.mix64(acc * tv.U64(0xD6E8FEB86659FD93) + h[at + n - 1])
        order, run = _groups(acc)
        size = np.diff(np.append(run, len(order)))
        many = np.repeat(size > 1, size)
        if n == 3:
            repeat_words = int(_covered(at[order[many]], 3, m).sum())
        limit = rules.top.get(n)
        if limit is not None and (size > 1).any():
            first = at[order[run]]
            share = float(((cum[first + n] - cum[first]) * size)[size > 1].max()) / total
            top = max(top, share)
            if share > limit and failed is None:
                failed = f"top_{n}gram"
        limit = rules.dup.get(n)
        if limit is not None and many.any():
            share = float(chars[_covered(at[_later(order, run, size)], n, m)].sum()) / total
            dup = max(dup, share)
            if share > limit and failed is None:
                failed = f"dup_{n}gram"
        keep = np.sort(order[many])
        at, acc = at[keep], acc[keep]
        if not len(at):
            break
    return repeat_words, top, dup, failed


def _lines(data: np.ndarray, sums: np.ndarray, word_start: np.ndarray, is_char: np.ndarray,
           a: int, b: int) -> tuple[int, int]:
    """(lines with a word that equal an earlier line, word characters in them) of bytes [a, b)."""
    cut = np.flatnonzero(data[a:b] == 10) + a
    if not len(cut):
        return 0, 0
    start = np.concatenate([[a], cut + 1])
    end = np.concatenate([cut, [b]])
    has = np.searchsorted(word_start, end) > np.searchsorted(word_start, start)
    start, end = start[has], end[has]
    if len(start) < 2:
        return 0, 0
    order, run = _groups(tv.span_hash(sums, start, end))
    d = _later(order, run, np.diff(np.append(run, len(order))))
    return len(d), int(sum(int(is_char[start[i]:end[i]].sum()) for i in d))


def repetition_batches(batches, rules: RepetitionRules):
    """Arrow batches of (doc_id, text) to batches of ``SCHEMA``."""
    for batch in batches:
        out: list[tuple] = []
        for c in tv.chunks(batch.column(1)):
            sums = tv.prefix_hash(c.data)
            w = tv.words(c, sums=sums)
            word_byte = tv._WS[c.data]
            is_char = word_byte & ((c.data & 0xC0) != 0x80)
            cum = np.concatenate([[0], np.cumsum(is_char)])
            chars = cum[w.end] - cum[w.start]
            sym = np.concatenate([[0], np.cumsum(_SYMBOL[c.data])])
            for r in range(len(c.offsets) - 1):
                a, b = int(c.offsets[r]), int(c.offsets[r + 1])
                i, j = int(w.first[r]), int(w.first[r + 1])
                n, wc = j - i, int(cum[b] - cum[a])
                rep, top, dup, failed = _measure(w.hash[i:j], chars[i:j], rules)
                lines, line_chars = _lines(c.data, sums, w.start[i:j], is_char, a, b)
                share = line_chars / wc if wc else 0.0
                if share > rules.dup_line:
                    failed = failed or "dup_line"
                base = n < rules.min_words or 100 * rep > rules.max_repeat_percent * n
                out.append((n, wc, int(sym[b] - sym[a]), lines, rep, base, not base and failed is None,
                            share, top, dup, failed))
        cols = list(zip(*out)) if out else [[] for _ in range(11)]
        types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), *[pa.array(x, t) for x, t in zip(cols, types)]],
            names=[x.split()[0] for x in SCHEMA.split(", ")])


def repetition_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """One row per input row with the counts, shares, first broken rule and the verdict."""
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return map_arrow(src, lambda it: repetition_batches(it, rules), SCHEMA)


def oracle_sql(rules: RepetitionRules = RepetitionRules()) -> str:
    """DuckDB SQL of the same rows, from the words themselves (for tables of modest size)."""
    lengths = sorted({3, *rules.top, *rules.dup})
    limit = lambda d: " ".join(f"WHEN {n} THEN {v}" for n, v in d.items())
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
size AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM d),
line AS (SELECT doc_id, u.i, string_split(t, chr(10))[u.i] AS x
         FROM d, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS u(i)),
again AS (SELECT doc_id, x FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
          QUALIFY row_number() OVER (PARTITION BY doc_id, x ORDER BY i) > 1),
lines AS (SELECT doc_id, count(*) AS n, sum(list_sum(list_transform(
              regexp_extract_all(x, '[^\x20\x09-\x0D]+'), lambda y: length(y)))) AS chars FROM again GROUP BY doc_id),
gram AS (SELECT doc_id, k.n, u.i, array_to_string(list_slice(w, u.i, u.i + k.n - 1), ' ') AS g
         FROM d, (VALUES {", ".join(f"({n})" for n in lengths)}) AS k(n), unnest(range(1, len(w) - k.n + 2)) AS u(i)),
many AS (SELECT *, count(*) OVER same AS times, min(i) OVER same AS head FROM gram
         WINDOW same AS (PARTITION BY doc_id, n, g) QUALIFY times > 1),
top AS (SELECT doc_id, n, max((length(g) - n + 1) * times) AS chars FROM many GROUP BY ALL),
later AS (SELECT DISTINCT doc_id, n, i + o.k AS p FROM many, unnest(range(0, n)) AS o(k) WHERE i > head),
dup AS (SELECT doc_id, n, sum(length(w[p])) AS chars FROM later JOIN d USING (doc_id) GROUP BY ALL),
thrice AS (SELECT doc_id, count(DISTINCT i + o.k) AS n FROM many, unnest(range(0, 3)) AS o(k) WHERE many.n = 3 GROUP BY doc_id),
share AS (
  SELECT doc_id, n, 'top_' || n || 'gram' AS rule, 'top' AS kind, chars / word_chars AS s, CASE n {limit(rules.top)} END AS cap
  FROM top JOIN size USING (doc_id)
  UNION ALL
  SELECT doc_id, n, 'dup_' || n || 'gram', 'dup', chars / word_chars, CASE n {limit(rules.dup)} END FROM dup JOIN size USING (doc_id)
  UNION ALL
  SELECT doc_id, 99, 'dup_line', 'line', chars / word_chars, {rules.dup_line} FROM lines JOIN size USING (doc_id)),
verdict AS (
  SELECT doc_id, max(s) FILTER (kind = 'top') AS top_share, max(s) FILTER (kind = 'dup') AS dup_share,
         max(s) FILTER (kind = 'line') AS dup_line_share, arg_min(rule, n) FILTER (s > cap) AS failed_rule
  FROM share WHERE cap IS NOT NULL GROUP BY doc_id),
f AS (SELECT *, n_words < {rules.min_words} OR 100 * coalesce(thrice.n, 0) > {rules.max_repeat_percent} * n_words AS base_failed
      FROM size LEFT JOIN thrice USING (doc_id))
SELECT f.doc_id, n_words, word_chars, n_symbols, coalesce(lines.n, 0) AS n_dup_lines, coalesce(f.n, 0) AS n_repeat_words,
       base_failed, NOT base_failed AND failed_rule IS NULL AS kept, coalesce(dup_line_share, 0.0) AS dup_line_share,
       coalesce(top_share, 0.0) AS top_share, coalesce(dup_share, 0.0) AS dup_share, failed_rule
FROM f LEFT JOIN lines USING (doc_id) LEFT JOIN verdict USING (doc_id)"""
