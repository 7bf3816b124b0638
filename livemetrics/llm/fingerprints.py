"""Operator 12, document fingerprints (native): one-permutation MinHash with optimal densification.

A document is the set of its five-word shingles (words ``[^\\x20\\x09-\\x0D]+``, lower-cased; with fewer
words the whole sequence is one).  Every shingle is hashed once; the top 8 bits are its bin, and a bin
keeps the smallest hash.  An empty bin takes over the value of a filled one: the first filled bin in
a random order of its own, which is optimal densification, every empty bin choosing independently.  The
order starts with ``PROBES`` bins drawn by a fixed rule, so a document with many filled bins needs
few steps; then all bins follow by ``xxhash64(empty, filled)``.  The fingerprint packs the ``BITS`` low-order bits of
the ``BINS`` values as hex digits (128 bytes whatever the document's length); two fingerprints agree by
chance in 2**-BITS of their bins, which ``likeness`` corrects.

Plan, all built-in functions: fingerprints are computed where texts are scanned, and only (id,
fingerprint) is dealt out to find each document's successor (``operators/ordered.py``: no global window).
For the edited texts a text is shuffled once by its document, and the piece its predecessor takes, at
most a third of the predecessor's length, once more.  Documents are joined by (id, two 64-bit hashes of the
text), so ids may repeat.

Defined edge results: a null text is empty; a text without words has the empty set, whose
fingerprint is the empty string, 1 like another one and 0 like any other; null ids come last in descending
order; rows of equal ids are ordered by their text's hashes, and among rows of equal id and text all but
one have their own copy as the next document; a single document is its own successor; texts of any
length are read whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livemetrics.llm.common import WORD, written
from livemetrics.operators.ordered import ordered_parts, running

WORDS = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 4                                     # stored per bin: one hex digit
PROBES = 16
LOW = (1 << (64 - BIN_BITS)) - 1             # what is no bin number in a hash


def shingle_hashes(text: Column) -> Column:
    """array<long> of a text's shingles (repeats included), 64 bits each."""
    words = F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0)),
                        lambda w: F.xxhash64(w))

    def cut(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - WORDS)
        return (F.when(F.size(w) >= WORDS, F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)])))
                .when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")))

    return F.element_at(F.transform(F.array(words), cut), 1)     # the word hashes are computed once


def bin_minima(hashes: Column) -> Column:
    """The ``BINS`` bins in order, each its smallest hash or, if empty, a mark whose low bits are all set.
    The marks join the hashes, so after sorting every bin is a run that starts with its value."""
    marks = F.transform(F.sequence(F.lit(-BINS // 2), F.lit(BINS // 2 - 1)),
                        lambda i: F.shiftleft(i.cast("long"), 64 - BIN_BITS).bitwiseOR(F.lit(LOW)))
    starts = lambda s: F.filter(s, lambda x, i: (i == 0) | (
        F.shiftright(x, 64 - BIN_BITS) != F.shiftright(F.get(s, i - 1), 64 - BIN_BITS)))
    return F.element_at(F.transform(F.array(F.sort_array(F.concat(hashes, marks))), starts), 1)


def _is_mark(x: Column) -> Column:
    return x.bitwiseAND(F.lit(LOW)) == LOW


def probes(number: int) -> list[int]:
    """The places an empty bin looks at first, in order: the first bytes of a hash of its number."""
    return list(hashlib.sha256(bytes([number])).digest()[:PROBES])


def densified(bins: Column) -> Column:
    """The ``BITS`` low bits of every bin, empty ones filled from the filled ones; no bin filled: empty."""
    low = (1 << BITS) - 1
    table = F.expr("array(" + ",".join(str(b) for i in range(BINS) for b in probes(i)) + ")")

    def fill(vals: Column) -> Column:        # the values in bin order, null in empty bins
        filled = F.filter(bins, lambda y: ~_is_mark(y))

        def choose(i: Column) -> Column:     # the order of the filled bins that belongs to this empty one
            number = (i - BINS // 2).cast("long")
            return F.array_min(F.transform(filled, lambda y: F.xxhash64(number, F.shiftright(y, 64 - BIN_BITS))
                                           .bitwiseAND(F.lit(~low)).bitwiseOR(y.bitwiseAND(F.lit(low))))).bitwiseAND(F.lit(low))

        def each(x: Column, i: Column) -> Column:
            looks = [F.get(vals, F.get(table, i * PROBES + a)) for a in range(PROBES)]
            return F.coalesce(x, *looks, choose(i))

        n = F.size(F.array_compact(vals))
        return F.when(n == BINS, vals).when(n > 0, F.transform(vals, each)).otherwise(F.array().cast("array<bigint>"))

    values = F.transform(bins, lambda x: F.when(~_is_mark(x), x.bitwiseAND(F.lit(low))))
    return F.element_at(F.transform(F.array(values), fill), 1)


def fingerprint(text: Column) -> Column:
    """The packed fingerprint of a text as a hex string of ``BINS`` digits, or the empty string."""
    bins = F.transform(F.array(bin_minima(shingle_hashes(text))), densified)
    digits = F.transform(F.element_at(bins, 1), lambda v: F.hex(v))
    return F.lower(F.array_join(digits, ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity (0 to 1) of two fingerprints: the share of agreeing bins, less what agrees by
    chance.  32 bits at a time: digits that differ leave a bit in their lowest place.  Both fingerprints are
    bound to a name first: each use of a column repeats its whole expression in the plan."""
    step = 8

    def of(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]

        def differing(acc: Column, at: Column) -> Column:
            x, y = (F.conv(F.substring(c, at, F.lit(step)), 16, 10).cast("long") for c in (a, b))
            d = x.bitwiseXOR(y)
            d = d.bitwiseOR(F.shiftright(d, 1))
            d = d.bitwiseOR(F.shiftright(d, 2))  # any of a digit's four bits is in its lowest one now
            return acc + F.bit_count(d.bitwiseAND(F.lit(0x11111111)))

        same = F.lit(BINS) - F.aggregate(F.sequence(F.lit(1), F.lit(BINS), F.lit(step)), F.lit(0), differing)
        chance = 2.0 ** -BITS
        corrected = F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance))
        return F.when((a == "") | (b == ""), F.when(a == b, 1.0).otherwise(0.0)).when(a == b, 1.0).otherwise(corrected)

    return F.element_at(F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))), of), 1)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].alias("id"), text.alias("text"), F.xxhash64(text).alias("t1"),
                       F.xxhash64(F.lit(1), text).alias("t2"))


KEY = ["has_id", "id0", "t1", "t2"]          # a document's key without nulls


def _named(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").isNotNull().alias("has_id"), F.coalesce("id", F.lit(0)).alias("id0"), "*")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t1, t2, n_chars, fingerprint), computed where the texts are scanned."""
    return _keyed(docs, id_col, text_col).select(
        "id", "t1", "t2", F.length("text").cast("long").alias("n_chars"), fingerprint(F.col("text")).alias("fingerprint"))


def successors(prints: DataFrame) -> DataFrame:
    """Per distinct document (by id and text) in descending order of id: its row, the successor's key and
    fingerprint (``n_...``), and the predecessor's key and need (``p_...``); the last one's is the first."""
    classes = _named(prints).groupBy(*KEY).agg(F.max("n_chars").alias("n_chars"), F.max("fingerprint").alias("fingerprint"))
    order = [F.col("has_id").desc(), F.col("id0").desc(), F.col("t1"), F.col("t2")]
    at = written(running(ordered_parts(classes, order, "print-order"), [], order, {"at": ("count", F.lit(1))},
                         totals={"n": ("count", F.lit(1))}), "print-at")
    need = F.floor(F.col("n_chars") / 3).cast("int")
    after = at.select(F.when(F.col("at") == 1, F.col("n")).otherwise(F.col("at") - 1).alias("at"),
                      F.col("fingerprint").alias("n_fingerprint"))
    ahead = at.select((F.col("at") % F.col("n") + 1).alias("at"), *[F.col(k).alias(f"p_{k}") for k in KEY], need.alias("p_need"))
    return written(at.join(after, "at").join(ahead, "at").drop("at", "n", "_part"), "print-next")


def edited_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's rows: every text and its edited text, whose last third comes from the next document."""
    prints = written(fingerprints(docs, id_col, text_col), "prints")
    # both uses of the texts read the same columns, so one exchange of them serves both
    texts = _named(_keyed(docs, id_col, text_col)).drop("id").join(successors(prints), KEY)
    texts = texts.withColumn("last", F.lag(F.lit(1)).over(Window.partitionBy(*KEY).orderBy("id0")).isNull())
    pieces = texts.where("last").select(*[F.col(f"p_{k}").alias(k) for k in KEY],
                                            F.substring("text", F.lit(1), F.col("p_need")).alias("piece"))
    both = texts.join(pieces, KEY)
    need = F.floor(F.col("n_chars") / 3).cast("int")
    last = F.col("last")                     # the copy that the next text follows; before it, the text follows itself
    taken = F.when(last, F.col("piece")).otherwise(F.substring("text", F.lit(1), need))
    edited = both.select(
        F.when(F.col("has_id"), F.col("id0")).alias("id"), "n_chars", "fingerprint",
        F.when(last, F.col("n_fingerprint")).otherwise(F.col("fingerprint")).alias("next"),
        F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - need).cast("int")), taken).alias("edited"))
    out = edited.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                        fingerprint(F.col("edited")).alias("edited_fingerprint"), "next")
    return out.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("next")).alias("near_next"))
