"""Operator 4, language ID: nearest centroid over TF-IDF character n-grams.

Each text becomes one normalised TF-IDF vector of hashed character n-grams (1 to 3
characters of lower-cased letters, word boundaries kept) over the whole text.  Training
clusters the vectors of each language into several centroids (spherical k-means, seeded by
distance, without clusters of a few odd texts); a text gets the language of the centroid with
the largest cosine, over all languages.  A text whose best cosine is below the rejection
line of its length is flagged ``rejected``.  The line of a length (letters, by powers of
two) is a share of a low quantile of the cosines that training texts kept out of the clustering,
and their beginnings of that length, reach; a shorter text never has a higher line.

Training rows: at most ``LangModel.per_language`` documents of each language, those with
the smallest hash of the id among the training fold (labelled, with a letter,
``crc32(id) % folds != 0``); nothing is read from other rows, their labels neither.  That bound is
the documented parameter of the classifier sample; only its hashed vectors
(``per_language * dims`` small floats per language, compressed) reach the driver, never texts.
Languages are taken from the labels, at most ``max_languages`` of them (more raise an error,
nothing is dropped silently).  The fitted model (centroids and IDF) is a few hundred kB and is
sent to the tasks; prediction is one scan without a shuffle.

Defined edge results: null text or a text without a letter: ``und``, score 0, rejected; no
training rows at all: every prediction is ``und``; very long texts are read whole; repeated
rows give repeated results, and of an id repeated in the training fold under one language the
smallest text is learned; a tie of cosines goes to the alphabetically first language; a null id
counts as held out of nothing (its crc32 is null) and is not learned from; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from livemetrics.llm import textvec as tv
from livemetrics.llm.common import map_arrow

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"


@dataclass(frozen=True)
class LangModel:
    dims: int = 4096                         # hashed n-gram space
    centroids: int = 4                       # clusters per language
    per_language: int = 400                  # bound of the labelled sample
    max_languages: int = 256
    folds: int = 5                           # remainder 0 is held out
    reject_quantile: float = 0.001
    reject_slack: float = 0.5                # rejection below slack * that quantile
    calibration: int = 5                     # one in so many sampled texts calibrates the rejection only
    rounds: int = 12
    restarts: int = 8
    smallest: float = 0.25                   # least size of a cluster, in shares of an even split


#: Lengths of the beginnings of calibration texts, in characters; rejection lines go by the
#: power of two of a text's letters, the last for all longer texts.
PIECES = (4, 8, 16, 32, 64, 128, 256, 512)
LENGTHS = 12


def _has_letter(text: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False), bool)


# Bytes of letters: ASCII letters and all of a multi-byte character; the rest are boundaries.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def term_counts(c: tv.Chunk, dims: int) -> np.ndarray:
    """(rows, dims) sublinear counts of hashed n-grams of each text of a chunk.

    N-grams run over bytes of the lower-cased text with every run of non-letters folded to
    one boundary, so an accented letter (two bytes) is told apart from its neighbours.
    """
    low = tv._LOWER[c.data]
    letter = _LETTER[low]
    x = np.where(letter, low, np.uint8(32)).astype(np.uint32)
    n, rows = len(x), len(c.offsets) - 1
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(c.offsets))
    first = np.zeros(n, bool)
    first[c.offsets[:-1][c.offsets[:-1] < n]] = True
    keep = letter.copy()                      # letters and the first boundary after each run
    keep[1:] |= letter[:-1] & ~first[1:]
    x, row = x[keep], row[keep]
    out = np.zeros((rows, dims), dtype=np.float32)
    if not len(x):
        return out
    flat = out.reshape(-1)
    gram = np.zeros(len(x), np.uint32)
    for k in (1, 2, 3):
        m = len(x) - k + 1
        if m <= 0:
            break
        gram = gram[:m] * np.uint32(257) + x[k - 1:]
        h = (gram * np.uint32(2654435761)) ^ np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        slot = ((h >> np.uint32(7)) % np.uint32(dims)).astype(np.int64)
        inside = row[:m] == row[k - 1:]
        flat += np.bincount(row[:m][inside] * dims + slot[inside], minlength=len(flat)).astype(np.float32)
    return np.log1p(out)


def _small_chunks(col: pa.Array, rows: int):
    """Chunks bounded by bytes and by rows, so the dense count matrix stays small."""
    for i in range(0, len(col), rows):
        for c in tv.chunks(col.slice(i, rows)):
            yield c._replace(first=c.first + i)


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 0, n, 1)


def letter_bytes(c: tv.Chunk) -> np.ndarray:
    """Bytes of letters of each text of a chunk."""
    upto = np.concatenate([[0], np.cumsum(_LETTER[c.data])])
    return upto[c.offsets[1:]] - upto[c.offsets[:-1]]


def length_class(letters: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(letters, 1)).astype(np.int64), LENGTHS - 1)


def _rounds(x: np.ndarray, c: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from the directions ``c``: (centroids, sizes)."""
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = _unit(np.stack([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))]))
    return c, np.bincount(np.argmax(x @ c.T, axis=1), minlength=len(c))


def _cluster(x: np.ndarray, p: LangModel) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, sizes) of one language.  Seeds are drawn with a chance in proportion to their distance from
    the seeds so far (fixed generator); of several starts the one with the most clusters of a
    fair size, then the closest, stays, and its smaller clusters join the others."""
    rng, best = np.random.default_rng(p.centroids), None
    for _ in range(p.restarts):
        seeds = [int(rng.integers(len(x)))]
        for _ in range(min(p.centroids, len(x)) - 1):
            far = np.clip(1.0 - (x @ x[seeds].T).max(axis=1), 0, None).astype(np.float64)
            far[far < 1e-6] = 0
            if not far.any():
                break
            seeds.append(int(rng.choice(len(x), p=far / far.sum())))
        c, n = _rounds(x, x[seeds], p.rounds)
        fair = n >= p.smallest * len(x) / p.centroids
        rank = (int(fair.sum()), float((x @ c.T).max(axis=1).sum()))
        if best is None or rank > best[0]:
            best = rank, c, fair
    return _rounds(x, best[1][best[2]], p.rounds)


@dataclass(frozen=True)
class FittedLanguages:
    langs: list[str]                         # language of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    reject_below: np.ndarray                 # cosine by length class
    sizes: np.ndarray                        # training texts of each centroid

    def scores(self, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the best centroid, its cosine) of every row."""
        cos = _unit(tf * self.idf) @ self.centroids.T
        best = np.argmax(cos, axis=1)
        return best, cos[np.arange(len(cos)), best]


def no_languages(p: LangModel) -> FittedLanguages:
    return FittedLanguages([], np.zeros((0, p.dims), np.float32), np.ones(p.dims, np.float32), np.zeros(LENGTHS),
                           np.zeros(0, np.int64))


def training_fold(docs: DataFrame, id_col: str, text_col: str, lang_col: str, p: LangModel) -> DataFrame:
    """(_k, lang, text) of the rows that may be learned from: labelled, with a letter, not held out."""
    src = docs.select(docs[id_col].cast("string").alias("_k"), docs[lang_col].alias("lang"), docs[text_col].alias("text"))
    return src.where(F.col("lang").isNotNull() & (F.pmod(F.crc32("_k"), F.lit(p.folds)) != 0)
                     & F.col("text").rlike(r"\p{L}"))


def training_sample(train: DataFrame, ids: dict[str, int], p: LangModel) -> DataFrame:
    """(lang, text, calibrates) of the bounded labelled sample, one row per id and language.

    Each language first keeps the ids whose hash is under a threshold that leaves about four
    times the wanted number (from its count of different ids in the training fold), so the ranking
    moves a bounded number of ids whatever the table's size; texts join the chosen ids.
    """
    share = F.create_map(*[F.lit(x) for k, n in sorted(ids.items()) for x in (k, min(1.0, 4.0 * p.per_language / n + 1e-9))])
    unit = (F.xxhash64("_k").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("_k"), "_k"))
    chosen = (train.where(unit <= F.element_at(share, F.col("lang"))).select("lang", "_k").distinct()
              .withColumn("_r", rank).where(F.col("_r") <= p.per_language)
              .select("lang", "_k", (F.col("_r") % p.calibration == 0).alias("calibrates")))
    # at most per_language * max_languages ids
    return (train.join(F.broadcast(chosen), ["lang", "_k"]).groupBy("lang", "_k", "calibrates")
            .agg(F.min("text").alias("text")).select("lang", "text", "calibrates"))


def rejection_lines(letters: np.ndarray, cos: np.ndarray, p: LangModel) -> np.ndarray:
    """Cosine below which a text of each length class is rejected."""
    at = length_class(letters)
    line = np.array([np.quantile(cos[at == j], p.reject_quantile) if (at == j).any() else np.inf for j in range(LENGTHS)])
    line = np.minimum.accumulate(line[::-1])[::-1]             # no higher line for a shorter text
    known = line[np.isfinite(line)]
    return np.where(np.isfinite(line), line, known[-1] if len(known) else 0.0) * p.reject_slack


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  p: LangModel = LangModel()) -> FittedLanguages:
    train = training_fold(docs, id_col, text_col, lang_col, p)
    langs = train.groupBy("lang").agg(F.approx_count_distinct("_k").alias("n")).limit(p.max_languages + 1).collect()
    if len(langs) > p.max_languages:
        raise ValueError(f"more than {p.max_languages} languages")
    if not langs:
        return no_languages(p)
    ids = {r["lang"]: max(r["n"], 1) for r in langs}

    def featurise(batches):
        for b in batches:
            lang, text, cal = b.column(0), b.column(1), b.column(2)
            held = text.filter(cal)
            parts = [(lang.filter(pc.invert(cal)), text.filter(pc.invert(cal)), False), (lang.filter(cal), held, True)]
            parts += [(lang.filter(cal), pc.utf8_slice_codeunits(held, 0, n), True) for n in PIECES]
            for names, texts, calibrates in parts:
                for c in _small_chunks(texts, 512):
                    tf = term_counts(c, p.dims).astype(np.float16)
                    letters = letter_bytes(c)
                    use = letters > 0
                    yield pa.RecordBatch.from_arrays(
                        [names.slice(c.first, len(tf)).filter(pa.array(use)), pa.array(np.full(use.sum(), calibrates)),
                         pa.array(letters[use].astype(np.int64)),
                         pa.array([zlib.compress(v.tobytes(), 1) for v in tf[use]], pa.binary())],
                        names=["lang", "calibrates", "letters", "tf"])

    rows = map_arrow(training_sample(train, ids, p), featurise,
                     "lang string, calibrates boolean, letters long, tf binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["calibrates"], bytes(r["tf"])))
    if not any(not r["calibrates"] for r in rows):
        return no_languages(p)
    tf = np.stack([np.frombuffer(zlib.decompress(r["tf"]), np.float16) for r in rows]).astype(np.float32)
    cal = np.array([r["calibrates"] for r in rows])
    lang = np.array([r["lang"] for r in rows])
    letters = np.array([r["letters"] for r in rows])
    learned = ~cal
    idf = (np.log((1 + learned.sum()) / (1 + (tf[learned] > 0).sum(axis=0))) + 1).astype(np.float32)
    x = _unit(tf * idf)
    names, cents, sizes = [], [], []
    for name in sorted(set(lang[learned].tolist())):
        c, n = _cluster(x[learned & (lang == name)], p)
        cents.append(c)
        sizes.append(n)
        names += [name] * len(c)
    cents = np.concatenate(cents).astype(np.float32)
    judged = cal if cal.any() else learned
    lines = rejection_lines(letters[judged], (x[judged] @ cents.T).max(axis=1), p)
    return FittedLanguages(names, cents, idf, lines, np.concatenate(sizes))


def predict_languages(docs: DataFrame, model: FittedLanguages, id_col: str = "doc_id", text_col: str = "text",
                      p: LangModel = LangModel()) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, rejected.  Inputs of a
    prediction: the text only."""
    k = docs[id_col]
    src = docs.select(k.cast("long").alias("doc_id"), docs[text_col].alias("text"),
                      F.coalesce(F.pmod(F.crc32(k.cast("string")), F.lit(p.folds)) == 0, F.lit(False)).alias("held_out"))
    return map_arrow(src, _predictor(model, p), SCHEMA)


def _predictor(model: FittedLanguages, p: LangModel):
    shared = _shared(model)

    def run(batches):
        m = shared()
        for b in batches:
            pred, score, rej = classify(b.column(1), m, p)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pred, score, rej],
                                             names=["doc_id", "held_out", "lang_pred", "score", "rejected"])
    return run


def _shared(model: FittedLanguages):
    """One copy of the bounded model per executor instead of one per task."""
    bc = SparkSession.getActiveSession().sparkContext.broadcast(model)
    return lambda: bc.value


def classify(texts: pa.Array, m: FittedLanguages, p: LangModel = LangModel()) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(language, score, rejected) arrays of a text column."""
    ok = _has_letter(texts)
    lang = np.full(len(ok), "und", dtype=object)
    score, line = np.zeros(len(ok)), np.zeros(len(ok))
    if m.langs:
        names = np.array(m.langs, dtype=object)
        for c in _small_chunks(texts, 512):
            best, cos = m.scores(term_counts(c, p.dims))
            at = slice(c.first, c.first + len(best))
            lang[at] = np.where(ok[at], names[best], "und")
            score[at] = np.where(ok[at], np.clip(cos, 0.0, 1.0), 0.0)
            line[at] = m.reject_below[length_class(letter_bytes(c))]
    rejected = ~ok | (lang == "und") | (score < line)
    return pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       p: LangModel = LangModel()) -> DataFrame:
    """Fit on the labelled training fold of ``docs`` and predict every row."""
    return predict_languages(docs, fit_languages(docs, id_col, text_col, lang_col, p), id_col, text_col, p)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    p: LangModel = LangModel()) -> DataFrame:
    """Rows whose language is not rejected, with exactly the input's columns."""
    shared = _shared(fit_languages(docs, id_col, text_col, lang_col, p))
    at = docs.columns.index(text_col)

    def run(batches):
        m = shared()
        for b in batches:
            yield b.filter(pc.invert(classify(b.column(at), m, p)[2]))

    return map_arrow(docs, run, docs.schema)
