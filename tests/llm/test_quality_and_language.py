"""Operators 1 (repetition quality) and 4 (language ID)."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from livemetrics.llm.language_id import (
    LangModel, classify, fit_languages, identify_languages, keep_identified, training_fold, training_sample,
)
from livemetrics.llm.repetition import RepetitionRules, repetition_quality
from tests.llm.helpers import DOC_SCHEMA, docs_frame, edge_rows, prose, words


def base(t):
    w = words(t)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), dup, len(covered), failed)


def dup_share(t, n):
    """Characters inside n-grams that occurred earlier, over word characters."""
    w, seen, cov = words(t), set(), set()
    for i in range(len(w) - n + 1):
        g = tuple(w[i:i + n])
        if g in seen:
            cov |= set(range(i, i + n))
        seen.add(g)
    return sum(len(w[i]) for i in cov) / max(1, sum(map(len, w)))


def top_share(t, n):
    w = words(t)
    c = collections.Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    return max([sum(map(len, g)) * k for g, k in c.items() if k > 1], default=0) / max(1, sum(map(len, w)))


def test_base_counts_on_edges(spark):
    rows = edge_rows() + [(20, "# a | b\nsame line\nsame line\n same line"), (21, "a b c a b c x a b"), (22, "née " * 60)]
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in repetition_quality(docs_frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(r[0], *base(r[1])) for r in rows], key=repr)


def test_method_verdict_matches_definition(spark):
    para = prose(1, 40)
    rows = [(1, prose(2, 200)), (2, para + " " + prose(3, 120) + " " + para), (3, prose(4, 100) + " hey you" * 30),
            (4, "\n".join([prose(5, 30)] * 2 + [prose(6, 60)]))]
    rules = RepetitionRules()
    for r, (_, t) in zip(sorted(repetition_quality(docs_frame(spark, rows)).collect()), rows):
        tops = {n: top_share(t, n) for n in rules.top}
        dups = {n: dup_share(t, n) for n in rules.dup}
        assert r.dup_share == pytest.approx(max(dups.values()))
        bad = any(tops[n] > v for n, v in rules.top.items()) or any(dups[n] > v for n, v in rules.dup.items()) \
            or r.dup_line_share > rules.dup_line
        assert r.kept == (not r.base_failed and not bad)
    assert [r.kept for r in sorted(repetition_quality(docs_frame(spark, rows)).collect())] == [True, False, False, False]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert repetition_quality(empty).count() == 0
    assert identify_languages(empty).count() == 0
    assert keep_identified(empty).columns == empty.columns


def language_rows():
    vocab = {"aa": ["the", "and", "thing", "with", "other", "house"], "bb": ["der", "und", "nicht", "straße", "größe", "ein"],
             "cc": ["été", "où", "français", "leçon", "garçon", "être"]}
    rows, k = [], 0
    for i in range(120):
        for lang, v in vocab.items():
            rows.append((k, " ".join(v[(i * 7 + j * (1 + i % 5)) % len(v)] for j in range(3 + i % 20)), lang))
            k += 1
    return rows


def test_held_out_accuracy_and_edges(spark):
    rows = language_rows()
    extra = [(-1, None, "aa"), (-2, "", "bb"), (-3, "12 ?!", "cc"), (None, "the and thing", None), (-4, "the and thing " * 9000, None)]
    out = identify_languages(docs_frame(spark, rows + extra)).collect()
    assert len(out) == len(rows) + len(extra)
    want = {r[0]: r[2] for r in rows}
    held = [r for r in out if r.doc_id in want and r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert sum(r.lang_pred == want[r.doc_id] for r in held) / len(held) >= 0.98
    by = {r.doc_id: r for r in out}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 and by[k].rejected for k in (-1, -2, -3))
    assert by[None].lang_pred == by[-4].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in out)


def test_prediction_ignores_label_source_and_id(spark):
    rows = language_rows()
    probe = [(10_000 + i, rows[i][1], "zz", "other") for i in range(9)]       # ids of the same fold rule, wrong labels
    held = [p for p in probe if zlib.crc32(str(p[0]).encode()) % 5 == 0]
    out = {r.doc_id: r for r in identify_languages(docs_frame(spark, rows + held)).collect()}
    for p in held:
        assert out[p[0]].lang_pred == rows[p[0] - 10_000][2]


def test_rejection_and_pipeline_form(spark):
    rows = language_rows() + [(9000, "1234 5678", "aa"), (9001, None, None)]
    df = docs_frame(spark, rows)
    kept = keep_identified(df)
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {r[0] for r in language_rows()}


def test_no_labels_and_too_many(spark):
    none = docs_frame(spark, [(1, "some words", None), (2, "more words", None)])
    assert {r.lang_pred for r in identify_languages(none).collect()} == {"und"}
    with pytest.raises(ValueError):
        identify_languages(docs_frame(spark, [(i, "w", f"l{i}") for i in range(5)]), p=LangModel(max_languages=3))


def training_ids(keep, n, start=0):
    """``n`` ids from ``start`` on whose fold is (not) the held-out one."""
    out, i = [], start
    while len(out) < n:
        if (zlib.crc32(str(i).encode()) % 5 != 0) == keep:
            out.append(i)
        i += 1
    return out


def test_sample_counts_usable_rows_of_the_training_fold_only(spark):
    """Null texts, held-out rows and repeats of an id neither thin the sample nor enter it."""
    p = LangModel(per_language=20)
    usable = training_ids(True, 30)
    rows = [(i, f"mot {i} leçon", "cc") for i in usable]
    rows += [(i, None, "cc") for i in training_ids(True, 6000, 1000)] + [(i, "held words", "cc") for i in training_ids(False, 3000, 1000)]
    rows += [(i, "held words", "held") for i in training_ids(False, 5, 50_000)]
    rows += [(usable[0], f"same id {j}", "dd") for j in range(3000)] + [(None, "no id", "dd")]
    train = training_fold(docs_frame(spark, rows), "doc_id", "text", "lang", p)
    ids = {r.lang: r.n for r in train.groupBy("lang").agg(F.approx_count_distinct("_k").alias("n")).collect()}
    assert set(ids) == {"cc", "dd"}
    got = training_sample(train, ids, p).collect()
    assert sum(r.lang == "cc" for r in got) == 20
    assert [(r.text) for r in got if r.lang == "dd"] == ["same id 0"]
    assert sum(r.calibrates for r in got if r.lang == "cc") == 4


def test_clusters_of_a_fair_size_and_lines_by_length(spark):
    m = fit_languages(docs_frame(spark, language_rows()))
    p = LangModel()
    for name in ("aa", "bb", "cc"):
        sizes = [n for lang, n in zip(m.langs, m.sizes) if lang == name]
        assert len(sizes) > 1 and min(sizes) >= p.smallest * sum(sizes) / p.centroids
    assert (np.diff(m.reject_below) >= 0).all()


def test_short_clean_texts_stay_and_foreign_ones_go(spark):
    m = fit_languages(docs_frame(spark, language_rows()))
    clean = ["the", "house", "und", "straße", "leçon", "thing and thing", "Other, house!", "été " * 300]
    foreign = ["погода и природа сегодня " * 8, "日本語の文章です。" * 9, "xqzj wvkq zzxq jjwq kxzv " * 12]
    assert classify(pa.array(clean), m)[2].to_pylist() == [False] * len(clean)
    assert classify(pa.array(foreign), m)[2].to_pylist() == [True] * len(foreign)


def brute_grams(text):
    """Sublinear counts of byte n-grams by hashed slot, one text and one gram at a time."""
    letters = set(b"abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    x = []
    for b in data:
        if b in letters:
            x.append(b)
        elif x and x[-1] != 32:
            x.append(32)
    n = collections.Counter()
    for k in (1, 2, 3):
        for i in range(len(x) - k + 1):
            g = 0
            for b in x[i:i + k]:
                g = (g * 257 + b) % 2**32
            h = (g * 2654435761 % 2**32) ^ (k * 0x9E3779B1 % 2**32)
            h = (h ^ (h >> 15)) * 0x85EBCA6B % 2**32
            n[(h >> 7) % 4096] += 1
    return {slot: math.log1p(c) for slot, c in n.items()}


def test_predictions_match_brute_force(spark):
    """Nearest centroid by cosine, one text at a time from the fitted centroids."""
    m = fit_languages(docs_frame(spark, language_rows()))
    texts = [r[1] for r in language_rows()[::7]] + ["a", "Zz 9 é", "--the--", "straße/ÉTÉ\nhouse" * 50]
    lang, score, _ = classify(pa.array(texts), m)
    for t, got, cos in zip(texts, lang.to_pylist(), score.to_pylist()):
        v = {k: c * float(m.idf[k]) for k, c in brute_grams(t).items()}
        norm = math.sqrt(sum(c * c for c in v.values()))
        sims = [sum(c * float(center[k]) for k, c in v.items()) / norm for center in m.centroids]
        assert cos == pytest.approx(max(0.0, max(sims)), abs=1e-4)
        assert max(s for s, name in zip(sims, m.langs) if name == got) == pytest.approx(max(sims), abs=1e-4)
