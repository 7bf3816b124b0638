"""Operator 2, mixing sources to target weights (native): raking, then calibrated sampling.

1. Tokens (white-space words) are summed per (source, lang, topic) cell, map-side first.
2. Iterative proportional fitting rakes a weight per cell until the token-weighted shares of
   every source, language and topic meet their targets.  Each sweep is one window sum per
   margin over the cell table, so no step needs the cells in one task and the number of
   sources is not limited.
3. A document is kept with probability ``min(1, scale * weight)``; ``scale`` is calibrated on
   the cells so that the expected tokens are ``keep_share`` of all tokens.  The draw is a
   hash of the id: repeatable, and independent of partitioning and retries.

Only the cell table is shuffled; documents meet their cell by a join that Spark broadcasts
when the table's size is under the session's threshold and otherwise shuffles with AQE skew
handling.  Targets default to the shares raised to ``temper`` (flatter than the data);
``targets`` gives explicit shares per margin value, others keep their tempered share.

Defined edge results: null source, lang or topic is a value like any other; a null or empty
text has 0 tokens, weighs nothing in the sums, and is sampled with its cell's probability (1
if the cell has no tokens); rows with the same id are kept or dropped together; a null id
draws like the text 'null'; an empty table gives an empty result; other columns are kept by
``sample_mixture`` under their own names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from livemetrics.llm.common import n_words, written

#: (topic, markers): the first topic one of whose markers occurs in the text, else "general".
TOPICS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("licence", ("licensed under", "License", "Copyright")),
    ("contact", ("@", "http://", "https://")),
    ("technical", ("###", "{", "token =")),
)
MARGINS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Mixture:
    temper: float = 0.5                      # default target: share ** temper, renormalised
    keep_share: float = 0.5                  # expected share of all tokens that is kept
    sweeps: int = 6                          # passes over all margins
    targets: Mapping[str, Mapping[str, float]] = field(default_factory=dict)


def topic_of(text: Column, topics: Sequence[tuple[str, tuple[str, ...]]] = TOPICS) -> Column:
    out = F.lit("general")
    for name, marks in reversed(topics):
        hit = F.lit(False)
        for m in marks:
            hit = hit | F.contains(text, F.lit(m))
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


def _target(margin: str, mix: Mixture) -> Column:
    """Unnormalised target of a margin value: the explicit share or the tempered one."""
    raw = F.pow(F.col(f"_{margin}_share"), F.lit(mix.temper))
    for value, share in mix.targets.get(margin, {}).items():
        raw = F.when(F.col(margin) == F.lit(value), F.lit(float(share))).otherwise(raw)
    return raw


def rake(cells: DataFrame, mix: Mixture = Mixture(), margins: Sequence[str] = MARGINS) -> DataFrame:
    """Cells ``(*margins, tokens)`` with the raked ``weight`` added (cells without tokens: null)."""
    total = cells.agg(F.sum("tokens").alias("t")).scalar()
    x = cells.where("tokens > 0").withColumn("_a", F.col("tokens") / total)
    norms = {}
    for m in margins:
        x = x.withColumn(f"_{m}_share", F.sum("_a").over(W.partitionBy(m)))
        per = x.groupBy(m).agg(F.first(f"_{m}_share").alias(f"_{m}_share"))
        norms[m] = per.agg(F.sum(_target(m, mix)).alias("n")).scalar()
    x = x.withColumn("_w", F.lit(1.0))
    for _ in range(mix.sweeps):
        for m in margins:
            now = F.sum(F.col("_a") * F.col("_w")).over(W.partitionBy(m))
            x = x.withColumn("_w", F.col("_w") * (_target(m, mix) / norms[m]) / now)
    return x.select(*margins, "tokens", F.col("_w").alias("weight"))


def calibrate(weighted: DataFrame, keep_share: float, steps: int = 40) -> float:
    """The scale with sum(tokens * min(1, scale * weight)) = keep_share * sum(tokens), by the
    monotone fixed point of 'cells at probability 1 are full, the rest share what is left'.
    Each step reads one aggregated row of the cell table."""
    scale = 0.0
    for _ in range(steps):
        full = F.col("weight") * F.lit(scale) >= 1
        r = weighted.agg(F.sum("tokens").alias("t"), F.sum(F.when(full, F.col("tokens"))).alias("f"),
                         F.sum(F.when(~full, F.col("tokens") * F.col("weight"))).alias("s")).first()
        if not r["t"] or not r["s"]:
            break
        new = max(0.0, keep_share * r["t"] - (r["f"] or 0)) / r["s"]
        if new <= scale:
            break
        scale = new
    return scale


def uniform_draw(key: Column) -> Column:
    """Repeatable uniform number in [0, 1) from 52 bits of the key's MD5."""
    h = F.md5(F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mixture_probabilities(docs: DataFrame, mix: Mixture = Mixture(), id_col: str = "doc_id",
                          text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """All input rows as ``_row`` struct with source, lang, topic, n_tokens, weight, probability
    and ``sampled``."""
    src = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs[id_col].alias("_id"),
                      docs[source_col].alias("source"), docs[lang_col].alias("lang"),
                      F.coalesce(topic_of(docs[text_col]), F.lit("general")).alias("topic"),
                      n_words(docs[text_col]).alias("n_tokens"))
    cells = src.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"))
    weighted = written(rake(written(cells, "mix-cells"), mix), "mix-weights")
    scale = calibrate(weighted, mix.keep_share)
    p = weighted.select(*[F.col(m).alias(f"_c_{m}") for m in MARGINS], "weight",
                        F.least(F.lit(1.0), F.col("weight") * F.lit(scale)).alias("_p"))
    on = [src[m].eqNullSafe(p[f"_c_{m}"]) for m in MARGINS]
    out = src.join(p, on, "left").withColumn("probability", F.coalesce("_p", F.lit(1.0)))
    return out.select("_row", "_id", *MARGINS, "n_tokens", "weight", "probability",
                      (uniform_draw(F.col("_id")) < F.col("probability")).alias("sampled"))


def sample_mixture(docs: DataFrame, mix: Mixture = Mixture(), **cols: str) -> DataFrame:
    """The sampled documents, with exactly the input's columns."""
    out = mixture_probabilities(docs, mix, **cols).where("sampled")
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def mixture_report(docs: DataFrame, mix: Mixture = Mixture()) -> DataFrame:
    """One row per document: its cell, tokens, probability (6 decimals) and decision."""
    out = mixture_probabilities(docs.select("doc_id", "text", "source", "lang"), mix)
    return out.select(F.col("_id").alias("doc_id"), *MARGINS, "n_tokens",
                      F.round("probability", 6).alias("probability"), "sampled")


def oracle_sql(mix: Mixture = Mixture(), steps: int = 12) -> str:
    """DuckDB SQL of the report: the same definition, sweep by sweep."""
    topic = "CASE " + " ".join(
        "WHEN " + " OR ".join(f"contains(text, '{m}')" for m in marks) + f" THEN '{name}'"
        for name, marks in TOPICS) + " ELSE 'general' END"
    q = [f"""WITH d AS (SELECT doc_id, source, lang, {topic} AS topic,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents),
c AS (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM d GROUP BY ALL HAVING sum(n_tokens) > 0),
a AS (SELECT *, tokens / sum(tokens) OVER () AS share FROM c)"""]
    for m in MARGINS:
        q.append(f"t_{m} AS (SELECT {m}, pow(sum(share), {mix.temper}) AS raw FROM a GROUP BY {m})")
        q.append(f"g_{m} AS (SELECT {m}, raw / (SELECT sum(raw) FROM t_{m}) AS goal FROM t_{m})")
    q.append("w0 AS (SELECT a.source, a.lang, a.topic, tokens, share, s.goal AS goal_source, l.goal AS goal_lang, "
             "p.goal AS goal_topic, 1.0::DOUBLE AS w FROM a JOIN g_source s USING (source) JOIN g_lang l USING (lang) "
             "JOIN g_topic p USING (topic))")
    k = 0
    for _ in range(mix.sweeps):
        for m in MARGINS:
            q.append(f"w{k + 1} AS (SELECT * REPLACE (w * goal_{m} / sum(share * w) OVER (PARTITION BY {m}) AS w) FROM w{k})")
            k += 1
    q.append("s0 AS (SELECT 0.0::DOUBLE AS scale)")
    for i in range(steps):
        q.append(f"s{i + 1} AS (SELECT greatest(any_value(scale), greatest(0, {mix.keep_share} * sum(tokens) "
                 f"- coalesce(sum(tokens) FILTER (w * scale >= 1), 0)) / sum(tokens * w) FILTER (w * scale < 1)) AS scale "
                 f"FROM w{k}, s{i})")
    q.append(f"p AS (SELECT source, lang, topic, least(1.0, w * scale) AS p FROM w{k}, s{steps})")
    return ",\n".join(q) + """
SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(p, 1.0), 6) AS probability,
       ('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < coalesce(p, 1.0) AS sampled
FROM d LEFT JOIN p USING (source, lang, topic)"""
