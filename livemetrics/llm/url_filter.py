"""Operator 10, URL filters (native): rules first, then a character language-model ratio.

Rules (host suffix, path prefix) decide where one fits; the longest wins.  The urls the
rules accept and reject train two smoothed variable-order Markov models of characters: the
probability of a character given the two before it, interpolated (Witten-Bell) with the one
before it and with single characters, so an unseen context falls back to a shorter one.  A
url no rule fits gets the difference of the two log-likelihoods per character, compared
with a threshold half-way between the mean differences of the accepted and rejected urls.
Every character of a url counts: the models give each trigram over ``ALPHABET`` a
probability, also one that no labelled url holds (its context's back-off).

Scale: models are counted from every distinct labelled url and aggregated map-side.  Urls
are folded to ``ALPHABET`` (other characters become one symbol), so the score table has
exactly ``len(ALPHABET)**3`` (about 70,000) rows whatever the input and is broadcast with that
proven bound.  A distinct url is scored once under the digest of its text, so its
trigrams are cut in one pass and carry no copy of it: time is linear in its length.  Scores
are joined back on the digest (AQE splits a repeated one).

Defined edge results: a null url, or one without ``://``, has an empty host and path and no
rule; it is scored like any text (null: no score) and allowed when it has no score or no
model exists (no url accepted or none rejected).  An empty url is scored by its end symbol;
very long urls are read whole.  A score equal to the threshold is allowed; of two rules of
one length that fit, the alphabetically last wins.  Repeated rows are all returned; a null
``page_id`` is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from livemetrics.llm.common import lower_ascii


class UrlRule(NamedTuple):
    verdict: str                             # allow or block
    rule: str                                # host/path, e.g. "net/es/"

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


RULES = (UrlRule("allow", "com/"), UrlRule("block", "example.com/en/"), UrlRule("allow", "www.example.com/en/"),
         UrlRule("block", "net/es/"), UrlRule("block", "net/fr/"))

#: Symbols of the models: digits fold to 0, anything else to ~; ^ starts and $ ends a url.
ALPHABET = "^$abcdefghijklmnopqrstuvwxyz0/.:-_?&=#%+~"


def url_host(url: Column) -> Column:
    """A-Z lower-cased text between the first ``://`` and the next ``/``, ``?`` or ``#``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules: Sequence[UrlRule] = RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.rule), r.rule)):          # the longest ends outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, F.lit(r.rule)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def folded(url: Column) -> Column:
    """The url over ``ALPHABET``, with two start symbols and one end symbol."""
    c = F.regexp_replace(lower_ascii(url), "[0-9]", "0")
    c = F.regexp_replace(c, r"[^a-z0/.:\-_?&=#%+]", "~")
    return F.concat(F.lit("^^"), c, F.lit("$"))


def _grams(urls: DataFrame, key: str) -> DataFrame:
    """``(key, gram)``: one row per character of each folded url, the trigram that ends there."""
    grams = F.regexp_extract_all(folded(F.col("url")), F.lit("(?=(.{3}))"), F.lit(1))
    return urls.select(key, F.explode(grams).alias("gram"))


def _all_grams(spark: SparkSession) -> DataFrame:
    """``(label, gram)``: every trigram over ``ALPHABET`` under both labels."""
    k, at = len(ALPHABET), F.col("id")
    char = lambda i: F.substring(F.lit(ALPHABET), (i % k + 1).cast("int"), F.lit(1))
    gram = F.concat(char(F.floor(at / (k * k))), char(F.floor(at / k)), char(at))
    return spark.range(k ** 3).select(F.explode(F.array(F.lit("allow"), F.lit("block"))).alias("label"), gram.alias("gram"))


def char_models(labelled: DataFrame) -> DataFrame:
    """``(label, url)`` rows to ``(label, gram, p)``: the smoothed probability of every trigram over
    ``ALPHABET`` under both labels (``2 * len(ALPHABET)**3`` rows)."""
    counts = _grams(labelled, "label").groupBy("label", "gram").agg(F.count(F.lit(1)).alias("n"))
    x = F.col("gram")
    m = (_all_grams(labelled.sparkSession).join(counts, ["label", "gram"], "left")
         .select("label", "gram", F.coalesce("n", F.lit(0)).alias("n"), F.substring(x, 1, 2).alias("c2"),
                 F.substring(x, 2, 2).alias("t2"), F.substring(x, 2, 1).alias("c1"), F.substring(x, 3, 1).alias("c0")))
    w = lambda *k: W.partitionBy("label", *k)
    m = (m.withColumn("n2", F.sum("n").over(w("c2")))
          .withColumn("f2", F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).over(w("c2")))
          .withColumn("nt", F.sum("n").over(w("t2")))
          .withColumn("n1", F.sum("n").over(w("c1")))
          .withColumn("f1", F.size(F.collect_set(F.when(F.col("n") > 0, F.col("c0"))).over(w("c1"))))
          .withColumn("n0", F.sum("n").over(w("c0")))
          .withColumn("all", F.sum("n").over(w())))
    p0 = (F.col("n0") + 1) / (F.col("all") + F.lit(len(ALPHABET)))
    p1 = F.when(F.col("n1") > 0, (F.col("nt") + F.col("f1") * p0) / (F.col("n1") + F.col("f1"))).otherwise(p0)
    p2 = F.when(F.col("n2") > 0, (F.col("n") + F.col("f2") * p1) / (F.col("n2") + F.col("f2"))).otherwise(p1)
    return m.select("label", "gram", p2.alias("p"))


def log_ratio(labelled: DataFrame, urls: DataFrame, key: str = "url") -> DataFrame:
    """Distinct ``(key, url)`` rows to ``(key, score)``: mean log-likelihood difference per character,
    over all characters of the url and its end symbol."""
    models = (char_models(labelled).groupBy("gram")
              .agg(F.sum(F.when(F.col("label") == "allow", F.log("p")).otherwise(-F.log("p"))).alias("d")))
    return (_grams(urls, key).join(F.broadcast(models), "gram").groupBy(key)
            .agg((F.sum("d") / F.count(F.lit(1))).alias("score")))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """One row per input row: page_id, url, host, path, rule, verdict and the model's score."""
    src = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    judged = (src.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url")),
                               "_key": F.sha2(F.col("url"), 256)})
              .withColumns({"rule": rule, "by_rule": verdict}))
    distinct = judged.where(F.col("url").isNotNull()).select("_key", "url", "by_rule").distinct()
    labelled = distinct.where(F.col("by_rule").isNotNull()).select(F.col("by_rule").alias("label"), "_key", "url")
    scores = log_ratio(labelled, distinct, "_key")
    side = scores.join(labelled.drop("url"), "_key").groupBy("label").agg(F.avg("score").alias("mean"))
    # one row per label: the threshold is a scalar subquery, half-way between the two means
    threshold = side.agg(F.when(F.count("mean") == 2, F.avg("mean")).alias("t")).scalar()
    by_model = F.when(F.col("score") < threshold, "block").otherwise("allow")
    return (judged.join(scores, "_key", "left")
            .select("page_id", "url", "host", "path", "rule",
                    F.coalesce("by_rule", by_model).alias("verdict"), "score"))


def oracle_sql(rules: Sequence[UrlRule] = RULES) -> str:
    """DuckDB SQL of page_id, host, path, rule and verdict: the same rules and models."""
    up = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = lambda c: f"translate({c}, '{up}', '{up.lower()}')"
    values = ", ".join(f"('{r.verdict}', '{r.rule}', '{r.host}', '{r.path}')" for r in rules)
    fold = (f"'^^' || regexp_replace(regexp_replace({low('url')}, '[0-9]', '0', 'g'), "
            r"'[^a-z0/.:\-_?&=#%+]', '~', 'g') || '$'")
    return rf"""
WITH rules(verdict, rule, rhost, rpath) AS (VALUES {values}),
p AS (SELECT page_id, url, coalesce({low("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
j AS (SELECT p.*, (SELECT arg_max(rule, length(rule)) FROM rules
                   WHERE (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)) AS rule FROM p),
k AS (SELECT j.*, r.verdict AS by_rule FROM j LEFT JOIN rules r USING (rule)),
u AS (SELECT DISTINCT url, by_rule, {fold} AS s FROM k WHERE url IS NOT NULL),
g AS (SELECT url, by_rule AS label, substr(s, i, 3) AS gram FROM u, unnest(range(1, length(s) - 1)) t(i)),
seen AS (SELECT label, gram, count(*) AS n FROM g WHERE label IS NOT NULL GROUP BY ALL),
alpha AS (SELECT substr('{ALPHABET}', i, 1) AS c FROM range(1, {len(ALPHABET) + 1}) t(i)),
every AS (SELECT a.c || b.c || c.c AS gram FROM alpha a, alpha b, alpha c),
cell AS (SELECT l.label, x.gram, coalesce(seen.n, 0) AS n, substr(x.gram, 1, 2) AS c2, substr(x.gram, 2, 2) AS t2,
                substr(x.gram, 2, 1) AS c1, substr(x.gram, 3, 1) AS c0
         FROM every x CROSS JOIN (VALUES ('allow'), ('block')) l(label)
         LEFT JOIN seen ON seen.label = l.label AND seen.gram = x.gram),
m0 AS (SELECT label, c0, sum(n) AS n0 FROM cell GROUP BY ALL),
m1 AS (SELECT label, c1, sum(n) AS n1, count(DISTINCT c0) FILTER (n > 0) AS f1 FROM cell GROUP BY ALL),
mt AS (SELECT label, t2, sum(n) AS nt FROM cell GROUP BY ALL),
m2 AS (SELECT label, c2, sum(n) AS n2, count(*) FILTER (n > 0) AS f2 FROM cell GROUP BY ALL),
ma AS (SELECT label, sum(n) AS na FROM cell GROUP BY ALL),
q0 AS (SELECT *, (n0 + 1) / (na + {len(ALPHABET)}) AS p0 FROM cell JOIN m0 USING (label, c0) JOIN m1 USING (label, c1)
       JOIN mt USING (label, t2) JOIN m2 USING (label, c2) JOIN ma USING (label)),
q1 AS (SELECT *, if(n1 > 0, (nt + f1 * p0) / (n1 + f1), p0) AS p1 FROM q0),
q2 AS (SELECT gram, label, if(n2 > 0, (n + f2 * p1) / (n2 + f2), p1) AS p2 FROM q1),
d AS (SELECT gram, sum(if(label = 'allow', ln(p2), -ln(p2))) AS d FROM q2 GROUP BY gram),
sc AS (SELECT url, sum(d) / count(*) AS score FROM g JOIN d USING (gram) GROUP BY url),
side AS (SELECT by_rule, avg(score) AS mean FROM u JOIN sc USING (url) WHERE by_rule IS NOT NULL GROUP BY by_rule),
cut AS (SELECT if(count(mean) = 2, avg(mean), NULL) AS t FROM side)
SELECT page_id, host, path, rule,
       coalesce(by_rule, if(score < (SELECT t FROM cut), 'block', 'allow')) AS verdict
FROM k LEFT JOIN sc USING (url)"""
